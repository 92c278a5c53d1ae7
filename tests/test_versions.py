"""Publications: all or nothing, old ones readable, several writers, expiry."""

import os

import pytest

from fieldbalance.session import new_shared_path
from fieldbalance.sources import versions


@pytest.fixture
def path(spark):
    return new_shared_path(spark, "versions-test")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_failed_write_leaves_the_last_version(spark, path):
    versions.publish_versioned(spark.range(3), path)
    broken = spark.range(9).selectExpr("assert_true(id < 5) IS NULL AS ok", "id")
    with pytest.raises(Exception):
        versions.publish_versioned(broken, path)
    assert ids(versions.read_version(spark, path)) == [0, 1, 2]
    assert versions.versions(spark, path) == [1]


def test_tables_of_a_draft_appear_together(spark, path):
    for n in (2, 4):
        draft = versions.Draft(spark, path)
        one = draft.write(spark.range(n), "one")
        if n == 4:  # written, not shown
            assert ids(versions.read_version(spark, path, "one")) == [0, 1]
        draft.write(one.selectExpr("id + 10 AS id", "id % 2 AS odd"), "two", partition_by=["odd"])
        assert draft.commit() == n // 2
    assert ids(versions.read_version(spark, path, "one")) == [0, 1, 2, 3]
    assert ids(versions.read_version(spark, path, "two")) == [10, 11, 12, 13]
    assert ids(versions.read_version(spark, path, "two", version=1)) == [10, 11]
    with pytest.raises(ValueError, match="no table"):
        versions.read_version(spark, path, "three")


def test_a_reader_keeps_its_version(spark, path):
    versions.publish_versioned(spark.range(3), path)
    reading = versions.read_version(spark, path)
    versions.publish_versioned(spark.range(5), path)
    assert reading.count() == 3 and versions.read_version(spark, path).count() == 5


def test_two_writers_take_two_numbers(spark, path):
    drafts = [versions.Draft(spark, path) for _ in range(2)]
    for n, draft in enumerate(drafts, start=1):
        draft.write(spark.range(n))
    files = versions._Files(spark, path)
    assert drafts[0].commit() == 1
    assert not files.create("_versions/1.json", "{}")  # taken: never overwritten
    assert drafts[1].commit() == 2


def test_half_written_manifest_is_no_version(spark, path):
    versions.publish_versioned(spark.range(2), path)
    versions._Files(spark, path).create("_versions/2.json", '{"tables": {"ta')
    assert ids(versions.read_version(spark, path)) == [0, 1]
    assert versions.publish_versioned(spark.range(1), path) == 3


def test_expiry_keeps_the_newest_and_what_is_under_way(spark, path):
    for n in range(1, 5):
        versions.publish_versioned(spark.range(n), path)
    versions.Draft(spark, path).write(spark.range(7))
    assert versions.expire_versions(spark, path, keep=2) == [1, 2]
    assert versions.versions(spark, path) == [3, 4] and len(os.listdir(f"{path}/_data")) == 3
    versions.expire_versions(spark, path, keep=2, unfinished_after_s=-5)
    assert len(os.listdir(f"{path}/_data")) == 2
    assert ids(versions.read_version(spark, path, version=3)) == [0, 1, 2]
    with pytest.raises(ValueError):
        versions.expire_versions(spark, path, keep=0)


def test_nothing_to_publish(spark, path):
    with pytest.raises(ValueError):
        versions.publish_versioned(None, path)
    with pytest.raises(ValueError):
        versions.Draft(spark, path).commit()
    with pytest.raises(ValueError, match="no published version"):
        versions.read_version(spark, path)
