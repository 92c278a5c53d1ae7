"""Publishing without a moment in which readers see half a result.

Every publication writes its tables into folders of its own and then one small
manifest that names them. A reader takes the newest complete manifest, so it sees
all tables of one publication or all of another; a job that fails before its
manifest changes nothing for readers. Manifests are numbered and are never
overwritten: of two writers that finish at once, one takes the next number.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_MANIFESTS, _DATA = "_versions", "_data"


class _Files:
    """The few file operations a manifest needs, on whatever store the path names."""

    def __init__(self, spark: SparkSession, base: str):
        self.jvm = spark._jvm
        self.base = base.rstrip("/")
        conf = spark._jsc.hadoopConfiguration()
        self.store = self._path("").getFileSystem(conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def names(self, folder: str) -> list[tuple[str, int]]:
        """Names and modification times (ms) in a folder, none if it is not there."""
        if not self.store.exists(self._path(folder)):
            return []
        return [(s.getPath().getName(), s.getModificationTime())
                for s in self.store.listStatus(self._path(folder))]

    def create(self, name: str, text: str) -> bool:
        """Write a new file; False if it is already there."""
        try:
            out = self.store.create(self._path(name), False)
        except Py4JJavaError:
            if self.store.exists(self._path(name)):
                return False
            raise
        out.write(text.encode("utf-8"))
        out.close()
        return True

    def read(self, name: str) -> str:
        stream = self.store.open(self._path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self.store.delete(self._path(name), True)


def _manifest(files: _Files, number: int) -> dict | None:
    """A manifest's content; None while it is still being written."""
    try:
        return json.loads(files.read(f"{_MANIFESTS}/{number}.json"))
    except ValueError:
        return None


def _numbers(files: _Files) -> list[int]:
    return sorted(int(name[:-5]) for name, _ in files.names(_MANIFESTS)
                  if name.endswith(".json") and name[:-5].isdigit())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete publications below a path, oldest first."""
    files = _Files(spark, path)
    return [n for n in _numbers(files) if _manifest(files, n) is not None]


@dataclass
class Draft:
    """A publication under way: tables written, and not yet shown to anybody."""

    spark: SparkSession
    path: str
    folder: str = field(default_factory=lambda: uuid.uuid4().hex)
    tables: dict[str, str] = field(default_factory=dict)

    def write(self, df: DataFrame, name: str = "table",
              partition_by: list[str] | None = None) -> DataFrame:
        """Write one table and read it back, for later tables to build on."""
        if df is None:
            raise ValueError("nothing to publish")
        if name in self.tables:
            raise ValueError(f"table {name!r} is already part of this publication")
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        place = f"{_DATA}/{self.folder}/{name}"
        writer.parquet(f"{self.path.rstrip('/')}/{place}")
        self.tables[name] = place
        return self.spark.read.schema(df.schema).parquet(f"{self.path.rstrip('/')}/{place}")

    def commit(self) -> int:
        """Show the written tables to readers, all at once; the number of the version."""
        if not self.tables:
            raise ValueError("nothing to publish")
        files = _Files(self.spark, self.path)
        text = json.dumps({"tables": self.tables, "at": int(time.time())})
        number = max(_numbers(files), default=0) + 1
        while not files.create(f"{_MANIFESTS}/{number}.json", text):
            number += 1
        return number


def publish_versioned(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Publish one table as a new version; readers of the old one are not disturbed."""
    if df is None:
        raise ValueError("nothing to publish")
    draft = Draft(df.sparkSession, path)
    draft.write(df, partition_by=partition_by)
    return draft.commit()


def read_version(spark: SparkSession, path: str, name: str = "table",
                 version: int | None = None) -> DataFrame:
    """A table of the newest publication, or of a numbered one."""
    files = _Files(spark, path)
    numbers = _numbers(files) if version is None else [version]
    for number in reversed(numbers):
        found = _manifest(files, number) if number in _numbers(files) else None
        if found is not None:
            if name not in found["tables"]:
                raise ValueError(f"version {number} has no table {name!r}")
            return spark.read.parquet(f"{path.rstrip('/')}/{found['tables'][name]}")
    raise ValueError(f"no published version below {path}")


def expire_versions(spark: SparkSession, path: str, keep: int = 2,
                    unfinished_after_s: float = 86_400) -> list[int]:
    """Delete all but the newest ``keep`` publications; returns their numbers.

    Manifests go before their data. Folders no manifest names belong to jobs that
    failed or still run; they go once they are older than ``unfinished_after_s``.
    """
    if keep < 1:
        raise ValueError("the newest version stays")
    files = _Files(spark, path)
    complete = {n: m for n in _numbers(files) if (m := _manifest(files, n)) is not None}
    gone = sorted(complete)[:-keep]
    for number in gone:
        files.remove(f"{_MANIFESTS}/{number}.json")
    held = {place.split("/")[1] for n, m in complete.items() if n not in gone
            for place in m["tables"].values()}
    dropped = {place.split("/")[1] for n in gone for place in complete[n]["tables"].values()}
    limit = (time.time() - unfinished_after_s) * 1000
    for folder, changed in files.names(_DATA):
        if folder not in held and (folder in dropped or changed < limit):
            files.remove(f"{_DATA}/{folder}")
    return gone
