"""Spelling variants, exact duplicates and whitening against brute force and SQL."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from fieldbalance.llm import exact_dedup, spelling, whitening

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows(sf_dir, name):
    return duckdb.sql(f"select * from '{sf_dir}/{name}.parquet'").df()


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)


# Spelling variants

def brute_words(docs, thin=31, least=7):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % thin == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= least and k >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute_variants(words, ratio=10):
    """Words that agree after one deletion or at one blanked place; then the definition itself."""
    spots = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            spots[w[:i] + "\0" + w[i + 1:]].add(w)
            spots[w[:i] + w[i + 1:]].add(w)
        spots[w].add(w)
    beside = defaultdict(set)
    for group in spots.values():
        for a in group:
            beside[a] |= {b for b in group if b != a and near(a, b)}
    forms = {}
    for w, n in words.items():
        best = min(beside[w], key=lambda b: (-words[b], b), default=None)
        forms[w] = best if best is not None and words[best] >= ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, len(beside[w]), words.get(forms[w])))
    return sorted(out, key=repr)


def test_spelling_equals_brute_force_over_the_table(spark, sf_dir):
    docs = rows(sf_dir, "documents")
    want = brute_variants(brute_words(zip(docs.doc_id, docs.text)))
    got = spelling.op11_spelling(spark, sf_dir)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert collected(got) == want
    assert any(r[1] for r in want)


@pytest.mark.parametrize("extended", [1, 40, 1 << 16])
def test_pairs_do_not_depend_on_the_dictionary(spark, extended):
    """Words over two letters share nearly all grams; edits fall on every place of short and long words."""
    rng = np.random.default_rng(3)
    words = {"".join(rng.choice(list("ab"), int(rng.integers(7, 11)))) for _ in range(200)}
    base = "abcdefghijklm" * 3
    words |= {base, base[1:], base[:-1], base + "x", "x" + base, base[:20] + "é" + base[21:], base[:20] + base[21:],
              "a" * 7, "a" * 8, "a" * 9, "b" + "a" * 7, "v" * 5000, "v" * 4999 + "w"}
    df = spark.createDataFrame([(w, 2) for w in sorted(words)], "word string, n long")
    got = {frozenset((r.a, r.b)) for r in spelling.near_pairs(df, extended=extended).collect()}
    assert got == {frozenset((a, b)) for a in words for b in words if a < b and near(a, b)}


def test_chains_ties_and_odd_rows_of_spelling(spark):
    words = {"abcdefgh": 10_000, "abcdefgx": 900, "abcdefxx": 80, "abcdefxxx": 8, "bbcdefgh": 10_000, "cbcdefgh": 9,
             "lonelyword": 3}
    df = spark.createDataFrame([(w, n, 1) for w, n in words.items()] + [(None, 5, 1)], "word string, n long, key int")
    assert collected(spelling.variants(df)) == brute_variants(words)
    got = {r.word: r for r in spelling.variants(df).collect()}
    assert got["abcdefxxx"].root == "abcdefgh" and got["cbcdefgh"].form == "abcdefgh"
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).count() == 0


def test_runs_of_odd_texts(spark):
    long = "Straßenübergang " * 3000 + "Z" * 60_000
    data = [(1, None), (2, ""), (None, "Abcdefghi abcdefghi"), (3, long), (4, "ÀBCDEFGH÷x àbcdefgh÷x 12345678 kurz"),
            (5, long), (5, long)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, 1) for i, t in data], DOCS + ", word int")
    got = {r.word: r.n for r in spelling.run_counts(docs).where("n >= 2").collect()}
    assert got == brute_words(data)
    assert spelling.run_counts(docs.limit(0)).count() == 0


# Exact duplicates

def brute_groups(docs):
    norm = ["".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r") for _, text in docs]
    groups = defaultdict(list)
    for i, key in enumerate(norm):
        groups[key].append(i)
    out = []
    for i, (doc_id, _) in enumerate(docs):
        same = groups[norm[i]]
        first = min(same, key=lambda j: (-len(docs[j][1] or ""), docs[j][0] is None, docs[j][0] or 0, j))
        out.append((doc_id, docs[first][0], len(same), i == first, hashlib.sha256(norm[i].encode()).hexdigest()))
    return sorted(out, key=repr)


ODD = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "one two"), (5, "onetwo"), (6, "o ne two"), (7, "one two"),
       (8, "é" * 9), (9, "é" * 9), (10, "x" * 300 + "a"), (11, "x" * 300 + "b"), (12, "x " * 300 + "a"),
       (13, "y" * 400_000), (13, "y" * 400_000), (None, "null id"), (None, "nullid"), (14, "nul lid")]


@pytest.mark.parametrize("prefix,words", [(256, 1 << 17), (1, 1), (4, 2)])
def test_exact_groups_equal_brute_force(spark, prefix, words):
    docs = spark.createDataFrame([(i, t, "en", None, 0, 1, 2) for i, t in ODD], DOCS + ", kept int, full int")
    docs = docs.withColumn("text_sha256", exact_dedup.F.sha2(exact_dedup.normalised("text"), 256))
    got = exact_dedup.exact_groups(docs.coalesce(1), carry=["text_sha256"], prefix=prefix, filter_words=words)
    assert collected(got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")) == brute_groups(ODD)


def test_deduplicated_keeps_whole_rows(spark):
    docs = spark.createDataFrame([(i, t, "en", None, 0, 1, 2, 3) for i, t in ODD],
                                 DOCS + ", kept int, full int, whole int")
    got = exact_dedup.deduplicated(docs)
    assert got.columns == docs.columns
    want = [r for r in brute_groups(ODD) if r[3]]
    assert sorted(map(repr, (r.doc_id for r in got.collect()))) == sorted(repr(r[0]) for r in want)
    assert exact_dedup.deduplicated(docs.limit(0)).count() == 0


def test_exact_dedup_equals_its_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    want = con.execute(exact_dedup.OP12_SQL).fetchall()
    assert collected(exact_dedup.op12_exact_dedup(spark, sf_dir)) == sorted(want, key=repr)
    docs = rows(sf_dir, "documents")
    assert sorted(want, key=repr) == brute_groups(list(zip(docs.doc_id, docs.text)))


# Whitening

def reference(x, m=8):
    y = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(y.T @ y / len(x))
    return values[::-1][:m], vectors[:, ::-1][:, :m], values.sum(), y


def test_whitening_equals_a_dense_solution(spark, sf_dir):
    data = rows(sf_dir, "embeddings")
    x = np.floor(1024 * np.array(data.embedding.tolist(), np.float64)) + 100_000
    values, vectors, trace, y = reference(x)
    want = y @ vectors / np.sqrt(values)
    got = whitening.op13_whitening(spark, sf_dir).toPandas().sort_values(["vec_id", "component"])
    assert len(got) == 8 * len(data) and (got.n == len(data)).all()
    wide = got.whitened.to_numpy().reshape(-1, 8)
    want = want[np.argsort(data.vec_id.to_numpy())]
    wide = wide * np.sign((wide * want).sum(axis=0))
    assert np.abs(wide - want).max() < 1e-8
    assert np.allclose(got.explained.to_numpy()[:8], values / trace, rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9
    s = x.astype(int).sum(axis=0)
    exact = {v: sum((len(x) * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for v, row in zip(data.vec_id, x)}
    assert dict(zip(got.vec_id, got.deviation)) == exact


def test_whitening_converges_on_close_eigenvalues(spark):
    rng = np.random.default_rng(5)
    c = rng.standard_normal((3000, 80)) * np.linspace(1.2, 1.0, 80)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(c)], "vec_id long, embedding array<double>")
    vectors = whitening.integer_vectors(df.repartition(6), "vec_id", "embedding").cache()
    found = whitening.fit(vectors)
    values, wanted, trace, _ = reference(np.floor(1024 * c) + 100_000)
    assert found.residual < 1e-12 and np.allclose(found.values, values, rtol=1e-12)
    assert np.abs(np.abs((found.vectors * wanted).sum(axis=0)) - 1).max() < 1e-10


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    schema = "vec_id long, embedding array<float>, component int, x int"

    def run(data):
        return whitening.whiten(spark.createDataFrame([(i, v, 1, 2) for i, v in data], schema)).collect()

    good = [(1, [0.1, 0.2, 0.5]), (2, [0.4, -0.2, 0.1]), (2, [0.4, -0.2, 0.1]), (None, [0.0, 0.3, 0.9])]
    bad = [(5, None), (6, []), (7, [1.0, None, 2.0]), (8, [nan, 0.0, 0.0]), (9, [inf, 0.0, 0.0]), (10, [1e30, 0.0, 0.0]),
           (11, [1.0, 2.0])]
    got = run(good + bad)
    assert {r.vec_id for r in got} == {1, 2, None} and {r.n for r in got} == {4}
    assert {r.component for r in got} == {1, 2} and len(got) == 8  # three points span two directions
    assert {r.identity_error < 1e-9 for r in got} == {True}
    assert run([]) == [] and run(bad) == [] or {r.vec_id for r in run(bad)} <= {11}
    assert run([(1, [0.5, 0.5]), (2, [0.5, 0.5])]) == []  # nothing varies
