"""Shared by the operators: words, tables, stored intermediate results."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbalance.session import new_shared_path

WORD = r"[^\x20\x09-\x0D]+"
_words = re.compile(WORD)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: str | None) -> list[str]:
    return _words.findall(text) if text else []


def word_count(text: Column) -> Column:
    """Words of a text inside the JVM; a null text has none."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, row_group_bytes: int = 128 << 20, compression: str = "snappy") -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there, executors may go.

    A writer holds a row group in memory; wide rows that do not compress take smaller ones.
    """
    spark, path = df.sparkSession, new_shared_path(df.sparkSession, name)
    before = spark.conf.get(CLEANUP)
    # Nothing reads the shuffles of a finished write: their files go at once.
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("parquet.block.size", row_group_bytes).option("compression", compression).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Remove stored tables that nothing will read again."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: 64-bit words of a bit filter: at most this many rows are broadcast, whatever the input.
FILTER_WORDS = 1 << 17


def _bit(column: str) -> tuple[Column, Column]:
    place = F.pmod(F.xxhash64(column), F.lit(FILTER_WORDS * 64))
    return F.shiftrightunsigned(place, 6), (place % 64).cast("int")


def maybe_among(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """The rows whose key may be one of the keys: all that are, and some that are not.

    For a join that would otherwise shuffle all rows. The keys become a bit filter of
    fixed size, so it can be broadcast; a crowded filter lets more rows through.
    """
    return _marked(rows, column, keys, "inner").drop("_word", "_mask")


def split_among(rows: DataFrame, column: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows as `maybe_among` gives them, and all others, none of whose keys is among the keys."""
    marked = _marked(rows, column, keys, "left")
    return tuple(marked.where(part).drop("_word", "_mask") for part in ("_mask IS NOT NULL", "_mask IS NULL"))


def _marked(rows: DataFrame, column: str, keys: DataFrame, how: str) -> DataFrame:
    word, bit = _bit("key")
    held = (keys.select(keys.columns[0]).toDF("key").select(
        word.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit"))
        .groupBy("_word").agg(F.bit_or("bit").alias("_mask")))
    word, bit = _bit(column)
    on = F.call_function("shiftright", F.col("_mask"), bit).bitwiseAND(F.lit(1).cast("long")) == 1
    return rows.join(F.broadcast(held), (word == F.col("_word")) & on, how)


def tasks(df: DataFrame) -> DataFrame:
    """At least one partition per core, so that a small scan uses all of them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


class _Hashes(dict):
    """64-bit hashes of words, each computed once while it is held."""

    def __missing__(self, word: bytes) -> int:
        from hashlib import blake2b
        if len(self) >= 200_000:  # forgets; a hash is then computed again
            self.clear()
        value = self[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return value


_hashes = _Hashes()


def byte_words(text: str | None, lower: bool = False) -> list[bytes]:
    """The words of a text in UTF-8; bytes split and fold at ASCII only, as WORD and LOWER do."""
    if not text:
        return []
    data = text.encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


def word_hashes(words: list[bytes]):
    import numpy as np
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def shingle_hashes(hashes, n: int):
    """Hash of every n consecutive words; fewer words give their whole sequence as one."""
    import numpy as np
    if not len(hashes):
        return np.zeros(0, np.uint64)
    n = min(n, len(hashes))
    out = np.full(len(hashes) - n + 1, n, np.uint64)
    for i in range(n):
        out = (out ^ hashes[i:len(hashes) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
    return out
