"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldbalance.llm.common import stored, table

BLANKS = " \t\n\x0b\x0c\r"
#: 64-bit words of a filter: at most this many rows are broadcast, whatever the input.
FILTER_WORDS = 1 << 17
PREFIX = 256


def normalised(text: Column | str) -> Column:
    """The text without the characters of [\\x20\\x09-\\x0D]; a null text is empty."""
    return F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), BLANKS, "")


def _place(key: str, words: int) -> tuple[Column, Column]:
    """Where the bit of a key lies: word, and bit in it."""
    place = F.pmod(F.xxhash64(key), F.lit(words * 64))
    return F.shiftrightunsigned(place, 6), (place % 64).cast("int")


def _filter(keys: DataFrame, words: int) -> DataFrame:
    """(_word, _mask): a bit for every key that at least two rows hold; never above ``words`` rows."""
    word, bit = _place("key", words)
    return (keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
            .select(word.alias("_word"),
                    F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit"))
            .groupBy("_word").agg(F.bit_or("bit").alias("_mask")))


def _passing(rows: DataFrame, key: str, held: DataFrame, words: int) -> DataFrame:
    """Adds ``_more``: some other row may share the key. False is certain."""
    word, bit = _place(key, words)
    on = F.call_function("shiftright", F.col("_mask"), bit).bitwiseAND(F.lit(1).cast("long"))
    return (rows.join(F.broadcast(held), word == F.col("_word"), "left")
            .withColumn("_more", F.coalesce(on == 1, F.lit(False))).drop("_word", "_mask"))


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text", *, carry: list[str] | None = None,
                 prefix: int = PREFIX, filter_words: int = FILTER_WORDS) -> DataFrame:
    """One row per row of ``docs``: its id, the ``carry`` columns, keep_id, group_size, kept.

    Texts are equal when they are identical without white space. The first pass reads
    lengths; the second hashes the first ``prefix`` characters of texts whose length
    occurs twice; the third hashes in full only texts whose length and prefix occur
    twice. What survives a pass is a bit filter of fixed size, so it can be broadcast
    at any scale; a bit that other keys share costs a hash, never a wrong answer.

    The row with the most code points in the original text stays, then the smallest id
    (a missing id last), then the first as read: of repeated rows exactly one stays.
    Null and empty texts are equal to each other and to texts of white space alone. An
    empty table gives no rows; other columns do not matter, whatever their names. A
    text's length is bounded by what a string may hold. Groups are counted before they
    are shuffled, so a group may hold any share of all rows.
    """
    carry = list(carry or [])
    source = docs.select(F.struct(F.col(id_column).alias("id"), *[F.col(f"`{c}`").alias(f"c{i}")
                                                                 for i, c in enumerate(carry)]).alias("doc"),
                         F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = source.withColumn("norm", normalised("text")).withColumn("size", F.length("norm"))
    lengths = stored(_filter(rows.select(F.col("size").alias("key")), filter_words), "op12-lengths")
    same_length = _passing(rows, "size", lengths, filter_words)
    same_length = same_length.withColumn(
        "start", F.when(F.col("_more"), F.xxhash64("size", F.substring("norm", 1, prefix)))).drop("_more")
    prefixes = stored(_filter(same_length.where("start IS NOT NULL").select(F.col("start").alias("key")), filter_words),
                      "op12-prefixes")
    final = _passing(same_length, "start", prefixes, filter_words).select(
        "doc", F.monotonically_increasing_id().alias("row"), F.length("text").alias("points"),
        F.when(F.col("start").isNotNull() & F.col("_more"), F.sha2("norm", 256)).alias("full"))
    # Written once: row numbers and hashes stay as they are, and no text travels further.
    final = stored(final, "op12-hashes")
    first = F.min(F.struct((-F.col("points")).alias("fewer"), F.col("doc.id").isNull().alias("none"),
                           F.col("doc.id").alias("id"), F.col("row").alias("row")))
    groups = (final.where("full IS NOT NULL").groupBy(F.col("full").alias("same"))
              .agg(F.count("*").alias("n"), first.alias("first")).where("n > 1"))
    def answer(rows: DataFrame, keep_id: Column, size: Column, kept: Column) -> DataFrame:
        return rows.select(F.col("doc.id").alias(id_column), *[F.col(f"doc.c{i}").alias(c) for i, c in enumerate(carry)],
                           keep_id.alias("keep_id"), size.cast("long").alias("group_size"), kept.alias("kept"))

    # Rows without a hash are alone; they need no join, in which they would be one hot key.
    alone = answer(final.where("full IS NULL"), F.col("doc.id"), F.lit(1), F.lit(True))
    own = F.col("n").isNull()
    shared = final.where("full IS NOT NULL").join(groups, F.col("full") == F.col("same"), "left")
    return alone.unionByName(answer(shared, F.when(own, F.col("doc.id")).otherwise(F.col("first.id")),
                                    F.coalesce("n", F.lit(1)), own | (F.col("row") == F.col("first.row"))))


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns as they came.

    Texts are carried through the intermediate table. Columns named like those that
    ``exact_groups`` adds come back unharmed.
    """
    packed = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"),
                         F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))
    return exact_groups(packed, "id", "text", carry=["whole"]).where("kept").select("whole.*")


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("text_sha256", F.sha2(normalised("text"), 256))
    return exact_groups(docs, carry=["text_sha256"]).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP12_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT *, count(*) OVER (PARTITION BY norm) AS group_size,
             first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id,
             row_number() OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS place FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM g
"""
