"""Mixing sources to target weights by subset-sum budget fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldbalance.llm.common import stored, table, word_count

WEIGHTS = (3, 1, 2)
#: Words left to the knapsack; the rest of a budget is spread over all lengths first.
KNAPSACK_WORDS = 200_000
BUCKETS = 256


def targets(sizes: dict, weights: dict, share: float, most: float) -> dict:
    """Words per source: a share of all sizes by weight, none above most times its own;
    what is above goes to the others by weight until none is."""
    left, out, budget = dict(sizes), {}, share * sum(sizes.values())
    while left:
        total = sum(weights[s] for s in left)
        full = [s for s in left if budget * weights[s] / total > most * left[s]]
        if not full:
            out |= {s: budget * weights[s] / total for s in left}
            break
        for s in full:
            out[s] = most * left.pop(s)
        budget -= sum(out[s] for s in full)
    return out


def fit(lengths: list[int], counts: list[int], budget: int, knapsack_words: int) -> list[int]:
    """How many documents of each length to take so that the words come to the budget.

    Lengths share the budget in proportion, the remainder carried from one to the
    next; the last words are found by a bounded knapsack over what is left.
    """
    order = sorted((i for i in range(len(lengths)) if lengths[i] > 0), key=lambda i: -lengths[i])
    take = [0] * len(lengths)
    total = sum(lengths[i] * counts[i] for i in order)
    budget = min(budget, total)
    first = max(0, budget - knapsack_words)
    seen = used = 0
    for i in order:
        seen += lengths[i] * counts[i]
        n = max(0, min(counts[i], (first * seen // max(total, 1) - used) // lengths[i]))
        take[i], used = n, used + n * lengths[i]
    rest = budget - used
    reached, step, steps = 1, {0: None}, []
    # A sum somewhat over the budget may be nearer than any below it.
    most = rest + max((lengths[i] for i in order), default=0)
    mask = (1 << (most + 1)) - 1
    for i in order:
        free, size = counts[i] - take[i], 1
        while free > 0 and not (reached >> rest) & 1:
            n = min(size, free)
            weight = n * lengths[i]
            free, size = free - n, size * 2
            if weight > most:
                break
            new = (reached << weight) & mask & ~reached
            if new:
                reached |= new
                steps.append((i, n, weight))
                bits = bin(new)[:1:-1]
                at = bits.find("1")
                while at >= 0:
                    step[at] = len(steps) - 1
                    at = bits.find("1", at + 1)
    at = min(step, key=lambda v: (abs(v - rest), v))
    while step[at] is not None:
        i, n, weight = steps[step[at]]
        take[i] += n
        at -= weight
    return take


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: int = 2, seed: int = 17,
        knapsack_words: int = KNAPSACK_WORDS, row=None) -> DataFrame:
    """row, doc_id, source, size, source_size, target, repeats, taken for every row.

    Sources by code point with null last, the weights repeating. A null text has no
    words; empty texts take no part of a budget and repeat as often as their source
    is taken whole. Rows with the same doc_id and source count as rows of their own.
    An empty table gives no rows. Only one row per source reaches the driver.
    """
    spark = docs.sparkSession
    # A row's own number tells repeated rows apart once it is written.
    d = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                           (F.monotonically_increasing_id() if row is None else row).alias("row")), "mix")
    place = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(BUCKETS))
    d = d.withColumn("bucket", place.cast("int"))
    by_length = stored(d.groupBy("source", "size", "bucket").agg(F.count("*").alias("n")), "mix-lengths")
    totals = by_length.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words")).collect()
    names = sorted((r.source for r in totals), key=lambda s: (s is None, (s or "").encode()))
    sizes = {r.source: r.words for r in totals}
    goal = targets(sizes, {s: weights[i % len(weights)] for i, s in enumerate(names)}, share, most)

    def plan(frame):
        import numpy as np
        import pandas as pd
        source = frame["source"].iloc[0]
        source = None if pd.isna(source) else source
        frame = frame.sort_values("size")
        words, budget = sizes[source], round(goal[source])
        n = frame["n"].to_numpy()
        take = np.array(fit(frame["size"].tolist(), (n * most).tolist(), budget, knapsack_words))
        # Empty texts cost nothing: as often as the source as a whole.
        take = np.where(frame["size"] == 0, n * (min(most, budget // words) if words else 1), take)
        return pd.DataFrame({"source": [source] * len(frame), "size": frame["size"],
                             "source_size": words, "target": goal[source], "whole": take // n, "extra": take % n})

    planned = (by_length.groupBy("source", "size").agg(F.sum("n").alias("n")).groupBy("source")
               .applyInPandas(plan, "source string, size long, source_size long, target double, whole long, extra long"))
    before = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counted = by_length.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    l, p = counted.alias("l"), planned.alias("p")
    slots = (l.join(p, F.col("l.source").eqNullSafe(F.col("p.source")) & (F.col("l.size") == F.col("p.size")))
             .select("l.source", "l.size", "l.bucket", "source_size", "target", "whole",
                     (F.col("extra") - F.col("before")).alias("open")))
    rank = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy(
        F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id", "row"))
    a, s = d.withColumn("rank", rank).alias("a"), stored(slots, "mix-slots").alias("s")
    repeats = F.col("whole") + (F.col("rank") <= F.col("open")).cast("long")
    return (a.join(s, F.col("a.source").eqNullSafe(F.col("s.source")) & (F.col("a.size") == F.col("s.size"))
                   & (F.col("a.bucket") == F.col("s.bucket")))
            .select("a.row", "a.doc_id", "a.source", "a.size", "source_size", "target", repeats.alias("repeats"),
                    (repeats * F.col("a.size")).alias("taken")))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The rows of docs as often as the mix takes them, with their columns, whatever their names.

    Rows are told apart by a number of their own, so ids may repeat or be missing.
    """
    d = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                           F.monotonically_increasing_id().alias("row")), "mix-docs")
    plan = (mix(d.select("doc.doc_id", "doc.source", "doc.text", "row"), row=F.col("row"), **settings)
            .where("repeats > 0").select("row", "repeats"))
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats")))
    return d.join(plan, "row").select("doc", times.alias("time")).select("doc.*")
