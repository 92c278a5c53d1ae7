"""Exact top-k search by distributed histogram selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldbalance.llm.common import table, tasks

#: Queries held at once; with BINS they bound what the driver and each task keep.
BLOCK = 1024
BINS = 128


def clean_vectors(df: DataFrame, id_column: str, vector: str, scale: int = 256) -> DataFrame:
    """(vec_id, v): components as floor(scale * x); vectors null, empty, or with a null or
    non-finite component take no part, and neither do rows without an id. A component from
    2^62 on raises: no integer score could hold it. Other columns are not read."""
    v = F.col(vector)

    def whole(x):
        scaled = x.cast("double") * scale
        return F.when(F.abs(scaled) < 2.0 ** 62, F.floor(scaled).cast("long")).otherwise(
            F.raise_error(F.lit("a vector component is too large for integer scores")).cast("long"))

    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return (df.where(F.col(id_column).isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False)))
            .select(F.col(id_column).cast("long").alias("vec_id"),
                    F.transform(v, whole).alias("v")))


def _scored(batches, ids, matrix):
    """(vec_ids, scores by query) per batch; vectors of another length than the queries' are skipped.

    Scores that doubles hold exactly come from a double product, larger ones from integers;
    from 2^63 on they raise.
    """
    import numpy as np
    doubles = matrix.astype(np.float64)
    most = np.abs(doubles).sum(axis=1).max(initial=0.0)
    for batch in batches:
        same = batch["v"].map(len).to_numpy() == matrix.shape[1]
        if same.any():
            got = batch["vec_id"].to_numpy()[same]
            block = np.stack(batch["v"].to_numpy()[same]).astype(np.int64)
            bound = most * np.abs(block.astype(np.float64)).max()
            if bound < 2.0 ** 52:
                scores = (doubles @ block.T.astype(np.float64)).astype(np.int64)
            elif bound < 2.0 ** 62:
                scores = matrix @ block.T
            else:
                raise OverflowError("an inner product may not fit 64 bits")
            yield got, scores, ids[:, None] != got[None, :]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of every query.

    Queries come in blocks of a fixed size. Every row scores against the block; a
    histogram of all scores is refined until the k-th value of each query stands
    alone; then only scores at or above it leave the tasks. Ties go to the smaller
    vec_id, and a task keeps no more than k of the ties at the k-th value. Repeated
    vec_ids are rows of their own; a row with the query's own id is no candidate.
    Fewer than k candidates: all. Empty tables give no rows. A vector scores against
    queries of its own length only. Products that 64 bits may not hold raise. Columns other
    than vec_id and v are not read.
    """
    import numpy as np
    spark = vectors.sparkSession
    vectors = tasks(vectors)
    numbered = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    total = numbered.count()
    blocks = max(1, -(-total // block))
    parts = []
    for number in range(blocks):
        rows = numbered.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number).orderBy("vec_id").collect()
        by_length: dict[int, list] = {}
        for row in rows:
            by_length.setdefault(len(row.v), []).append(row)
        for same in by_length.values():
            ids = np.array([r.vec_id for r in same], np.int64)
            parts.append(_block(vectors, ids, np.array([r.v for r in same], np.int64), k))
    schema = "query_id long, rank int, vec_id long, score long"
    if not parts:
        return spark.createDataFrame([], schema)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order).cast("int"))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def _block(vectors: DataFrame, ids, matrix, k: int) -> DataFrame:
    import numpy as np
    n = len(ids)

    def extremes(batches):
        import pandas as pd
        low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
        for _, scores, other in _scored(batches, ids, matrix):
            low = np.minimum(low, np.where(other, scores, np.iinfo(np.int64).max).min(axis=1))
            high = np.maximum(high, np.where(other, scores, np.iinfo(np.int64).min).max(axis=1))
        yield pd.DataFrame({"q": np.arange(n), "low": low, "high": high})

    got = (vectors.mapInPandas(extremes, "q long, low long, high long").groupBy("q")
           .agg(F.min("low").alias("low"), F.max("high").alias("high")).toPandas().sort_values("q"))
    if got.empty:
        low, high = np.zeros(n, np.int64), np.zeros(n, np.int64)
    else:
        low, high = got["low"].to_numpy(), got["high"].to_numpy()
    alone = low > high  # no candidate at all
    low, high = np.where(alone, 0, low), np.where(alone, 0, high)
    above = np.zeros(n, np.int64)
    while (high > low).any():
        width = np.maximum(1, -(-(high - low + 1) // BINS))

        def histogram(batches, low=low, high=high, width=width):
            import pandas as pd
            counts = np.zeros(n * BINS, np.int64)
            for _, scores, other in _scored(batches, ids, matrix):
                inside = other & (scores >= low[:, None]) & (scores <= high[:, None])
                q, at = np.nonzero(inside)
                bins = (scores[q, at] - low[q]) // width[q]
                counts += np.bincount(q * BINS + bins, minlength=n * BINS)
            used = np.flatnonzero(counts)
            yield pd.DataFrame({"q": used // BINS, "bin": used % BINS, "n": counts[used]})

        table_ = (vectors.mapInPandas(histogram, "q long, bin long, n long")
                  .groupBy("q", "bin").agg(F.sum("n").alias("n")).toPandas())
        grid = np.zeros((n, BINS), np.int64)
        grid[table_["q"], table_["bin"]] = table_["n"]
        from_top = grid[:, ::-1].cumsum(axis=1)[:, ::-1]
        reach = above[:, None] + from_top >= k
        enough = reach.any(axis=1)
        chosen = np.where(enough, BINS - 1 - reach[:, ::-1].argmax(axis=1), 0)
        rows = np.arange(n)
        over = from_top[rows, chosen] - grid[rows, chosen]
        more = high > low
        new_low = np.where(enough, low + chosen * width, low)
        # Fewer than k candidates: everything from the lowest score on is wanted.
        high = np.where(more, np.where(enough, np.minimum(high, new_low + width - 1), low), high)
        above = np.where(more & enough, above + over, above)
        low = np.where(more, new_low, low)
    kth = low

    def winners(batches):
        import pandas as pd
        for got_ids, scores, other in _scored(batches, ids, matrix):
            q, at = np.nonzero(other & (scores > kth[:, None]))
            tie_q, tie_at = np.nonzero(other & (scores == kth[:, None]))
            order = np.lexsort((got_ids[tie_at], tie_q))
            tie_q, tie_at = tie_q[order], tie_at[order]
            place = np.arange(len(tie_q)) - np.searchsorted(tie_q, tie_q)
            tie_q, tie_at = tie_q[place < k], tie_at[place < k]
            q, at = np.concatenate([q, tie_q]), np.concatenate([at, tie_at])
            yield pd.DataFrame({"query_id": ids[q], "vec_id": got_ids[at], "score": scores[q, at]})

    return vectors.mapInPandas(winners, "query_id long, vec_id long, score long")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = clean_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


OP10_SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
