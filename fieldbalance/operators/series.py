"""Order-dependent steps over many series at once.

Each function takes the columns that name a series and the columns that order
it. Without ``block`` a series is one window partition, which suits tables with
at most one row per series and day. With ``block`` (for example the year of the
date) a series is split: every block gets a seed row that carries what earlier
or later blocks leave behind, and a window only spans one block. The seeds come
from an aggregate that shrinks a block to one row before it is shuffled, so even
a series holding a large share of the table is worked on by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_START, _ROW, _END = -1, 0, 1


def _known(col: str, order: Sequence[str]) -> Column:
    """Order of a row where the column is filled; missing elsewhere."""
    return F.when(F.col(col).isNotNull(), F.struct(*order))


def _rows(df: DataFrame, block: Column) -> DataFrame:
    return df.withColumns({"_block": block, "_kind": F.lit(_ROW)})


def _earlier(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)


def _forward(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys, "_block").orderBy("_kind", *order)


def _with_seeds(rows: DataFrame, seeds: DataFrame, kind: int) -> DataFrame:
    return rows.unionByName(seeds.withColumn("_kind", F.lit(kind)), allowMissingColumns=True)


def _only_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_kind") == _ROW).drop("_block", "_kind")


def _last_known_seeds(rows: DataFrame, cols: Sequence[str], keys: Sequence[str],
                      order: Sequence[str]) -> DataFrame:
    ends = rows.groupBy(*keys, "_block").agg(
        *[F.max_by(c, _known(c, order)).alias(c) for c in cols])
    return ends.select(*keys, "_block", *[
        F.last(c, ignorenulls=True).over(_earlier(keys)).alias(c) for c in cols])


def locf(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str],
         block: Column | None = None) -> DataFrame:
    """Carry the last known value forward; rows before the first stay missing."""
    if block is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
            Window.unboundedPreceding, 0)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
    rows = _rows(df, block)
    seeded = _with_seeds(rows, _last_known_seeds(rows, cols, keys, order), _START)
    w = _forward(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    return _only_rows(seeded.withColumns(
        {c: F.last(c, ignorenulls=True).over(w) for c in cols}))


def locf_lag_diff(df: DataFrame, col: str, keys: Sequence[str], order: Sequence[str],
                  block: Column | None = None, name: str = "diff") -> DataFrame:
    """Carry forward, then the step from the row before; 0 at the first known row.

    Rows before the first known value are left out.
    """
    if block is None:
        rows = df.withColumn("_kind", F.lit(_ROW)).withColumn("_block", F.lit(0))
        seeded = rows
    else:
        rows = _rows(df, block)
        seeded = _with_seeds(rows, _last_known_seeds(rows, [col], keys, order), _START)
    w = _forward(keys, order)
    filled = seeded.withColumn(col, F.last(col, ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    stepped = filled.withColumn(name, F.coalesce(F.col(col) - F.lag(col).over(w), F.lit(0.0)))
    return _only_rows(stepped.filter(F.col(col).isNotNull()))


def runs_by_nonnull(df: DataFrame, col: str, keys: Sequence[str], order: Sequence[str],
                    block: Column | None = None, name: str = "run") -> DataFrame:
    """Number of known values up to and with each row: a new run starts at each."""
    known = F.col(col).isNotNull().cast("long")
    if block is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
            Window.unboundedPreceding, 0)
        return df.withColumn(name, F.sum(known).over(w))
    rows = _rows(df, block).withColumn(name, known)
    counts = rows.groupBy(*keys, "_block").agg(F.sum(name).alias(name))
    seeds = counts.select(*keys, "_block", F.coalesce(
        F.sum(name).over(_earlier(keys)), F.lit(0).cast("long")).alias(name))
    w = _forward(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    return _only_rows(_with_seeds(rows, seeds, _START).withColumn(name, F.sum(name).over(w)))


def interpolate_linear(df: DataFrame, col: str, keys: Sequence[str], date: str = "date",
                       block: Column | None = None) -> DataFrame:
    """Fill gaps on the straight line between the known values around them.

    Values before the first and after the last known one stay missing. The next
    known value is found by carrying forward in reverse order, one pass over the
    sorted rows, instead of looking ahead from every row.
    """
    point = F.when(F.col(col).isNotNull(), F.struct(date, F.col(col).alias("y")))
    if block is None:
        rows = df.withColumns({"_block": F.lit(0), "_kind": F.lit(_ROW), "_point": point})
        seeded = rows
    else:
        rows = _rows(df, block).withColumn("_point", point)
        sides = rows.groupBy(*keys, "_block").agg(
            F.max("_point").alias("_last"), F.min("_point").alias("_first"))
        later = Window.partitionBy(*keys).orderBy(F.desc("_block")).rowsBetween(
            Window.unboundedPreceding, -1)
        before = sides.select(*keys, "_block", F.last("_last", ignorenulls=True).over(
            _earlier(keys)).alias("_point"))
        after = sides.select(*keys, "_block", F.last("_first", ignorenulls=True).over(
            later).alias("_point"))
        seeded = _with_seeds(_with_seeds(rows, before, _START), after, _END)
    span = (Window.unboundedPreceding, 0)
    forward = _forward(keys, [date]).rowsBetween(*span)
    backward = Window.partitionBy(*keys, "_block").orderBy(
        F.desc("_kind"), F.desc(date)).rowsBetween(*span)
    around = seeded.withColumns({
        "_left": F.last("_point", ignorenulls=True).over(forward),
        "_right": F.last("_point", ignorenulls=True).over(backward),
    })
    left, right = F.col("_left"), F.col("_right")
    share = (F.date_diff(F.col(date), left[date])
             / F.date_diff(right[date], left[date]))
    line = left["y"] + (right["y"] - left["y"]) * share
    filled = around.withColumn(col, F.coalesce(F.col(col), line))
    return _only_rows(filled).drop("_point", "_left", "_right")


def seed_first_row(df: DataFrame, col: str, value, keys: Sequence[str],
                   order: Sequence[str] = ("date",)) -> DataFrame:
    """Set a column on the first row of every series."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(col, F.when(place == 1, F.lit(value)).otherwise(F.col(col)))


def last_row_flag(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  name: str = "is_last") -> DataFrame:
    """Mark the last row of every group."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn(name, F.row_number().over(w) == 1)


def date_range(df: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def calendar_days(ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every day of each range, unfolded in place from its one row."""
    days = F.sequence("first_date", "last_date", F.expr("interval 1 day"))
    return ranges.select(*keys, F.explode(days).alias("date"))
