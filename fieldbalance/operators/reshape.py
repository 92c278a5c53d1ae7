"""Long, wide and nested forms of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbalance.sources.headers import matching_columns


def melt(df: DataFrame, ids: Sequence[str], measures: Sequence[str] | str | None = None,
         name: str = "variable", value: str = "value") -> DataFrame:
    """One row per id row and measured column.

    ``measures`` is a list, a pattern for the column names, or None for every
    column that is not an id.
    """
    if isinstance(measures, str):
        measures = [c for c in matching_columns(df, measures) if c not in ids]
    elif measures is None:
        measures = [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), list(measures), name, value)


def found_names(df: DataFrame, column: str, most: int = 200) -> list:
    """The names a column holds, in order: the columns of a cast, from the data.

    One aggregate whose result is one row per name. More than ``most`` names are an
    error before they are collected: they would not be columns of a table.
    """
    names = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.lit(1)).select(column)
    rows = names.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} different values of {column}")
    return sorted(r[0] for r in rows)


def cast_wide(df: DataFrame, ids: Sequence[str], names_from: str, names: Sequence,
              values: Mapping[str, str], others: str = "drop") -> DataFrame:
    """One row per id, one column per listed name and value column.

    ``values`` maps a value column to the prefix of its new columns. Rows with
    a missing name only keep their id row, and so do those with a name that is not
    listed, unless ``others`` is "raise": then a rate or level that arrives later is
    an error and not lost. Two rows for one cell are an error rather than a silent
    count. This is one aggregate, so rows are combined before the only shuffle.
    """
    hit = {n: F.col(names_from) == F.lit(n) for n in names}
    cells = [F.max(F.when(hit[n], F.col(v))).alias(f"{prefix}{n}")
             for v, prefix in values.items() for n in names]
    counts = [F.count_if(hit[n]).alias(f"_count_{i}") for i, n in enumerate(names)]
    if others not in ("drop", "raise"):
        raise ValueError("others is 'drop' or 'raise'")
    listed = F.col(names_from).isin(*names) if names else F.lit(False)
    unlisted = F.max(F.when(~listed, F.col(names_from).cast("string"))).alias("_unlisted")
    wide = df.groupBy(*ids).agg(*cells, *counts, *([unlisted] if others == "raise" else []))
    if others == "raise":
        wide = wide.filter(F.assert_true(F.col("_unlisted").isNull(), F.concat(
            F.lit(f"{names_from} not among the columns: "), "_unlisted")).isNull()).drop("_unlisted")
    for i, n in enumerate(names):
        message = f"more than one row for {names_from} {n} of one {tuple(ids)}"
        wide = wide.filter(F.assert_true(F.col(f"_count_{i}") <= 1, message).isNull())
    return wide.drop(*[f"_count_{i}" for i in range(len(names))])


def nest(df: DataFrame, keys: Sequence[str], columns: Sequence[str], chunk: Column,
         name: str = "rows") -> DataFrame:
    """Rows of a group as sorted arrays of structs, one array per chunk.

    The chunk (for daily rows: the year) bounds every array, however long the
    group is. ``columns`` starts with the columns that give the order.
    """
    return (df.groupBy(*keys, chunk.alias("chunk"))
            .agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name)))


def unnest(df: DataFrame, keys: Sequence[str], name: str = "rows") -> DataFrame:
    """Back to one row per nested row, tagged with the keys of its group."""
    return df.select(*keys, F.inline(name))
