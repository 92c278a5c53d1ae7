"""Column expressions for missing values."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _strict(fold, cols: Iterable[Column | str]) -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in cols]
    complete = reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])
    return F.when(complete, fold(*cols))


def strict_least(*cols: Column | str) -> Column:
    """Smallest argument, missing as soon as one argument is missing."""
    return _strict(F.least, cols)


def strict_greatest(*cols: Column | str) -> Column:
    """Largest argument, missing as soon as one argument is missing."""
    return _strict(F.greatest, cols)


# A number as sheets write it: no word such as NaN, no type letter after the digits.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(col: Column | str) -> Column:
    """Text to double; text that is not a number becomes missing.

    The cast alone would take ``NaN`` and ``Infinity`` for numbers, and ``12d`` for 12.
    """
    text = F.col(col) if isinstance(col, str) else col
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def filled(col: Column | str, default) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(default))


def total(col: Column | str) -> Column:
    """Sum that skips missing values and is 0 when all of them are missing."""
    return F.coalesce(F.sum(col), F.lit(0.0))


def zero_to_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """The same zero-is-missing rule over a list of columns."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(0.0)) for c in cols})


def filter_not_null(df: DataFrame, *cols: str) -> DataFrame:
    return df.dropna(how="any", subset=list(cols))


def not_in_or_null(col: str, values: Iterable) -> Column:
    """Negated membership that keeps rows where the value is missing."""
    return F.col(col).isNull() | ~F.col(col).isin(*values)
