"""Sheets exported as delimited text, with free text above the header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbalance.functions.nulls import to_number


def read_sheet(spark: SparkSession, path: str, schema: T.StructType, key: str,
               sep: str = ",") -> DataFrame:
    """Typed rows of one or many exported sheets.

    ``key`` is a typed column every data row fills. Preamble and header lines
    cannot be cast to its type, which tells them from data without counting
    lines, so a large file can still be split over many tasks.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows = (spark.read.schema(as_text).option("sep", sep).option("mode", "PERMISSIVE")
            .csv(path))
    return (rows.filter(F.col(key).try_cast(schema[key].dataType).isNotNull())
            .select(*[typed_cell(f).alias(f.name) for f in schema.fields]))


def typed_cell(field: T.StructField) -> Column:
    """A text cell in the type of its column; missing if it cannot be read."""
    cell = F.col(f"`{field.name}`")
    return to_number(cell) if isinstance(field.dataType, T.DoubleType) else cell.try_cast(field.dataType)


def project_rename(df: DataFrame, **new_from_old: str) -> DataFrame:
    """Keep only the named columns, under their new names."""
    return df.select(*[F.col(old).alias(new) for new, old in new_from_old.items()])
