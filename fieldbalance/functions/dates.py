"""Column expressions for local dates, text dates and growth-event text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRIAL_ZONE = "Pacific/Auckland"


def local_date(col: Column | str, zone: str = TRIAL_ZONE, wall_clock: bool = False) -> Column:
    """Calendar date of an instant where the trial stands, whatever the session's zone.

    A ``wall_clock`` column (a timestamp without zone) holds UTC. An instant is moved
    by the zone's offset and its days are counted, so it is never shown in a zone.
    """
    if wall_clock:
        return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), col))
    seconds = F.unix_seconds(F.from_utc_timestamp(col, zone))
    return F.date_from_unix_date(F.floor(seconds / 86_400).cast("int"))


def with_local_date(df: DataFrame, column: str = "date", zone: str = TRIAL_ZONE) -> DataFrame:
    """Replace an instant column by its local date; a date column stays as it is."""
    if column not in df.columns:
        raise ValueError(f"no column {column!r} to turn into a local date")
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return df
    return df.withColumn(column, local_date(F.col(column), zone, isinstance(kind, T.TimestampNTZType)))


def parsed_date(col: Column | str, fmt: str) -> Column:
    """Date from text in a given layout; unparsable text becomes missing."""
    return F.to_date(F.try_to_timestamp(col, F.lit(fmt)))


def time_bucket(col: Column | str, width: str) -> Column:
    """First day of the bucket of whole days (counted from 1970-01-01) holding a date."""
    found = re.fullmatch(r"\s*(\d+)\s+(day|week)s?\s*", width)
    if not found or not int(found[1]):
        raise ValueError(f"a bucket is a number of days or weeks, not {width!r}")
    days = int(found[1]) * (7 if found[2] == "week" else 1)
    date = (F.col(col) if isinstance(col, str) else col).cast("date")
    return F.date_from_unix_date((F.floor(F.unix_date(date) / days) * days).cast("int"))


def nitrogen_label(col: Column | str) -> Column:
    return F.concat(F.lit("Nitrogen "), (F.col(col) if isinstance(col, str) else col).cast("string"))
