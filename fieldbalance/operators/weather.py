"""Daily inputs of the balance: evaporation, rain, irrigation and the crop."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbalance.functions.nulls import filled
from fieldbalance.operators.reshape import cast_wide, melt
from fieldbalance.operators.series import locf, seed_first_row

LEVELS = ["irrigation_1", "irrigation_2"]


def weather_join(pet: DataFrame, rain: DataFrame) -> DataFrame:
    """Every evaporation day, with its rain where there is a record."""
    return pet.join(rain, ["site_id", "date"], "left")


def melt_irrigation(diary: DataFrame) -> DataFrame:
    """One row per irrigation day and level."""
    return melt(diary, ["site_id", "crop", "date"], None, "treatment", "irrigation")


def weather_irrigation_join(weather: DataFrame, irrigation: DataFrame) -> DataFrame:
    """Weather with one row per irrigation level on days that were irrigated."""
    return weather.join(irrigation, ["site_id", "date"], "left")


def pivot_irrigation(joined: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """One row per day again, one column per irrigation level."""
    return cast_wide(joined, ["site_id", "date", "pet", "rain", "crop"], "treatment",
                     levels, {"irrigation": ""}, others="raise")


def fill_zero(df: DataFrame, cols: Sequence[str] = LEVELS) -> DataFrame:
    return df.withColumns({c: filled(c, 0.0) for c in cols})


def diary_levels(diary: DataFrame) -> list[str]:
    """The irrigation columns of a diary, by level."""
    return sorted((c for c in diary.columns if re.fullmatch(r"irrigation_\d+", c)),
                  key=lambda c: int(c.split("_")[1]))


def daily_inputs(weather: DataFrame, diary: DataFrame, levels: Sequence[str] | None = None,
                 seed_crop: str = "Potato", missing_rain: str = "missing") -> DataFrame:
    """Precipitation of every irrigation level and the crop in the ground, by day.

    The diary already has one column per level, so it joins as it is; melting
    and casting it back would add a shuffle for the same table. With
    ``missing_rain="zero"`` a day without a rain record counts as dry instead of
    leaving its precipitation missing. Without ``levels`` every irrigation column
    of the diary is one.
    """
    levels = diary_levels(diary) if levels is None else levels
    joined = weather.join(diary.select("site_id", "date", "crop", *levels),
                          ["site_id", "date"], "left")
    if missing_rain == "zero":
        joined = joined.withColumn("rain", filled("rain", 0.0))
    elif missing_rain != "missing":
        raise ValueError("missing_rain is 'missing' or 'zero'")
    rows = fill_zero(joined, levels).withColumns({
        re.sub("^irrigation", "precipitation", c): F.col("rain") + filled(c, 0.0)
        for c in levels})
    seeded = seed_first_row(rows, "crop", seed_crop, ["site_id"], ["date", "pet", "rain"])
    return locf(seeded, ["crop"], ["site_id"], ["date", "pet", "rain"])
