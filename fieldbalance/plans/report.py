"""Wide result tables, dashboard panels and figure data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbalance.functions.dates import time_bucket
from fieldbalance.functions.nulls import not_in_or_null, zero_to_null
from fieldbalance.operators.reshape import cast_wide, melt

NITROGEN = ["Nitrogen 1", "Nitrogen 2", "Nitrogen 3", "Nitrogen 4"]


def pivot_swd(deficits: DataFrame, irrigation: int, nitrogen: Sequence[str] = NITROGEN) -> DataFrame:
    """Measured deficits of one irrigation level, one column per nitrogen rate."""
    return cast_wide(deficits.filter(F.col("irrigation") == irrigation),
                     ["site_id", "crop", "date", "profile"], "n_rate", nitrogen, {"swd": "SWD_"},
                     others="raise")


def pivot_balance(balance: DataFrame, irrigation: int,
                  nitrogen: Sequence[str] = NITROGEN) -> DataFrame:
    """Modelled deficit and drainage of one irrigation level, with the weather.

    All treatments of a level share the day's weather, which is carried as part
    of the id, so it needs no join.
    """
    return cast_wide(balance.filter(F.col("irrigation") == irrigation),
                     ["site_id", "date", "pet", "precipitation"], "n_rate", nitrogen,
                     {"wt": "Wt_", "drainage": "Drainage_"}, others="raise")


def publish_wide(balance: DataFrame, deficits: DataFrame, irrigation: int = 1,
                 nitrogen: Sequence[str] = NITROGEN,
                 measured_irrigation: int | None = None) -> DataFrame:
    """The published table: every day, once per measured depth where measured.

    ``measured_irrigation`` names the level of the measured deficits where it is not
    the level of the modelled ones.
    """
    measured = pivot_swd(deficits, measured_irrigation or irrigation, nitrogen).drop("crop")
    modelled = (pivot_balance(balance, irrigation, nitrogen)
                .withColumnsRenamed({"pet": "PET", "precipitation": "Precipitation"}))
    return modelled.join(measured, ["site_id", "date"], "left").select(
        "site_id", "date", "profile", *[f"SWD_{n}" for n in nitrogen], "PET", "Precipitation",
        *[f"Wt_{n}" for n in nitrogen], *[f"Drainage_{n}" for n in nitrogen])


def _short(nitrogen: str) -> str:
    return nitrogen.replace("Nitrogen ", "N")


def panel_balance(published: DataFrame, nitrogen: Sequence[str] = NITROGEN) -> DataFrame:
    """Modelled against measured deficit, in time order."""
    return published.select(
        "site_id", F.col("date").alias("time"),
        *[F.col(f"Wt_{n}").alias(f"WaterBalance {_short(n)}") for n in nitrogen],
        *[F.col(f"SWD_{n}").alias(f"Measurement {_short(n)}") for n in nitrogen]).orderBy("time")


def panel_drainage(published: DataFrame, nitrogen: Sequence[str] = NITROGEN) -> DataFrame:
    """Evaporation, precipitation and drainage, in time order."""
    return published.select(
        "site_id", F.col("date").alias("time"), "PET", "Precipitation",
        *[F.col(f"Drainage_{n}").alias(n) for n in nitrogen]).orderBy("time")


def canopy_time_bucket(summary: DataFrame, width: str = "7 days") -> DataFrame:
    """Mean canopy index per time bucket, treatment and crop."""
    return (summary.groupBy(time_bucket("date", width).alias("time"), "site_id", "crop",
                            "irrigation", "nitrogen")
            .agg(F.avg("mean").alias("mean")).orderBy("time"))


SHALLOW = ["20 cm", "40 cm"]


def figure_long_60cm(published: DataFrame, nitrogen: Sequence[str] = NITROGEN) -> DataFrame:
    """Modelled and measured deficit as rows, without the shallower depths."""
    wanted = [f"{p}{n}" for p in ("Wt_", "SWD_") for n in nitrogen]
    rows = published.filter(not_in_or_null("profile", SHALLOW))
    return melt(rows.select("site_id", "date", "profile", *wanted),
                ["site_id", "date", "profile"])


def figure_drainage(published: DataFrame,
                    nitrogen: Sequence[str] = NITROGEN) -> tuple[DataFrame, DataFrame]:
    """Weather columns with zero shown as missing, and drainage as rows."""
    drains = [f"Drainage_{n}" for n in nitrogen]
    rows = published.filter(not_in_or_null("profile", SHALLOW)).select(
        "site_id", "date", "PET", "Precipitation", *drains)
    base = zero_to_null(rows, ["PET", "Precipitation", *drains])
    return base, melt(base.select("site_id", "date", *drains), ["site_id", "date"])
