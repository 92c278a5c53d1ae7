"""The whole dataflow: raw tables in, every result table out, all lazy."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from fieldbalance.functions.dates import nitrogen_label, with_local_date
from fieldbalance.operators import balance, canopy, soil_sheet, weather
from fieldbalance.operators.reshape import found_names
from fieldbalance.plans import report
from fieldbalance.sources.versions import Draft


@dataclass
class SeasonTables:
    """Inputs of one run; the layouts are in ``schemas``."""

    soil: DataFrame
    flags: DataFrame
    pet: DataFrame
    rain: DataFrame
    diary: DataFrame
    canopy: DataFrame
    growth_events: DataFrame


def soil_means(tables: SeasonTables) -> DataFrame:
    """Mean water of every layer per treatment and day, the base of all soil results."""
    return soil_sheet.sheet_means(
        with_local_date(tables.soil).dropna(subset=["crop", "date"]),
        with_local_date(tables.flags))


def season(tables: SeasonTables, top_depth: int = 3, use_corrected_pet: bool = False,
           reset_to_measured: bool = False, missing_rain: str = "missing",
           means: DataFrame | None = None, sensor: str | None = None,
           nitrogen: Sequence[str] = report.NITROGEN, same_day: str = "raise") -> dict[str, DataFrame]:
    """Named result tables. Only those that are written or read are computed.

    ``means`` may be a stored ``soil_means`` table. ``sensor`` names the canopy sensor
    whose readings count. Every irrigation level of the diary gets a published table
    with a column per rate in ``nitrogen``; a rate that is not listed raises.
    """
    means = soil_means(tables) if means is None else means
    levels = [int(c.split("_")[1]) for c in weather.diary_levels(tables.diary)]
    summary = canopy.canopy_summary(tables.canopy, sensor)
    stages = canopy.growth_stage_merge(canopy.growth_event_parse(tables.growth_events),
                                       canopy.full_cover_date(summary))
    coefficients = canopy.crop_coefficient(stages)
    daily = weather.daily_inputs(weather.weather_join(tables.pet, tables.rain),
                                 tables.diary, missing_rain=missing_rain)
    corrected = canopy.pet_correction(daily, coefficients)
    depths = soil_sheet.multi_depth_from_means(means)
    top = soil_sheet.swd_from_means(means, top_depth)
    states = balance.water_balance(
        corrected if use_corrected_pet else daily,
        soil_sheet.inputs_from_means(means, top_depth),
        reset=top if reset_to_measured else None,
        pet_col="pet_correction" if use_corrected_pet else "pet", same_day=same_day)
    return {
        "layer_means": soil_sheet.layers_from_means(means),
        "profile": soil_sheet.swd_from_means(means),
        "profile_depths": depths,
        "canopy": summary,
        "coefficients": coefficients,
        "daily": corrected,
        "balance": states,
        **{f"published_{k}": report.publish_wide(states, depths, k, nitrogen) for k in levels},
    }


def publish_season(tables: SeasonTables, path: str, **options) -> int:
    """Publish layer means, balance, depths and the table of every irrigation level.

    What later tables build on is written first and read back: the readings are
    scanned once, the days are walked once, and a lost executor starts neither
    again. Nitrogen rates are those of the means unless they are given. Readers
    (``read_version``) see all tables of the new version at once, or none: a run
    that fails leaves the last version in place. Returns the version's number.
    """
    draft = Draft(tables.soil.sparkSession, path)
    means = draft.write(soil_means(tables), "means")
    if "nitrogen" not in options:
        rates = means.withColumn("n_rate", nitrogen_label("n_rate"))
        options["nitrogen"] = found_names(rates, "n_rate")
    results = season(tables, **options, means=means)
    states = draft.write(results["balance"], "balance")
    depths = draft.write(results["profile_depths"], "profile_depths")
    for column in weather.diary_levels(tables.diary):
        level = int(column.split("_")[1])
        draft.write(report.publish_wide(states, depths, level, options["nitrogen"]),
                    f"published_{level}")
    return draft.commit()
