"""Layers as depth intervals: any thickness, any number, gaps allowed.

A layer's name gives its top and bottom in centimetres. A profile reaches to a
depth, and takes from each layer the share of it that lies above that depth.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldbalance.functions.dates import nitrogen_label
from fieldbalance.operators.soil import PROFILE_KEYS, TREATMENT

# A reading is percent of volume; a percent of one centimetre is a tenth of a millimetre.
MM_PER_PERCENT_CM = 0.1


def _text(name: str) -> str:
    """A name as a text in SQL."""
    return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"


def layer_intervals(names: Sequence[str]) -> dict[str, tuple[int, int]]:
    """Top and bottom of every layer by the two numbers in its name; they may not overlap."""
    found = {}
    for name in names:
        numbers = re.findall(r"\d+", name)
        if len(numbers) != 2 or int(numbers[0]) >= int(numbers[1]):
            raise ValueError(f"no top and bottom depth in layer name {name!r}")
        found[name] = (int(numbers[0]), int(numbers[1]))
    ordered = sorted(found.values())
    for (_, bottom), (top, _) in zip(ordered, ordered[1:]):
        if top < bottom:
            raise ValueError(f"layers overlap between {top} and {bottom} cm")
    return found


def interval_layers(readings: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean water (mm) of each layer of a treatment and day, with its top and bottom.

    ``readings`` is the long form (variable, value). A layer without any reading that
    day is absent; one with only missing values counts as dry, like the profile sums.
    """
    intervals = layer_intervals(names)
    if len(intervals) > 62:
        raise ValueError("at most 62 layers fit the mask")
    bit = {name: 1 << k for k, name in enumerate(intervals)}
    cases = " ".join(f"WHEN {_text(name)} THEN {b}L" for name, b in bit.items())
    # Layers are averaged side by side, one row per treatment and day in the shuffle.
    marked = readings.withColumn("_bit", F.expr(f"CASE variable {cases} END"))
    listed = marked.filter(F.assert_true(F.col("_bit").isNotNull(), F.concat(
        F.lit("reading of an unlisted layer "), "variable")).isNull())
    named = listed.groupBy(*PROFILE_KEYS).agg(
        F.bit_or("_bit").alias("_seen"),
        *[F.expr(f"avg(if(_bit = {b}L, value, NULL))").alias(f"_percent_{k}")
          for k, b in enumerate(bit.values())])
    rows = F.inline(F.array(*[
        F.struct(F.lit(top).alias("top"), F.lit(bottom).alias("bottom"),
                 (F.col(f"_percent_{k}") * F.lit(bottom - top) * F.lit(MM_PER_PERCENT_CM)).alias("sw"),
                 F.expr(f"_seen & {bit[name]}L <> 0").alias("_there"))
        for k, (name, (top, bottom)) in enumerate(intervals.items())]))
    return named.select(*PROFILE_KEYS, rows).filter("_there").drop("_there")


def _reached(layers: DataFrame, depths: DataFrame | Mapping[str, int]) -> DataFrame:
    """Every layer with each profile that reaches into it."""
    if isinstance(depths, Mapping):
        listed = F.inline(F.array(*[F.struct(F.lit(name).alias("profile"), F.lit(cm).alias("depth_cm"))
                                    for name, cm in depths.items()]))
        return layers.select("*", listed).filter("top < depth_cm")
    wanted = depths.select(F.col("site_id").alias("_site"), "profile", "depth_cm")
    return layers.join(wanted, (F.col("site_id") == F.col("_site"))
                       & (F.col("top") < F.col("depth_cm"))).drop("_site")


def water_to_depths(layers: DataFrame, depths: DataFrame | Mapping[str, int]) -> DataFrame:
    """Profile water to every asked depth, and the centimetres of it that layers cover.

    ``depths`` maps profile names to centimetres, or is a table (site_id, profile,
    depth_cm) where depths differ by site. Layers meet the depths that reach into
    them; each gives the share of its water that lies above the depth. A table joins
    on the site and the range; a mapping unfolds in place.
    """
    met = _reached(layers, depths)
    inside = F.least("bottom", "depth_cm") - F.col("top")
    return met.groupBy(*PROFILE_KEYS, "profile", "depth_cm").agg(
        F.coalesce(F.sum(F.col("sw") * inside / (F.col("bottom") - F.col("top"))), F.lit(0.0))
        .alias("profile_water"),
        F.sum(inside).cast("int").alias("covered_cm"))


def swd_to_depths(layers: DataFrame, depths: DataFrame | Mapping[str, int],
                  deepest_cm: int | None = None) -> DataFrame:
    """Soil water deficit to every asked depth; capacity is the most its treatment held.

    ``deepest_cm``, the bottom of the lowest layer, makes a depth below it an error.
    Days whose layers have a gap above the depth tell so by ``covered_cm``.
    """
    water = water_to_depths(layers, depths)
    if deepest_cm is not None:
        water = water.filter(F.assert_true(F.col("depth_cm") <= deepest_cm, F.concat(
            F.lit(f"the layers end at {deepest_cm} cm, above profile "), "profile")).isNull())
    most = F.max("profile_water").over(Window.partitionBy(*TREATMENT, "profile"))
    return (water.withColumn("pawc", most)
            .withColumns({"swd": F.col("profile_water") - F.col("pawc"),
                          "n_rate": nitrogen_label("n_rate")}))
