"""Soil readings: flagged cells, layer means, profile water and deficit.

The long form has one row per reading and layer. ``soil_sheet`` computes the
same layer means and profiles straight from the wide sheet, with an eighth of
the rows in the shuffles; use it when readings come as a sheet.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbalance.functions.dates import nitrogen_label
from fieldbalance.functions.nulls import to_number, total
from fieldbalance.operators.reshape import melt

READING_IDS = ["site_id", "crop", "date", "plot", "irrigation", "n_rate"]
PROFILE_KEYS = ["site_id", "crop", "date", "irrigation", "n_rate"]
TREATMENT = ["site_id", "irrigation", "n_rate"]

# Depths reported by name, in layers of the profile.
REPORTED_DEPTHS = {"20 cm": 1, "40 cm": 2, "60 cm": 3}
FULL_DEPTH = 8
# A reading is percent of a 20 cm layer; doubled it is millimetres.
MM_PER_PERCENT = 2


def melt_layers(soil: DataFrame, measures: Sequence[str] | str = "^VWC") -> DataFrame:
    """One row per reading and layer, text values turned into numbers."""
    return melt(soil, READING_IDS, measures).withColumn("value", to_number("value"))


def flagged_cells(flags: DataFrame, measures: Sequence[str] | str = "^VWC") -> DataFrame:
    """Cells somebody marked as wrong, without the comments."""
    ids = ["site_id", "date", "plot"]
    return melt(flags.drop("comments"), ids, measures).filter(F.col("value") == 1)


def _same_cell(readings: DataFrame, flags: DataFrame) -> Column:
    # The plot may be missing on both sides, and missing then means the same plot.
    return ((readings["site_id"] == flags["flag_site"]) & (readings["date"] == flags["flag_date"])
            & (readings["variable"] == flags["flag_variable"])
            & readings["plot"].eqNullSafe(flags["flag_plot"]))


def _flag_keys(flags: DataFrame, *more: Column) -> DataFrame:
    return flags.select(F.col("site_id").alias("flag_site"), F.col("date").alias("flag_date"),
                        F.col("plot").alias("flag_plot"),
                        F.col("variable").alias("flag_variable"), *more)


#: 64-bit words of the filter of flagged cells: at most this many rows are broadcast.
FILTER_WORDS = 1 << 17


def _by_filter(readings: DataFrame, side: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readings that surely have no flag, and those that may have one.

    Few cells are flagged, and a join would shuffle every reading to find them. The
    flagged cells become a bit filter of fixed size, which every task can hold; only
    readings it lets through need the join. A crowded filter lets more of them through.
    """
    flag = {"site_id": "flag_site", "date": "flag_date", "plot": "flag_plot", "variable": "flag_variable"}
    left, right = dict(readings.dtypes), dict(side.dtypes)
    # Equal values of unlike types have unlike hashes: those columns are left to the join.
    names = [c for c, f in flag.items() if left[c] == right[f]]

    def bit(columns: list[Column]) -> tuple[Column, Column]:
        place = F.pmod(F.xxhash64(F.lit(0), *columns), F.lit(FILTER_WORDS * 64))
        return F.shiftrightunsigned(place, 6), (place % 64).cast("int")

    word, at = bit([F.col(flag[c]) for c in names])
    held = (side.select(word.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), at).alias("_bit"))
            .groupBy("_word").agg(F.bit_or("_bit").alias("_mask")))
    word, at = bit([readings[c] for c in names])
    marked = readings.join(F.broadcast(held), word == F.col("_word"), "left")
    hit = F.call_function("shiftright", F.coalesce("_mask", F.lit(0).cast("long")), at).bitwiseAND(F.lit(1).cast("long")) == 1
    return marked.filter(~hit).drop("_word", "_mask"), marked.filter(hit).drop("_word", "_mask")


def join_flags(readings: DataFrame, flags: DataFrame) -> DataFrame:
    """All readings, each with the flag of its cell if there is one."""
    side = _flag_keys(flags, F.col("value").alias("flag"))
    plain, some = _by_filter(readings, side)
    joined = (some.join(side, _same_cell(some, side), "left")
              .drop("flag_site", "flag_date", "flag_plot", "flag_variable"))
    return plain.withColumn("flag", F.lit(None).cast(side.schema["flag"].dataType)).unionByName(joined)


def drop_flagged(readings: DataFrame, flags: DataFrame) -> DataFrame:
    """Readings whose cell nobody flagged."""
    side = _flag_keys(flags)
    plain, some = _by_filter(readings, side)
    return plain.unionByName(some.join(side, _same_cell(some, side), "left_anti"))


def layer_mean(readings: DataFrame) -> DataFrame:
    """Mean water (mm) of each layer over the plots of a treatment."""
    return (readings.groupBy("site_id", "crop", "date", "variable", "irrigation", "n_rate")
            .agg(F.avg(F.col("value") * MM_PER_PERCENT).alias("sw")))


def layer_numbers(names: Sequence[str]) -> dict[str, int]:
    """Layers numbered from the surface by the depth in their name."""
    top = {n: int(re.search(r"\d+", n).group()) for n in names}
    return {n: i for i, n in enumerate(sorted(names, key=top.get), start=1)}


def order_layers(layers: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace the layer name by its number; the header gives all names."""
    numbers = layer_numbers(names)
    lookup = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
    return layers.withColumn("layer", lookup[F.col("variable")]).drop("variable")


def layer_count_check(layers: DataFrame, max_depth: int = FULL_DEPTH) -> DataFrame:
    """Per site the number of layers, and whether the asked depth is covered."""
    return (layers.groupBy("site_id").agg(F.count_distinct("layer").alias("layers"))
            .withColumn("covers_depth", F.col("layers") >= max_depth))


def profile_depth(layers: DataFrame, max_depth: int = FULL_DEPTH) -> DataFrame:
    """Water of the profile from the surface down to a layer."""
    return (layers.filter(F.col("layer").between(1, max_depth))
            .groupBy(*PROFILE_KEYS).agg(total("sw").alias("profile_water")))


def with_deficit(profiles: DataFrame, by: Sequence[str] = TREATMENT,
                 pawc: float | None = None) -> DataFrame:
    """Capacity (largest profile water of the treatment, or given) and deficit.

    A profile table has one row per crop and day of a treatment, so the days on
    the calendar bound each window partition.
    """
    capacity = (F.max("profile_water").over(Window.partitionBy(*by)) if pawc is None
                else F.lit(float(pawc)))
    return (profiles.withColumn("pawc", capacity)
            .withColumns({"swd": F.col("profile_water") - F.col("pawc"),
                          "n_rate": nitrogen_label("n_rate")}))


def swd_profile(layers: DataFrame, max_depth: int = FULL_DEPTH,
                pawc: float | None = None) -> DataFrame:
    """Soil water deficit of the profile down to a layer."""
    return with_deficit(profile_depth(layers, max_depth), pawc=pawc)


def pawc_by_treatment(layers: DataFrame, max_depth: int = FULL_DEPTH) -> DataFrame:
    """Largest profile water of every treatment."""
    return (profile_depth(layers, max_depth).groupBy(*TREATMENT)
            .agg(F.max("profile_water").alias("awhc"))
            .withColumn("n_rate", nitrogen_label("n_rate")))


def capacity_global(layers: DataFrame, top_layers: int = 3) -> DataFrame:
    """Per site the largest profile, and the shares an even profile would give."""
    most = F.max("profile_water")
    return (profile_depth(layers).groupBy("site_id")
            .agg(most.alias("awhc"), (most / FULL_DEPTH * top_layers).alias("awhc_top"),
                 (most / FULL_DEPTH).alias("awhc_layer")))


def _depth_rows(depths: Mapping[str, tuple[Column, Column]]) -> Column:
    return F.inline(F.array(*[
        F.struct(F.lit(name).alias("profile"), water.alias("profile_water"), seen.alias("seen"))
        for name, (water, seen) in depths.items()]))


def swd_multi_depth(layers: DataFrame, depths: Mapping[str, int] = REPORTED_DEPTHS) -> DataFrame:
    """Deficits to several depths from one pass over the layers."""
    within = {name: F.col("layer").between(1, d) for name, d in depths.items()}
    sums = layers.groupBy(*PROFILE_KEYS).agg(
        *[total(F.when(w, F.col("sw"))).alias(f"_sum_{i}") for i, w in enumerate(within.values())],
        *[F.count_if(w).alias(f"_seen_{i}") for i, w in enumerate(within.values())])
    rows = sums.select(*PROFILE_KEYS, _depth_rows({
        name: (F.col(f"_sum_{i}"), F.col(f"_seen_{i}") > 0) for i, name in enumerate(within)}))
    return with_deficit(rows.filter("seen").drop("seen"), [*TREATMENT, "profile"])


def start_deficit(layers: DataFrame, max_depth: int = FULL_DEPTH) -> DataFrame:
    """Deficit of every treatment on its first day, in one aggregate."""
    first = F.min_by("profile_water", F.struct("date", "crop"))
    return (profile_depth(layers, max_depth).groupBy(*TREATMENT)
            .agg(F.min("date").alias("date"),
                 (first - F.max("profile_water")).alias("swd"))
            .withColumn("n_rate", nitrogen_label("n_rate")))


def _treatment_inputs(profiles: DataFrame) -> DataFrame:
    """Start deficits and capacities from ``full`` and ``top`` profile water."""
    def first(col: str) -> Column:
        return F.min_by(col, F.when(F.col(col).isNotNull(), F.struct("date", "crop")))

    return (profiles.groupBy(*TREATMENT)
            .agg((first("full") - F.max("full")).alias("wt0"),
                 (first("top") - F.max("top")).alias("ws0"),
                 F.max("full").alias("awhc"), F.max("top").alias("awhcs"))
            # A treatment must have both profiles.
            .filter(F.col("awhc").isNotNull() & F.col("awhcs").isNotNull())
            .withColumn("n_rate", nitrogen_label("n_rate")))


def balance_inputs(layers: DataFrame, top_depth: int = 3,
                   max_depth: int = FULL_DEPTH) -> DataFrame:
    """What the daily balance needs per treatment: wt0, ws0, awhc, awhcs.

    Conditional aggregates over one grouping stand in for four passes over the
    layers and three joins.
    """
    def water(depth: int) -> Column:
        inside = F.col("layer").between(1, depth)
        return F.when(F.count_if(inside) > 0, total(F.when(inside, F.col("sw"))))

    return _treatment_inputs(layers.groupBy(*PROFILE_KEYS).agg(
        water(max_depth).alias("full"), water(top_depth).alias("top")))
