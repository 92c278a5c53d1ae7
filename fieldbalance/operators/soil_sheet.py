"""Layer means, profiles and balance inputs straight from the wide soil sheet.

A sheet row holds all layers of one reading. Flags are matched once per row and
the layers are averaged side by side, so the join and the first aggregate move
one row per reading rather than one per reading and layer, and the profile sums
need no shuffle at all. The results equal those of the long form in ``soil``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbalance.functions.nulls import to_number
from fieldbalance.operators.soil import (FULL_DEPTH, MM_PER_PERCENT, PROFILE_KEYS,
                                         REPORTED_DEPTHS, TREATMENT, _depth_rows,
                                         _treatment_inputs, layer_numbers, with_deficit)
from fieldbalance.schemas import LAYER_COLUMNS


def sheet_means(soil: DataFrame, flags: DataFrame | None = None,
                layer_columns: Sequence[str] = LAYER_COLUMNS) -> DataFrame:
    """Per treatment and day: ``sw_k``, the mean water (mm) of layer k, and
    ``seen``, whose bit k-1 tells that some cell of layer k was not flagged.

    Which layers are flagged or seen travels as one number. A column for each
    would triple the aggregates and make the generated code too long to compile.
    """
    numbers = layer_numbers(layer_columns)
    if len(numbers) > 62:
        raise ValueError("at most 62 layers fit the mask")
    bit = {name: 1 << (k - 1) for name, k in numbers.items()}
    # Numbers before the join: they are half as wide as their text.
    rows = soil.withColumns({name: to_number(f"`{name}`") for name in numbers})
    if flags is None:
        rows = rows.withColumn("_bad", F.lit(0))
    else:
        mark = " + ".join(f"if(`{name}` = 1, {b}, 0)" for name, b in bit.items())
        # A missing plot matches a missing plot. Grouping by the very columns the
        # join compares lets the marks go into it as they are partitioned.
        plot, no_plot = F.coalesce("plot", F.lit("")), F.col("plot").isNull()
        # A row without a mark changes nothing, and most rows have none.
        marks = flags.filter(F.expr(f"{mark} <> 0")).groupBy(F.col("site_id").alias("_site"), F.col("date").alias("_date"),
                              plot.alias("_plot"), no_plot.alias("_no_plot")).agg(
            F.expr(f"bit_or({mark})").alias("_bad"))
        rows = rows.join(marks, (F.col("site_id") == F.col("_site"))
                         & (F.col("date") == F.col("_date"))
                         & (plot == F.col("_plot")) & (no_plot == F.col("_no_plot")), "left")
        rows = rows.withColumn("_bad", F.coalesce("_bad", F.lit(0)))
    return rows.groupBy(*PROFILE_KEYS).agg(
        F.expr(f"bit_or({sum(bit.values())} & ~_bad)").alias("seen"),
        *[F.expr(f"avg(if(_bad & {bit[name]} = 0, `{name}` * {MM_PER_PERCENT}, NULL))")
          .alias(f"sw_{k}") for name, k in numbers.items()])


def _layer_range(means: DataFrame, depth: int | None = None) -> list[int]:
    """Layers down to a depth, which the sheet must reach; all of them without one."""
    held = sorted(int(c[3:]) for c in means.columns if c.startswith("sw_"))
    if depth is None:
        return held
    if depth not in held:
        raise ValueError(f"a profile of {depth} layers, but the sheet has {len(held)}")
    return [k for k in held if k <= depth]


def _water(means: DataFrame, depth: int) -> tuple[Column, Column]:
    """Profile water to a depth, and whether any cell of it was seen."""
    layers = _layer_range(means, depth)
    water = " + ".join(f"coalesce(sw_{k}, 0D)" for k in layers)
    return F.expr(water), F.expr(f"seen & {sum(1 << (k - 1) for k in layers)} > 0")


def layers_from_means(means: DataFrame) -> DataFrame:
    """The long layer table: one row per layer that has an unflagged cell."""
    rows = F.inline(F.array(*[
        F.struct(F.lit(k).alias("layer"), F.col(f"sw_{k}").alias("sw"),
                 F.expr(f"seen & {1 << (k - 1)} > 0").alias("seen"))
        for k in _layer_range(means)]))
    return means.select(*PROFILE_KEYS, rows).filter("seen").drop("seen")


def named_layers(layers: DataFrame, layer_columns: Sequence[str] = LAYER_COLUMNS) -> DataFrame:
    """The long layer table with the names of the sheet instead of numbers."""
    names = F.create_map(*[F.lit(x) for name, k in layer_numbers(layer_columns).items() for x in (k, name)])
    return layers.withColumn("variable", names[F.col("layer")]).drop("layer")


def swd_from_means(means: DataFrame, max_depth: int = FULL_DEPTH,
                   pawc: float | None = None) -> DataFrame:
    water, seen = _water(means, max_depth)
    return with_deficit(means.filter(seen).select(*PROFILE_KEYS, water.alias("profile_water")),
                        pawc=pawc)


def multi_depth_from_means(means: DataFrame,
                           depths: Mapping[str, int] = REPORTED_DEPTHS) -> DataFrame:
    rows = means.select(*PROFILE_KEYS, _depth_rows(
        {name: _water(means, d) for name, d in depths.items()}))
    return with_deficit(rows.filter("seen").drop("seen"), [*TREATMENT, "profile"])


def inputs_from_means(means: DataFrame, top_depth: int = 3,
                      max_depth: int = FULL_DEPTH) -> DataFrame:
    def shown(depth: int) -> Column:
        water, seen = _water(means, depth)
        return F.when(seen, water)

    return _treatment_inputs(means.select(
        *PROFILE_KEYS, shown(max_depth).alias("full"), shown(top_depth).alias("top")))
