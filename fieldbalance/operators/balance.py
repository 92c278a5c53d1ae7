"""The daily two-store soil water balance of every site and treatment."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator
from math import nan

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Executors get the code of this module with the task; they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value of the readily-available-water term.
RAW_FACTOR = 0.0073

# States of a block of sites that are walked side by side; a block holds at least one site.
BLOCK_STATES = 1 << 18

_START = ["wt0", "ws0", "awhc", "awhcs"]
STATES = ["ws", "es", "wt", "raw", "ex", "aet", "drainage"]


def two_store_states(pet: np.ndarray, rain: np.ndarray, wt0: np.ndarray, ws0: np.ndarray,
                     awhc: np.ndarray, awhcs: np.ndarray,
                     measured: np.ndarray | None = None) -> np.ndarray:
    """States of many series side by side: state, day, series, states as in ``STATES``.

    ``pet``, ``rain`` and ``measured`` have a row per day and a column per series.
    ``wt`` and ``ws`` are the deficits of the profile and of its top store, never
    above 0. Day one holds the start values. NaN stands for missing and passes
    through. A measured deficit, where there is one, replaces the modelled one.
    Only the two deficits depend on the day before, so the loop goes once over the
    days, whatever the number of series; the rest follows for all days at once.
    """
    out = np.zeros((len(STATES), *pet.shape))
    if not pet.size:
        return out
    wts, wss = np.empty(pet.shape), np.empty(pet.shape)
    wts[0], wss[0] = wt0, ws0
    seen = None if measured is None else ~np.isnan(measured)
    with np.errstate(divide="ignore", invalid="ignore"):
        for t in range(1, len(pet)):
            e, p, wt, ws = pet[t], rain[t], wts[t - 1], wss[t - 1]
            es = np.minimum(e, awhcs + ws)
            held = awhc + wt
            ex = np.maximum(es, e * (held / (awhc - RAW_FACTOR * (e * held))))
            level = wt + p - np.minimum(e, ex)
            if seen is not None:
                level = np.where(seen[t], measured[t], level)
            np.minimum(level, 0.0, out=wts[t])
            np.minimum(ws + p - es, 0.0, out=wss[t])
        e, p, before = pet[1:], rain[1:], wts[:-1]
        es = np.minimum(e, awhcs + wss[:-1])
        held = awhc + before
        raw = RAW_FACTOR * (e * held)
        ex = np.maximum(es, e * (held / (awhc - raw)))
        aet = np.minimum(e, ex)
        drainage = np.maximum(0.0, wts[1:] + before + p - aet)
    out[0], out[2] = wss, wts
    for row, values in ((1, es), (3, raw), (4, ex), (5, aet), (6, drainage)):
        out[row, 1:] = values
    return out


def two_store_series(pet: np.ndarray, rain: np.ndarray, wt0: float, ws0: float,
                     awhc: float, awhcs: float, measured: np.ndarray | None = None) -> np.ndarray:
    """States of one series, a column of the result per day, rows as in ``STATES``."""
    return two_store_states(pet[:, None], rain[:, None], wt0, ws0, awhc, awhcs,
                            None if measured is None else measured[:, None])[:, :, 0]


def _floats(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(float)


def _sites(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, pa.Table]]:
    """The rows of one site after the other, from batches in which sites are together."""
    held, name = [], None
    for batch in batches:
        runs, start = pc.run_end_encode(batch.column("site_id")), 0
        for end, site in zip(runs.run_ends.to_pylist(), runs.values.to_pylist()):
            if held and site != name:
                yield name, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            name, start = site, end
    if held:
        yield name, pa.Table.from_batches(held)


class _Site:
    """Days and treatments of one site: the row with its treatments comes before its days."""

    def __init__(self, name: str, rows: pa.Table, level_columns: dict[int, str]):
        self.name = name
        self.starts = rows["starts"][0].as_py() or []
        daily = rows.slice(1) if self.starts else rows
        self.day = daily["day"].to_numpy()
        if not self.starts:
            return
        if (np.diff(self.day) == 0).any():
            raise ValueError(f"site {name} has two daily rows for one date")
        self.pet = _floats(daily["pet"])
        missing = {s["irrigation"] for s in self.starts} - set(level_columns)
        if missing and len(self.day):
            raise ValueError(f"no precipitation column for irrigation {min(missing)}")
        self.rain = {k: _floats(daily[c]) for k, c in level_columns.items()}

    @property
    def walks(self) -> bool:
        return bool(self.starts) and len(self.day) > 0

    def measured(self, start: dict) -> np.ndarray:
        """The measured deficits of a treatment on its days; other days are missing."""
        swd = np.full(len(self.day), nan)
        found = start["measured"]
        if found:
            when = np.array([m["day"] for m in found])
            if (np.diff(when) == 0).any():
                raise ValueError(f"site {self.name} has two measured deficits for one date")
            at = np.searchsorted(self.day, when)
            hit = (at < len(self.day)) & (self.day[np.minimum(at, len(self.day) - 1)] == when)
            swd[at[hit]] = np.array([m["swd"] for m in found], float)[hit]
        return swd


def _walk(sites: list[_Site], out_schema: pa.Schema) -> pa.RecordBatch:
    """All series of some sites, padded to the longest at their ends."""
    series = [(site, start) for site in sites for start in site.starts]
    days = np.array([len(site.day) for site, _ in series])
    longest = int(days.max())

    def padded(values: Iterable[np.ndarray]) -> np.ndarray:
        table = np.full((len(series), longest), nan)
        for row, found in zip(table, values):
            row[:len(found)] = found
        return table

    pet = padded(site.pet for site, _ in series)
    rain = padded(site.rain[start["irrigation"]] for site, start in series)
    swd = None
    if any(start["measured"] for _, start in series):
        swd = padded(site.measured(start) for site, start in series)
    first = [np.array([start[c] for _, start in series], float) for c in _START]
    across = [None if x is None else np.ascontiguousarray(x.T) for x in (pet, rain, swd)]
    states = two_store_states(across[0], across[1], *first, measured=across[2])
    inside = np.arange(longest) < days[:, None]
    which = np.repeat(np.arange(len(series)), days)

    def column(values: np.ndarray | None) -> pa.Array:
        return (pa.nulls(len(which), pa.float64()) if values is None
                else pa.array(values[inside], from_pandas=True))

    dates = np.concatenate([site.day for site, _ in series])
    return pa.RecordBatch.from_arrays(
        [pa.array([site.name for site, _ in series], pa.string()).take(which),
         pa.array(np.array([start["irrigation"] for _, start in series], np.int32)[which]),
         pa.array([start["n_rate"] for _, start in series], pa.string()).take(which),
         pa.array(dates, pa.int32(), from_pandas=True).cast(pa.date32()),
         column(pet), column(rain), column(swd), *[column(state.T) for state in states]],
        schema=out_schema)


def _block_runner(level_columns: dict[int, str], out_schema: pa.Schema, block_states: int):
    """Sites of a partition, some at a time: a block is bounded whatever the partition holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, longest, series = [], 0, 0
        for name, rows in _sites(batches):
            site = _Site(name, rows, level_columns)
            if not site.walks:
                continue
            wider = max(longest, len(site.day)) * (series + len(site.starts))
            if block and wider > block_states:
                yield _walk(block, out_schema)
                block, longest, series = [], 0, 0
            block.append(site)
            longest, series = max(longest, len(site.day)), series + len(site.starts)
        if block:
            yield _walk(block, out_schema)

    return run


_OUT = pa.schema([("site_id", pa.string()), ("irrigation", pa.int32()), ("n_rate", pa.string()),
                  ("date", pa.date32()), ("pet", pa.float64()), ("precipitation", pa.float64()),
                  ("swd", pa.float64()), *[(s, pa.float64()) for s in STATES]])
_OUT_DDL = ("site_id string, irrigation int, n_rate string, date date, pet double, "
            "precipitation double, swd double, " + ", ".join(f"{s} double" for s in STATES))


def nested_resets(reset: DataFrame, same_day: str = "raise") -> DataFrame:
    """Measured deficits as one array (date, swd) per treatment, in date order.

    A treatment may be measured twice on one day, under two crops. ``same_day`` says what
    counts then: "raise" (both stay, and the walk raises), "driest" (the larger
    deficit) or "mean" (of the values that are there). With one value a day an array
    is bounded by the calendar.
    """
    keys = ["site_id", "irrigation", "n_rate"]
    one = {"driest": F.min, "mean": F.avg}
    days = reset.filter(F.col("date").isNotNull()).withColumn("swd", F.col("swd").cast("double"))
    if same_day in one:
        days = days.groupBy(*keys, "date").agg(one[same_day]("swd").alias("swd"))
    elif same_day != "raise":
        raise ValueError("same_day is 'raise', 'driest' or 'mean'")
    return days.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("date", "swd"))).alias("measured"))


def water_balance(daily: DataFrame, treatments: DataFrame, reset: DataFrame | None = None,
                  pet_col: str = "pet", same_day: str = "raise",
                  block_states: int = BLOCK_STATES) -> DataFrame:
    """Daily states of every treatment of every site.

    Each day depends on the day before, so a site's days are walked in order;
    sites are independent and run in parallel. Days and treatments meet in one
    shuffle by site: a site is the row of its treatments, then its days, so one day is
    shuffled and handed to Python once, not once per treatment. Python walks the
    series of several sites side by side, one step per day for all of them, in blocks of
    ``block_states`` states, so its memory does not grow with a partition. A site has one
    row per calendar day (two are an error), which bounds what one site adds.

    ``daily`` has a ``precipitation_<level>`` column per irrigation level,
    ``treatments`` is made by ``balance_inputs``. ``reset`` optionally holds
    measured deficits (site_id, irrigation, n_rate, date, swd); they travel as one
    array per treatment, so its parameters go to Python once, and ``same_day`` says
    what two of one day mean (see ``nested_resets``). The raw PET enters unless
    ``pet_col`` names another column.
    """
    levels = {int(m.group(1)): c for c in daily.columns
              if (m := re.fullmatch(r"precipitation_(\d+)", c))}
    if not levels:
        raise ValueError("daily rows need a precipitation_<level> column")
    days = daily.select("site_id", F.unix_date("date").alias("day"), F.col(pet_col).cast("double").alias("pet"),
                        *[F.col(c).cast("double").alias(c) for c in levels.values()])
    starts = treatments.select("site_id", F.col("irrigation").cast("int").alias("irrigation"),
                               "n_rate", *_START)
    if reset is None:
        starts = starts.withColumn("measured", F.lit(None).cast("array<struct<date:date,swd:double>>"))
    elif "swd" not in reset.columns:
        raise ValueError("a reset table needs the measured deficit in column swd")
    else:
        starts = starts.join(nested_resets(reset, same_day), ["site_id", "irrigation", "n_rate"], "left")
    measured = F.transform("measured", lambda m: F.struct(F.unix_date(m["date"]).alias("day"), m["swd"].alias("swd")))
    nested = starts.groupBy("site_id").agg(F.sort_array(F.collect_list(F.struct(
        "irrigation", "n_rate", *[F.col(c).cast("double").alias(c) for c in _START],
        measured.alias("measured")))).alias("starts"))
    rows = days.unionByName(nested, allowMissingColumns=True)
    states = (rows.repartition("site_id")
              .sortWithinPartitions("site_id", F.col("starts").isNull(), F.col("day").asc_nulls_last())
              .mapInArrow(_block_runner(levels, _OUT, block_states), _OUT_DDL))
    return states if reset is not None else states.drop("swd")
