"""The trial views and every query as plain SQL, for the check against DuckDB.

Each view names the views it reads; ``statement`` puts just those in front of a
query. The SQL follows the definitions (rows melted, calendars walked day by
day, next values looked up) and not the way the Spark side gets there.
"""

from __future__ import annotations

import re

from fieldbalance.plans.trial import (CANOPY_OF_EVENT, GROWTH_EVENTS, MONTHS_BACK,
                                      UNEVEN_LAYERS)
from fieldbalance.schemas import LAYER_COLUMNS

VIEWS: dict[str, str] = {}
WALK = "UNION ALL -- day by day"


def _crop(date: str) -> str:
    return (f"CASE (year({date}) * 2 + CASE WHEN month({date}) > 6 THEN 1 ELSE 0 END) % 4 "
            "WHEN 1 THEN 'Wheat' WHEN 2 THEN 'Broccoli' ELSE 'Potato' END")


def _case(column: str, values: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + " END"


def statement(body: str) -> str:
    """The body with the views it needs, in order, as common table expressions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and VIEWS[name] is not text and re.search(rf"\b{name}\b", text):
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    heads = [f"{n} AS ({VIEWS[n]})" if WALK in VIEWS[n] else f"{n} AS MATERIALIZED ({VIEWS[n]})"
             for n in needed]
    return "WITH RECURSIVE " + ",\n".join(heads) + "\n" + body


def _cells(names: list[str]) -> str:
    return ",\n".join(
        f"CASE WHEN (l_orderkey + {k}) % 97 = 0 THEN 'n/a' WHEN (l_partkey + {k}) % 53 = 0 THEN NULL "
        f"ELSE CAST(8 + (CAST(l_quantity AS BIGINT) * {k + 3} + l_partkey) % 30 AS VARCHAR) || '.5' "
        f"END AS {name}" for k, name in enumerate(names))


def _soil(names: list[str], rates: int = 4) -> str:
    return f"""
SELECT 'S' || (l_suppkey // 4) AS site_id, {_crop('l_shipdate')} AS crop,
  CAST(date_trunc('month', l_shipdate) AS DATE) AS date, CAST(l_suppkey AS VARCHAR) AS plot,
  CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS irrigation,
  (l_linenumber - 1) % {rates} + 1 AS n_rate,
{_cells(names)}
FROM lineitem"""


VIEWS["v_soil"] = _soil(LAYER_COLUMNS)

_MARKS = ",\n".join(
    f"CASE WHEN o_orderstatus = 'P' AND o_orderkey % 8 = {k} THEN 1 END AS {name}"
    for k, name in enumerate(LAYER_COLUMNS))

VIEWS["v_flags"] = f"""
SELECT 'S' || (o_custkey // 60) AS site_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
  CAST(o_custkey // 15 AS VARCHAR) AS plot,
{_MARKS},
  o_orderpriority AS comments
FROM orders"""

VIEWS["v_pet"] = """
SELECT 'S' || (l_suppkey // 4) AS site_id, CAST(l_shipdate AS DATE) AS date,
  CAST(CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) * 10 // count(*) AS DOUBLE) / 10 AS pet
FROM lineitem GROUP BY 1, 2"""

VIEWS["v_rain"] = """
SELECT 'S' || (l_suppkey // 4) AS site_id, CAST(l_shipdate AS DATE) AS date,
  greatest(max(l_quantity) - 40, 0) * 2 AS rain
FROM lineitem GROUP BY 1, 2"""

VIEWS["v_gauge"] = """
SELECT 'S' || (o_custkey // 60) AS site_id, CAST(o_orderdate AS DATE) AS date,
  CAST(count(*) AS DOUBLE) AS rain
FROM orders GROUP BY 1, 2"""

VIEWS["v_diary"] = f"""
SELECT site_id, {_crop('date')} AS crop, date,
  CASE WHEN f > 0 THEN f * CAST(5 AS DOUBLE) END AS irrigation_1,
  CASE WHEN o > 0 THEN o * CAST(5 AS DOUBLE) END AS irrigation_2
FROM (SELECT 'S' || (o_custkey // 60) AS site_id, CAST(o_orderdate AS DATE) AS date,
        count(*) FILTER (WHERE o_orderstatus = 'F') AS f,
        count(*) FILTER (WHERE o_orderstatus = 'O') AS o
      FROM orders GROUP BY 1, 2)"""

VIEWS["v_canopy_all"] = f"""
SELECT 'S' || (user_id // 6) AS site_id,
  {_case('event_type', {e: f"'{c}'" for e, (c, _, _) in CANOPY_OF_EVENT.items()})} AS crop,
  CASE WHEN event_type = 'error' THEN 'Sunscan' ELSE 'Greenseeker' END AS sensor,
  {_case('event_type', {e: f"DATE '{d}' + CAST(day(ts) * {s} AS INTEGER)"
                        for e, (_, d, s) in CANOPY_OF_EVENT.items()})} AS date,
  CAST(CASE WHEN event_id % 50 <> 0 THEN event_id % 2 + 1 END AS INTEGER) AS irrigation,
  CAST(event_id // 2 % 4 + 1 AS INTEGER) AS nitrogen,
  least(value, 100) / 199 + day(ts) / CAST(61 AS DOUBLE) AS ndvi
FROM events"""

VIEWS["v_canopy"] = "SELECT * FROM v_canopy_all WHERE sensor = 'Greenseeker'"

VIEWS["v_sites"] = """
SELECT DISTINCT s_suppkey // 4 AS site_no, 'S' || (s_suppkey // 4) AS site_id FROM supplier"""

VIEWS["v_events"] = f"""
SELECT site_id, CAST(CAST(day AS DATE) - INTERVAL {MONTHS_BACK} MONTH AS DATE)
    + CAST(site_no % 5 AS INTEGER) AS date, events
FROM v_sites, (VALUES {", ".join(f"('{d}', '{e}')" for d, e in GROWTH_EVENTS)}) AS t(day, events)"""

# Soil: everything in long form.
VIEWS["v_long"] = f"""
SELECT site_id, crop, date, plot, irrigation, n_rate, variable, TRY_CAST(value AS DOUBLE) AS value
FROM v_soil UNPIVOT INCLUDE NULLS (value FOR variable IN ({", ".join(LAYER_COLUMNS)}))"""

VIEWS["v_cells"] = f"""
SELECT site_id, date, plot, variable, value
FROM v_flags UNPIVOT (value FOR variable IN ({", ".join(LAYER_COLUMNS)}))
WHERE value = 1"""

VIEWS["v_kept"] = """
SELECT l.* FROM v_long l ANTI JOIN v_cells c
  ON l.site_id = c.site_id AND l.date = c.date AND l.plot = c.plot AND l.variable = c.variable"""

VIEWS["v_mean"] = """
SELECT site_id, crop, date, variable, irrigation, n_rate, avg(value * 2) AS sw
FROM v_kept GROUP BY ALL"""

VIEWS["v_layers"] = """
SELECT m.site_id, m.crop, m.date, m.irrigation, m.n_rate, m.sw, CAST(n.layer AS INTEGER) AS layer
FROM v_mean m JOIN (
  SELECT variable, dense_rank() OVER (
    ORDER BY CAST(regexp_extract(variable, '[0-9]+') AS INTEGER)) AS layer
  FROM (SELECT DISTINCT variable FROM v_mean)) n USING (variable)"""

VIEWS["v_profiles"] = """
SELECT site_id, crop, date, irrigation, n_rate, depth, coalesce(sum(sw), 0) AS profile_water
FROM v_layers JOIN (VALUES (1), (2), (3), (8)) AS d(depth) ON layer <= depth
GROUP BY ALL"""

VIEWS["v_swd"] = """
SELECT *, profile_water - pawc AS swd FROM (
  SELECT site_id, crop, date, irrigation, 'Nitrogen ' || n_rate AS n_rate, depth, profile_water,
    max(profile_water) OVER (PARTITION BY site_id, irrigation, n_rate, depth) AS pawc
  FROM v_profiles)"""

VIEWS["v_depths"] = """
SELECT site_id, crop, date, irrigation, n_rate, (depth * 20) || ' cm' AS profile,
  profile_water, pawc, swd
FROM v_swd WHERE depth <= 3"""

VIEWS["v_starts"] = """
SELECT site_id, irrigation, n_rate, depth, date, swd, pawc FROM v_swd
QUALIFY row_number() OVER (
  PARTITION BY site_id, irrigation, n_rate, depth ORDER BY date, crop) = 1"""

VIEWS["v_inputs"] = """
SELECT site_id, irrigation, n_rate, a.swd AS wt0, b.swd AS ws0, a.pawc AS awhc, b.pawc AS awhcs
FROM (SELECT * FROM v_starts WHERE depth = 8) a
JOIN (SELECT * FROM v_starts WHERE depth = 3) b USING (site_id, irrigation, n_rate)"""

# Weather.
VIEWS["v_weather"] = """
SELECT p.site_id, p.date, p.pet, r.rain FROM v_pet p LEFT JOIN v_rain r USING (site_id, date)"""

VIEWS["v_irrigation"] = """
SELECT site_id, crop, date, 'irrigation_1' AS treatment, irrigation_1 AS irrigation FROM v_diary
UNION ALL
SELECT site_id, crop, date, 'irrigation_2', irrigation_2 FROM v_diary"""

VIEWS["v_joined"] = """
SELECT w.site_id, w.date, w.pet, w.rain, i.crop, i.treatment, i.irrigation
FROM v_weather w LEFT JOIN v_irrigation i ON w.site_id = i.site_id AND w.date = i.date"""

VIEWS["v_daywise"] = """
SELECT site_id, date, pet, rain, crop,
  max(CASE WHEN treatment = 'irrigation_1' THEN irrigation END) AS irrigation_1,
  max(CASE WHEN treatment = 'irrigation_2' THEN irrigation END) AS irrigation_2
FROM v_joined GROUP BY ALL"""

VIEWS["v_daily"] = """
SELECT site_id, date, pet, rain, irrigation_1, irrigation_2,
  rain + irrigation_1 AS precipitation_1, rain + irrigation_2 AS precipitation_2,
  last_value(seeded IGNORE NULLS) OVER (PARTITION BY site_id ORDER BY date) AS crop
FROM (
  SELECT site_id, date, pet, rain, coalesce(irrigation_1, 0) AS irrigation_1,
    coalesce(irrigation_2, 0) AS irrigation_2,
    CASE WHEN row_number() OVER (PARTITION BY site_id ORDER BY date) = 1
      THEN 'Potato' ELSE crop END AS seeded
  FROM v_daywise)"""

# Canopy: stages on a calendar, walked day by day.
VIEWS["v_summary"] = """
SELECT site_id, crop, sensor, date, CAST(irrigation AS VARCHAR) AS irrigation,
  CAST(nitrogen AS VARCHAR) AS nitrogen, avg(ndvi) AS mean, stddev_samp(ndvi) AS sd
FROM v_canopy WHERE irrigation IS NOT NULL GROUP BY ALL"""

VIEWS["v_cover"] = """
SELECT site_id, crop, date, irrigation, nitrogen, mean, sd FROM v_summary WHERE mean >= 0.75
QUALIFY row_number() OVER (PARTITION BY site_id, crop ORDER BY date, irrigation, nitrogen) = 1"""

VIEWS["v_parsed"] = """
SELECT site_id, date, crop, events FROM (
  SELECT site_id, date, split_part(events, ' ', 1) AS crop, split_part(events, ' ', 2) AS events
  FROM v_events)
WHERE regexp_matches(events, 'emerged|harvest|plant')"""

VIEWS["v_stages"] = """
SELECT site_id, date, crop, events, coalesce(mean,
  CASE WHEN regexp_matches(events, 'planted|harvest') THEN 0
       WHEN regexp_matches(events, 'emerged') THEN 0.1 END) AS mean
FROM (SELECT coalesce(e.site_id, c.site_id) AS site_id, coalesce(e.date, c.date) AS date,
        coalesce(e.crop, c.crop) AS crop, coalesce(e.events, 'canopy-closure') AS events, c.mean
      FROM v_parsed e FULL JOIN v_cover c ON e.site_id = c.site_id AND e.date = c.date)"""

VIEWS["v_calendar"] = """
SELECT site_id, CAST(unnest(generate_series(CAST(first_date AS TIMESTAMP),
  CAST(last_date AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
FROM (SELECT site_id, min(date) AS first_date, max(date) AS last_date FROM v_stages GROUP BY 1)"""

VIEWS["v_dayjoin"] = """
SELECT coalesce(d.site_id, s.site_id) AS site_id, coalesce(d.date, s.date) AS date,
  s.events, s.mean, s.crop
FROM v_calendar d FULL JOIN v_stages s ON d.site_id = s.site_id AND d.date = s.date"""

VIEWS["v_stageday"] = """
SELECT site_id, date, mean, stage_no,
  max(crop) OVER (PARTITION BY site_id, stage_no) AS crop,
  max(events) OVER (PARTITION BY site_id, stage_no) AS events,
  row_number() OVER (PARTITION BY site_id, stage_no ORDER BY date DESC) AS from_end
FROM (
  SELECT *, count(events) OVER (PARTITION BY site_id ORDER BY date, crop, events
    ROWS UNBOUNDED PRECEDING) AS stage_no
  FROM v_dayjoin)"""

VIEWS["v_ends"] = """
SELECT site_id, stage_no, start_value,
  CASE WHEN events = 'canopy-closure' THEN 1
    ELSE coalesce(lead(nominal) OVER (PARTITION BY site_id ORDER BY stage_no), 0.15) END AS end_value
FROM (
  SELECT *, CASE WHEN events = 'canopy-closure' THEN 1 ELSE start_value END AS nominal
  FROM (SELECT site_id, stage_no, events,
          CAST(CASE WHEN mean IN (0, 0.1) THEN 0.15 WHEN mean > 0.75 THEN 1 END AS DOUBLE) AS start_value
        FROM v_stageday
        QUALIFY row_number() OVER (PARTITION BY site_id, stage_no ORDER BY date) = 1))"""

VIEWS["v_coefficient"] = """
SELECT site_id, date, crop, events, mean,
  CASE WHEN from_end = 1 THEN end_value
    ELSE start_value + (end_value - start_value) * ((date - first_date)
      / CAST(last_date - first_date AS DOUBLE)) END AS pet_correction
FROM (
  SELECT d.*, e.start_value, e.end_value,
    min(date) OVER (PARTITION BY d.site_id, d.stage_no) AS first_date,
    max(date) OVER (PARTITION BY d.site_id, d.stage_no) AS last_date
  FROM v_stageday d JOIN v_ends e ON d.site_id = e.site_id AND d.stage_no = e.stage_no)"""

# Canopy index on every day, on the line between observations.
VIEWS["v_canopy_days"] = """
SELECT site_id, crop, CAST(unnest(generate_series(CAST(first_date AS TIMESTAMP),
  CAST(last_date AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
FROM (SELECT site_id, crop, min(date) AS first_date, max(date) AS last_date
      FROM v_canopy GROUP BY ALL)"""

VIEWS["v_canopy_seen"] = """
SELECT site_id, crop, date, avg(ndvi) AS ndvi FROM v_canopy WHERE irrigation IS NOT NULL
GROUP BY ALL"""

VIEWS["v_canopy_line"] = """
SELECT site_id, crop, date, coalesce(ndvi, y0 + (y1 - y0) * ((date - d0)
  / nullif(CAST(d1 - d0 AS DOUBLE), 0))) AS ndvi
FROM (
  SELECT d.site_id, d.crop, d.date, s.ndvi,
    last_value(s.date IGNORE NULLS) OVER before AS d0,
    last_value(s.ndvi IGNORE NULLS) OVER before AS y0,
    first_value(s.date IGNORE NULLS) OVER following AS d1,
    first_value(s.ndvi IGNORE NULLS) OVER following AS y1
  FROM v_canopy_days d LEFT JOIN v_canopy_seen s
    ON d.site_id = s.site_id AND d.crop = s.crop AND d.date = s.date
  WINDOW before AS (PARTITION BY d.site_id, d.crop ORDER BY d.date ROWS UNBOUNDED PRECEDING),
    following AS (PARTITION BY d.site_id, d.crop ORDER BY d.date
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""

VIEWS["v_corrected"] = """
SELECT d.*, d.pet * coalesce(c.pet_correction, 0.15) AS pet_correction
FROM v_daily d LEFT JOIN v_coefficient c
  ON d.site_id = c.site_id AND d.date = c.date AND d.crop = c.crop"""


def _series(pet: str, days: str = "v_corrected", swd: str = "m.swd") -> str:
    return f"""
SELECT i.site_id, i.irrigation, i.n_rate, d.date, {pet} AS pet,
  CASE i.irrigation WHEN 1 THEN d.precipitation_1 ELSE d.precipitation_2 END AS precipitation,
  {swd} AS swd, i.wt0, i.ws0, i.awhc, i.awhcs,
  dense_rank() OVER (ORDER BY i.site_id, i.irrigation, i.n_rate) AS series,
  row_number() OVER (PARTITION BY i.site_id, i.irrigation, i.n_rate ORDER BY d.date) AS t
FROM {days} d JOIN v_inputs i ON d.site_id = i.site_id
LEFT JOIN (SELECT * FROM v_swd WHERE depth = 3) m
  ON m.site_id = i.site_id AND m.irrigation = i.irrigation AND m.n_rate = i.n_rate
  AND m.date = d.date"""


def _walk(series: str, name: str, reset: bool, strict: bool = False) -> str:
    def fold(f: str, *args: str) -> str:
        """Smallest or largest; with ``strict`` missing as soon as an argument is."""
        plain = f"{f}({', '.join(args)})"
        known = " AND ".join(f"({a}) IS NOT NULL" for a in args)
        return f"CASE WHEN {known} THEN {plain} END" if strict else plain

    modelled = "ow + precipitation - aet"
    following = f"coalesce(swd, {modelled})" if reset else modelled
    return f"""
SELECT site_id, irrigation, n_rate, date, pet, precipitation, swd, awhc, awhcs, series, t,
  ws0 AS ws, CAST(0 AS DOUBLE) AS es, wt0 AS wt, CAST(0 AS DOUBLE) AS raw,
  CAST(0 AS DOUBLE) AS ex, CAST(0 AS DOUBLE) AS aet, CAST(0 AS DOUBLE) AS drainage
FROM {series} WHERE t = 1
{WALK}
SELECT site_id, irrigation, n_rate, date, pet, precipitation, swd, awhc, awhcs, series, t,
  ws, es, wt, raw, ex, aet, {fold('greatest', '0', 'wt + ow + precipitation - aet')} AS drainage
FROM (SELECT *, {fold('least', '0', following)} AS wt
  FROM (SELECT *, {fold('least', 'pet', 'ex')} AS aet
    FROM (SELECT *, {fold('greatest', 'es', 'pet * ((awhc + ow) / (awhc - raw))')} AS ex
      FROM (SELECT *, {fold('least', '0', 'os + precipitation - es')} AS ws,
              CAST(0.0073 AS DOUBLE) * (pet * (awhc + ow)) AS raw
        FROM (SELECT s.*, w.ws AS os, w.wt AS ow, {fold('least', 's.pet', 's.awhcs + w.ws')} AS es
              FROM {name} w JOIN {series} s ON s.series = w.series AND s.t = w.t + 1)))))"""


VIEWS["v_series"] = _series("d.pet")
VIEWS["v_states"] = _walk("v_series", "v_states", reset=False)
VIEWS["v_reset_states"] = _walk("v_series", "v_reset_states", reset=True)
VIEWS["v_cor_series"] = _series("d.pet_correction")
VIEWS["v_cor_states"] = _walk("v_cor_series", "v_cor_states", reset=False)


VIEWS["v_driest_series"] = _series("d.pet", swd="CASE WHEN month(m.date) = 6 THEN m.swd - 5 ELSE m.swd END")
VIEWS["v_driest_states"] = _walk("v_driest_series", "v_driest_states", reset=True)


def _gauged(rain: str) -> str:
    """Days of the second gauge, which has many gaps."""
    return f"""
SELECT site_id, date, pet, {rain} + coalesce(irrigation_1, 0) AS precipitation_1,
  {rain} + coalesce(irrigation_2, 0) AS precipitation_2
FROM v_pet LEFT JOIN v_gauge g USING (site_id, date) LEFT JOIN v_diary USING (site_id, date)"""


VIEWS["v_gap_days"] = _gauged("g.rain")
VIEWS["v_gap_series"] = _series("d.pet", "v_gap_days")
VIEWS["v_gap_states"] = _walk("v_gap_series", "v_gap_states", reset=False, strict=True)
VIEWS["v_dry_days"] = _gauged("coalesce(g.rain, 0)")
VIEWS["v_dry_series"] = _series("d.pet", "v_dry_days")
VIEWS["v_dry_states"] = _walk("v_dry_series", "v_dry_states", reset=False, strict=True)

# Layers of uneven thickness: every centimetre of a profile is a row.
VIEWS["v_uneven"] = _soil(UNEVEN_LAYERS)
VIEWS["v_uneven_mean"] = f"""
SELECT site_id, crop, date, irrigation, n_rate, variable, avg(TRY_CAST(value AS DOUBLE)) AS percent
FROM v_uneven UNPIVOT INCLUDE NULLS (value FOR variable IN ({", ".join(UNEVEN_LAYERS)}))
GROUP BY ALL"""
VIEWS["v_uneven_cm"] = """
SELECT variable, CAST(unnest(range(CAST(split_part(variable, '_', 2) AS BIGINT),
  CAST(split_part(variable, '_', 3) AS BIGINT))) AS INTEGER) AS cm
FROM (SELECT DISTINCT variable FROM v_uneven_mean)"""
VIEWS["v_asked"] = """
SELECT site_id, profile, CAST(cm AS INTEGER) AS depth_cm FROM (
  SELECT site_id, unnest(['30 cm', '105 cm', '200 cm', 'rooted']) AS profile,
    unnest([30, 105, 200, 35 + 15 * (site_no % 9)]) AS cm
  FROM v_sites)"""
VIEWS["v_asked_parts"] = """
SELECT a.site_id, a.profile, a.depth_cm, c.variable, CAST(count(*) AS INTEGER) AS cm
FROM v_asked a JOIN v_uneven_cm c ON c.cm < a.depth_cm GROUP BY ALL"""
VIEWS["v_interval_swd"] = """
SELECT *, profile_water - pawc AS swd FROM (
  SELECT *, max(profile_water) OVER (PARTITION BY site_id, irrigation, n_rate, profile) AS pawc
  FROM (SELECT m.site_id, m.crop, m.date, m.irrigation, 'Nitrogen ' || m.n_rate AS n_rate,
          p.profile, p.depth_cm, coalesce(sum(m.percent * p.cm / 10.0), 0) AS profile_water,
          CAST(sum(p.cm) AS INTEGER) AS covered_cm
        FROM v_uneven_mean m JOIN v_asked_parts p USING (site_id, variable) GROUP BY ALL))"""

# Five rates, three levels.
VIEWS["v_soil_5"] = _soil(LAYER_COLUMNS, rates=5)
VIEWS["v_depths_5"] = f"""
SELECT *, profile_water - max(profile_water) OVER (
  PARTITION BY site_id, irrigation, n_rate, profile) AS swd
FROM (
  SELECT site_id, crop, date, irrigation, n_rate, (d.depth * 20) || ' cm' AS profile,
    coalesce(sum(sw), 0) AS profile_water
  FROM (SELECT site_id, crop, date, irrigation, n_rate, variable,
          avg(TRY_CAST(value AS DOUBLE) * 2) AS sw
        FROM v_soil_5 UNPIVOT INCLUDE NULLS (value FOR variable IN ({", ".join(LAYER_COLUMNS)}))
        GROUP BY ALL)
  JOIN (VALUES (1), (2), (3)) AS d(depth) ON CAST(split_part(variable, '_', 3) AS INTEGER) <= d.depth * 20
  GROUP BY ALL)"""
VIEWS["v_five_rates"] = """
SELECT site_id, crop, date, profile,
""" + ", ".join(f'max(CASE WHEN n_rate = {k} THEN swd END) AS "SWD_Nitrogen {k}"' for k in range(1, 6)) + """
FROM v_depths_5 WHERE irrigation = 2 GROUP BY ALL"""
VIEWS["v_diary_3"] = f"""
SELECT site_id, {_crop('date')} AS crop, date, CASE WHEN f > 0 THEN f * CAST(5 AS DOUBLE) END AS irrigation_1,
  CASE WHEN o > 0 THEN o * CAST(5 AS DOUBLE) END AS irrigation_2,
  CASE WHEN p > 0 THEN p * CAST(5 AS DOUBLE) END AS irrigation_3
FROM (SELECT 'S' || (o_custkey // 60) AS site_id, CAST(o_orderdate AS DATE) AS date,
        count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o,
        count(*) FILTER (WHERE o_orderstatus = 'P') AS p
      FROM orders GROUP BY 1, 2)"""
VIEWS["v_daily_3"] = """
SELECT site_id, date, coalesce(irrigation_3, 0) AS irrigation_3,
  rain + coalesce(irrigation_1, 0) AS precipitation_1, rain + coalesce(irrigation_2, 0) AS precipitation_2,
  rain + coalesce(irrigation_3, 0) AS precipitation_3,
  last_value(CASE WHEN place = 1 THEN 'Potato' ELSE crop END IGNORE NULLS)
    OVER (PARTITION BY site_id ORDER BY date) AS crop
FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY date) AS place
      FROM v_weather LEFT JOIN v_diary_3 USING (site_id, date))"""


def _wide(value: str, prefix: str, source_label: str = "n_rate") -> str:
    return ",\n".join(
        f"max(CASE WHEN {source_label} = 'Nitrogen {k}' THEN {value} END) AS \"{prefix}Nitrogen {k}\""
        for k in range(1, 5))


def _wide_swd(level: int) -> str:
    return f"""
SELECT site_id, crop, date, profile, {_wide('swd', 'SWD_')}
FROM v_depths WHERE irrigation = {level} GROUP BY ALL"""


def _wide_states(level: int) -> str:
    return f"""
SELECT site_id, date, pet, precipitation, {_wide('wt', 'Wt_')}, {_wide('drainage', 'Drainage_')}
FROM v_states WHERE irrigation = {level} GROUP BY ALL"""


VIEWS["v_wide_swd"], VIEWS["v_wide_swd_2"] = _wide_swd(1), _wide_swd(2)
VIEWS["v_wide_states"], VIEWS["v_wide_states_2"] = _wide_states(1), _wide_states(2)


def nitrogen_columns(*prefixes: str) -> list[str]:
    return [f"{p}Nitrogen {k}" for p in prefixes for k in range(1, 5)]


def _published(modelled: str, measured: str, level: int) -> str:
    return f"""
SELECT w.site_id, w.date, m.profile, {", ".join(f'm."{c}"' for c in nitrogen_columns("SWD_"))},
  d.pet AS "PET", d.precipitation_{level} AS "Precipitation",
  {", ".join(f'w."{c}"' for c in nitrogen_columns("Wt_", "Drainage_"))}
FROM {modelled} w
LEFT JOIN v_daily d ON d.site_id = w.site_id AND d.date = w.date
LEFT JOIN {measured} m ON m.site_id = w.site_id AND m.date = w.date"""


VIEWS["v_published"] = _published("v_wide_states", "v_wide_swd", 1)
VIEWS["v_published_2"] = _published("v_wide_states_2", "v_wide_swd_2", 2)
VIEWS["v_published_2of1"] = _published("v_wide_states", "v_wide_swd_2", 1)
