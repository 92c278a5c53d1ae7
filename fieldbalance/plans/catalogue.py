"""Every operator as a named query over the trial views, with its SQL.

A query and its SQL are registered together. Doubles that went through
arithmetic are rounded to six decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbalance.functions import dates, nulls
from fieldbalance.operators import (balance, canopy, intervals, reshape, series, soil, soil_sheet,
                                    top_store, weather)
from fieldbalance.plans import report, trial
from fieldbalance.plans.trial_sql import nitrogen_columns, statement
from fieldbalance.schemas import (CANOPY_SHEET, IRRIGATION_DIARY, LAYER_COLUMNS)
from fieldbalance.session import new_shared_path
from fieldbalance.sources import (climate, headers, published, rejects, sheets, tagged,
                                  versions)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            _SQL[fn.__name__] = sql
        return fn
    return register


def oracle_sql() -> dict[str, str]:
    return {name: statement(sql) for name, sql in _SQL.items()}


# Results such as 6.8556125 end on a half at the seventh decimal, where the last
# bit of a sum decides the rounding. Rounding a hair above the half keeps both
# sides clear of that.
HALF = 0.500137219


def _six(column: str):
    """Six decimals by the same arithmetic on both sides."""
    return F.expr(f"floor(`{column}` * 1e6D + {HALF}D) / 1e6D")


def _rounded(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: _six(c) for c in doubles})


def _sql_six(expression: str) -> str:
    return f"floor(({expression}) * CAST(1e6 AS DOUBLE) + CAST({HALF} AS DOUBLE)) / CAST(1e6 AS DOUBLE)"


def _r(*columns: str) -> str:
    return ", ".join(f'{_sql_six(_quoted(c))} AS "{c}"' for c in columns)


def _quoted(column: str) -> str:
    return f'"{column}"'


# Views used by many queries -------------------------------------------------

def _soil(spark, sf):
    return dates.with_local_date(trial.soil_sheet(spark, sf))


def _flags(spark, sf):
    return dates.with_local_date(trial.flag_sheet(spark, sf))


def _long(spark, sf):
    return soil.melt_layers(_soil(spark, sf))


def _kept(spark, sf):
    return soil.drop_flagged(_long(spark, sf), soil.flagged_cells(_flags(spark, sf)))


def _means(spark, sf):
    return soil_sheet.sheet_means(_soil(spark, sf), _flags(spark, sf))


def _once(df, name):
    """The rows written to the shared folder, for queries that read them more than once."""
    path = new_shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _means_of(spark, sf, *levels):
    """The means of some irrigation levels, stored."""
    soil_rows = _soil(spark, sf).filter(F.col("irrigation").isin(*levels))
    return _once(soil_sheet.sheet_means(soil_rows, _flags(spark, sf)), "means")


def _layers(spark, sf):
    """The long layer table, melted after the means instead of before."""
    return soil_sheet.layers_from_means(_means(spark, sf))


def _depths(spark, sf):
    return soil_sheet.multi_depth_from_means(_means(spark, sf))


def _inputs(spark, sf):
    return soil_sheet.inputs_from_means(_means(spark, sf))


def _weather(spark, sf):
    return weather.weather_join(trial.pet(spark, sf), trial.rain(spark, sf))


def _daily(spark, sf):
    return weather.daily_inputs(_weather(spark, sf), trial.irrigation_diary(spark, sf))


def _daywise(spark, sf):
    """Weather with the diary's columns, gaps as they are."""
    return _weather(spark, sf).join(trial.irrigation_diary(spark, sf), ["site_id", "date"], "left")


def _summary(spark, sf):
    return canopy.canopy_summary(trial.canopy_sheet(spark, sf), sensor="Greenseeker")


def _cover(spark, sf):
    return canopy.full_cover_date(_summary(spark, sf))


def _stages(spark, sf):
    return canopy.growth_stage_merge(
        canopy.growth_event_parse(trial.growth_events(spark, sf)), _cover(spark, sf))


def _calendar(spark, sf):
    return series.calendar_days(series.date_range(_stages(spark, sf), ["site_id"]), ["site_id"])


def _coefficient(spark, sf):
    return canopy.crop_coefficient(_stages(spark, sf))


def _states(spark, sf):
    return balance.water_balance(_daily(spark, sf), _inputs(spark, sf))


def _published(spark, sf):
    """The table of irrigation level 1; the other level's days are not walked."""
    means = _means_of(spark, sf, 1)
    states = balance.water_balance(_daily(spark, sf), soil_sheet.inputs_from_means(means))
    return report.publish_wide(states, soil_sheet.multi_depth_from_means(means), 1)


_READING = "site_id, crop, date, plot, irrigation, n_rate"
_PROFILE = "site_id, crop, date, irrigation, n_rate"
_TREATMENT = "site_id, irrigation, n_rate"
_STATE_COLUMNS = ["pet", "precipitation", *balance.STATES]


# Scans, columns and types -----------------------------------------------------

@query("SELECT site_id, crop, date, irrigation_1, irrigation_2 FROM v_diary")
def scan_typed(spark, sf):
    """Sheets exported as text, each with a preamble and a header line."""
    path = new_shared_path(spark, "diary-sheet")
    diary = trial.irrigation_diary(spark, sf)
    diary.write.csv(path)
    top = (diary.groupBy("site_id").agg(F.count("*").alias("n"))
           .select(F.inline(F.array(
               F.struct(F.concat(F.lit("Irrigation diary of site "), "site_id").alias("line")),
               F.struct(F.concat(F.lit("Entries: "), F.col("n").cast("string")).alias("line")),
               F.struct(F.lit(",".join(IRRIGATION_DIARY.fieldNames())).alias("line"))))))
    top.write.mode("append").text(path)
    return sheets.read_sheet(spark, path, IRRIGATION_DIARY, key="date")


@query("SELECT site_id AS station, date AS day, pet AS evaporation FROM v_pet")
def project_rename(spark, sf):
    return sheets.project_rename(trial.pet(spark, sf), station="site_id", day="date",
                                 evaporation="pet")


@query(f"SELECT {', '.join(LAYER_COLUMNS)} FROM v_soil")
def select_by_regex(spark, sf):
    return headers.select_by_regex(trial.soil_sheet(spark, sf), "^VWC.+")


@query(f"""
SELECT site_id, date, {_sql_six("rain - pet")} AS surplus, {_sql_six("-pet")} AS loss,
  {_sql_six("rain / 8 * 3")} AS share, CAST(year(date) AS VARCHAR) AS season
FROM v_weather""")
def derive_columns(spark, sf):
    rows = _weather(spark, sf).withColumns({
        "surplus": F.col("rain") - F.col("pet"),
        "loss": -F.col("pet"),
        "share": F.col("rain") / 8 * 3,
        "season": F.year("date").cast("string")})
    return _rounded(rows.drop("pet", "rain"))


_RAW_HEADER = ["Crop", "Date", "Irrigation", "", "Plot No", "N rate", "Irrigation", "2nd", None,
               "Date", "Soil_T"]


@query("""
SELECT l_orderkey AS "Crop", l_partkey AS "Date_2", l_suppkey AS "Irrigation_3",
  l_linenumber AS "_4", l_quantity AS "Plot_No", l_extendedprice AS "N_rate",
  l_discount AS "Irrigation_7", l_tax AS "_2nd", l_returnflag AS "_9", l_linestatus AS "Date_10",
  CAST(l_shipdate AS DATE) AS "Soil_T"
FROM lineitem""")
def header_repair(spark, sf):
    """Header cells with blanks and repeats; dots become underscores to compare."""
    rows = trial.table(spark, sf, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    repaired = headers.repair_header(rows, _RAW_HEADER)
    plain = [c.replace("...", "_").replace("..", "_").replace(".", "_") for c in repaired.columns]
    return repaired.toDF(*plain)


@query(f"""
SELECT site_id, crop, date, irrigation, nitrogen, {_r('ndvi')} FROM v_canopy_all
WHERE irrigation IS NOT NULL AND ndvi IS NOT NULL""")
def filter_not_null(spark, sf):
    rows = nulls.filter_not_null(trial.canopy_sheet(spark, sf), "irrigation", "ndvi")
    return _rounded(rows.drop("sensor"))


@query("SELECT site_id, date, plot, TRY_CAST(VWC_0_20 AS DOUBLE) AS percent FROM v_soil")
def clean_numeric(spark, sf):
    return _soil(spark, sf).select("site_id", "date", "plot",
                                   nulls.to_number("VWC_0_20").alias("percent"))


@query("SELECT site_id, date, nullif(pet, 0) AS pet, nullif(rain, 0) AS rain FROM v_weather")
def zero_to_null(spark, sf):
    return nulls.zero_to_null(_weather(spark, sf), ["pet", "rain"])


@query("SELECT site_id, date, pet FROM v_pet")
def publish_roundtrip(spark, sf):
    path = new_shared_path(spark, "published")
    published.publish(trial.pet(spark, sf), path)
    return published.read_published(spark, path)


@query(f"""
SELECT site_id, crop, sensor, date, irrigation, nitrogen, {_r('ndvi')} FROM v_canopy_all
WHERE sensor = 'Greenseeker'""")
def multi_file_tagged_scan(spark, sf):
    """Canopy files, one folder per site, crop and sensor, found by their names."""
    path = new_shared_path(spark, "canopy-files")
    tagged.write_tagged(trial.canopy_sheet(spark, sf), path)
    inner = T.StructType([f for f in CANOPY_SHEET.fields
                          if f.name not in ("site_id", "crop", "sensor")])
    return _rounded(tagged.read_tagged(spark, path, inner, trial.CROPS, ["Greenseeker"],
                                       one_folder_each=True))


@query(f"""
SELECT site_id, crop, sensor, site_id || '_' || crop || '_' || sensor AS stem
FROM v_sites, (VALUES {', '.join(f"('{c}')" for c in trial.CROPS)}) AS a(crop),
  (VALUES {', '.join(f"('{s}')" for s in trial.SENSORS)}) AS b(sensor)""")
def grid_cross(spark, sf):
    return tagged.file_grid(spark, trial.sites(spark, sf), trial.CROPS, trial.SENSORS)


@query("""
SELECT p.site_id, p.date, p.pet FROM v_pet p
JOIN (SELECT site_id, min(date) AS start_date FROM v_diary GROUP BY 1) s USING (site_id)
WHERE p.date BETWEEN s.start_date AND current_date""")
def station_period_scan(spark, sf):
    """Weather from the first diary entry of each site up to today."""
    return climate.station_period(trial.pet(spark, sf),
                                  climate.first_dates(trial.irrigation_diary(spark, sf)))


@query("""
SELECT CAST(substr(p.site_id, 2) AS INTEGER) AS station, p.date, p.pet, r.rain
FROM v_pet p JOIN v_rain r USING (site_id, date)""")
def climate_text_parse(spark, sf):
    """Station exports as text in the provider's layout, parsed back."""
    path = new_shared_path(spark, "station-text")
    station = F.substring("site_id", 2, 9)
    hour = F.when(F.month("date").between(4, 9), "09").otherwise("08")
    when = F.concat_ws(",", F.date_format("date", "yyyy,MM,dd"), hour)

    def lines(df, amount, *rest):
        fields = [station, when, F.format_string("%.1f", amount), *map(F.lit, rest)]
        return df.select(F.concat_ws("\t", *fields).alias("line"))

    head = trial.sites(spark, sf).select(F.inline(F.array(*[
        F.struct(F.concat(F.lit(text), "site_id").alias("line")) for text in
        ("Station information: ", "Station\tDate(NZST)\tAmount(mm)\tPeriod(Hrs)\tType ",
         "Total number of rows output = ")])))
    head.write.text(path)
    (lines(trial.pet(spark, sf), "pet", "24", "P")
     .unionByName(lines(trial.rain(spark, sf), "rain", "-", "0.0", "0.0", "24", "D"))
     .write.mode("append").text(path))
    pet, rain = climate.read_station_text(spark, path)
    return pet.join(rain, ["station", "date"])


def _station_lines(spark, sf, path):
    """Station exports of which some lines are damaged."""
    fields = {"station": F.substring("site_id", 2, 9),
              "date": F.concat(F.date_format("date", "yyyy,MM,dd"), F.lit(",08"))}
    day = F.day("date")

    def lines(df, amount, *rest):
        text = F.format_string("%.1f", amount)
        good = F.concat_ws("\t", fields["station"], fields["date"], text, *map(F.lit, rest))
        return df.select(
            F.when(day == 3, F.concat(good, F.lit("\textra")))
            .when(day == 5, F.concat_ws("\t", F.lit("?"), fields["date"], text, *map(F.lit, rest)))
            .when(day == 7, F.concat_ws("\t", fields["station"], F.lit("1996,13,45,08"), text,
                                        *map(F.lit, rest)))
            .when(day == 9, F.concat_ws("\t", fields["station"], fields["date"], F.lit("12d"),
                                        *map(F.lit, rest)))
            .when(day == 11, F.concat_ws("\t", fields["station"], fields["date"], F.lit("-"),
                                         *map(F.lit, rest))).otherwise(good).alias("line"))

    head = trial.sites(spark, sf).select(F.inline(F.array(*[
        F.struct(F.concat(F.lit(text), "site_id").alias("line")) for text in
        ("Station information: ", "Station\tDate(NZST)\tAmount(mm)\tPeriod(Hrs)\tType ",
         "Total number of rows output = ")])))
    head.write.text(path)
    lines(trial.pet(spark, sf), "pet", "24", "P").write.mode("append").text(path)
    (lines(trial.rain(spark, sf), "rain", "-", "0.0", "0.0", "24", "D")
     .write.mode("append").text(path))


@query("""
SELECT kind, CAST(rows AS BIGINT) AS rows, amount FROM (
  SELECT 'pet' AS kind, count(*) AS rows, 
    CAST(sum(CASE WHEN day(date) = 11 THEN 0 ELSE CAST(round(pet * 10) AS BIGINT) END) AS DOUBLE) / 10 AS amount
  FROM v_pet WHERE day(date) NOT IN (3, 5, 7, 9)
  UNION ALL
  SELECT 'rain', count(*), 
    CAST(sum(CASE WHEN day(date) = 11 THEN 0 ELSE CAST(round(rain * 10) AS BIGINT) END) AS DOUBLE) / 10
  FROM v_rain WHERE day(date) NOT IN (3, 5, 7, 9)
  UNION ALL
  SELECT CASE day(date) WHEN 3 THEN 'fields' WHEN 5 THEN 'station' WHEN 7 THEN 'date'
      ELSE 'amount' END, count(*), NULL
  FROM (SELECT date FROM v_pet UNION ALL SELECT date FROM v_rain)
  WHERE day(date) IN (3, 5, 7, 9) GROUP BY 1)""")
def station_rejects(spark, sf):
    """Rows and millimetres that can be used, and lines that cannot, by reason."""
    path = new_shared_path(spark, "station-text")
    _station_lines(spark, sf, path)
    found = rejects.read_station_text_checked(spark, path, max_rejected=0.5)

    def counted(df, kind, amount):
        return df.groupBy(kind.alias("kind")).agg(F.count("*").alias("rows"), amount.alias("amount"))

    tenths = {c: F.coalesce(F.sum(F.round(F.col(c) * 10).cast("long")), F.lit(0)) / F.lit(10.0)
              for c in ("pet", "rain")}
    return (counted(found.pet, F.lit("pet"), tenths["pet"])
            .unionByName(counted(found.rain, F.lit("rain"), tenths["rain"]))
            .unionByName(counted(found.rejects, F.col("reason"), F.lit(None).cast("double"))))


@query("""
SELECT CASE day(date) WHEN 4 THEN 'date' ELSE 'irrigation_1' END AS reason, site_id, crop, date
FROM v_diary
WHERE day(date) = 6 AND irrigation_1 IS NOT NULL
  OR day(date) = 4 AND (irrigation_1 IS NOT NULL OR irrigation_2 IS NOT NULL)
UNION ALL
SELECT 'used', site_id, crop, date FROM v_diary WHERE day(date) <> 4""")
def sheet_rejects(spark, sf):
    """Diary rows in use, rows whose date cannot be read, cells that are no number."""
    path = new_shared_path(spark, "diary-sheet")
    diary = trial.irrigation_diary(spark, sf)
    day = F.day("date")
    amount = F.col("irrigation_1").cast("string")
    text = diary.select(
        "site_id", "crop",
        F.when(day == 4, F.concat(F.lit("the "), F.date_format("date", "yyyy-MM-dd")))
        .otherwise(F.date_format("date", "yyyy-MM-dd")).alias("date"),
        F.when(day == 6, F.concat(amount, F.lit("d"))).otherwise(amount).alias("irrigation_1"),
        "irrigation_2")
    text.write.csv(path)
    sites = diary.select("site_id").distinct()
    sites.select(F.inline(F.array(
        F.struct(F.concat(F.lit("Irrigation diary of site "), "site_id").alias("line")),
        F.struct(F.lit(",".join(IRRIGATION_DIARY.fieldNames())).alias("line"))))
    ).write.mode("append").text(path)
    found = rejects.read_sheet_checked(spark, path, IRRIGATION_DIARY, "date", max_rejected=0.5)
    cell = F.split("line", ",")
    lost = found.rejects.select("reason", cell[0].alias("site_id"), cell[1].alias("crop"),
                                F.to_date(F.regexp_extract(cell[2], r"\d{4}-\d\d-\d\d", 0)).alias("date"))
    return lost.unionByName(found.rows.select(F.lit("used").alias("reason"), "site_id", "crop", "date"))


@query("""
SELECT CAST(1 AS INTEGER) AS version, site_id, date, pet, CAST(NULL AS DOUBLE) AS rain FROM v_pet
UNION ALL
SELECT 2, site_id, date, pet, rain FROM v_weather""")
def publish_versioned(spark, sf):
    """Two published versions; a third is written and never shown."""
    path = new_shared_path(spark, "versions")
    first = trial.pet(spark, sf).withColumn("rain", F.lit(None).cast("double"))
    versions.publish_versioned(first, path)
    versions.publish_versioned(_weather(spark, sf), path)
    versions.Draft(spark, path).write(first.limit(1))
    old = versions.read_version(spark, path, version=1).withColumn("version", F.lit(1))
    return old.unionByName(versions.read_version(spark, path).withColumn("version", F.lit(2)))


@query(f"""
SELECT g.site_id, g.crop, g.sensor, c.rows IS NOT NULL AS present
FROM (SELECT replace(site_id, 'S', 'S_') AS site_id, a.crop, b.sensor
      FROM v_sites, (VALUES {', '.join(f"('{c}')" for c in trial.CROPS)}) AS a(crop),
        (VALUES {', '.join(f"('{s}')" for s in trial.SENSORS)}) AS b(sensor)) g
LEFT JOIN (SELECT replace(site_id, 'S', 'S_') AS site_id, crop, sensor, count(*) AS rows
           FROM v_canopy_all GROUP BY ALL) c USING (site_id, crop, sensor)""")
def canopy_files_missing(spark, sf):
    """The candidate grid against the files that are there; site names hold an underscore."""
    path = new_shared_path(spark, "canopy-files")

    def named(df):
        return df.withColumn("site_id", F.regexp_replace("site_id", "^S", "S_"))

    tagged.write_tagged(named(trial.canopy_sheet(spark, sf)), path)
    grid = tagged.file_grid(spark, named(trial.sites(spark, sf)), trial.CROPS, trial.SENSORS)
    listing = tagged.file_listing(spark, path, trial.CROPS, trial.SENSORS, one_folder_each=True)
    return tagged.grid_coverage(grid, listing).select("site_id", "crop", "sensor", "present")


@query("""
SELECT p.site_id, p.date, p.pet FROM v_pet p
JOIN (SELECT site_id, min(date) AS start_date FROM v_diary WHERE irrigation_1 >= 15 GROUP BY 1) s
  USING (site_id)
WHERE p.date BETWEEN s.start_date AND current_date""")
def station_pruned_scan(spark, sf):
    """Stored weather of the sites with a heavily watered day, from the first such day on."""
    path = new_shared_path(spark, "weather-by-site")
    climate.store_by_station(trial.pet(spark, sf), path)
    starts = climate.first_dates(trial.irrigation_diary(spark, sf).filter("irrigation_1 >= 15"))
    return climate.stored_period(spark, path, "date date, pet double, site_id string", starts).select(
        "site_id", "date", "pet")


# Reshaping -------------------------------------------------------------------

@query(f"SELECT {_READING}, variable, value FROM v_long")
def melt_layers(spark, sf):
    return _long(spark, sf)


@query("SELECT site_id, crop, date, treatment, irrigation FROM v_irrigation")
def melt_irrigation(spark, sf):
    return weather.melt_irrigation(trial.irrigation_diary(spark, sf))


@query("SELECT site_id, date, plot, variable, value FROM v_cells")
def flagged_cells(spark, sf):
    return soil.flagged_cells(_flags(spark, sf))


@query(f"SELECT site_id, crop, date, profile, {_r(*nitrogen_columns('SWD_'))} FROM v_wide_swd")
def pivot_swd(spark, sf):
    return _rounded(report.pivot_swd(_depths(spark, sf), 1))


@query("SELECT site_id, date, pet, rain, crop, irrigation_1, irrigation_2 FROM v_daywise")
def pivot_irrigation(spark, sf):
    joined = weather.weather_irrigation_join(
        _weather(spark, sf), weather.melt_irrigation(trial.irrigation_diary(spark, sf)))
    return weather.pivot_irrigation(joined)


@query(f"""
SELECT site_id, date, {_r('pet', 'precipitation', *nitrogen_columns('Wt_', 'Drainage_'))}
FROM v_wide_states""")
def pivot_balance(spark, sf):
    """Level 1; the days of the other level are not walked."""
    states = balance.water_balance(_daily(spark, sf), _inputs(spark, sf).filter("irrigation = 1"))
    return _rounded(report.pivot_balance(states, 1))


def _nested(spark, sf):
    swd = soil_sheet.swd_from_means(_means(spark, sf), 3)
    return reshape.nest(swd, soil.TREATMENT, ["date", "crop", "profile_water", "pawc", "swd"],
                        chunk=F.year("date"))


@query(f"""
SELECT {_TREATMENT}, CAST(year(date) AS INTEGER) AS chunk, CAST(count(*) AS INTEGER) AS days,
  min(date) AS first_date, {_sql_six("arg_min(swd, date)")} AS first_swd
FROM v_swd WHERE depth = 3 GROUP BY ALL""")
def nest_by_treatment(spark, sf):
    rows = F.col("rows")
    return _rounded(_nested(spark, sf).select(
        *soil.TREATMENT, "chunk", F.size(rows).alias("days"),
        rows[0]["date"].alias("first_date"), rows[0]["swd"].alias("first_swd")))


@query(f"""
SELECT {_TREATMENT}, date, crop, {_r('profile_water', 'pawc', 'swd')} FROM v_swd
WHERE depth = 3""")
def unnest_groups(spark, sf):
    return _rounded(reshape.unnest(_nested(spark, sf), soil.TREATMENT))


# Quality and joins -------------------------------------------------------------

@query(f"""
SELECT l.site_id, l.crop, l.date, l.plot, l.irrigation, l.n_rate, l.variable, l.value,
  c.value AS flag
FROM v_long l LEFT JOIN v_cells c ON l.site_id = c.site_id AND l.date = c.date
  AND l.plot = c.plot AND l.variable = c.variable""")
def join_left_multi_key(spark, sf):
    return soil.join_flags(_long(spark, sf), soil.flagged_cells(_flags(spark, sf)))


@query(f"SELECT {_READING}, variable, value FROM v_kept")
def drop_flagged(spark, sf):
    return _kept(spark, sf)


@query("""
SELECT p.site_id, p.date, p.pet, g.rain FROM v_pet p LEFT JOIN v_gauge g USING (site_id, date)""")
def weather_join(spark, sf):
    return weather.weather_join(trial.pet(spark, sf), trial.gauge(spark, sf))


@query("SELECT site_id, date, pet, rain, crop, treatment, irrigation FROM v_joined")
def weather_irrigation_join(spark, sf):
    return weather.weather_irrigation_join(
        _weather(spark, sf), weather.melt_irrigation(trial.irrigation_diary(spark, sf)))


@query(f"SELECT site_id, date, events, crop, {_r('mean')} FROM v_dayjoin")
def calendar_join(spark, sf):
    return _rounded(canopy.calendar_join(_calendar(spark, sf), _stages(spark, sf)))


# Soil ----------------------------------------------------------------------------

@query(f"SELECT {_PROFILE}, variable, {_r('sw')} FROM v_mean")
def layer_mean(spark, sf):
    return _rounded(soil_sheet.named_layers(_layers(spark, sf)))


@query(f"SELECT {_PROFILE}, layer, {_r('sw')} FROM v_layers")
def layer_order(spark, sf):
    return _rounded(_layers(spark, sf))


@query("""
SELECT site_id, count(DISTINCT layer) AS layers, count(DISTINCT layer) >= 8 AS covers_depth
FROM v_layers GROUP BY 1""")
def layer_count_check(spark, sf):
    return soil.layer_count_check(_layers(spark, sf))


@query(f"SELECT {_PROFILE}, {_r('profile_water')} FROM v_profiles WHERE depth = 3")
def profile_depth(spark, sf):
    return _rounded(soil.profile_depth(_layers(spark, sf), 3))


@query(f"SELECT {_TREATMENT}, {_r('awhc')} FROM (SELECT DISTINCT {_TREATMENT}, pawc AS awhc "
       "FROM v_swd WHERE depth = 8)")
def pawc_by_treatment(spark, sf):
    return _rounded(soil.pawc_by_treatment(_layers(spark, sf))).orderBy(*soil.TREATMENT)


@query(f"""
SELECT site_id, {_r('awhc', 'awhc_top', 'awhc_layer')} FROM (
  SELECT site_id, max(profile_water) AS awhc, max(profile_water) / 8 * 3 AS awhc_top,
    max(profile_water) / 8 AS awhc_layer
  FROM v_profiles WHERE depth = 8 GROUP BY 1)""")
def capacity_global(spark, sf):
    return _rounded(soil.capacity_global(_layers(spark, sf)))


@query(f"SELECT {_PROFILE}, {_r('profile_water', 'pawc', 'swd')} FROM v_swd WHERE depth = 8")
def swd_profile(spark, sf):
    return _rounded(soil_sheet.swd_from_means(_means(spark, sf)))


@query(f"""
SELECT site_id, crop, date, irrigation, 'Nitrogen ' || n_rate AS n_rate, {_r('profile_water')},
  CAST(400 AS DOUBLE) AS pawc, {_sql_six("profile_water - 400")} AS swd
FROM v_profiles WHERE depth = 8""")
def swd_fixed_pawc(spark, sf):
    return _rounded(soil.swd_profile(_layers(spark, sf), pawc=400))


@query(f"SELECT {_PROFILE}, profile, {_r('profile_water', 'pawc', 'swd')} FROM v_depths")
def swd_multi_depth(spark, sf):
    return _rounded(_depths(spark, sf))


@query(f"SELECT {_TREATMENT}, date, {_r('swd')} FROM v_starts WHERE depth = 8")
def start_deficit(spark, sf):
    return _rounded(soil.start_deficit(_layers(spark, sf)))


def _depth_table(spark, sf):
    """Depths of interest, one of them the rooting depth of the site."""
    rooted = (F.lit(35) + 15 * (F.col("site_no") % 9)).cast("int")
    return trial.sites(spark, sf).select("site_id", F.inline(F.array(*[
        F.struct(F.lit(name).alias("profile"), F.lit(cm).cast("int").alias("depth_cm"))
        if isinstance(cm, int) else F.struct(F.lit(name).alias("profile"), cm.alias("depth_cm"))
        for name, cm in (("30 cm", 30), ("105 cm", 105), ("200 cm", 200), ("rooted", rooted))])))


@query(f"SELECT {_PROFILE}, profile, depth_cm, covered_cm, {_r('profile_water', 'pawc', 'swd')} "
       "FROM v_interval_swd")
def swd_depth_intervals(spark, sf):
    """Ten uneven layers with a gap, summed to depths that cut through them."""
    sheet = dates.with_local_date(trial.soil_sheet(spark, sf, names=trial.UNEVEN_LAYERS))
    layers = intervals.interval_layers(soil.melt_layers(sheet), trial.UNEVEN_LAYERS)
    return _rounded(intervals.swd_to_depths(layers, _depth_table(spark, sf), deepest_cm=200))


# Dates and ordered series ---------------------------------------------------------

@query("""
SELECT event_id,
  CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Pacific/Auckland' AS DATE) AS date
FROM events""")
def local_date(spark, sf):
    rows = trial.table(spark, sf, "events").select("event_id", F.col("ts").alias("date"))
    return dates.with_local_date(rows)


@query("SELECT site_id, min(date) AS first_date, max(date) AS last_date FROM v_stages GROUP BY 1")
def date_range(spark, sf):
    return series.date_range(_stages(spark, sf), ["site_id"])


@query("SELECT site_id, date FROM v_calendar")
def calendar_days(spark, sf):
    return _calendar(spark, sf)


@query("""
SELECT site_id, date, pet,
  last_value(crop IGNORE NULLS) OVER w AS crop,
  last_value(irrigation_1 IGNORE NULLS) OVER w AS irrigation_1
FROM v_daywise WINDOW w AS (PARTITION BY site_id ORDER BY date ROWS UNBOUNDED PRECEDING)""")
def locf_fill(spark, sf):
    rows = _daywise(spark, sf).select("site_id", "date", "pet", "crop", "irrigation_1")
    return series.locf(rows, ["crop", "irrigation_1"], ["site_id"], ["date"],
                       block=F.year("date"))


@query("""
SELECT site_id, date, pet, CASE WHEN row_number() OVER (PARTITION BY site_id ORDER BY date) = 1
  THEN 'Potato' ELSE crop END AS crop
FROM v_daywise""")
def seed_first_row(spark, sf):
    rows = _daywise(spark, sf).select("site_id", "date", "pet", "crop")
    return series.seed_first_row(rows, "crop", "Potato", ["site_id"])


@query(f"SELECT site_id, crop, date, {_r('ndvi')} FROM v_canopy_line")
def interpolate_linear(spark, sf):
    """Canopy index of every crop on every day between its observations."""
    rows = trial.scanned_canopy(spark, sf)
    keys = ["site_id", "crop"]
    seen = (rows.filter(F.col("irrigation").isNotNull()).groupBy(*keys, "date")
            .agg(F.avg("ndvi").alias("ndvi")))
    days = series.calendar_days(series.date_range(rows, keys), keys)
    return _rounded(series.interpolate_linear(
        days.join(seen, [*keys, "date"], "left"), "ndvi", keys, block=F.year("date")))


@query("""
SELECT site_id, date, irrigation_1, coalesce(irrigation_1 - lag(irrigation_1) OVER (
  PARTITION BY site_id ORDER BY date), 0) AS diff
FROM (
  SELECT site_id, date, last_value(irrigation_1 IGNORE NULLS) OVER (
    PARTITION BY site_id ORDER BY date ROWS UNBOUNDED PRECEDING) AS irrigation_1
  FROM v_daywise)
WHERE irrigation_1 IS NOT NULL""")
def locf_lag_diff(spark, sf):
    rows = _daywise(spark, sf).select("site_id", "date", "irrigation_1")
    return series.locf_lag_diff(rows, "irrigation_1", ["site_id"], ["date"],
                                block=F.year("date"))


@query("""
SELECT site_id, date, irrigation_1, count(irrigation_1) OVER (
  PARTITION BY site_id ORDER BY date ROWS UNBOUNDED PRECEDING) AS run
FROM v_daywise""")
def runs_by_nonnull(spark, sf):
    rows = _daywise(spark, sf).select("site_id", "date", "irrigation_1")
    return series.runs_by_nonnull(rows, "irrigation_1", ["site_id"], ["date"],
                                  block=F.year("date"))


@query(f"""
SELECT CAST(DATE '1970-01-01' + CAST((date - DATE '1970-01-01') // 7 * 7 AS INTEGER) AS DATE)
    AS time, site_id, crop, irrigation, nitrogen, {_sql_six("avg(mean)")} AS mean
FROM v_summary GROUP BY ALL""")
def canopy_time_bucket(spark, sf):
    return _rounded(report.canopy_time_bucket(_summary(spark, sf)))


# Canopy ------------------------------------------------------------------------------

@query(f"SELECT site_id, crop, sensor, date, irrigation, nitrogen, {_r('mean', 'sd')} "
       "FROM v_summary")
def canopy_summary(spark, sf):
    return _rounded(_summary(spark, sf))


@query(f"SELECT site_id, crop, date, irrigation, nitrogen, {_r('mean', 'sd')} FROM v_cover")
def full_cover_date(spark, sf):
    return _rounded(_cover(spark, sf))


@query("SELECT site_id, date, events FROM v_events")
def growth_event_literal(spark, sf):
    return trial.growth_events(spark, sf)


@query("SELECT site_id, date, crop, events FROM v_parsed")
def growth_event_parse(spark, sf):
    return canopy.growth_event_parse(trial.growth_events(spark, sf))


@query(f"SELECT site_id, date, crop, events, {_r('mean')} FROM v_stages")
def growth_stage_merge(spark, sf):
    return _rounded(_stages(spark, sf))


@query("""
SELECT site_id, date, crop, events,
  CAST(CASE WHEN mean IN (0, 0.1) THEN 0.15 WHEN mean > 0.75 THEN 1 END AS DOUBLE) AS start_value
FROM v_stages""")
def stage_start_value(spark, sf):
    return _stages(spark, sf).withColumn("start_value", canopy.stage_start_value()).drop("mean")


@query("SELECT site_id, crop, events, date AS end_date FROM v_stageday WHERE from_end = 1")
def stage_end_rows(spark, sf):
    return canopy.stage_spans(_stages(spark, sf)).select("site_id", "crop", "events", "end_date")


@query("""
SELECT d.site_id, d.crop, d.events, d.date AS end_date,
  CAST(e.end_value AS DOUBLE) AS end_value
FROM v_stageday d JOIN v_ends e ON d.site_id = e.site_id AND d.stage_no = e.stage_no
WHERE d.from_end = 1""")
def stage_end_value(spark, sf):
    return canopy.stage_spans(_stages(spark, sf)).select(
        "site_id", "crop", "events", "end_date", "end_value")


@query(f"SELECT site_id, date, crop, events, {_r('mean', 'pet_correction')} FROM v_coefficient")
def crop_coefficient(spark, sf):
    return _rounded(_coefficient(spark, sf))


_DAILY = ["pet", "rain", "irrigation_1", "irrigation_2", "precipitation_1", "precipitation_2"]


@query(f"SELECT site_id, date, crop, {_r(*_DAILY, 'pet_correction')} FROM v_corrected")
def pet_correction(spark, sf):
    return _rounded(canopy.pet_correction(_daily(spark, sf), _coefficient(spark, sf)))


# Balance -------------------------------------------------------------------------------

@query("""
SELECT site_id, crop, date, coalesce(irrigation_1, 0) AS irrigation_1,
  coalesce(irrigation_2, 0) AS irrigation_2
FROM v_diary""")
def fill_zero(spark, sf):
    return weather.fill_zero(trial.irrigation_diary(spark, sf))


@query("""
SELECT site_id, date,
  CASE WHEN irrigation_1 IS NOT NULL AND irrigation_2 IS NOT NULL
    THEN least(irrigation_1, irrigation_2) END AS lower,
  CASE WHEN irrigation_1 IS NOT NULL AND irrigation_2 IS NOT NULL
    THEN greatest(irrigation_1, irrigation_2) END AS upper
FROM v_diary""")
def null_strict_least(spark, sf):
    levels = ["irrigation_1", "irrigation_2"]
    return trial.irrigation_diary(spark, sf).select(
        "site_id", "date", nulls.strict_least(*levels).alias("lower"),
        nulls.strict_greatest(*levels).alias("upper"))


@query(f"SELECT site_id, date, crop, {_r(*_DAILY)} FROM v_daily")
def daily_inputs(spark, sf):
    return _rounded(_daily(spark, sf))


@query(f"SELECT {_TREATMENT}, {_r('wt0', 'ws0', 'awhc', 'awhcs')} FROM v_inputs")
def balance_inputs(spark, sf):
    return _rounded(_inputs(spark, sf))


@query(f"SELECT {_TREATMENT}, date, {_r(*_STATE_COLUMNS)} FROM v_states")
def water_balance(spark, sf):
    return _rounded(_states(spark, sf))


@query(f"SELECT {_TREATMENT}, date, {_r('swd', *_STATE_COLUMNS)} FROM v_reset_states")
def balance_reset(spark, sf):
    means = _once(_means(spark, sf), "means")
    measured = soil_sheet.swd_from_means(means, 3)
    return _rounded(balance.water_balance(_daily(spark, sf), soil_sheet.inputs_from_means(means), reset=measured))


@query(f"SELECT {_TREATMENT}, date, {_r(*_STATE_COLUMNS)} FROM v_cor_states")
def balance_corrected_pet(spark, sf):
    """The balance on corrected instead of raw evaporation."""
    daily = canopy.pet_correction(_daily(spark, sf), _coefficient(spark, sf))
    return _rounded(balance.water_balance(daily, _inputs(spark, sf), pet_col="pet_correction"))


@query(f"SELECT {_TREATMENT}, date, {_r('ws', 'es')} FROM v_states")
def balance_top_store_scan(spark, sf):
    """The top store by composed maps of months, without a walk over the days."""
    daily = _once(_daily(spark, sf), "daily")
    return _rounded(top_store.top_store_scan(daily, _inputs(spark, sf)))


@query(f"SELECT {_TREATMENT}, date, {_r('swd', *_STATE_COLUMNS)} FROM v_driest_states")
def balance_nested_reset(spark, sf):
    """June days measured a second time, under another crop; the driest counts."""
    means = _once(_means(spark, sf), "means")
    measured = soil_sheet.swd_from_means(means, 3).select(
        "site_id", "irrigation", "n_rate", "date", "swd")
    again = measured.filter(F.month("date") == 6).withColumn("swd", F.col("swd") - 5)
    return _rounded(balance.water_balance(_daily(spark, sf), soil_sheet.inputs_from_means(means),
                                          reset=measured.unionByName(again), same_day="driest"))


@query(f"""
SELECT 'missing' AS mode, {_TREATMENT}, date, {_r(*_STATE_COLUMNS)} FROM v_gap_states
UNION ALL
SELECT 'zero', {_TREATMENT}, date, {_r(*_STATE_COLUMNS)} FROM v_dry_states""")
def balance_missing_rain(spark, sf):
    """A rain gauge with gaps: days without a record as missing, and as dry."""
    seen = _once(weather.weather_join(trial.pet(spark, sf), trial.gauge(spark, sf)), "weather")
    diary, inputs = _once(trial.irrigation_diary(spark, sf), "diary"), _once(_inputs(spark, sf), "inputs")
    states = []
    for mode in ("missing", "zero"):
        daily = weather.daily_inputs(seen, diary, missing_rain=mode)
        states.append(balance.water_balance(daily, inputs).withColumn("mode", F.lit(mode)))
    return _rounded(states[0].unionByName(states[1]))


# Reports -------------------------------------------------------------------------------

_PUBLISHED = [*nitrogen_columns("SWD_"), "PET", "Precipitation",
              *nitrogen_columns("Wt_", "Drainage_")]


@query(f"SELECT site_id, date, profile, {_r(*_PUBLISHED)} FROM v_published")
def publish_wide(spark, sf):
    return _rounded(_published(spark, sf))


def _second(spark, sf, level):
    means = _means_of(spark, sf, *{level, 2})
    inputs = soil_sheet.inputs_from_means(means).filter(F.col("irrigation") == level)
    states = balance.water_balance(_daily(spark, sf), inputs)
    return report.publish_wide(states, soil_sheet.multi_depth_from_means(means), level, measured_irrigation=2)


@query(f"SELECT site_id, date, profile, {_r(*_PUBLISHED)} FROM v_published_2")
def publish_wide_2(spark, sf):
    """The table of irrigation level 2."""
    return _rounded(_second(spark, sf, 2))


@query(f"SELECT site_id, date, profile, {_r(*_PUBLISHED)} FROM v_published_2of1")
def publish_wide_2_parity(spark, sf):
    """Measured deficits of level 2 beside the modelled days of level 1."""
    return _rounded(_second(spark, sf, 1))


_FIVE = [f"SWD_Nitrogen {k}" for k in range(1, 6)]


@query(f"SELECT site_id, crop, date, profile, {_r(*_FIVE)} FROM v_five_rates")
def pivot_found_rates(spark, sf):
    """Five nitrogen rates that only the data tell of."""
    sheet = dates.with_local_date(trial.soil_sheet(spark, sf, rates=5))
    depths = soil_sheet.multi_depth_from_means(soil_sheet.sheet_means(sheet))
    return _rounded(report.pivot_swd(depths, 2, reshape.found_names(depths, "n_rate")))


@query(f"""
SELECT site_id, date, crop, {_r('irrigation_3', 'precipitation_1', 'precipitation_2', 'precipitation_3')}
FROM v_daily_3""")
def daily_inputs_found_levels(spark, sf):
    """Three irrigation levels that only the diary's header tells of."""
    daily = weather.daily_inputs(_weather(spark, sf), trial.three_level_diary(spark, sf))
    return _rounded(daily.select("site_id", "date", "crop", "irrigation_3",
                                 *[f"precipitation_{k}" for k in (1, 2, 3)]))


@query(f"""
SELECT site_id, date, nullif({_sql_six(_quoted("PET"))}, 0) AS "PET",
  nullif({_sql_six(_quoted("Precipitation"))}, 0) AS "Precipitation"
FROM v_published WHERE profile IS NULL OR profile NOT IN ('20 cm', '40 cm')""")
def figure_weather(spark, sf):
    rows = report.figure_drainage(_published(spark, sf))[0].select("site_id", "date", "PET", "Precipitation")
    return nulls.zero_to_null(_rounded(rows), ["PET", "Precipitation"])


def _panel(column: str, name: str) -> str:
    return f'{_sql_six(_quoted(column))} AS "{name}"'


@query("SELECT site_id, date AS time, "
       + ", ".join(_panel(f"Wt_Nitrogen {k}", f"WaterBalance N{k}") for k in range(1, 5)) + ", "
       + ", ".join(_panel(f"SWD_Nitrogen {k}", f"Measurement N{k}") for k in range(1, 5))
       + " FROM v_published ORDER BY time")
def panel_balance(spark, sf):
    return _rounded(report.panel_balance(_published(spark, sf)))


@query("SELECT site_id, date AS time, " + _r("PET", "Precipitation") + ", "
       + ", ".join(_panel(f"Drainage_Nitrogen {k}", f"Nitrogen {k}") for k in range(1, 5))
       + " FROM v_published ORDER BY time")
def panel_drainage(spark, sf):
    return _rounded(report.panel_drainage(_published(spark, sf)))


@query("\nUNION ALL\n".join(
    f"""SELECT site_id, date, profile, '{c}' AS variable, {_sql_six(_quoted(c))} AS value
FROM v_published WHERE profile IS NULL OR profile NOT IN ('20 cm', '40 cm')"""
    for c in nitrogen_columns("Wt_", "SWD_")))
def figure_long_60cm(spark, sf):
    return _rounded(report.figure_long_60cm(_published(spark, sf)))


@query("\nUNION ALL\n".join(
    f"""SELECT site_id, date, '{c}' AS variable, nullif({_sql_six(_quoted(c))}, 0) AS value
FROM v_published WHERE profile IS NULL OR profile NOT IN ('20 cm', '40 cm')"""
    for c in nitrogen_columns("Drainage_")))
def figure_drainage(spark, sf):
    rows = _rounded(report.figure_drainage(_published(spark, sf))[1])
    return nulls.zero_to_null(rows, ["value"])
