"""Canopy cover, growth stages and the daily crop coefficient."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The canopy index at which cover counts as full, the index given
# to sown and emerged crops, and the coefficients of bare and covered soil.
FULL_COVER = 0.75
BARE_INDEX, EMERGED_INDEX = 0.0, 0.1
BARE_COEFFICIENT, COVERED_COEFFICIENT = 0.15, 1.0
CLOSURE = "canopy-closure"


def canopy_summary(canopy: DataFrame, sensor: str | None = None) -> DataFrame:
    """Mean and spread of the canopy index per day and treatment, of one sensor if named.

    Sensors read differently; full cover and stages are to come from one of them.
    """
    if sensor is not None:
        canopy = canopy.filter(F.col("sensor") == sensor)
    return (canopy.filter(F.col("irrigation").isNotNull())
            .groupBy("site_id", "crop", "sensor", "date",
                     F.col("irrigation").cast("string").alias("irrigation"),
                     F.col("nitrogen").cast("string").alias("nitrogen"))
            .agg(F.avg("ndvi").alias("mean"), F.stddev_samp("ndvi").alias("sd")))


def full_cover_date(summary: DataFrame) -> DataFrame:
    """First day on which a crop of a site covers the soil.

    Of several treatments on that day the lowest irrigation and nitrogen stand.
    """
    first = F.min(F.struct("date", "irrigation", "nitrogen", "mean", "sd"))
    return (summary.filter(F.col("mean") >= FULL_COVER).groupBy("site_id", "crop")
            .agg(first.alias("first")).select("site_id", "crop", "first.*"))


def growth_event_parse(events: DataFrame) -> DataFrame:
    """Crop and event out of the text, keeping events that change the cover."""
    words = F.split("events", r"\s")
    return (events.withColumns({"crop": words[0], "events": words[1]})
            .filter(F.col("events").rlike("emerged|harvest|plant")))


def growth_stage_merge(events: DataFrame, cover: DataFrame) -> DataFrame:
    """Growth events and full-cover days as one list of stages with an index."""
    closed = cover.select("site_id", "date", F.col("crop").alias("cover_crop"), "mean")
    event = F.col("events")
    by_event = (F.when(event.rlike("planted|harvest"), BARE_INDEX)
                .when(event.rlike("emerged"), EMERGED_INDEX))
    return (events.join(closed, ["site_id", "date"], "full")
            .select("site_id", "date", F.coalesce("crop", "cover_crop").alias("crop"),
                    F.coalesce(event, F.lit(CLOSURE)).alias("events"),
                    F.coalesce("mean", by_event).alias("mean")))


def calendar_join(calendar: DataFrame, stages: DataFrame) -> DataFrame:
    """Every day of a site, with the stage that starts on it."""
    return calendar.join(stages, ["site_id", "date"], "full").select(
        "site_id", "date", "events", "mean", "crop")


def stage_start_value(mean: Column | str = "mean") -> Column:
    """Coefficient on the first day of a stage.

    An index of exactly the full-cover limit gives none: the limit selects with
    "at least" but values with "more than".
    """
    mean = F.col(mean) if isinstance(mean, str) else mean
    return (F.when(mean.isin(BARE_INDEX, EMERGED_INDEX), BARE_COEFFICIENT)
            .when(mean > FULL_COVER, COVERED_COEFFICIENT))


def stage_spans(stages: DataFrame) -> DataFrame:
    """First and last day and coefficient of every stage.

    A stage ends at the start value of the next one; a closed canopy stays
    closed; the last stage ends bare. A site has a handful of stages.
    """
    w = Window.partitionBy("site_id").orderBy("date", "crop", "events")
    start = stage_start_value()
    nominal = F.when(F.col("events") == CLOSURE, COVERED_COEFFICIENT).otherwise(start)
    end = F.coalesce(F.when(F.col("events") == CLOSURE, F.lit(COVERED_COEFFICIENT)),
                     F.lead(nominal).over(w), F.lit(BARE_COEFFICIENT))
    before_next = F.date_sub(F.lead("date").over(w), 1)
    return stages.filter(F.col("events").isNotNull()).select(
        "site_id", "crop", "events", "mean", F.col("date").alias("start_date"),
        F.greatest("date", before_next).alias("end_date"),
        start.alias("start_value"), end.alias("end_value"))


def crop_coefficient(stages: DataFrame) -> DataFrame:
    """Daily crop coefficient of every site.

    Takes the stages, or a calendar joined to them. Each stage unfolds into its
    days on the line from its start to its end value, so no window or join ever
    touches the daily rows.
    """
    days = F.sequence("start_date", "end_date", F.expr("interval 1 day"))
    rows = stage_spans(stages).select("*", F.explode(days).alias("date"))
    first, last = F.col("start_date"), F.col("end_date")
    share = F.date_diff("date", first) / F.nullif(F.date_diff(last, first), F.lit(0))
    line = F.col("start_value") + (F.col("end_value") - F.col("start_value")) * share
    value = F.when(F.col("date") == last, F.col("end_value")).otherwise(line)
    return rows.select("site_id", "date", "crop", "events",
                       F.when(F.col("date") == first, F.col("mean")).alias("mean"),
                       value.alias("pet_correction"))


def pet_correction(daily: DataFrame, coefficients: DataFrame,
                   default: float = BARE_COEFFICIENT) -> DataFrame:
    """PET times the crop coefficient; days without one count as bare soil.

    The coefficients are stages unfolded into days. Spark sizes them as the few stages
    they come from and would send all their days through the driver, so the join is
    told to sort both sides.
    """
    side = coefficients.select("site_id", "date", "crop", "pet_correction").hint("merge")
    return (daily.join(side, ["site_id", "date", "crop"], "left")
            .withColumn("pet_correction",
                        F.col("pet") * F.coalesce("pet_correction", F.lit(default))))
