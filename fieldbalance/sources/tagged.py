"""Many files named ``<site>_<crop>_<sensor>``, read at once with their tags."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _tags(crops: Sequence[str], sensors: Sequence[str]) -> str:
    """Pattern of a tagged name. Crop and sensor are known, so a site may hold ``_``."""
    listed = ["|".join(re.escape(x) for x in sorted(xs, key=len, reverse=True))
              for xs in (crops, sensors)]
    return rf"(?:^|[/=])([^/=]+)_({listed[0]})_({listed[1]})(?:\.[^/]*)?$"


def file_grid(spark: SparkSession, sites: DataFrame, crops: Sequence[str],
              sensors: Sequence[str]) -> DataFrame:
    """Every site with every listed crop and sensor, and the file stem of each.

    The two lists are short and known, so each site row unfolds in place.
    """
    return (sites.select("site_id", F.explode(F.array(*map(F.lit, crops))).alias("crop"))
            .select("*", F.explode(F.array(*map(F.lit, sensors))).alias("sensor"))
            .withColumn("stem", F.concat_ws("_", "site_id", "crop", "sensor")))


LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def write_tagged(rows: DataFrame, folder: str) -> None:
    """One folder ``file=<site>_<crop>_<sensor>`` per site, crop and sensor.

    Folders are many and small: they are dealt out by number and not by size, so that all
    cores make files, however few bytes there are. A folder is written by one task.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    (rows.withColumn("file", F.concat_ws("_", "site_id", "crop", "sensor"))
     .drop("site_id", "crop", "sensor").repartition(4 * cores, "file")
     .write.partitionBy("file").parquet(folder))


def _listed(spark: SparkSession, load: Callable[[], DataFrame]) -> DataFrame:
    """What a reader finds; its listing takes some tasks a core, not one for every folder."""
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(4 * spark.sparkContext.defaultParallelism))
    try:
        return load()
    finally:
        spark.conf.set(LISTING, before)


def _named(path: Column, of_folder: bool) -> Column:
    """The part of a path that carries the tags."""
    return F.url_decode(F.regexp_replace(path, r"/[^/]*$", "") if of_folder else path)


def file_listing(spark: SparkSession, folder: str, crops: Sequence[str], sensors: Sequence[str],
                 one_folder_each: bool = False) -> DataFrame:
    """(site_id, crop, sensor, files, bytes) of the tagged files below a folder.

    The files are listed as a table and not opened. Names that carry no listed crop
    and sensor are left out. A folder that is not there gives no rows.
    """
    kept = "site_id string, crop string, sensor string, files long, bytes long"
    try:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        files = _listed(spark, lambda: reader.load(folder)).select("path", "length")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], kept)
    tags = _tags(crops, sensors)
    name = _named(F.col("path"), one_folder_each)
    return (files.select(*[F.regexp_extract(name, tags, i).alias(c) for i, c in
                           enumerate(("site_id", "crop", "sensor"), start=1)], "length")
            .filter("site_id <> ''").groupBy("site_id", "crop", "sensor")
            .agg(F.count("*").alias("files"), F.sum("length").alias("bytes")))


def grid_coverage(grid: DataFrame, listing: DataFrame) -> DataFrame:
    """Every candidate of the grid with its files and bytes, and whether there are any."""
    found = grid.select("site_id", "crop", "sensor").join(
        listing, ["site_id", "crop", "sensor"], "left")
    return found.withColumns({"present": F.col("files").isNotNull(),
                              "files": F.coalesce("files", F.lit(0).cast("long")),
                              "bytes": F.coalesce("bytes", F.lit(0).cast("long"))})


def absent_files(grid: DataFrame, listing: DataFrame) -> DataFrame:
    """Candidates of the grid without a file."""
    return grid.join(listing, ["site_id", "crop", "sensor"], "left_anti")


def read_tagged(spark: SparkSession, folder: str, schema: T.StructType,
                crops: Sequence[str], sensors: Sequence[str],
                fmt: str = "parquet", one_folder_each: bool = False,
                **options: str) -> DataFrame:
    """Rows of the files that exist for the asked crops and sensors.

    Only files whose name carries an asked crop and sensor are listed and read;
    asked combinations without a file give no rows. With ``one_folder_each`` the
    tags name folders of part files instead of single files.
    """
    stem = f"*_{{{','.join(crops)}}}_{{{','.join(sensors)}}}"
    reader = spark.read.format(fmt).schema(schema).options(**options)
    reader = reader.option("recursiveFileLookup", "true")
    try:
        rows = _listed(spark, lambda: reader.load(f"{folder}/{stem}") if one_folder_each
                       else reader.option("pathGlobFilter", f"{stem}.*").load(folder))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T.StructType(
            [*(T.StructField(c, T.StringType()) for c in ("site_id", "crop", "sensor")),
             *schema.fields]))
    tags, name = _tags(crops, sensors), _named(F.col("_metadata.file_path"), one_folder_each)
    return rows.select(*[F.regexp_extract(name, tags, i).alias(c) for i, c in
                         enumerate(("site_id", "crop", "sensor"), start=1)], *schema.fieldNames())
