"""Publishing a result table, and reading a published one back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write a table in place of the one that was published there before."""
    if df is None:
        raise ValueError("nothing to publish")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def publish_table(df: DataFrame, name: str) -> None:
    """The same into the session's catalog."""
    if df is None:
        raise ValueError("nothing to publish")
    df.write.mode("overwrite").saveAsTable(name)


def publish_jdbc(df: DataFrame, url: str, table: str, **properties: str) -> None:
    """The same into a database the executors can reach."""
    if df is None:
        raise ValueError("nothing to publish")
    df.write.jdbc(url, table, mode="overwrite", properties=properties)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
