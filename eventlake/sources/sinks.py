"""Batch sinks of the lake."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_silver(df: DataFrame, path: str, fmt: str = "parquet", whole: bool = True) -> None:
    """Replace a date-partitioned table, or of it only the dates that ``df`` holds.

    ``rebalance`` groups the rows of a date for few large files and splits a date that is larger
    than the advisory partition size, so one busy date does not end in one task.
    """
    (
        df.hint("rebalance", "event_date")
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .option("overwriteSchema", "true")
        .partitionBy("event_date")
        .save(path)
    )


def store_daily(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace exactly the dates that ``df`` holds; storing a date again leaves one version of it."""
    write_silver(df, path, fmt, whole=False)


def write_gold(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").save(path)


def publish_gold(df: DataFrame, path: str, fmt: str = "parquet", whole: bool = False) -> None:
    """Replace exactly the dates that ``df`` holds, or the ``whole`` table, and stamp the rows.

    Running it again, or after a lost executor, leaves one version of each date.
    """
    (
        df.withColumn("updated_at", F.current_timestamp())
        .hint("rebalance", "event_date")
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy("event_date")
        .save(path)
    )


def drop_dates(spark: SparkSession, path: str, dates: Sequence[date]) -> None:
    """Remove date partitions of a file table; an overwrite by partition cannot write an empty one."""
    jvm = spark._jvm.org.apache.hadoop.fs
    for day in dates:
        folder = jvm.Path(f"{path}/event_date={day.isoformat()}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def publish_jdbc(df: DataFrame, url: str, table: str, **properties: str) -> None:
    """Replace a whole KPI table of an external store, keeping its definition."""
    stamped = df.withColumn("updated_at", F.current_timestamp())
    stamped.write.mode("overwrite").option("truncate", "true").jdbc(url, table, properties=properties)
