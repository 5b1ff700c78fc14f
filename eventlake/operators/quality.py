"""Data quality reports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventlake.functions import predicates as rules


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Number of rows of each table."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def quality_report(tables: Mapping[str, DataFrame | None], spark=None) -> DataFrame:
    """Presence and emptiness of each table; ``None`` stands for a table that is not there."""
    present = {name: df for name, df in tables.items() if df is not None}
    report = None
    if present:
        report = row_counts(present).select(
            "table", F.lit(True).alias("exists"), "rows", (F.col("rows") == 0).alias("is_empty")
        )
    missing = [name for name, df in tables.items() if df is None]
    if missing:
        session = spark or next(iter(present.values())).sparkSession
        absent = session.createDataFrame(
            [(name, False, 0, True) for name in missing], "table string, exists boolean, rows long, is_empty boolean"
        )
        report = absent if report is None else report.unionByName(absent)
    return report


def passes(report: DataFrame) -> bool:
    """Non-fatal verdict of a report."""
    return report.filter(~F.col("exists") | F.col("is_empty")).isEmpty()


def event_quality(bronze: DataFrame, as_of: Column, late_after: str = "10 minutes") -> DataFrame:
    """Share of bronze rows with each defect, next to the number of repeated event ids.

    Rows are combined per event id first, so repeats are counted in the same pass.
    """
    arrived = F.col("ingestion_timestamp")
    happened = F.col("event_timestamp")
    defects = {
        "schema_violations": ~rules.has_required_fields(),
        "invalid_categories": ~rules.has_valid_category(),
        "missing_prices": F.coalesce(rules.is_purchase() & F.col("price").isNull(), F.lit(False)),
        "future_timestamps": F.coalesce(happened > as_of, F.lit(False)),
        "late_arrivals": F.coalesce(arrived > happened + F.expr(f"INTERVAL {late_after}"), F.lit(False)),
    }
    per_id = bronze.groupBy("event_id").agg(
        F.count("*").alias("rows"), *[F.count_if(test).alias(name) for name, test in defects.items()]
    )
    return per_id.agg(
        F.sum("rows").alias("rows"),
        F.sum(F.when(F.col("event_id").isNotNull(), F.col("rows") - 1).otherwise(0)).alias("duplicate_ids"),
        *[F.sum(name).alias(name) for name in defects],
    )


def out_of_order(bronze: DataFrame) -> DataFrame:
    """Per minute of arrival, the events older than the newest event that had arrived by then.

    The running maximum is taken level by level: over days, over the minutes of a day, and over
    the distinct arrival instants of a minute. Each level has a bounded number of rows per group.
    """
    dated = bronze.filter("ingestion_timestamp IS NOT NULL AND event_timestamp IS NOT NULL")
    arrivals = (
        dated.groupBy("ingestion_timestamp")
        .agg(F.max("event_timestamp").alias("newest_here"))
        .withColumn("arrival_minute", F.date_trunc("minute", F.col("ingestion_timestamp")))
    )
    minutes = arrivals.groupBy("arrival_minute").agg(F.max("newest_here").alias("newest"))
    minutes = minutes.withColumn("day", F.to_date("arrival_minute"))
    days = minutes.groupBy("day").agg(F.max("newest").alias("newest"))

    earlier_days = W.orderBy("day").rowsBetween(W.unboundedPreceding, -1)
    earlier_minutes = W.partitionBy("day").orderBy("arrival_minute").rowsBetween(W.unboundedPreceding, -1)
    before_day = days.select("day", F.max("newest").over(earlier_days).alias("before_day"))
    before_minute = (
        minutes.withColumn("in_day", F.max("newest").over(earlier_minutes))
        .join(before_day, "day")
        .select("arrival_minute", F.greatest("before_day", "in_day").alias("before_minute"))
    )
    within = W.partitionBy("arrival_minute").orderBy("ingestion_timestamp")
    newest = arrivals.join(before_minute, "arrival_minute").select(
        "arrival_minute",
        "ingestion_timestamp",
        F.greatest("before_minute", F.max("newest_here").over(within)).alias("newest"),
    )
    instants = dated.groupBy("ingestion_timestamp", "event_timestamp").agg(F.count("*").alias("events"))
    older = F.when(F.col("event_timestamp") < F.col("newest"), F.col("events")).otherwise(0)
    return (
        instants.join(newest, "ingestion_timestamp")
        .groupBy("arrival_minute")
        .agg(F.sum(older).alias("out_of_order"))
    )
