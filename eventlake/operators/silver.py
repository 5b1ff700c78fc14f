"""Bronze to silver: cleaning, de-duplication and the audit of both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventlake.functions import predicates as rules
from eventlake.functions.parsing import with_event_date


def valid_required(events: DataFrame) -> DataFrame:
    return events.filter(rules.has_required_fields())


def valid_domains(events: DataFrame) -> DataFrame:
    """Known event type and source, positive user, known category and positive price where given."""
    return events.filter(
        rules.has_valid_event_type()
        & rules.has_valid_source()
        & rules.has_valid_user()
        & rules.has_valid_category()
        & rules.has_valid_price()
    )


def valid_purchase(events: DataFrame) -> DataFrame:
    return events.filter(rules.is_complete_purchase())


def clean_events(events: DataFrame) -> DataFrame:
    return events.filter(rules.is_clean())


def dedupe_first(
    events: DataFrame, key: str = "event_id", order: str = "ingestion_timestamp"
) -> DataFrame:
    """Keep the earliest row of each key.

    Ties are broken by all other columns, so the kept row never depends on task order. The
    ``row_number = 1`` filter lets Spark cut each key to one row *before* the shuffle, so a key
    that holds a third of all rows sends one row per map task.
    """
    rest = [c for c in events.columns if c not in (key, order)]
    earliest = W.partitionBy(key).orderBy(order, *rest)
    return events.withColumn("_rank", F.row_number().over(earliest)).filter("_rank = 1").drop("_rank")


def dedupe_stream(events: DataFrame, delay: str) -> DataFrame:
    """Drop repeats of an event id that arrive within ``delay`` of each other (streaming)."""
    return events.withWatermark("event_timestamp", delay).dropDuplicatesWithinWatermark(["event_id"])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("count")).filter("count > 1")


def silver(bronze: DataFrame) -> DataFrame:
    return with_event_date(dedupe_first(clean_events(bronze)))


def reject_counts(bronze: DataFrame) -> DataFrame:
    """One row per silver rule with the number of bronze rows that break it, in one pass."""
    counts = bronze.agg(
        *[F.count_if(~rule()).alias(name) for name, rule in rules.SILVER_RULES.items()]
    )
    pairs = ", ".join(f"'{name}', {name}" for name in rules.SILVER_RULES)
    return counts.selectExpr(f"stack({len(rules.SILVER_RULES)}, {pairs}) AS (rule, rejected)")


def clean_report(bronze: DataFrame) -> DataFrame:
    """Rows read, kept and dropped by the bronze-to-silver step.

    Kept rows are the distinct ids among clean rows, so the audit reads narrow columns and needs
    no de-duplicated table. NULL event dates are counted: such rows never reach silver.
    """
    per_id = (
        bronze.select(
            F.when(rules.is_clean(), F.col("event_id")).alias("clean_id"),
            F.col("event_date").isNull().alias("undated"),
        )
        .groupBy("clean_id")
        .agg(F.count("*").alias("rows"), F.count_if("undated").alias("undated"))
    )
    return per_id.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_read"),
        F.count("clean_id").alias("rows_kept"),
        (F.coalesce(F.sum("rows"), F.lit(0)) - F.count("clean_id")).alias("rows_dropped"),
        F.coalesce(F.sum("undated"), F.lit(0)).alias("rows_undated"),
    )


def merge_silver(existing: DataFrame, bronze_increment: DataFrame) -> DataFrame:
    """Silver after one more slice of bronze: equal to a full rebuild over both slices."""
    fresh = with_event_date(clean_events(bronze_increment))
    return dedupe_first(existing.unionByName(fresh))
