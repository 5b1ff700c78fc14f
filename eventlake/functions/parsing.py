"""From raw stream records to typed events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.schemas import EVENT_SCHEMA


def parse_events(raw: DataFrame, with_ingestion: bool = True) -> DataFrame:
    """Decode the JSON ``value`` of each record into typed event columns.

    A malformed record yields NULLs and a bad field yields NULL in that field only: casts are
    ``try_cast``, so ANSI mode does not fail the job on one dirty record. With ``with_ingestion``
    the record time is kept as ``ingestion_timestamp`` and the partition date is derived.
    """
    record_time = [F.col("timestamp").alias("ingestion_timestamp")] if with_ingestion else []
    data = raw.select(
        F.from_json(F.col("value").cast("string"), EVENT_SCHEMA).alias("data"), *record_time
    )
    events = data.select(
        "data.event_id",
        "data.user_id",
        "data.event_type",
        "data.page",
        F.col("data.timestamp").try_cast("timestamp").alias("event_timestamp"),
        "data.source",
        "data.session_id",
        F.col("data.price").try_cast("double").alias("price"),
        "data.category",
        "data.product_id",
        *(["ingestion_timestamp"] if with_ingestion else []),
    )
    return with_event_date(events) if with_ingestion else events


def with_event_date(events: DataFrame) -> DataFrame:
    return events.withColumn("event_date", F.to_date("event_timestamp"))


def to_json_records(events: DataFrame) -> DataFrame:
    """Inverse of :func:`parse_events`: one JSON ``value`` per event plus its record time."""
    wire = F.struct(
        "event_id",
        "user_id",
        "event_type",
        "page",
        F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("timestamp"),
        "source",
        "session_id",
        "price",
        "category",
        "product_id",
    )
    return events.select(
        F.to_json(wire).alias("value"), F.col("ingestion_timestamp").alias("timestamp")
    )
