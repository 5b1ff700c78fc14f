"""Tumbling-window aggregates. Every function runs on batch and on streaming frames.

Input is the parsed event frame, not silver: the speed layer counts what arrives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.group import GroupedData

from eventlake.functions.predicates import is_purchase
from eventlake.functions.timerange import flat_window

MINUTE = "1 minute"


def tumbling(events: DataFrame, *keys: str, width: str = MINUTE) -> GroupedData:
    return events.groupBy(F.window("event_timestamp", width), *keys)


def with_watermark(events: DataFrame, delay: str) -> DataFrame:
    """Declare how late an event may be. Zone-less times cannot carry a watermark, so cast."""
    return events.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp")).withWatermark(
        "event_timestamp", delay
    )


def events_per_minute(events: DataFrame, width: str = MINUTE) -> DataFrame:
    return flat_window(
        tumbling(events, "event_type", width=width).agg(F.count("*").alias("event_count"))
    )


def revenue_per_minute(events: DataFrame, width: str = MINUTE) -> DataFrame:
    return flat_window(
        tumbling(events.filter(is_purchase()), width=width).agg(
            F.sum("price").alias("revenue"), F.count("*").alias("purchase_count")
        )
    )


def purchases_per_minute(events: DataFrame, width: str = MINUTE) -> DataFrame:
    return flat_window(
        tumbling(events.filter(is_purchase()), width=width).agg(F.count("*").alias("purchase_count"))
    )


def category_velocity(events: DataFrame, width: str = MINUTE) -> DataFrame:
    return flat_window(
        tumbling(events.filter(is_purchase()), "category", width=width).agg(
            F.count("*").alias("purchase_count"), F.sum("price").alias("revenue")
        )
    )


def logins_per_source(events: DataFrame, width: str = MINUTE) -> DataFrame:
    return flat_window(
        tumbling(events.filter(F.col("event_type") == "login"), "source", width=width).agg(
            F.count("*").alias("login_count")
        )
    )


# --- one aggregate for all minute tables -----------------------------------------------------


def minute_cube(events: DataFrame, width: str = MINUTE) -> DataFrame:
    """Counts per (window, type, source, category): the finest grain of all minute tables.

    One streaming query keeps this frame up to date with one read of the topic and one state
    store. The minute tables are sums over its newest rows.
    """
    return flat_window(
        tumbling(events, "event_type", "source", "category", width=width).agg(
            F.count("*").alias("event_count"),
            F.sum(F.when(is_purchase(), F.col("price"))).alias("revenue"),
        )
    )


MINUTE_CUBE_KEYS = ("window_start", "event_type", "source", "category")


def _sum_cube(cube: DataFrame, kind: str | None, keys: tuple[str, ...], **sums: str) -> DataFrame:
    """Sums over a cube; a cube read with its date folders keeps the date, so filters on it reach the scan."""
    rows = cube if kind is None else cube.filter(F.col("event_type") == kind)
    dated = [c for c in ("event_date",) if c in cube.columns]
    return rows.groupBy("window_start", "window_end", *dated, *keys).agg(
        *[F.sum(column).alias(name) for name, column in sums.items()]
    )


def events_from_cube(cube: DataFrame) -> DataFrame:
    return _sum_cube(cube, None, ("event_type",), event_count="event_count")


def revenue_from_cube(cube: DataFrame) -> DataFrame:
    return _sum_cube(cube, "purchase", (), revenue="revenue", purchase_count="event_count")


def purchases_from_cube(cube: DataFrame) -> DataFrame:
    return _sum_cube(cube, "purchase", (), purchase_count="event_count")


def category_velocity_from_cube(cube: DataFrame) -> DataFrame:
    return _sum_cube(cube, "purchase", ("category",), purchase_count="event_count", revenue="revenue")


def logins_from_cube(cube: DataFrame) -> DataFrame:
    return _sum_cube(cube, "login", ("source",), login_count="event_count")
