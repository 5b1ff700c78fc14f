"""Time windows and ranges relative to an explicit ``as_of`` instant."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The ranges a picker offers.
RANGES = {
    "1h": "1 hour",
    "6h": "6 hours",
    "12h": "12 hours",
    "24h": "24 hours",
    "7d": "7 days",
    "30d": "30 days",
}
DEFAULT_RANGE = "24h"


def instant(as_of: Column | datetime | str) -> Column:
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp_ntz")


def latest(events: DataFrame, column: str = "event_timestamp") -> Column:
    """Newest instant of a frame as a scalar subquery: the default ``as_of``."""
    return events.agg(F.max(column).alias("as_of")).scalar()


def before(as_of: Column | datetime | str, span: str) -> Column:
    return instant(as_of) - F.expr(f"INTERVAL {span}")


def today(as_of: Column | datetime | str) -> Column:
    return F.to_date(instant(as_of))


def yesterday(as_of: Column | datetime | str) -> Column:
    return F.date_sub(today(as_of), 1)


def in_range(df: DataFrame, column: str, span: str, as_of: Column | datetime | str) -> DataFrame:
    """Rows of the last ``span``; an unknown picker value means the last 24 hours."""
    return since(df, column, before(as_of, RANGES.get(span, RANGES[DEFAULT_RANGE])))


def since(df: DataFrame, column: str, start: Column) -> DataFrame:
    """Rows from an instant on. Where the date of the instant is a folder of the table, others are not read."""
    rows = df.filter(F.col(column) >= start)
    dated = "event_date" in df.columns
    return rows.filter(F.col("event_date") >= F.to_date(start)) if dated else rows


def flat_window(df: DataFrame) -> DataFrame:
    """Replace the ``window`` struct by ``window_start`` and ``window_end``."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )
