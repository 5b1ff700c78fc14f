"""Event schema, value domains and the keys of the serving tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Wire format of one JSON event. Everything is nullable after ``from_json``,
# so requiredness is checked by the silver rules and not by the schema.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.IntegerType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("product_id", T.StringType()),
    ]
)

REQUIRED_FIELDS = ("event_id", "user_id", "event_type", "event_timestamp", "source", "session_id")

# The closed domains of an event.
EVENT_TYPES = ("login", "view", "add_to_cart", "purchase", "logout")
SOURCES = ("web", "mobile")
CATEGORIES = ("Electronics", "Fashion", "Home", "Books", "Sports", "Beauty", "Toys", "Food")
PAGES = (
    "/home", "/profile", "/settings", "/products", "/products/detail",
    "/search", "/about", "/help", "/cart", "/checkout",
)

BRONZE_COLUMNS = (
    "event_id", "user_id", "event_type", "page", "event_timestamp", "source", "session_id",
    "price", "category", "product_id", "ingestion_timestamp", "event_date",
)

FACT_COLUMNS = (
    "event_id", "user_id", "event_type", "page", "event_timestamp", "source", "event_date",
)

ANOMALY_COLUMNS = (
    "window_start", "anomaly_type", "severity", "description", "metric_value", "expected_value",
)


@dataclass(frozen=True)
class TableSpec:
    """Key and merge rule of one serving table."""

    keys: tuple[str, ...]
    merge: str  # "replace": newest version of a key wins; "append"; "sum"


# Table names and keys of the serving layer.
SERVING_TABLES = {
    "events_per_minute": TableSpec(("window_start", "event_type"), "append"),
    "purchases_per_minute": TableSpec(("window_start",), "append"),
    "revenue_per_minute": TableSpec(("window_start",), "append"),
    "category_velocity": TableSpec(("window_start", "category"), "append"),
    "daily_active_users": TableSpec(("event_date",), "replace"),
    "events_per_source_daily": TableSpec(("event_date", "source"), "replace"),
    "purchases_per_page_daily": TableSpec(("event_date", "page"), "replace"),
    "conversion_rate_daily": TableSpec(("event_date",), "replace"),
    "revenue_daily": TableSpec(("event_date",), "replace"),
    "category_sales_daily": TableSpec(("event_date", "category"), "replace"),
    "cart_abandonment_daily": TableSpec(("event_date",), "replace"),
    "anomalies": TableSpec(("detected_at", "severity", "anomaly_type"), "append"),
    "anomaly_baselines": TableSpec(("metric_name", "window_size"), "replace"),
    "anomaly_summary": TableSpec(("anomaly_date", "severity", "anomaly_type"), "sum"),
}
