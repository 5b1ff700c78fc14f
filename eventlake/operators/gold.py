"""Silver to gold: dimensions, facts and daily KPIs.

The KPI functions read silver directly. ``user_day`` and ``page_day`` are compact rollups from which
a batch run derives several KPIs, so that silver is scanned once for each group of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.predicates import is_purchase
from eventlake.schemas import FACT_COLUMNS


def _purchases(silver: DataFrame) -> DataFrame:
    return silver.filter(is_purchase())


def _rate(part: str, whole: str) -> Column:
    return F.round(F.try_divide(F.col(part), F.col(whole)), 4)


def _average_value(total: Column, count: Column) -> Column:
    """Average to the cent. The last digits of a sum of doubles depend on task order; they are cut
    off first, so that an average halfway between two cents always rounds the same way."""
    return F.round(F.round(total, 6) / count, 2)


# --- dimensions and facts -------------------------------------------------------------------


def dim_users(silver: DataFrame) -> DataFrame:
    return silver.groupBy("user_id").agg(
        F.count("*").alias("total_events"), F.countDistinct("source").alias("source_count")
    )


def dim_pages(silver: DataFrame) -> DataFrame:
    return silver.groupBy("page").agg(F.count("*").alias("total_events"))


def fact_events(silver: DataFrame) -> DataFrame:
    return silver.select(*FACT_COLUMNS)


# --- daily KPIs ------------------------------------------------------------------------------


def kpi_dau(silver: DataFrame) -> DataFrame:
    return silver.groupBy("event_date").agg(F.countDistinct("user_id").alias("dau_count"))


def kpi_events_per_source(silver: DataFrame) -> DataFrame:
    return silver.groupBy("event_date", "source").agg(F.count("*").alias("event_count"))


def kpi_purchases_per_page(silver: DataFrame) -> DataFrame:
    return _purchases(silver).groupBy("event_date", "page").agg(F.count("*").alias("purchase_count"))


def kpi_revenue_daily(silver: DataFrame) -> DataFrame:
    return _purchases(silver).groupBy("event_date").agg(
        F.sum("price").alias("total_revenue"),
        F.count("*").alias("total_purchases"),
        _average_value(F.sum("price"), F.count("*")).alias("avg_order_value"),
    )


def kpi_category_sales(silver: DataFrame) -> DataFrame:
    return _purchases(silver).groupBy("event_date", "category").agg(
        F.count("*").alias("units_sold"), F.sum("price").alias("category_revenue")
    )


def kpi_conversion_rate(silver: DataFrame) -> DataFrame:
    """Buyers over active users. Both counts come from one per-user pass instead of a join."""
    per_user = silver.groupBy("event_date", "user_id").agg(
        F.max(is_purchase().cast("int")).alias("bought")
    )
    return _conversion(per_user)


def _conversion(per_user: DataFrame) -> DataFrame:
    return per_user.groupBy("event_date").agg(
        F.count("*").alias("dau_count"), F.sum("bought").alias("unique_buyers")
    ).withColumn("conversion_rate", _rate("unique_buyers", "dau_count"))


def join_buyers(dau: DataFrame, buyers: DataFrame) -> DataFrame:
    """Conversion from two already aggregated KPI tables: a day without buyers counts 0."""
    return (
        dau.join(buyers, "event_date", "left")
        .fillna(0, subset=["unique_buyers"])
        .withColumn("conversion_rate", _rate("unique_buyers", "dau_count"))
    )


def unique_buyers(silver: DataFrame) -> DataFrame:
    return _purchases(silver).groupBy("event_date").agg(F.countDistinct("user_id").alias("unique_buyers"))


def cart_sessions(silver: DataFrame, *extra: str) -> DataFrame:
    """Sessions with a cart-add and their purchases on the same date.

    This is cart sessions left-joined to purchase sessions on (date, session), written as one
    conditional aggregate: one shuffle, and a hot session is combined before it. A session that
    bought nothing has a NULL ``purchase_count``.
    """
    relevant = silver.filter(F.col("event_type").isin("add_to_cart", "purchase"))
    purchases = F.count_if(is_purchase())
    return (
        relevant.groupBy("event_date", "session_id", *extra)
        .agg(
            F.count_if(F.col("event_type") == "add_to_cart").alias("cart_add_count"),
            F.when(purchases > 0, purchases).alias("purchase_count"),
        )
        .filter("cart_add_count > 0")
    )


def abandonment(sessions: DataFrame, *keys: str) -> DataFrame:
    return sessions.groupBy(*keys).agg(
        F.count("*").alias("sessions_with_cart"),
        F.count_if(F.col("purchase_count").isNull()).alias("abandoned_carts"),
    ).withColumn("abandonment_rate", _rate("abandoned_carts", "sessions_with_cart"))


def kpi_cart_abandonment(silver: DataFrame) -> DataFrame:
    return abandonment(cart_sessions(silver), "event_date")


# --- rollups shared by one batch run ---------------------------------------------------------


def user_day(silver: DataFrame) -> DataFrame:
    """Events and purchases per (date, user, source): the only wide shuffle over all events."""
    return silver.groupBy("event_date", "user_id", "source").agg(
        F.count("*").alias("events"), F.count_if(is_purchase()).alias("purchases")
    )


def page_day(silver: DataFrame) -> DataFrame:
    """Events and purchases per (date, page): as many rows a day as there are pages."""
    return silver.groupBy("event_date", "page").agg(
        F.count("*").alias("events"), F.count_if(is_purchase()).alias("purchases")
    )


def dim_users_from_rollup(users: DataFrame) -> DataFrame:
    return users.groupBy("user_id").agg(
        F.sum("events").alias("total_events"), F.countDistinct("source").alias("source_count")
    )


def dau_from_rollup(users: DataFrame) -> DataFrame:
    return users.groupBy("event_date").agg(F.countDistinct("user_id").alias("dau_count"))


def events_per_source_from_rollup(users: DataFrame) -> DataFrame:
    return users.groupBy("event_date", "source").agg(F.sum("events").alias("event_count"))


def conversion_from_rollup(users: DataFrame) -> DataFrame:
    return _conversion(
        users.groupBy("event_date", "user_id").agg(
            F.max((F.col("purchases") > 0).cast("int")).alias("bought")
        )
    )


def dim_pages_from_rollup(pages: DataFrame) -> DataFrame:
    return pages.groupBy("page").agg(F.sum("events").alias("total_events"))


def purchases_per_page_from_rollup(pages: DataFrame) -> DataFrame:
    return pages.filter("purchases > 0").select(
        "event_date", "page", F.col("purchases").alias("purchase_count")
    )


def revenue_from_category_sales(sales: DataFrame) -> DataFrame:
    """Daily revenue from the category table: every silver purchase has a category."""
    return sales.groupBy("event_date").agg(
        F.sum("category_revenue").alias("total_revenue"),
        F.sum("units_sold").alias("total_purchases"),
        _average_value(F.sum("category_revenue"), F.sum("units_sold")).alias("avg_order_value"),
    )
