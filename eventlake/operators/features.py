"""Feature frames for the models, as ordinary aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventlake.functions.predicates import is_purchase
from eventlake.schemas import CATEGORIES


def user_features(silver: DataFrame) -> DataFrame:
    """Purchase frequency, average order value and category shares of each buyer."""
    bought = silver.filter(is_purchase())
    counts = bought.groupBy("user_id").agg(
        F.count("*").alias("purchases"),
        F.avg("price").alias("avg_order_value"),
        *[F.count_if(F.col("category") == c).alias(c) for c in CATEGORIES],
    )
    shares = [(F.col(c) / F.col("purchases")).alias(f"share_{c.lower()}") for c in CATEGORIES]
    return counts.select("user_id", "purchases", "avg_order_value", *shares)


def purchase_counts(silver: DataFrame) -> DataFrame:
    """How often each user bought each product: the implicit rating."""
    return (
        silver.filter(is_purchase())
        .groupBy("user_id", "product_id")
        .agg(F.count("*").alias("purchases"))
    )


def dense_ids(df: DataFrame, column: str, name: str, buckets: int = 1024) -> DataFrame:
    """Number the distinct values of a column 0..n-1 without one task that sees them all.

    Values are ranked inside hash buckets; the offset of a bucket is a running sum over as many
    rows as there are buckets.
    """
    values = df.select(column).distinct().withColumn("_b", F.pmod(F.xxhash64(column), F.lit(buckets)))
    sizes = values.groupBy("_b").agg(F.count("*").alias("_n"))
    earlier = W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_b", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    rank = F.row_number().over(W.partitionBy("_b").orderBy(column)) - 1
    return (
        values.join(F.broadcast(offsets), "_b")  # at most ``buckets`` rows
        .select(column, (F.col("_offset") + rank).cast("int").alias(name))
    )


def session_features(session_rows: DataFrame) -> DataFrame:
    """What a session looked like apart from its purchases, and whether it bought."""
    return session_rows.select(
        "user_id",
        "session_start",
        (F.col("events") - F.col("purchases")).alias("other_events"),
        "views",
        "cart_adds",
        "duration_seconds",
        (F.col("purchases") > 0).cast("int").alias("converted"),
    )


def revenue_forecast(category_sales: DataFrame, as_of_date: Column, days: int = 7) -> DataFrame:
    """Linear trend of daily revenue per category, continued for some days, with bounds.

    The days of a category run from its first sale to the day before ``as_of_date``; a day without
    sales counts as 0, and the running day is left out. The fit is five moments per category from one aggregate; the
    bounds are two residual standard errors around the trend.
    """
    past = category_sales.select("category", "event_date", "category_revenue").filter(F.col("event_date") < as_of_date)
    days_of = F.explode(F.sequence("first", F.date_sub(as_of_date, 1))).alias("event_date")
    spine = past.groupBy("category").agg(F.min("event_date").alias("first")).select("category", days_of)
    history = spine.join(past, ["category", "event_date"], "left").select(
        "category", F.coalesce("category_revenue", F.lit(0.0)).alias("category_revenue"),
        F.datediff(F.col("event_date"), as_of_date).alias("x"),
    )
    x, y = F.col("x"), F.col("category_revenue")
    fits = history.groupBy("category").agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_syy(y, x).alias("syy"),
        F.regr_sxy(y, x).alias("sxy"),
        F.regr_sxx(y, x).alias("sxx"),
        F.regr_count(y, x).alias("n"),
    )
    residual = F.greatest(F.col("syy") - F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx")), F.lit(0.0))
    error = F.sqrt(F.try_divide(residual, F.when(F.col("n") > 2, F.col("n") - 2)))
    ahead = F.explode(F.sequence(F.lit(1), F.lit(days))).alias("ahead")
    predicted = F.col("intercept") + F.col("slope") * F.col("ahead")
    return fits.select("*", error.alias("error"), ahead).select(
        "category",
        F.date_add(as_of_date, F.col("ahead")).alias("forecast_date"),
        predicted.alias("predicted_revenue"),
        (predicted - 2 * F.col("error")).alias("lower_bound"),
        (predicted + 2 * F.col("error")).alias("upper_bound"),
    )
