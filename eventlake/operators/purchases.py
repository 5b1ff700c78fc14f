"""Suspicious purchases: many in a short time, or an abnormal price."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.predicates import is_purchase
from eventlake.operators.timeline import over_trailing_range


def purchase_bursts(
    silver: DataFrame, lookback_seconds: int = 600, min_purchases: int = 3
) -> DataFrame:
    """Instants at which a user reached ``min_purchases`` purchases within the lookback."""
    instants = (
        silver.filter(is_purchase())
        .groupBy("user_id", "event_timestamp")
        .agg(F.count("*").alias("purchases"))
    )
    counted = over_trailing_range(
        instants,
        ["user_id"],
        "event_timestamp",
        lookback_seconds,
        {"recent_purchases": lambda w: F.sum("purchases").over(w)},
    )
    return counted.filter(F.col("recent_purchases") >= min_purchases).select(
        "user_id", "event_timestamp", "recent_purchases"
    )


def abnormal_prices(silver: DataFrame, sigma: float = 3.0) -> DataFrame:
    """Purchases priced more than ``sigma`` deviations from the mean of their category."""
    bought = silver.filter(is_purchase())
    stats = bought.groupBy("category").agg(
        F.avg("price").alias("mean_price"), F.stddev("price").alias("std_price")
    )
    score = F.try_divide(F.col("price") - F.col("mean_price"), F.nullif(F.col("std_price"), F.lit(0.0)))
    return (
        bought.select("event_id", "user_id", "category", "price")
        .join(stats, "category")
        .withColumn("price_zscore", score)
        .filter(F.abs("price_zscore") > sigma)
        .select("event_id", "user_id", "category", "price", "price_zscore")
    )
