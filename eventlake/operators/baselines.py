"""Statistics of window metrics and the detectors that compare a window with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.config import BaselineConfig
from eventlake.operators.timeline import over_previous_rows, over_trailing_range

# Metrics a baseline is kept for.
BASELINE_METRICS = (
    "total_events", "unique_users", "unique_sessions", "total_revenue", "purchase_count",
    "avg_purchase_price", "cart_adds", "buyers",
)


def anomaly_baselines(
    metrics: DataFrame, window_size: str, names: tuple[str, ...] = BASELINE_METRICS
) -> DataFrame:
    """Average, spread, range and 95th percentile per metric, for one window size."""
    pairs = ", ".join(f"'{name}', CAST({name} AS DOUBLE)" for name in names)
    values = metrics.selectExpr(f"stack({len(names)}, {pairs}) AS (metric_name, value)")
    return values.groupBy("metric_name").agg(
        F.lit(window_size).alias("window_size"),
        F.avg("value").alias("avg_value"),
        F.stddev("value").alias("stddev_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.percentile_approx("value", 0.95).alias("percentile_95"),
        F.count("value").alias("sample_count"),
    )


#: Size parameter of the quantile sketches, and the error of a rank at that size (normalised, with 99 % confidence).
SKETCH_SIZE, RANK_ERROR = 400, 0.008


def daily_baselines(metrics: DataFrame, names: tuple[str, ...] = BASELINE_METRICS) -> DataFrame:
    """What a baseline needs of a day: per metric the number, mean and squared deviations of its values, their range and a quantile sketch.

    Rows of days can be merged in any order (:func:`merged_baselines`), so a day is written once and no value is read again.
    """
    pairs = ", ".join(f"'{name}', CAST({name} AS DOUBLE)" for name in names)
    values = metrics.selectExpr("to_date(window_start) AS event_date", f"stack({len(names)}, {pairs}) AS (metric_name, value)")
    return values.where("value IS NOT NULL").groupBy("event_date", "metric_name").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        (F.var_pop("value") * F.count("value")).alias("m2"),
        F.min("value").alias("least"),
        F.max("value").alias("greatest"),
        F.kll_sketch_agg_double("value", SKETCH_SIZE).alias("sketch"),
    )


def merged_baselines(days: DataFrame, window_size: str) -> DataFrame:
    """The rows of :func:`anomaly_baselines` from stored days. The 95th percentile is that of the merged sketches: its rank is
    right up to `RANK_ERROR`; all else is exact.

    Squared deviations add up with those of the days' means from the mean of all, which keeps them small numbers.
    """
    total = days.groupBy("metric_name").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    apart = F.col("n") * (F.col("mean") - F.col("_mean")) * (F.col("mean") - F.col("_mean"))
    merged = days.join(total, "metric_name").groupBy("metric_name").agg(
        F.max("_mean").alias("avg_value"),
        F.sqrt(F.try_divide(F.sum(F.col("m2") + apart), F.nullif(F.sum("n") - 1, F.lit(0)))).alias("stddev_value"),
        F.min("least").alias("min_value"),
        F.max("greatest").alias("max_value"),
        F.kll_sketch_get_quantile_double(F.kll_merge_agg_double("sketch", SKETCH_SIZE), F.lit(0.95)).alias("percentile_95"),
        F.sum("n").alias("sample_count"),
    )
    return merged.withColumn("window_size", F.lit(window_size))


def abandonment_rate() -> Column:
    """Share of cart-adds without a purchase in the same window; 0 without cart-adds."""
    return F.coalesce(1 - F.try_divide(F.col("purchase_count"), F.col("cart_adds")), F.lit(0.0))


def rolling_baseline(
    metrics: DataFrame, names: tuple[str, ...], windows: int = 12, block: int = 100_000
) -> DataFrame:
    """Mean, spread, min and max of each metric over the windows before the current one."""
    measures = {}
    for name in names:
        measures[f"{name}_mean"] = lambda w, n=name: F.avg(n).over(w)
        measures[f"{name}_std"] = lambda w, n=name: F.stddev(n).over(w)
        measures[f"{name}_min"] = lambda w, n=name: F.min(n).over(w)
        measures[f"{name}_max"] = lambda w, n=name: F.max(n).over(w)
    measures["baseline_windows"] = lambda w: F.count(F.lit(1)).over(w)
    return over_previous_rows(metrics, "window_start", windows, measures, block)


def _grade(amount: Column, steps: tuple[float, float, float]) -> Column:
    medium, high, critical = steps
    return (
        F.when(amount > critical, "critical").when(amount > high, "high").when(amount > medium, "medium")
    )


#: What the rolling baseline is kept of.
BASELINE_CHECKS = ("total_events", "total_revenue", "abandonment")


def baseline_anomalies(metrics: DataFrame, cfg: BaselineConfig = BaselineConfig()) -> DataFrame:
    """Windows that leave their rolling baseline: traffic, abandonment and revenue.

    A window is judged once a full baseline lies before it. A baseline without spread has no
    z-score and raises no z-score alert.
    """
    frame = metrics.select(
        "window_start", "total_events", "total_revenue", "cart_adds", abandonment_rate().alias("abandonment")
    )
    return judge_baselines(rolling_baseline(frame, BASELINE_CHECKS, cfg.windows), cfg)


def judge_baselines(timeline: DataFrame, cfg: BaselineConfig = BaselineConfig()) -> DataFrame:
    """The findings of windows that carry their baseline, in batch and stream."""
    based = timeline.filter(F.col("baseline_windows") == cfg.windows)

    def score(name: str) -> Column:
        return F.try_divide(F.col(name) - F.col(f"{name}_mean"), F.nullif(F.col(f"{name}_std"), F.lit(0.0)))

    traffic, abandonment = score("total_events"), score("abandonment")
    drop = -F.try_divide(F.col("total_revenue") - F.col("total_revenue_mean"), F.col("total_revenue_mean"))
    checks = [
        (
            F.when(traffic > 0, "traffic_spike").otherwise("traffic_drop"),
            _grade(F.abs(traffic), cfg.traffic_sigma),
            F.col("total_events").cast("double"), F.col("total_events_mean"), traffic,
        ),
        (
            F.lit("cart_abandonment_spike"),
            F.when(
                (abandonment > cfg.abandonment_sigma) & (F.col("abandonment") > cfg.abandonment_rate),
                F.when(F.col("abandonment") > 0.9, "critical")
                .when(F.col("abandonment") > 0.8, "high")
                .otherwise("medium"),
            ),
            F.col("abandonment"), F.col("abandonment_mean"), abandonment,
        ),
        (
            F.lit("revenue_drop"), _grade(drop, cfg.revenue_drop),
            F.col("total_revenue"), F.col("total_revenue_mean"), -drop,
        ),
    ]
    found = F.array(
        *[
            F.when(
                severity.isNotNull(),
                F.struct(
                    kind.alias("anomaly_type"), severity.alias("severity"), value.alias("value"),
                    mean.alias("baseline"), deviation.alias("deviation"),
                ),
            )
            for kind, severity, value, mean, deviation in checks
        ]
    )
    fired = F.filter(found, lambda f: f.isNotNull())
    return based.select("window_start", F.explode(fired).alias("f")).select("window_start", "f.*")


def minute_features(events: DataFrame, width: str = "1 minute") -> DataFrame:
    """Per-window features for the z-score detector."""
    bought = F.col("event_type") == "purchase"
    rows = events.groupBy(F.window("event_timestamp", width)).agg(
        F.count("*").alias("events_per_minute"),
        F.sum(F.when(bought, F.col("price")).otherwise(0)).alias("revenue_per_minute"),
        F.avg("price").alias("avg_price"),
        F.count_if(F.col("event_type") == "add_to_cart").alias("cart_adds"),
        F.count_if(bought).alias("purchases_per_minute"),
        F.approx_count_distinct("user_id").alias("unique_users_per_minute"),
    )
    return rows.select(
        F.col("window.start").alias("window_start"),
        *[c for c in rows.columns if c != "window"],
        (1 - F.col("purchases_per_minute") / (F.col("cart_adds") + 1)).alias("cart_abandonment_rate"),
    )


FEATURES = (
    "events_per_minute", "revenue_per_minute", "avg_price", "cart_abandonment_rate",
    "purchases_per_minute", "unique_users_per_minute",
)


def zscore_flags(
    features: DataFrame, names: tuple[str, ...] = FEATURES, limit: float = 3.0
) -> DataFrame:
    """Flag each feature that lies more than ``limit`` deviations from its mean.

    All means and deviations come from one aggregate, read back as one scalar subquery.
    """
    stats = features.agg(
        F.struct(
            *[F.avg(n).alias(f"{n}_mean") for n in names],
            *[F.stddev(n).alias(f"{n}_std") for n in names],
        ).alias("stats")
    ).scalar()
    scored = features.withColumn("_stats", stats)
    scores = {
        n: (F.col(n) - F.col(f"_stats.{n}_mean")) / (F.col(f"_stats.{n}_std") + 0.0001) for n in names
    }
    flagged = scored.select(
        *features.columns,
        *[z.alias(f"{n}_zscore") for n, z in scores.items()],
        *[F.when(F.abs(z) > limit, 1).otherwise(0).alias(f"{n}_anomaly") for n, z in scores.items()],
    )
    return flagged.withColumn("is_anomaly", F.greatest(*[F.col(f"{n}_anomaly") for n in names]) > 0)


def revenue_below_daily_average(
    revenue_per_minute: DataFrame, drop: float = 0.20, lookback_seconds: int = 86_400
) -> DataFrame:
    """Minutes whose revenue lies more than ``drop`` under the average of the 24 hours before."""
    based = over_trailing_range(
        revenue_per_minute.select("window_start", "revenue"),
        [],
        "window_start",
        lookback_seconds,
        {"average_24h": lambda w: F.avg("revenue").over(w)},
        include_current=False,
    )
    return based.filter(F.col("revenue") < (1 - drop) * F.col("average_24h"))
