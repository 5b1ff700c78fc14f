"""Window metrics and the threshold detectors over them.

All detectors read one metrics row and are emitted by one ``explode``. A stream therefore keeps a
single aggregate with a single state store; a union of detector branches over a shared streaming
aggregate would keep one per branch and lose rows in append mode.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.config import DetectorConfig
from eventlake.functions.predicates import is_purchase
from eventlake.functions.text import percent, render, whole
from eventlake.functions.timerange import flat_window
from eventlake.schemas import ANOMALY_COLUMNS

# The texts of the alerts.
REVENUE_ZERO = "Revenue dropped to ZERO - possible payment system failure"
REVENUE_DROP = "Revenue dropped by {drop}% from baseline (${baseline} → ${revenue})"
TRAFFIC_SPIKE = (
    "Traffic SPIKE: {events} events (expected <{limit}). Possible bot attack or viral event."
)
TRAFFIC_DROP = (
    "Traffic DROP: {events} events (expected >{limit}). Possible system issue or producer failure."
)
CART_ABANDONMENT = (
    "Cart abandonment SPIKE: {rate}% (expected ~{expected}%). Possible checkout bug or payment "
    "issue. {carts} carts added, only {purchases} purchases."
)
CONVERSION_DROP = (
    "Conversion rate VERY LOW: {rate}% ({buyers} buyers / {users} users). Expected >{expected}%. "
    "Check purchase flow."
)
DATA_QUALITY = (
    "DATA QUALITY ISSUE: {rate}% of purchases missing price ({missing}/{purchases} purchases). "
    "Check producer or data pipeline."
)
CATEGORY_IMBALANCE = (
    "CATEGORY IMBALANCE: Electronics accounts for {rate}% of purchases ({electronics}/{purchases}). "
    "Expected distribution more balanced. Possible bot or unusual promotion."
)


# --- metrics ---------------------------------------------------------------------------------


def _additive_metrics() -> dict[str, Column]:
    bought = is_purchase()
    return {
        "total_events": F.count("*"),
        "total_revenue": F.sum(F.when(bought, F.col("price")).otherwise(0)),
        "purchase_count": F.count_if(bought),
        "cart_adds": F.count_if(F.col("event_type") == "add_to_cart"),
        "purchases_missing_price": F.count_if(bought & F.col("price").isNull()),
        "purchases_missing_category": F.count_if(bought & F.col("category").isNull()),
        "electronics_purchases": F.count_if(bought & (F.col("category") == "Electronics")),
        "fashion_purchases": F.count_if(bought & (F.col("category") == "Fashion")),
    }


METRIC_COLUMNS = (
    "window_start", "window_end", "total_events", "unique_users", "unique_sessions", "total_revenue",
    "purchase_count", "avg_purchase_price", "cart_adds", "buyers", "purchases_missing_price",
    "purchases_missing_category", "electronics_purchases", "fashion_purchases",
)


def window_metrics(events: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Metrics per tumbling window with approximate distinct counts (batch and stream)."""
    distinct = {
        "unique_users": F.approx_count_distinct("user_id"),
        "unique_sessions": F.approx_count_distinct("session_id"),
        "buyers": F.approx_count_distinct(F.when(is_purchase(), F.col("user_id"))),
        "avg_purchase_price": F.avg(F.when(is_purchase(), F.col("price"))),
    }
    aggregates = {**_additive_metrics(), **distinct}
    grouped = events.groupBy(F.window("event_timestamp", width))
    metrics = grouped.agg(*[column.alias(name) for name, column in aggregates.items()])
    return flat_window(metrics).select(*METRIC_COLUMNS)


def window_metrics_exact(events: DataFrame, width: str = "5 minutes") -> DataFrame:
    """The same columns with exact distinct counts (batch only).

    Events are first combined per (window, user, session). The three distinct counts, which make
    Spark expand its input, then run over that compact frame and not over the events.
    """
    additive = _additive_metrics()
    priced = F.when(is_purchase(), F.col("price"))
    visits = events.groupBy(F.window("event_timestamp", width), "user_id", "session_id").agg(
        *[column.alias(name) for name, column in additive.items()],
        F.sum(priced).alias("priced_sum"),
        F.count(priced).alias("priced_count"),
    )
    metrics = visits.groupBy("window").agg(
        *[F.sum(name).alias(name) for name in additive],
        F.countDistinct("user_id").alias("unique_users"),
        F.countDistinct("session_id").alias("unique_sessions"),
        F.countDistinct(F.when(F.col("purchase_count") > 0, F.col("user_id"))).alias("buyers"),
        F.try_divide(F.sum("priced_sum"), F.sum("priced_count")).alias("avg_purchase_price"),
    )
    return flat_window(metrics).select(*METRIC_COLUMNS)


def window_metrics_chained(events: DataFrame, width: str = "5 minutes") -> DataFrame:
    """The same columns with exact counts of users and buyers, also in a stream.

    A stream cannot count distinct values, but it can aggregate in steps: per visit, per user, per
    window. A session belongs to its user, so sessions are counted as pairs of both.
    """
    additive = [*_additive_metrics(), "priced_sum", "priced_count"]
    priced = F.when(is_purchase(), F.col("price"))
    sums = [F.sum(name).alias(name) for name in additive]
    visits = events.groupBy(F.window("event_timestamp", width), "user_id", "session_id").agg(
        *[column.alias(name) for name, column in _additive_metrics().items()],
        F.sum(priced).alias("priced_sum"),
        F.count(priced).alias("priced_count"),
    )
    users = visits.groupBy("window", "user_id").agg(*sums, F.count("session_id").alias("sessions"))
    metrics = users.groupBy("window").agg(
        *sums,
        F.count("user_id").alias("unique_users"),
        F.sum("sessions").alias("unique_sessions"),
        F.count_if((F.col("purchase_count") > 0) & F.col("user_id").isNotNull()).alias("buyers"),
    )
    average = F.try_divide(F.col("priced_sum"), F.col("priced_count")).alias("avg_purchase_price")
    flat = flat_window(metrics)
    return flat.select(*[average if c == "avg_purchase_price" else c for c in METRIC_COLUMNS])


def window_metrics_sketched(events: DataFrame, width: str = "5 minutes", precision: int = 14) -> DataFrame:
    """The same columns from one aggregate, with distinct counts from sketches (batch and stream).

    A sketch holds up to a few hundred values as they are, so small windows are counted exactly; beyond that the relative
    error is about 1.04 / sqrt(2 ** precision), 0.8 % here. Its state has a bound of 16 kB for each of three counts, whatever the load.
    """
    def distinct(value: Column) -> Column:
        return F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(value, precision)), F.lit(0))

    counts = {
        "unique_users": distinct(F.col("user_id")),
        "unique_sessions": distinct(F.col("session_id")),
        "buyers": distinct(F.when(is_purchase(), F.col("user_id"))),
        "avg_purchase_price": F.avg(F.when(is_purchase(), F.col("price"))),
    }
    grouped = events.groupBy(F.window("event_timestamp", width))
    metrics = grouped.agg(*[column.alias(name) for name, column in {**_additive_metrics(), **counts}.items()])
    return flat_window(metrics).select(*METRIC_COLUMNS)


def fill_empty_windows(metrics: DataFrame, start: Column, end: Column, width: str) -> DataFrame:
    """Add a zero row for each window in ``[start, end)`` without events (batch only).

    A window without events makes no metrics row, so silence would never alert. The spine holds
    one row per window of the period, made by ``sequence``, and is joined on the window start.
    """
    step = F.expr(f"INTERVAL {width}")
    spine = (
        metrics.sparkSession.range(1)
        .select(F.explode(F.sequence(start, end - step, step)).alias("window_start"))
        .withColumn("window_end", F.col("window_start") + step)
    )
    filled = spine.join(metrics.drop("window_end"), "window_start", "left")
    zero = [c for c in METRIC_COLUMNS if c not in ("window_start", "window_end", "avg_purchase_price")]
    # A window that has rows keeps its NULL revenue; only missing windows get zeros.
    missing = F.col("total_events").isNull()
    return filled.select(
        "window_start",
        "window_end",
        *[F.when(missing, 0).otherwise(F.col(c)).alias(c) if c in zero else F.col(c)
          for c in METRIC_COLUMNS[2:]],
    )


# --- detectors -------------------------------------------------------------------------------


def _ladder(*steps: tuple[Column, str], otherwise: str) -> Column:
    """First matching step wins."""
    result = None
    for condition, severity in steps:
        result = F.when(condition, severity) if result is None else result.when(condition, severity)
    return F.lit(otherwise) if result is None else result.otherwise(otherwise)


def _finding(
    fires: Column, kind: Column | str, severity: Column | str, description: Column,
    metric: Column, expected: Column | str,
) -> Column:
    """A finding struct where the detector fires, else NULL."""
    as_column = lambda value: F.lit(value) if isinstance(value, str) else value
    return F.when(
        fires,
        F.struct(
            as_column(kind).alias("anomaly_type"),
            as_column(severity).alias("severity"),
            description.alias("description"),
            metric.cast("string").alias("metric_value"),
            as_column(expected).alias("expected_value"),
        ),
    )


def revenue_drop(cfg: DetectorConfig) -> Column:
    revenue = F.col("total_revenue")
    change = (revenue - cfg.revenue_baseline) / F.lit(cfg.revenue_baseline + 0.01)
    text = F.when(revenue == 0, REVENUE_ZERO).otherwise(
        render(
            REVENUE_DROP,
            drop=whole(change * -100),
            baseline=F.lit(int(cfg.revenue_baseline)),
            revenue=whole(revenue),
        )
    )
    severity = _ladder(
        (change < -cfg.revenue_drop_critical, "critical"),
        (change < -cfg.revenue_drop_high, "high"),
        otherwise="medium",
    )
    return _finding(
        change < -cfg.revenue_drop, "revenue_drop", severity, text, revenue, str(cfg.revenue_baseline)
    )


def traffic(cfg: DetectorConfig) -> Column:
    events = F.col("total_events")
    high = events > cfg.traffic_max
    severity = _ladder(
        (events < cfg.traffic_low_critical, "critical"),
        (events > cfg.traffic_peak_critical, "critical"),
        (events < cfg.traffic_low_high, "high"),
        (events > cfg.traffic_peak_high, "high"),
        otherwise="medium",
    )
    text = F.when(high, render(TRAFFIC_SPIKE, events=events, limit=F.lit(cfg.traffic_max))).otherwise(
        render(TRAFFIC_DROP, events=events, limit=F.lit(cfg.traffic_min))
    )
    return _finding(
        (events < cfg.traffic_min) | high,
        F.when(high, "traffic_spike").otherwise("traffic_drop"),
        severity,
        text,
        events,
        F.when(high, f"<{cfg.traffic_max}").otherwise(f">{cfg.traffic_min}"),
    )


def cart_abandonment(cfg: DetectorConfig) -> Column:
    carts, purchases = F.col("cart_adds"), F.col("purchase_count")
    rate = F.coalesce(1 - F.try_divide(purchases, carts), F.lit(0.0))
    expected = int(cfg.abandonment_expected * 100)
    severity = _ladder(
        (rate > cfg.abandonment_critical, "critical"),
        (rate > cfg.abandonment_high, "high"),
        otherwise="medium",
    )
    text = render(
        CART_ABANDONMENT, rate=percent(rate), expected=F.lit(expected), carts=carts, purchases=purchases
    )
    fires = (carts > cfg.cart_min_adds) & (rate > cfg.abandonment_max)
    return _finding(fires, "cart_abandonment_spike", severity, text, rate * 100, f"{expected}%")


def conversion_drop(cfg: DetectorConfig) -> Column:
    users, buyers = F.col("unique_users"), F.col("buyers")
    rate = F.coalesce(F.try_divide(buyers, users), F.lit(0.0))
    expected = round(cfg.conversion_min * 100, 6)
    severity = _ladder(
        (rate < cfg.conversion_critical, "critical"),
        (rate < cfg.conversion_high, "high"),
        otherwise="medium",
    )
    text = render(
        CONVERSION_DROP,
        rate=(rate * 100).try_cast("decimal(5,2)"),
        buyers=buyers,
        users=users,
        expected=F.lit(f"{expected:g}"),
    )
    fires = (users > cfg.conversion_min_users) & (rate < cfg.conversion_min)
    return _finding(fires, "conversion_drop", severity, text, rate * 100, str(expected))


def data_quality(cfg: DetectorConfig) -> Column:
    """Purchases without a price. Missing categories are counted in the metrics but not tested."""
    missing, purchases = F.col("purchases_missing_price"), F.col("purchase_count")
    share = F.try_divide(missing, purchases)
    severity = _ladder(
        (share > cfg.missing_price_critical, "critical"),
        (share > cfg.missing_price_high, "high"),
        otherwise="medium",
    )
    text = render(DATA_QUALITY, rate=percent(share), missing=missing, purchases=purchases)
    fires = (purchases > 0) & (share > cfg.missing_price)
    return _finding(fires, "data_quality", severity, text, missing, "0")


def category_imbalance(cfg: DetectorConfig) -> Column:
    """Only Electronics is tested, always at low severity."""
    electronics, purchases = F.col("electronics_purchases"), F.col("purchase_count")
    share = F.try_divide(electronics, purchases)
    text = render(
        CATEGORY_IMBALANCE, rate=percent(share), electronics=electronics, purchases=purchases
    )
    fires = (purchases > cfg.category_min_purchases) & (share > cfg.category_dominance)
    return _finding(
        fires, "category_imbalance", "low", text, share * 100, str(cfg.category_expected_pct)
    )


DETECTORS: dict[str, Callable[[DetectorConfig], Column]] = {
    "revenue_drop": revenue_drop,
    "traffic": traffic,
    "cart_abandonment": cart_abandonment,
    "conversion_drop": conversion_drop,
    "data_quality": data_quality,
    "category_imbalance": category_imbalance,
}


def detect(
    metrics: DataFrame, cfg: DetectorConfig = DetectorConfig(), only: tuple[str, ...] | None = None
) -> DataFrame:
    """Findings of all detectors (or of those named in ``only``), one row each."""
    names = DETECTORS if only is None else only
    findings = F.array(*[DETECTORS[name](cfg) for name in names])
    fired = F.filter(findings, lambda finding: finding.isNotNull())
    return metrics.select("window_start", F.explode(fired).alias("finding")).select(
        "window_start", "finding.*"
    ).select(*ANOMALY_COLUMNS)


def detect_anomalies(events: DataFrame, cfg: DetectorConfig = DetectorConfig()) -> DataFrame:
    return detect(window_metrics(events, cfg.width), cfg)


def detect_exactly(events: DataFrame, cfg: DetectorConfig = DetectorConfig()) -> DataFrame:
    """Findings that rest on exact counts, in batch and stream."""
    return detect(window_metrics_chained(events, cfg.width), cfg)


def detect_sketched(events: DataFrame, cfg: DetectorConfig = DetectorConfig()) -> DataFrame:
    """Findings from one aggregate. Only the conversion rate rests on distinct counts; where it is further from a threshold than
    the error of a sketch, the findings are those of :func:`detect_exactly`."""
    return detect(window_metrics_sketched(events, cfg.width), cfg)


def log_entries(anomalies: DataFrame, detected_at: Column) -> DataFrame:
    """Rows of the anomaly log: a fresh finding is not acknowledged yet."""
    return anomalies.select(
        *ANOMALY_COLUMNS,
        detected_at.alias("detected_at"),
        F.lit(0).alias("acknowledged"),
        F.lit(None).cast("timestamp").alias("acknowledged_at"),
        F.lit(None).cast("string").alias("acknowledged_by"),
    )


# --- summaries -------------------------------------------------------------------------------


def anomaly_summary(log: DataFrame) -> DataFrame:
    return log.groupBy(
        F.to_date("detected_at").alias("anomaly_date"), "severity", "anomaly_type"
    ).agg(F.count("*").alias("anomaly_count"))


def merge_summaries(parts: DataFrame) -> DataFrame:
    """Sum the per-batch summaries of an incrementally kept table."""
    return parts.groupBy("anomaly_date", "severity", "anomaly_type").agg(
        F.sum("anomaly_count").alias("anomaly_count")
    )
