"""Frames over the stateful processors: streaming forms of the window timeline, of sessions and of alert suppression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.config import AlertConfig, BaselineConfig, DetectorConfig, SessionConfig
from eventlake.operators.anomalies import METRIC_COLUMNS, detect, window_metrics_chained, window_metrics_sketched
from eventlake.operators.baselines import BASELINE_CHECKS, abandonment_rate, judge_baselines
from eventlake.operators.sessions import ACTIVITY, instants
from eventlake.schemas import ANOMALY_COLUMNS
from eventlake.streaming.processors import FirstAlerts, LogoutSessions, WindowTimeline

_UNITS = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400}
_DOUBLES = ("total_revenue", "avg_purchase_price")


def span_micros(text: str) -> int:
    """Microseconds of a span like `5 minutes`."""
    number, unit = text.strip().split()
    return int(number) * _UNITS[unit.rstrip("s")] * 1_000_000


def _instant(column: str) -> Column:
    return F.timestamp_micros(F.col(column))


def window_timeline(events: DataFrame, width: str, windows: int = BaselineConfig.windows, exact: bool = False) -> DataFrame:
    """Each closed window of a marked stream in order, with its metrics and the baseline before it; silent windows are zero rows.

    One timeline is one key: a row per window, whatever the load.
    """
    metrics = (window_metrics_chained if exact else window_metrics_sketched)(events, width)
    kinds = {c: "double" if c in _DOUBLES else "bigint" for c in METRIC_COLUMNS[2:]}
    silent = {c: None if c == "avg_purchase_price" else 0.0 if kind == "double" else 0 for c, kind in kinds.items()}
    rows = metrics.select(
        F.lit(0).alias("timeline"), F.unix_micros(F.col("window_start").cast("timestamp")).alias("start"),
        *[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()], abandonment_rate().alias("abandonment"),
    )
    based = "".join(f", {m}_{part} double" for m in BASELINE_CHECKS for part in ("mean", "std", "min", "max"))
    fields = ", ".join(f"{c} {kind}" for c, kind in kinds.items())
    step = span_micros(width)
    processor = WindowTimeline({**silent, "abandonment": 0.0}, BASELINE_CHECKS, step, windows)
    out = rows.groupBy("timeline").transformWithState(
        processor, f"start bigint, {fields}, abandonment double, baseline_windows bigint{based}", "Append", "EventTime"
    )
    return out.select(_instant("start").alias("window_start"), F.timestamp_micros(F.col("start") + step).alias("window_end"), *out.columns[1:])


def timeline_findings(
    timeline: DataFrame, detector: DetectorConfig = DetectorConfig(), baseline: BaselineConfig = BaselineConfig()
) -> tuple[DataFrame, DataFrame]:
    """Findings of the thresholds, which hear silence here, and of the rolling baseline. Two readers of one timeline keep a
    state each; a stream takes one of them, or both in a `foreachBatch`."""
    return detect(timeline, detector), judge_baselines(timeline, baseline)


def logout_sessions(events: DataFrame, cfg: SessionConfig = SessionConfig()) -> DataFrame:
    """Closed sessions of a marked stream by the rule of :func:`eventlake.operators.sessions.sessions`."""
    rows = instants(events).select(
        "user_id", F.unix_micros("event_timestamp").alias("at"), *[c for c in ACTIVITY if c != "revenue"],
        F.col("revenue").cast("double").alias("revenue"), "logout",
    )
    kind = dict(events.dtypes)["user_id"]
    counts = ", ".join(f"{c} bigint" for c in LogoutSessions.SUMS)
    out = rows.groupBy("user_id").transformWithState(
        LogoutSessions(span_micros(cfg.gap)),
        f"user_id {kind}, first bigint, last bigint, {counts}, revenue double, logged_out boolean", "Append", "EventTime",
    )
    return out.select(
        "user_id", _instant("first").alias("session_start"), _instant("last").alias("session_end"), *ACTIVITY, "logged_out",
        ((F.col("last") - F.col("first")) / 1_000_000).alias("duration_seconds"),
    )


def marked_alerts(findings: DataFrame, cfg: AlertConfig = AlertConfig()) -> DataFrame:
    """Findings of a stream with `is_first`: whether they are severe enough for a message and none of their type was sent
    within the de-duplication span before."""
    carried = tuple(c for c in ANOMALY_COLUMNS if c != "window_start")
    rows = findings.select(F.unix_micros(F.col("window_start").cast("timestamp")).alias("at"), *[F.col(c).cast("string").alias(c) for c in carried])
    fields = ", ".join(f"{c} string" for c in carried)
    out = rows.groupBy("anomaly_type").transformWithState(
        FirstAlerts(span_micros(cfg.dedup_window), cfg.severities, carried), f"at bigint, {fields}, is_first boolean", "Append", "EventTime"
    )
    return out.select(_instant("at").alias("window_start"), *carried, "is_first").select(*ANOMALY_COLUMNS, "is_first")
