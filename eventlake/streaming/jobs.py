"""The streaming queries of the speed layer and of the bronze landing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from eventlake.config import AlertConfig, BaselineConfig, DetectorConfig, SessionConfig, StreamConfig
from eventlake.functions.parsing import parse_events
from eventlake.operators import realtime
from eventlake.operators.anomalies import detect_exactly, detect_sketched, log_entries
from eventlake.operators.realtime import with_watermark
from eventlake.operators.sessions import session_windows
from eventlake.operators.silver import dedupe_stream
from eventlake.streaming.sinks import anomaly_writer, realtime_writer, run_id, write_log, write_realtime
from eventlake.streaming.stateful import logout_sessions, marked_alerts, timeline_findings, window_timeline

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, cfg: StreamConfig = StreamConfig()) -> SparkSession:
    """Session for stateful queries; batch settings of the caller stay as they are.

    State lives in RocksDB with changelog checkpoints, so its size is not bound to the heap and a
    lost executor reloads only what changed.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.shuffle.partitions", str(cfg.state_partitions))
    session.conf.set("spark.sql.sessionWindow.merge.sessions.in.local.partition", "true")
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return session


def _trigger(writer: DataStreamWriter, every: str | None, available_now: bool) -> DataStreamWriter:
    """Catch up once and stop, or run on an interval; without one, as fast as possible."""
    if available_now:
        return writer.trigger(availableNow=True)
    return writer if every is None else writer.trigger(processingTime=every)


def land_bronze(
    raw: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", available_now: bool = False
) -> StreamingQuery:
    """Raw records to the date-partitioned bronze table. No watermark: late events are kept."""
    writer = (
        parse_events(raw)
        .writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy("event_date")
    )
    return _trigger(writer, None, available_now).start(path)


def _start_upserts(
    rows: DataFrame, name: str, root: str, checkpoints: str, cfg: StreamConfig, available_now: bool
) -> StreamingQuery:
    writer = (
        rows.writeStream.outputMode("update")
        .foreachBatch(realtime_writer(f"{root}/{name}", run_id(rows.sparkSession, f"{checkpoints}/{name}")))
        .option("checkpointLocation", f"{checkpoints}/{name}")
        .queryName(name)
    )
    return _trigger(writer, cfg.trigger, available_now).start()


MINUTE_TABLES: dict[str, Callable[..., DataFrame]] = {
    "events_per_minute": realtime.events_per_minute,
    "revenue_per_minute": realtime.revenue_per_minute,
    "purchases_per_minute": realtime.purchases_per_minute,
    "category_velocity": realtime.category_velocity,
}


def start_fast_aggregates(
    events: DataFrame, root: str, checkpoints: str, cfg: StreamConfig = StreamConfig(),
    available_now: bool = False,
) -> dict[str, StreamingQuery]:
    """One query and one checkpoint per minute table, as independent tables need it.

    Each query reads the stream for itself. Where one reader is wanted, use
    :func:`start_minute_cube`, which serves all of them from one state.
    """
    marked = with_watermark(events, cfg.fast_watermark)
    return {
        name: _start_upserts(build(marked, cfg.minute), name, root, checkpoints, cfg, available_now)
        for name, build in MINUTE_TABLES.items()
    }


def start_minute_cube(
    events: DataFrame, root: str, checkpoints: str, cfg: StreamConfig = StreamConfig(),
    available_now: bool = False,
) -> StreamingQuery:
    """All minute tables from one read of the stream and one state store."""
    marked = with_watermark(events, cfg.fast_watermark)
    cube = realtime.minute_cube(marked, cfg.minute)
    return _start_upserts(cube, "minute_cube", root, checkpoints, cfg, available_now)


def start_anomaly_detector(
    events: DataFrame, log_path: str, checkpoint: str, alert_path: str | None = None,
    detector: DetectorConfig = DetectorConfig(), cfg: StreamConfig = StreamConfig(),
    alerts: AlertConfig = AlertConfig(), available_now: bool = False, exact: bool = False, suppress: bool = False,
    summary_path: str | None = None,
) -> StreamingQuery:
    """Findings per closed window. Append mode: a window speaks once, after the watermark.

    Users and sessions are counted by sketches in one state store; ``exact`` counts them in three chained ones. With
    ``suppress`` a message is sent only if none of its type was sent within the de-duplication span before.
    """
    detect = detect_exactly if exact else detect_sketched
    findings = detect(with_watermark(events, cfg.anomaly_watermark), detector)
    if suppress:
        findings = marked_alerts(findings, alerts)
    writer = (
        findings.writeStream.outputMode("append")
        .foreachBatch(anomaly_writer(log_path, alert_path, alerts, run_id(events.sparkSession, checkpoint), summary_path))
        .option("checkpointLocation", checkpoint)
        .queryName("anomaly_detector")
    )
    return _trigger(writer, cfg.trigger, available_now).start()


def start_baseline_detector(
    events: DataFrame, root: str, checkpoint: str, detector: DetectorConfig = DetectorConfig(),
    baseline: BaselineConfig = BaselineConfig(), cfg: StreamConfig = StreamConfig(), available_now: bool = False, exact: bool = False,
) -> StreamingQuery:
    """The timeline of closed windows, silent ones included, with the findings of the thresholds (`anomalies`) and of the rolling
    baseline (`deviations`) over it, each batch under its run."""
    run = run_id(events.sparkSession, checkpoint)

    def write(df: DataFrame, batch_id: int) -> None:
        windows = df.persist()
        try:
            write_realtime(windows, batch_id, f"{root}/timeline", run)
            fired, deviations = timeline_findings(windows, detector, baseline)
            write_log(log_entries(fired, F.current_timestamp()), batch_id, f"{root}/anomalies", run)
            write_realtime(deviations, batch_id, f"{root}/deviations", run)
        finally:
            windows.unpersist()

    timeline = window_timeline(with_watermark(events, cfg.anomaly_watermark), detector.width, baseline.windows, exact)
    writer = (
        timeline.writeStream.outputMode("append").foreachBatch(write)
        .option("checkpointLocation", checkpoint).queryName("baseline_detector")
    )
    return _trigger(writer, cfg.trigger, available_now).start()


def start_logout_sessions(
    events: DataFrame, path: str, checkpoint: str, sessions: SessionConfig = SessionConfig(), available_now: bool = False,
    cfg: StreamConfig = StreamConfig(),
) -> StreamingQuery:
    """Closed sessions per user, which end with a logout or after a gap. Repeats of an event are dropped first."""
    unique = dedupe_stream(events.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp")), cfg.anomaly_watermark)
    return _start_append(logout_sessions(unique, sessions), path, checkpoint, cfg, available_now)


def start_dedupe(
    events: DataFrame, path: str, checkpoint: str, delay: str = "10 minutes", available_now: bool = False,
    cfg: StreamConfig = StreamConfig(),
) -> StreamingQuery:
    """Events without the repeats that arrive within ``delay`` of each other."""
    unique = dedupe_stream(events.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp")), delay)
    return _start_append(unique, path, checkpoint, cfg, available_now)


def start_session_windows(
    events: DataFrame, path: str, checkpoint: str, gap: str = "30 minutes", available_now: bool = False,
    cfg: StreamConfig = StreamConfig(),
) -> StreamingQuery:
    """Closed gap sessions per user."""
    rows = session_windows(with_watermark(events, cfg.anomaly_watermark), gap)
    return _start_append(rows, path, checkpoint, cfg, available_now)


def _start_append(
    rows: DataFrame, path: str, checkpoint: str, cfg: StreamConfig, available_now: bool
) -> StreamingQuery:
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return _trigger(writer, cfg.trigger, available_now).start(path)


def await_any(spark: SparkSession, timeout: int | None = None) -> bool | None:
    """Block until one of the running queries ends; its failure is raised here."""
    return spark.streams.awaitAnyTermination(timeout)
