"""Queries that run whole jobs: a stream that catches up with the events, or the batch medallion.

Each run works in a new folder below the shared one and returns the table it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.config import AlertConfig, BaselineConfig, DetectorConfig, StreamConfig
from eventlake.functions.parsing import to_json_records
from eventlake.operators import realtime
from eventlake.operators.realtime import MINUTE_CUBE_KEYS
from eventlake.operators.silver import clean_events
from eventlake.plans.batch import LakePaths, run_batch, update_silver
from eventlake.plans.catalogue import HOURLY, LOOSE_BASELINE, SESSION_GAP, Query, _numeric, rounded, utc
from eventlake.schemas import ANOMALY_COLUMNS, BRONZE_COLUMNS, SERVING_TABLES
from eventlake.sources.fixtures import clickstream_from_events, read_bronze
from eventlake.sources.scratch import new_folder
from eventlake.sources.streams import read_event_stream
from eventlake.streaming import health, jobs
from eventlake.streaming.sinks import compact_realtime, compact_summary, read_log, read_realtime, read_summary, read_versions


def _settings(spark: SparkSession) -> StreamConfig:
    """State partitions in proportion to the cores of the cluster."""
    return StreamConfig(state_partitions=max(8, 2 * spark.sparkContext.defaultParallelism))


def _event_stream(session: SparkSession, folder: str) -> DataFrame:
    """The events table followed as a stream of click-stream events."""
    schema = session.read.parquet(f"{folder}/events.parquet").schema
    files = session.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return clickstream_from_events(files.parquet(folder))


def _in_utc(df: DataFrame) -> DataFrame:
    """Times without zone, as the batch queries give them."""
    kinds = dict(df.dtypes)
    return df.select(*[utc(c) if kinds[c] == "timestamp" else F.col(c) for c in df.columns])


def landed_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """JSON records followed as a stream and landed by date."""
    work = new_folder(spark, "landing")
    session = jobs.stream_session(spark, _settings(spark))
    records = to_json_records(read_bronze(session, folder))
    records.withColumn("timestamp", F.col("timestamp").cast("timestamp")).write.parquet(f"{work}/topic")
    raw = read_event_stream(session, "parquet", f"{work}/topic")
    jobs.land_bronze(raw, f"{work}/bronze", f"{work}/checkpoint", available_now=True).awaitTermination()
    return _in_utc(session.read.parquet(f"{work}/bronze")).select(*BRONZE_COLUMNS)


def streamed_cube(spark: SparkSession, folder: str) -> DataFrame:
    work = new_folder(spark, "cube")
    cfg = _settings(spark)
    session = jobs.stream_session(spark, cfg)
    query = jobs.start_minute_cube(
        _event_stream(session, folder), work, f"{work}/checkpoints", cfg, available_now=True
    )
    query.awaitTermination()
    rows = read_realtime(session, f"{work}/minute_cube", MINUTE_CUBE_KEYS)
    return rounded(_in_utc(rows), 2, "revenue")


def streamed_twice(spark: SparkSession, folder: str) -> DataFrame:
    """The cube after a lost checkpoint: a second one reads the stream again into the same, compacted table."""
    work = new_folder(spark, "restarted")
    cfg = _settings(spark)
    session = jobs.stream_session(spark, cfg)
    for attempt in ("first", "second"):
        jobs.start_minute_cube(
            _event_stream(session, folder), work, f"{work}/checkpoints-{attempt}", cfg, available_now=True
        ).awaitTermination()
        compact_realtime(session, f"{work}/minute_cube", MINUTE_CUBE_KEYS, retain_seconds=0)
    rows = read_realtime(session, f"{work}/minute_cube", MINUTE_CUBE_KEYS)
    return rounded(_in_utc(rows), 2, "revenue")


def streamed_minute_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Four independent queries; their tables are returned as one frame of named counts."""
    work = new_folder(spark, "minutes")
    cfg = _settings(spark)
    session = jobs.stream_session(spark, cfg)
    running = jobs.start_fast_aggregates(
        _event_stream(session, folder), work, f"{work}/checkpoints", cfg, available_now=True
    )
    for query in running.values():
        query.awaitTermination()
    counts = {
        "events_per_minute": "event_count",
        "revenue_per_minute": "purchase_count",
        "purchases_per_minute": "purchase_count",
        "category_velocity": "purchase_count",
    }
    frames = [
        read_realtime(session, f"{work}/{name}", SERVING_TABLES[name].keys)
        .groupBy("window_start")
        .agg(F.sum(column).alias("total"), F.count("*").alias("table_rows"))
        .select(F.lit(name).alias("table_name"), "window_start", "total", "table_rows")
        for name, column in counts.items()
    ]
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame)
    return _in_utc(merged)


def _streamed_findings(spark: SparkSession, folder: str, **options) -> tuple[SparkSession, str]:
    work = new_folder(spark, "anomalies")
    cfg = _settings(spark)
    session = jobs.stream_session(spark, cfg)
    jobs.start_anomaly_detector(
        _event_stream(session, folder), f"{work}/log", f"{work}/checkpoint", f"{work}/alerts",
        HOURLY, cfg, available_now=True, **options,
    ).awaitTermination()
    return session, work


def streamed_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    """Logged findings of the closed windows, from exact counts."""
    session, work = _streamed_findings(spark, folder, exact=True)
    return _numeric(_in_utc(read_log(session, f"{work}/log").select(*ANOMALY_COLUMNS)))


def sketched_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    """Logged findings of the closed windows, with users counted by sketches in one state store."""
    session, work = _streamed_findings(spark, folder)
    return _numeric(_in_utc(read_log(session, f"{work}/log").select(*ANOMALY_COLUMNS)))


def streamed_outbox(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of the running stream: severe findings of a type at least six hours apart, with their channel."""
    session, work = _streamed_findings(spark, folder, exact=True, suppress=True, alerts=AlertConfig(dedup_window="6 hours"))
    rows = read_versions(session, f"{work}/alerts")
    return _in_utc(rows.select("window_start", "anomaly_type", "severity", "title", "channel"))


def kept_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The summary kept by two runs over the same stream, folded between them; each window counts once. Times of detection are
    those of the run, so days are left out."""
    work = new_folder(spark, "summary")
    cfg = _settings(spark)
    session = jobs.stream_session(spark, cfg)
    for attempt in ("first", "second"):
        jobs.start_anomaly_detector(
            _event_stream(session, folder), f"{work}/log", f"{work}/checkpoint-{attempt}", None, HOURLY, cfg, available_now=True,
            exact=True, summary_path=f"{work}/summary",
        ).awaitTermination()
        compact_summary(session, f"{work}/summary", retain_seconds=0)
    rows = read_summary(session, f"{work}/summary")
    return rows.groupBy("severity", "anomaly_type").agg(F.sum("anomaly_count").alias("anomaly_count"))


def _timeline_run(spark: SparkSession, folder: str, detector: DetectorConfig, baseline: BaselineConfig) -> tuple[SparkSession, str]:
    work = new_folder(spark, "timeline")
    cfg = _settings(spark)
    session = jobs.stream_session(spark, cfg)
    jobs.start_baseline_detector(
        _event_stream(session, folder), work, f"{work}/checkpoint", detector, baseline, cfg, available_now=True
    ).awaitTermination()
    return session, work


def streamed_timeline(spark: SparkSession, folder: str) -> DataFrame:
    """Every closed five-minute window, silent ones too, with the statistics of the twelve windows before it."""
    session, work = _timeline_run(spark, folder, DetectorConfig(), BaselineConfig())
    rows = _in_utc(read_realtime(session, f"{work}/timeline", ["window_start"]))
    numbers = [f"{m}_{part}" for m in ("total_events", "total_revenue", "abandonment") for part in ("mean", "std", "min", "max")]
    picked = rows.select("window_start", "window_end", "total_events", "purchase_count", "total_revenue", "baseline_windows", *numbers)
    return rounded(picked, 4, "total_revenue", *numbers)


def streamed_silence(spark: SparkSession, folder: str) -> DataFrame:
    """Traffic findings of windows without any event."""
    session, work = _timeline_run(spark, folder, DetectorConfig(), BaselineConfig())
    log = read_log(session, f"{work}/anomalies")
    return _in_utc(log.filter("anomaly_type = 'traffic_drop' AND metric_value = '0'").select("window_start", "severity", "description"))


def streamed_deviations(spark: SparkSession, folder: str) -> DataFrame:
    """Windows that leave their rolling baseline, from the running stream."""
    session, work = _timeline_run(spark, folder, HOURLY, LOOSE_BASELINE)
    keys = ["window_start", "anomaly_type"]
    rows = _in_utc(read_realtime(session, f"{work}/deviations", keys))
    return rounded(rows.select(*keys, "severity", "value", "baseline", "deviation"), 4, "value", "baseline", "deviation")


def streamed_logout_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Closed sessions of clean events by the rule of the batch sessions."""
    work = new_folder(spark, "logouts")
    session = jobs.stream_session(spark, _settings(spark))
    jobs.start_logout_sessions(
        clean_events(_event_stream(session, folder)), f"{work}/sessions", f"{work}/checkpoint", SESSION_GAP, available_now=True
    ).awaitTermination()
    return rounded(_in_utc(session.read.parquet(f"{work}/sessions")), 6, "revenue", "duration_seconds")


def streamed_unique_events(spark: SparkSession, folder: str) -> DataFrame:
    work = new_folder(spark, "unique")
    session = jobs.stream_session(spark, _settings(spark))
    jobs.start_dedupe(
        _event_stream(session, folder), f"{work}/events", f"{work}/checkpoint", available_now=True
    ).awaitTermination()
    # Which of two copies comes first is open; what both have in common is not.
    return _in_utc(session.read.parquet(f"{work}/events")).select(
        "event_id", "user_id", "event_type", "event_timestamp", "source", "session_id", "price", "category", "product_id"
    )


def stream_progress(spark: SparkSession, folder: str) -> DataFrame:
    """What the progress of a stream says it has read."""
    work = new_folder(spark, "progress")
    session = jobs.stream_session(spark, _settings(spark))
    query = jobs.start_dedupe(_event_stream(session, folder), f"{work}/events", f"{work}/checkpoint", available_now=True)
    query.awaitTermination()
    rows = health.progress_rows(session, query)
    ids = F.sort_array(F.collect_list("batch_id"))  # Spark keeps a bounded number of them
    return rows.agg(F.sum("input_rows").alias("input_rows"), (F.count_distinct("batch_id") == F.size(ids)).alias("batches_in_order"))


def _daily_files(spark: SparkSession, folder: str, target: str) -> None:
    """The events as one file per day, the earlier day first."""
    events = spark.read.parquet(f"{folder}/events.parquet").withColumn("day", F.to_date("ts"))
    days = [r[0] for r in events.select("day").distinct().orderBy("day").collect()]  # the days of the table
    for day in days:
        events.filter(F.col("day") == F.lit(day)).drop("day").coalesce(1).write.mode("append").parquet(target)


def stored_health(spark: SparkSession, folder: str) -> DataFrame:
    """A landing with one day in a batch, its progress stored batch by batch, and the days on which rows went missing.

    Slow batches depend on the machine and are left out.
    """
    work = new_folder(spark, "health")
    session = jobs.stream_session(spark, _settings(spark))
    _daily_files(session, folder, f"{work}/events")
    stream = session.readStream.schema(session.read.parquet(f"{work}/events").schema).option("maxFilesPerTrigger", 1)
    log = health.ProgressLog(f"{work}/progress", ("daily_landing",))
    session.streams.addListener(log)
    try:
        rows = clickstream_from_events(stream.parquet(f"{work}/events")).writeStream.queryName("daily_landing")
        query = rows.format("parquet").option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start(f"{work}/bronze")
        query.awaitTermination()
        session.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        session.streams.removeListener(log)
    progress = health.read_progress(session, f"{work}/progress")
    found = health.pipeline_health(progress, max_duration_ms=1 << 40, drop_share=0.1).filter("anomaly_type = 'row_drop'")
    return progress.join(found.select("batch_id", "anomaly_type"), "batch_id", "left").select("batch_id", "input_rows", "anomaly_type")


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Events per hour from a stream of three batches, the last of which is the first day: all of it is behind the watermark.

    A row is late by the watermark that the batch before its own began with, so it takes a third batch. The metric of the state
    operator says that rows were dropped.
    """
    work = new_folder(spark, "late")
    cfg = _settings(spark)
    session = jobs.stream_session(spark, cfg)
    events = session.read.parquet(f"{folder}/events.parquet").withColumn("day", F.to_date("ts"))
    first = events.agg(F.min("day").alias("day")).scalar()
    for chosen in (
        events.filter(F.col("day") == F.date_add(first, 1)), events.filter(F.col("day") > F.date_add(first, 1)), events.filter(F.col("day") == first)
    ):
        chosen.drop("day").coalesce(1).write.mode("append").parquet(f"{work}/events")
    stream = session.readStream.schema(events.drop("day").schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/events")
    marked = realtime.with_watermark(clickstream_from_events(stream), cfg.anomaly_watermark)
    counted = realtime.events_per_minute(marked, "1 hour")
    query = (
        counted.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{work}/checkpoint")
        .trigger(availableNow=True).start(f"{work}/hours")
    )
    query.awaitTermination()
    dropped = health.progress_rows(session, query).agg((F.sum("late_rows") > 0).alias("rows_were_late"))
    return _in_utc(session.read.parquet(f"{work}/hours")).crossJoin(F.broadcast(dropped))


def streamed_sessions(spark: SparkSession, folder: str) -> DataFrame:
    work = new_folder(spark, "sessions")
    session = jobs.stream_session(spark, _settings(spark))
    jobs.start_session_windows(
        _event_stream(session, folder), f"{work}/sessions", f"{work}/checkpoint", "6 hours", available_now=True
    ).awaitTermination()
    return _in_utc(session.read.parquet(f"{work}/sessions"))


def lake_kpis(spark: SparkSession, folder: str) -> DataFrame:
    """The whole batch run over a bronze table, read back from the gold tables it wrote."""
    paths = LakePaths(new_folder(spark, "lake"))
    read_bronze(spark, folder).write.partitionBy("event_date").parquet(paths.bronze)
    run_batch(spark, paths)
    conversion = spark.read.parquet(paths.gold("kpi_conversion_rate")).drop("updated_at")
    revenue = spark.read.parquet(paths.gold("kpi_revenue_daily")).drop("updated_at")
    return rounded(conversion.join(revenue, "event_date", "left"), 2, "total_revenue")


def incremental_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Silver from two slices that share ids and dates, the second one merged into the first."""
    paths = LakePaths(new_folder(spark, "slices"))
    bronze = read_bronze(spark, folder)
    second = F.coalesce(F.col("page") == "/retry", F.lit(False)) | (F.col("event_id").cast("int") % 3 == 0)
    for slice_ in (bronze.filter(second), bronze.filter(~second)):
        update_silver(spark, paths, slice_)
    return spark.read.parquet(paths.silver).select(*BRONZE_COLUMNS)


def derived_minute_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Events per minute and type, summed from the streamed cube."""
    cube = streamed_cube(spark, folder)
    return realtime.events_from_cube(cube)


def stream_queries() -> dict[str, Query]:
    return {
        "r13_landed_bronze": landed_bronze,
        "r_streamed_cube": streamed_cube,
        "s6_cube_after_restart": streamed_twice,
        "r1_from_streamed_cube": derived_minute_tables,
        "r9_streamed_minute_tables": streamed_minute_tables,
        "ad7_streamed_anomalies": streamed_anomalies,
        "ad7_sketched_anomalies": sketched_anomalies,
        "c3_streamed_outbox": streamed_outbox,
        "k14_kept_summary": kept_summary,
        "w5_streamed_timeline": streamed_timeline,
        "ad2_streamed_silence": streamed_silence,
        "c2_streamed_deviations": streamed_deviations,
        "r12_streamed_logout_sessions": streamed_logout_sessions,
        "dq4_stream_progress": stream_progress,
        "dq4_stored_health": stored_health,
        "r10_late_rows": late_rows,
        "d3_streamed_unique_events": streamed_unique_events,
        "r12_streamed_sessions": streamed_sessions,
        "s4_incremental_silver": incremental_silver,
        "s7_lake_kpis": lake_kpis,
    }
