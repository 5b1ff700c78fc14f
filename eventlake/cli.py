"""Jobs from the command line, for ``spark-submit`` or ``python -m eventlake.cli``.

    land    raw records to bronze (stream)
    fast    one-minute tables (stream)
    detect  anomaly log, alert outbox and kept summary (stream)
    watch   timeline of windows, silent ones too, with rolling baselines (stream)
    silver  bronze to silver (batch)
    gold    silver to gold (batch); --dates limits it to some days
    update  slices of bronze (--dates) into silver, and the touched days into gold (batch)
    compact minute tables, kept summary and stored progress into few files (batch)
    health  findings about the streams from their stored progress (batch)
    check   presence and emptiness of the tables
    batch   silver, gold and check
    query   one serving query over the stored tables (--name, --as-of)
"""

from __future__ import annotations

import argparse
import inspect
import sys
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.config import StreamConfig
from eventlake.functions.parsing import parse_events
from eventlake.operators.quality import passes
from eventlake.plans import serving
from eventlake.operators.realtime import MINUTE_CUBE_KEYS
from eventlake.plans.batch import LakePaths, check_lake, run_batch, run_gold, run_silver, silver_audit, update_silver
from eventlake.schemas import SERVING_TABLES
from eventlake.sources.streams import read_event_stream
from eventlake.sources.tables import MissingTableError, read_table, table_exists
from eventlake.streaming import jobs
from eventlake.streaming.health import ProgressLog, compact_progress, pipeline_health, read_progress
from eventlake.streaming.sinks import compact_realtime, compact_summary


STREAMS = ("land", "fast", "detect", "watch")
TABLE_JOBS = ("silver", "gold", "update", "compact", "health", "check", "batch")


def parse_arguments(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="eventlake", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("job", choices=(*STREAMS, *TABLE_JOBS, "query"))
    parser.add_argument("--lake", required=True, help="root folder of the tables")
    parser.add_argument("--checkpoints", help="root folder of the stream checkpoints")
    parser.add_argument("--format", default="parquet", help="table format (parquet or delta)")
    parser.add_argument("--source", default="kafka", choices=("kafka", "text", "parquet"))
    parser.add_argument("--path", help="folder a file source follows")
    parser.add_argument("--servers", help="Kafka brokers")
    parser.add_argument("--per-trigger", type=int, help="records of a topic, or files of a folder, in a micro-batch")
    parser.add_argument("--name", help="serving query to run, for example daily_summary")
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="instant a serving query looks back from (default: now)")
    parser.add_argument("--topic", default="user-events")
    parser.add_argument("--dates", nargs="*", type=date.fromisoformat)
    parser.add_argument("--separate", action="store_true", help="one query per minute table")
    parser.add_argument("--once", action="store_true", help="catch up and stop")
    parser.add_argument("--state-partitions", type=int, default=StreamConfig.state_partitions)
    return parser.parse_args(arguments)


def _records(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    options = {}
    if args.source == "kafka":
        if not args.servers:
            raise SystemExit("a Kafka source needs --servers")
        options = {"kafka.bootstrap.servers": args.servers, "subscribe": args.topic}
    return read_event_stream(spark, args.source, args.path, args.per_trigger, **options)


def run_stream(spark: SparkSession, args: argparse.Namespace) -> None:
    checkpoints = args.checkpoints or f"{args.lake}/checkpoints"
    cfg = StreamConfig(state_partitions=args.state_partitions)
    session = jobs.stream_session(spark, cfg)
    records = _records(session, args)
    root = f"{args.lake}/realtime"
    session.streams.addListener(ProgressLog(f"{args.lake}/progress"))
    if args.job == "land":
        path = LakePaths(args.lake, args.format).bronze
        started = [jobs.land_bronze(records, path, f"{checkpoints}/landing", args.format, args.once)]
    elif args.job == "detect":
        events = parse_events(records, with_ingestion=False)
        started = [
            jobs.start_anomaly_detector(
                events, f"{root}/anomalies", f"{checkpoints}/anomalies", f"{root}/alerts", cfg=cfg,
                available_now=args.once, suppress=True, summary_path=f"{root}/anomaly_summary",
            )
        ]
    elif args.job == "watch":
        events = parse_events(records, with_ingestion=False)
        started = [jobs.start_baseline_detector(events, f"{root}/watch", f"{checkpoints}/watch", cfg=cfg, available_now=args.once)]
    else:
        events = parse_events(records, with_ingestion=False)
        start = jobs.start_fast_aggregates if args.separate else jobs.start_minute_cube
        running = start(events, root, checkpoints, cfg, args.once)
        started = list(running.values()) if args.separate else [running]
    if args.once:
        for query in started:
            query.awaitTermination()
    else:
        jobs.await_any(session)


def compact_all(spark: SparkSession, lake: str) -> list[str]:
    """Compact what is there; the names of the tables that are."""
    root, done = f"{lake}/realtime", []
    keys = {name: SERVING_TABLES[name].keys for name in jobs.MINUTE_TABLES} | {"minute_cube": MINUTE_CUBE_KEYS}
    for name, own in keys.items():
        if table_exists(spark, f"{root}/{name}"):
            compact_realtime(spark, f"{root}/{name}", own)
            done.append(name)
    if table_exists(spark, f"{root}/anomaly_summary"):
        compact_summary(spark, f"{root}/anomaly_summary")
        done.append("anomaly_summary")
    if table_exists(spark, f"{lake}/progress"):
        compact_progress(spark, f"{lake}/progress", datetime.now(timezone.utc).date())
        done.append("progress")
    return done


def run_tables(spark: SparkSession, args: argparse.Namespace) -> int:
    paths = LakePaths(args.lake, args.format)
    try:
        if args.job == "compact":
            print("compacted: " + ", ".join(compact_all(spark, args.lake)))
            return 0
        if args.job == "health":
            pipeline_health(read_progress(spark, f"{args.lake}/progress")).orderBy("query", "run_id", "batch_id").show(1000, truncate=False)
            return 0
        if args.job == "update":
            bronze = read_table(spark, paths.bronze, paths.fmt)
            touched = update_silver(spark, paths, bronze.filter(F.col("event_date").isin(args.dates)) if args.dates else bronze)
            run_gold(spark, paths, touched)
            print(f"{len(touched)} days written")
            return 0
        if args.job == "silver":
            report = silver_audit(spark, paths) if run_silver(spark, paths) else None
        elif args.job == "gold":
            if not run_gold(spark, paths, args.dates):
                print("silver is empty, nothing to do")
            return 0
        else:
            report = run_batch(spark, paths) if args.job == "batch" else check_lake(spark, paths)
    except MissingTableError as error:
        print(error, file=sys.stderr)
        return 1
    if report is None:
        print("bronze is empty, nothing to do")
        return 0
    report.show(truncate=False)
    if args.job in ("batch", "check") and not passes(report):
        print("some tables are missing or empty")
    return 0


def run_query(spark: SparkSession, args: argparse.Namespace) -> int:
    """Print one serving query over the stored gold and realtime tables."""
    query = getattr(serving, args.name or "", None)
    takes = list(inspect.signature(query).parameters) if inspect.isfunction(query) else []
    if takes[:1] != ["t"] or args.name.startswith("_"):
        print(f"no serving query named {args.name}", file=sys.stderr)
        return 1
    tables = serving.ServingTables.from_lake(spark, LakePaths(args.lake, args.format), f"{args.lake}/realtime")
    moment = [args.as_of or datetime.now(timezone.utc).replace(tzinfo=None)] if "as_of" in takes else []
    query(tables, *moment).show(1000, truncate=False)
    return 0


def main(arguments: list[str] | None = None) -> int:
    args = parse_arguments(arguments)
    spark = SparkSession.builder.appName(f"eventlake-{args.job}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # dates are dates in UTC, wherever the cluster stands
    if args.job in STREAMS:
        run_stream(spark, args)
        return 0
    return run_query(spark, args) if args.job == "query" else run_tables(spark, args)


if __name__ == "__main__":
    sys.exit(main())
