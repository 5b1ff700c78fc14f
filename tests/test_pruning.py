"""Serving queries read the folders they need."""

import pytest
from pyspark.sql import functions as F

from eventlake.operators import anomalies, baselines
from eventlake.plans import serving
from eventlake.plans.serving import ServingTables
from eventlake.sources.sinks import store_daily
from eventlake.streaming.sinks import read_log, stored_dates, write_log, write_realtime
from tests.conftest import at


def entries(spark, *rows):
    """Log rows of (minute, severity, type), detected five minutes after the window began."""
    made = [(at(m), kind, severity, "text", "1", "2") for m, severity, kind in rows]
    frame = spark.createDataFrame(made, "window_start timestamp_ntz, anomaly_type string, severity string, description string, metric_value string, expected_value string")
    return anomalies.log_entries(frame, F.col("window_start") + F.expr("INTERVAL 5 MINUTES"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


DAY = 24 * 60


@pytest.fixture
def log(spark, tmp_path):
    path = str(tmp_path / "anomalies")
    write_log(entries(spark, (0, "high", "a"), (10, "high", "b"), (DAY, "high", "a")), 0, path, "1-a")
    write_log(entries(spark, (2 * DAY, "critical", "a")), 1, path, "1-a")
    return path


def test_newest_run_speaks_for_its_windows(spark, log):
    def rows():
        return sorted((r.window_start, r.anomaly_type) for r in read_log(spark, log).collect())

    assert rows() == [(at(0), "a"), (at(10), "b"), (at(DAY), "a"), (at(2 * DAY), "a")]
    write_log(entries(spark, (0, "high", "c"), (DAY, "high", "a"), (DAY, "high", "d")), 0, log, "2-b")
    assert rows() == [(at(0), "c"), (at(10), "b"), (at(DAY), "a"), (at(DAY), "d"), (at(2 * DAY), "a")]
    write_log(entries(spark, (10, "low", "e")), 0, log, "3-c")
    assert rows() == [(at(0), "c"), (at(10), "e"), (at(DAY), "a"), (at(DAY), "d"), (at(2 * DAY), "a")]


def test_dashboards_prune_the_log(spark, log):
    write_log(entries(spark, (DAY, "high", "d")), 0, log, "2-b")
    tables = ServingTables({"anomalies": lambda: stored_dates(spark, log)}, anomalies=lambda: read_log(spark, log))
    now = F.lit(at(2 * DAY + 20))
    for query in (
        serving.active_alerts, serving.critical_alerts, serving.alerts_by_severity, serving.alerts_by_type, serving.recent_alerts,
        serving.anomaly_timeline, serving.severity_counts_today, serving.weekly_review,
    ):
        scans = plan_of(query(tables, now)).split("PartitionFilters: [")[1:]
        # Each run is a scan that starts at a date; the other scan names the windows of the later run.
        pruned = [s.split("]")[0] for s in scans if "event_date" in s.split("]")[0]]
        assert len(pruned) == 2 and all(">=" in s for s in pruned) and "Window" not in plan_of(query(tables, now)), query.__name__
    newest = serving.latest_anomalies(tables, 1)
    assert [r.anomaly_type for r in newest.collect()] == ["a"] and "event_date" in plan_of(newest).split("PartitionFilters: [")[1].split("]")[0]
    assert serving.latest_anomalies(tables, 10).count() == 4
    assert stored_dates(spark, log) == [at(2 * DAY).date(), at(DAY).date(), at(0).date()]


def test_newest_rows_come_from_newest_dates(spark, tmp_path):
    path = str(tmp_path / "cube")
    rows = [(at(m), at(m + 1), "view", 1) for m in (0, 1, 2, DAY, 3 * DAY, 3 * DAY + 1)]
    write_realtime(spark.createDataFrame(rows, "window_start timestamp_ntz, window_end timestamp_ntz, event_type string, event_count bigint"), 0, path)
    tables = ServingTables(
        {"events_per_minute": lambda: stored_dates(spark, path)}, events_per_minute=lambda: spark.read.parquet(path)
    )
    for n, dates in ((1, 1), (2, 1), (3, 3), (5, 3), (9, 3)):
        found = serving.recent_activity(tables, n)
        assert [r.window_start for r in found.collect()] == [r[0] for r in sorted(rows, reverse=True)[:n]]
        assert found.inputFiles() is not None
    assert "event_date" in plan_of(serving.recent_activity(tables, 2)).split("PartitionFilters: [")[1].split("]")[0]


def test_baselines_of_stored_days(spark, tmp_path):
    path = str(tmp_path / "days")
    values = [(at(60 * i), float((i * 7919) % 1000) if i % 7 else None) for i in range(24 * 40)]
    metrics = spark.createDataFrame(values, "window_start timestamp_ntz, total_events double")
    names = ("total_events",)
    for low, high in ((0, 15), (10, 30), (30, 41), (10, 12)):
        some = metrics.filter((F.datediff("window_start", F.lit(at(0))) >= low) & (F.datediff("window_start", F.lit(at(0))) < high))
        store_daily(baselines.daily_baselines(some, names), path)
    got = baselines.merged_baselines(spark.read.parquet(path), "1hour").first()
    want = baselines.anomaly_baselines(metrics, "1hour", names).first()
    for name in ("avg_value", "stddev_value", "min_value", "max_value", "sample_count"):
        assert got[name] == pytest.approx(want[name]), name
    known = sorted(v for _, v in values if v is not None)
    rank = sum(v <= got.percentile_95 for v in known) / len(known)
    assert abs(rank - 0.95) <= baselines.RANK_ERROR + 1 / len(known)


def test_one_value_has_no_spread(spark):
    metrics = spark.createDataFrame([(at(0), 3.0)], "window_start timestamp_ntz, total_events double")
    row = baselines.merged_baselines(baselines.daily_baselines(metrics, ("total_events",)), "1hour").first()
    assert (row.avg_value, row.stddev_value, row.percentile_95, row.sample_count) == (3.0, None, 3.0, 1)
