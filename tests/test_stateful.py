"""Stateful processors, fed batch by batch, against the batch operators."""

import random

import pytest
from pyspark.sql import functions as F

from eventlake.config import AlertConfig, BaselineConfig, DetectorConfig, SessionConfig, StreamConfig
from eventlake.operators import anomalies, baselines
from eventlake.operators.alerts import first_alerts
from eventlake.operators.sessions import sessions
from eventlake.streaming import health, jobs
from eventlake.streaming.processors import summary
from eventlake.streaming.sinks import compact_summary, read_log, read_realtime, read_summary, read_versions
from eventlake.streaming.stateful import span_micros
from tests.conftest import PURCHASE, at
from tests.test_streaming import CFG, Feed

DETECTOR = DetectorConfig(traffic_min=3, traffic_max=8)
BASELINE = BaselineConfig(windows=3, traffic_sigma=(1.0, 1.5, 2.0))


@pytest.fixture
def feed(spark, events, tmp_path):
    return Feed(spark, events, tmp_path)


def run_timeline(feed, read=True):
    jobs.start_baseline_detector(
        feed.parsed(), str(feed.root / "t"), str(feed.root / "ck"), DETECTOR, BASELINE, CFG, available_now=True
    ).awaitTermination()
    if read:
        return read_realtime(feed.session, str(feed.root / "t/timeline"), ["window_start"]).orderBy("window_start")


def test_summary_of_few_values():
    assert summary([]) == (None, None, None, None) and summary([None, 2.0]) == (2.0, None, 2.0, 2.0)
    assert summary([1.0, 3.0]) == (2.0, 2.0**0.5, 1.0, 3.0)
    assert span_micros("5 minutes") == 300_000_000


def test_silence_is_heard_before_the_next_window_closes(feed):
    feed.add({}, {}, {"event_timestamp": at(6)})
    run_timeline(feed, read=False)
    # Half an hour without events: the watermark moves to 27 minutes, and the window of the new event stays open.
    feed.add({"event_timestamp": at(37)})
    rows = run_timeline(feed).collect()
    assert [(r.window_start, r.total_events) for r in rows] == [(at(0), 2), (at(5), 1), (at(10), 0), (at(15), 0), (at(20), 0)]
    log = read_log(feed.session, str(feed.root / "t/anomalies")).filter("anomaly_type = 'traffic_drop' AND metric_value = '0'")
    assert sorted(r.window_start for r in log.collect()) == [at(10), at(15), at(20)]
    feed.add({"event_timestamp": at(70)})
    rows = run_timeline(feed).collect()
    assert [r.window_start for r in rows] == [at(m) for m in range(0, 60, 5)]
    assert [r.total_events for r in rows] == [2, 1, 0, 0, 0, 0, 0, 1, 0, 0, 0, 0]


def test_timeline_equals_the_batch(feed, events, spark):
    rng = random.Random(3)
    rows = []
    for step in range(8):
        start = max([r["event_timestamp"] for r in rows], default=at(0))
        minute = (start - at(0)).seconds // 60
        batch = [
            {"event_timestamp": at(minute + rng.randrange(0, 25), seconds=rng.randrange(60)), "user_id": rng.randrange(1, 6), **rng.choice([{}, {}, PURCHASE, {"event_type": "add_to_cart"}])}
            for _ in range(rng.randrange(1, 12))
        ]
        feed.add(*batch)
        rows += batch
        got = run_timeline(feed, read=step == 7)
    closed = max(r["event_timestamp"] for r in rows)
    bronze = events(*rows)
    metrics = anomalies.window_metrics_exact(bronze)
    first = bronze.agg(F.min(F.window("event_timestamp", "5 minutes")["start"]).alias("s")).first()[0]
    step = at(5) - at(0)
    stop = at(0) + (closed - at(10)) // step * step  # the end of the last closed window
    filled = anomalies.fill_empty_windows(metrics, F.lit(first), F.lit(stop), "5 minutes")
    frame = filled.select("window_start", "total_events", "total_revenue", "cart_adds", "purchase_count", baselines.abandonment_rate().alias("abandonment"))
    names = baselines.BASELINE_CHECKS
    based = baselines.rolling_baseline(frame, names, BASELINE.windows)
    columns = ["total_events", "total_revenue", *[f"{n}_{p}" for n in names for p in ("mean", "std", "min", "max")], "baseline_windows"]

    def rounded(df):
        return [tuple(None if v is None else round(float(v), 6) for v in r[1:]) for r in df.select("window_start", *columns).orderBy("window_start").collect()]

    assert [r.window_start for r in got.collect()] == [r.window_start for r in based.orderBy("window_start").collect()]
    assert rounded(got) == rounded(based)
    want = {(r.window_start, r.anomaly_type, r.severity) for r in baselines.baseline_anomalies(filled, BASELINE).collect()}
    found = read_realtime(feed.session, str(feed.root / "t/deviations"), ["window_start", "anomaly_type"])
    assert {(r.window_start, r.anomaly_type, r.severity) for r in found.collect()} == want and want


def test_sessions_equal_the_batch(feed, events):
    """Events of several users in eight batches, some of them late but not too late, some twice."""
    rng = random.Random(11)
    kinds = ["view", "view", "add_to_cart", "purchase", "login", "logout"]
    rows, clock = [], 0
    for batch in range(8):
        own = []
        for _ in range(rng.randrange(5, 25)):
            kind = rng.choice(kinds)
            minute = max(0, clock + rng.randrange(-5, 30))
            own.append({
                "event_id": f"x{len(rows) + len(own)}", "user_id": rng.randrange(1, 4), "event_type": kind, "event_timestamp": at(minute, seconds=rng.randrange(60)),
                **({"price": rng.randrange(1, 50) / 2, "category": "Books", "product_id": "PROD-1"} if kind == "purchase" else {}),
            })
        rows += own
        feed.add(*own, *rng.choices(own, k=2))
        clock = max(clock, max((r["event_timestamp"] - at(0)).seconds // 60 for r in own))
        jobs.start_logout_sessions(
            feed.parsed(), str(feed.root / "s"), str(feed.root / "ck"), SessionConfig(gap="10 minutes"), True, CFG
        ).awaitTermination()
    mark = max(r["event_timestamp"] for r in rows) - (at(10) - at(0))
    closed = sessions(events(*rows), SessionConfig(gap="10 minutes")).filter(
        (F.col("session_end") + F.expr("INTERVAL 10 MINUTES") <= F.lit(mark)) | (F.col("logged_out") & (F.col("session_end") <= F.lit(mark)))
    )
    columns = ["user_id", "session_start", "session_end", "events", "views", "cart_adds", "purchases", "revenue", "logged_out", "duration_seconds"]
    got = sorted(tuple(r) for r in feed.session.read.parquet(str(feed.root / "s")).select(*columns).collect())
    want = sorted(tuple(r) for r in closed.select(*columns).collect())
    assert [g[:1] + g[3:] for g in got] == [w[:1] + w[3:] for w in want] and len(want) > 10
    assert any(w[8] for w in want) and any(not w[8] for w in want)


def run_detector(feed, name="a", **options):
    query = jobs.start_anomaly_detector(
        feed.parsed(), str(feed.root / "log"), str(feed.root / f"ck-{name}"), str(feed.root / "alerts"), DETECTOR, CFG,
        available_now=True, **options,
    )
    query.awaitTermination()
    return query


def test_only_first_alerts_are_sent(feed, spark):
    for minute in (0, 5, 10, 15, 20, 40, 45, 60, 90):
        feed.add({"event_timestamp": at(minute)})
        query = run_detector(feed, suppress=True, alerts=AlertConfig(severities=("critical", "high", "medium")))
    log = read_log(feed.session, str(feed.root / "log")).filter("anomaly_type = 'traffic_drop'")
    assert log.count() == 8
    sent = read_versions(feed.session, str(feed.root / "alerts")).filter("anomaly_type = 'traffic_drop'")
    held = first_alerts(log.select("window_start", "anomaly_type", "severity"))
    assert sorted(r.window_start for r in sent.collect()) == sorted(r.window_start for r in held.collect()) == [at(0), at(15), at(40), at(60)]
    assert {r.channel for r in sent.collect()} == {"critical"}
    # The state of a type is one row, however many alerts there were.
    assert max(s["numRowsTotal"] for s in query.lastProgress["stateOperators"] if "transformWithState" in s["operatorName"]) <= 6


def test_sketches_count_small_windows_exactly(events):
    rng = random.Random(5)
    bronze = events(*[{"user_id": rng.randrange(1, 60), "session_id": f"s{rng.randrange(80)}", "event_timestamp": at(rng.randrange(30)), **rng.choice([{}, PURCHASE])} for _ in range(400)])
    one, two = (sorted(map(tuple, f(bronze).collect())) for f in (anomalies.window_metrics_sketched, anomalies.window_metrics_exact))
    assert one == two
    assert anomalies.window_metrics_sketched(bronze.limit(0)).count() == 0


def test_sketched_detector_has_one_state_store(feed):
    feed.add({}, {"event_timestamp": at(30)})
    assert len(run_detector(feed).lastProgress["stateOperators"]) == 1
    assert len(run_detector(feed, "exact", exact=True).lastProgress["stateOperators"]) == 3


def test_kept_summary(feed):
    path = str(feed.root / "summary")

    def counted(rows):
        return {(r.severity, r.anomaly_type): r.anomaly_count for r in rows.groupBy("severity", "anomaly_type").agg(F.sum("anomaly_count").alias("anomaly_count")).collect()}

    def want():
        return counted(anomalies.anomaly_summary(read_log(feed.session, str(feed.root / "log"))))

    for minute in (0, 20, 40):
        feed.add({"event_timestamp": at(minute)}, {"event_timestamp": at(minute)})
        run_detector(feed, "a", summary_path=path)
    assert counted(read_summary(feed.session, path)) == want() == {("critical", "traffic_drop"): 2, ("critical", "revenue_drop"): 2}
    # A new checkpoint reads all again and speaks of the same windows, some of them with other findings.
    feed.add(*[{"event_timestamp": at(41)}] * 9, {"event_timestamp": at(70)})
    run_detector(feed, "b", summary_path=path)
    assert counted(read_summary(feed.session, path)) == want()
    compact_summary(feed.session, path, retain_seconds=0)
    assert counted(read_summary(feed.session, path)) == want()
    feed.add({"event_timestamp": at(100)})
    run_detector(feed, "b", summary_path=path)
    compact_summary(feed.session, path, retain_seconds=0)
    compact_summary(feed.session, path, retain_seconds=0)
    assert counted(read_summary(feed.session, path)) == want()
    assert feed.session.read.parquet(path).select(F.input_file_name()).distinct().count() == 1


def test_progress_is_stored_batch_by_batch(spark, tmp_path):
    """150 small batches, of which Spark itself keeps 100."""
    path = str(tmp_path / "progress")
    for batch in range(150):
        row = {
            "id": "q", "runId": "r", "name": "made", "batchId": batch, "timestamp": f"2024-01-0{1 + batch // 60}T00:00:00.000Z",
            "numInputRows": 0 if batch == 149 else 100, "durationMs": {"triggerExecution": 60_000 if batch == 3 else 10},
            "stateOperators": [{"numRowsTotal": 1, "numRowsDroppedByWatermark": 2 if batch == 7 else 0}],
        }
        for _ in range(1 + batch % 2):  # some are reported twice
            health.ProgressLog(path).onQueryProgress(_event(row))
    rows = health.read_progress(spark, path)
    assert rows.count() == 150
    want = {(3, "pipeline_delay"), (7, "late_rows"), (149, "row_drop")}
    assert {(r.batch_id, r.anomaly_type) for r in health.pipeline_health(rows).collect()} == want
    from datetime import date

    assert health.compact_progress(spark, path, date(2024, 1, 3)) == ["2024-01-01", "2024-01-02"]
    assert health.compact_progress(spark, path, date(2024, 1, 3)) == []
    again = health.read_progress(spark, path)
    files = spark.read.parquet(path).select(F.input_file_name()).distinct()
    assert again.count() == 150 and files.count() == 2 + 30
    assert health.read_progress(spark, path, since=date(2024, 1, 3)).count() == 30


def _event(row):
    import json
    from types import SimpleNamespace

    return SimpleNamespace(progress=SimpleNamespace(json=json.dumps(row)))


def test_listener_hears_a_stream(feed):
    log = health.ProgressLog(str(feed.root / "progress"), ("anomaly_detector",))
    feed.session.streams.addListener(log)
    try:
        feed.add({}, {})
        run_detector(feed)
        feed.session.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        feed.session.streams.removeListener(log)
    rows = health.read_progress(feed.session, str(feed.root / "progress")).collect()
    assert sum(r.input_rows for r in rows) == 2 and {r.query for r in rows} == {"anomaly_detector"}
