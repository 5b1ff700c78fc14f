"""Streams fed batch by batch from files."""

import pytest
from pyspark.sql import functions as F

from eventlake.config import DetectorConfig, StreamConfig
from eventlake.functions.parsing import parse_events, to_json_records
from eventlake.operators import anomalies, realtime
from eventlake.schemas import SERVING_TABLES
from eventlake.sources.streams import read_event_stream
from eventlake.streaming import health, jobs
from eventlake.streaming.sinks import compact_realtime, read_realtime, run_id, write_realtime
from tests.conftest import PURCHASE, at

CFG = StreamConfig(state_partitions=2)


class Feed:
    """A folder of JSON lines that grows by one file per batch, and the stream that follows it."""

    def __init__(self, spark, events, root):
        self.session = jobs.stream_session(spark, CFG)
        self.events, self.root, self.files = events, root, 0

    def add(self, *rows):
        lines = [r["value"] for r in to_json_records(self.events(*rows)).collect()]
        self.add_lines(*lines)

    def add_lines(self, *lines):
        folder = self.root / "topic"
        folder.mkdir(exist_ok=True)
        (folder / f"{self.files:05d}.json").write_text("\n".join(lines) + "\n")
        self.files += 1

    def raw(self):
        return read_event_stream(self.session, "text", str(self.root / "topic"))

    def parsed(self):
        return parse_events(self.raw(), with_ingestion=False)


@pytest.fixture
def feed(spark, events, tmp_path):
    return Feed(spark, events, tmp_path)


def cube(feed):
    jobs.start_minute_cube(
        feed.parsed(), str(feed.root / "rt"), str(feed.root / "ck"), CFG, available_now=True
    ).awaitTermination()
    return read_realtime(feed.session, str(feed.root / "rt/minute_cube"), realtime.MINUTE_CUBE_KEYS)


def total(df):
    return df.agg(F.sum("event_count")).first()[0]


def test_running_totals_are_not_added_up(feed):
    feed.add({}, {}, {**PURCHASE})
    assert total(cube(feed)) == 3
    feed.add({}, {**PURCHASE, "price": 5.0})
    rows = cube(feed)
    assert total(rows) == 5
    purchases = realtime.revenue_from_cube(rows).first()
    assert (purchases["revenue"], purchases["purchase_count"]) == (15.0, 2)
    versions = feed.session.read.parquet(str(feed.root / "rt/minute_cube"))
    assert versions.filter("event_type = 'view'").agg(F.sum("event_count")).first()[0] == 2 + 3


def test_late_events_are_dropped_in_the_speed_layer_and_kept_in_bronze(feed):
    feed.add({"event_timestamp": at(60)})
    cube(feed)
    feed.add({"event_timestamp": at(61)})
    cube(feed)
    feed.add({"event_timestamp": at(0)}, {"event_timestamp": at(60), "event_type": "login"})
    assert total(cube(feed)) == 3
    jobs.land_bronze(feed.raw(), str(feed.root / "bronze"), str(feed.root / "ckb"), available_now=True).awaitTermination()
    assert feed.session.read.parquet(str(feed.root / "bronze")).count() == 4


def test_four_tables(feed):
    feed.add({}, {**PURCHASE}, {**PURCHASE, "category": "Food", "event_timestamp": at(3)}, {"event_type": "login"})
    started = jobs.start_fast_aggregates(
        feed.parsed(), str(feed.root / "rt"), str(feed.root / "ck"), CFG, available_now=True
    )
    assert set(started) == {"events_per_minute", "revenue_per_minute", "purchases_per_minute", "category_velocity"}
    for query in started.values():
        query.awaitTermination()
    for name, count in {"events_per_minute": 4, "revenue_per_minute": 2, "purchases_per_minute": 2, "category_velocity": 2}.items():
        rows = read_realtime(feed.session, str(feed.root / "rt" / name), SERVING_TABLES[name].keys)
        assert rows.count() == count, name


def test_bronze_keeps_malformed_records(feed):
    feed.add({}, {**PURCHASE})
    feed.add_lines("no json", '{"event_id": "x", "user_id": "x"}', '{"event_id": "y", "timestamp": "soon"}')
    jobs.land_bronze(feed.raw(), str(feed.root / "bronze"), str(feed.root / "ck"), available_now=True).awaitTermination()
    bronze = feed.session.read.parquet(str(feed.root / "bronze"))
    assert bronze.count() == 5
    assert bronze.filter("event_date IS NULL").count() == 3
    assert bronze.filter("ingestion_timestamp IS NULL").isEmpty()


def detector_run(feed, cfg=DetectorConfig()):
    jobs.start_anomaly_detector(
        feed.parsed(), str(feed.root / "log"), str(feed.root / "ck"), str(feed.root / "alerts"), cfg, CFG,
        available_now=True,
    ).awaitTermination()


def test_detector_speaks_once_per_closed_window(feed):
    feed.add({}, {"event_timestamp": at(6)}, {"event_timestamp": at(30)})
    detector_run(feed)
    feed.add({"event_timestamp": at(60)})
    detector_run(feed)
    log = feed.session.read.parquet(str(feed.root / "log"))
    drops = log.filter("anomaly_type = 'traffic_drop'").orderBy("window_start").collect()
    assert [r["window_start"] for r in drops] == [at(0), at(5), at(30)]  # the window at 60 is open
    assert log.filter("acknowledged <> 0 OR detected_at IS NULL").isEmpty()
    sent = feed.session.read.parquet(str(feed.root / "alerts"))
    assert sent.filter("anomaly_type = 'traffic_drop'").count() == 3
    assert sent.filter("severity NOT IN ('critical', 'high')").isEmpty()


def test_detector_has_one_state_store(feed):
    feed.add({})
    found = anomalies.detect_anomalies(realtime.with_watermark(feed.parsed(), "10 minutes"))
    query = (
        found.writeStream.format("noop").outputMode("append")
        .option("checkpointLocation", str(feed.root / "ck")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert len(query.lastProgress["stateOperators"]) == 1


def test_replayed_batch_replaces_itself(spark, tmp_path):
    df = spark.createDataFrame([(at(0), 1)], "window_start timestamp_ntz, n int")
    for _ in range(2):
        write_realtime(df, 0, str(tmp_path / "t"))
    write_realtime(df.withColumn("n", F.lit(5)), 1, str(tmp_path / "t"))
    write_realtime(df.limit(0), 2, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    assert [r["n"] for r in read_realtime(spark, str(tmp_path / "t"), ["window_start"]).collect()] == [5]


def window_rows(spark, *rows):
    return spark.createDataFrame([(at(m), n) for m, n in rows], "window_start timestamp_ntz, n int")


def stored(spark, path):
    return {r["window_start"]: r["n"] for r in read_realtime(spark, path, ["window_start"]).collect()}


def test_a_later_run_keeps_and_overrules_an_earlier_one(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch, row in enumerate([(0, 10), (1, 11), (2, 12)]):
        write_realtime(window_rows(spark, row), batch, path, "1-a")
    write_realtime(window_rows(spark, (2, 99), (3, 1)), 0, path, "2-b")
    assert stored(spark, path) == {at(0): 10, at(1): 11, at(2): 99, at(3): 1}


def test_run_lives_with_its_checkpoint(spark, tmp_path):
    first = run_id(spark, str(tmp_path / "ck"))
    assert run_id(spark, str(tmp_path / "ck")) == first < run_id(spark, str(tmp_path / "other"))


def test_compaction_leaves_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in range(6):
        write_realtime(window_rows(spark, (batch, batch), (0, batch)), batch, path, "1-a")
    before = stored(spark, path)
    compact_realtime(spark, path, ["window_start"], retain_seconds=0)
    assert stored(spark, path) == before
    write_realtime(window_rows(spark, (3, 77)), 6, path, "1-a")
    compact_realtime(spark, path, ["window_start"], retain_seconds=0)
    compact_realtime(spark, path, ["window_start"], retain_seconds=0)
    assert stored(spark, path) == {**before, at(3): 77}
    assert len({r[0] for r in spark.read.parquet(path).select(F.input_file_name()).collect()}) <= 2
    compact_realtime(spark, path, ["window_start"])  # nothing new, nothing old enough
    assert stored(spark, path) == {**before, at(3): 77}


def test_dates_prune_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    write_realtime(window_rows(spark, (0, 1), (60 * 24, 2)), 0, path)
    rows = read_realtime(spark, path, ["window_start"], dated=True).filter("event_date = DATE '2024-01-02'")
    assert [r["n"] for r in rows.collect()] == [2]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_sink_errors_end_the_query(feed):
    feed.add({})

    def broken(df, batch_id):
        raise RuntimeError("store is away")

    query = (
        realtime.events_per_minute(realtime.with_watermark(feed.parsed(), "2 minutes"))
        .writeStream.outputMode("update").foreachBatch(broken)
        .option("checkpointLocation", str(feed.root / "ck")).trigger(availableNow=True).start()
    )
    with pytest.raises(Exception, match="store is away"):
        query.awaitTermination()


def test_dedupe_stream(feed):
    feed.add({"event_id": "a"}, {"event_id": "a"}, {"event_id": "b"})
    feed.add({"event_id": "a", "event_timestamp": at(1)}, {"event_id": "c"})
    jobs.start_dedupe(
        feed.parsed(), str(feed.root / "out"), str(feed.root / "ck"), available_now=True
    ).awaitTermination()
    got = sorted(r["event_id"] for r in feed.session.read.parquet(str(feed.root / "out")).collect())
    assert got == ["a", "b", "c"]


def test_progress_and_health(feed, spark):
    feed.add({}, {})
    query = jobs.start_minute_cube(
        feed.parsed(), str(feed.root / "rt"), str(feed.root / "ck"), CFG, available_now=True
    )
    query.awaitTermination()
    rows = health.progress_rows(spark, query).collect()
    assert sum(r["input_rows"] for r in rows) == 2
    made = spark.createDataFrame(
        [(0, 100, 1000, 10.0, 20.0), (1, 110, 50_000, 10.0, 20.0), (2, 20, 1000, 10.0, 20.0), (3, 90, 1000, 30.0, 20.0)],
        "batch_id long, input_rows long, duration_ms long, input_rate double, processed_rate double",
    )
    found = {(r["batch_id"], r["anomaly_type"]) for r in health.pipeline_health(made).collect()}
    assert found == {(1, "pipeline_delay"), (2, "row_drop"), (3, "input_backlog")}


def test_unknown_source_format(spark):
    with pytest.raises(ValueError):
        read_event_stream(spark, "csv", "/tmp")
    with pytest.raises(ValueError):
        read_event_stream(spark, "text")
