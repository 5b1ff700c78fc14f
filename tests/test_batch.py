from datetime import date

import pytest
from pyspark.sql import functions as F

from eventlake.functions import timerange
from eventlake.operators.gold import kpi_conversion_rate, kpi_revenue_daily
from eventlake.operators.quality import event_quality, out_of_order, passes, quality_report
from eventlake.operators.silver import silver
from eventlake.plans import serving
from eventlake.plans.batch import LakePaths, check_lake, extend_silver, run_batch, run_gold, run_silver, silver_audit, update_silver
from eventlake.sources.fixtures import read_bronze
from eventlake.sources.scratch import cut_lineage, new_folder
from eventlake.sources.sinks import publish_gold, write_silver
from eventlake.sources.tables import MissingTableError, has_rows, read_table, table_exists
from tests.conftest import PURCHASE, SMALL, at


@pytest.fixture
def lake(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    read_bronze(spark, SMALL).write.partitionBy("event_date").parquet(paths.bronze)
    return paths


def snapshot(spark, paths, table):
    df = spark.read.parquet(paths.gold(table)).drop("updated_at")
    digits = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    names = sorted(df.columns)
    return sorted(map(str, df.select(*digits).select(*names).collect()))


TABLES = (
    "dim_users", "dim_pages", "fact_events", "kpi_dau", "kpi_events_per_source", "kpi_purchases_per_page",
    "kpi_revenue_daily", "kpi_conversion_rate", "kpi_category_sales", "kpi_cart_abandonment",
)


def test_run_twice_gives_the_same_tables(spark, lake):
    report = run_batch(spark, lake)
    assert passes(report)
    first = {t: snapshot(spark, lake, t) for t in TABLES}
    run_batch(spark, lake)
    assert {t: snapshot(spark, lake, t) for t in TABLES} == first


def test_rerun_of_some_dates_changes_nothing(spark, lake):
    run_batch(spark, lake)
    first = {t: snapshot(spark, lake, t) for t in TABLES}
    dates = [r[0] for r in spark.read.parquet(lake.silver).select("event_date").distinct().limit(3).collect()]
    assert run_gold(spark, lake, dates)
    assert {t: snapshot(spark, lake, t) for t in TABLES} == first


def test_whole_build_forgets_dates_that_left_silver(spark, lake, tmp_path):
    run_batch(spark, lake)
    fewer = LakePaths(str(tmp_path / "fewer"))
    spark.read.parquet(lake.silver).filter("event_date < DATE '2024-01-10'").write.partitionBy("event_date").parquet(
        fewer.silver
    )
    spark.read.parquet(lake.gold("kpi_category_sales")).write.partitionBy("event_date").parquet(
        fewer.gold("kpi_category_sales")
    )
    assert run_gold(spark, fewer)
    days = [r[0] for r in spark.read.parquet(fewer.gold("kpi_category_sales")).select("event_date").distinct().collect()]
    assert max(days) < date(2024, 1, 10)


def test_date_filter_prunes_partitions(spark, lake):
    run_silver(spark, lake)
    df = read_table(spark, lake.silver).filter(F.col("event_date").isin([date(2024, 1, 2)]))
    plan = kpi_conversion_rate(df)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_date#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_extending_silver_equals_rebuilding_it(spark, lake, events, tmp_path):
    run_silver(spark, lake)
    more = events(PURCHASE, {"user_id": 0})
    extend_silver(spark, lake, more, str(tmp_path / "silver2"))
    whole = silver(read_bronze(spark, SMALL).unionByName(more))
    names = sorted(whole.columns)
    extended = spark.read.parquet(str(tmp_path / "silver2"))
    assert sorted(map(str, extended.select(*names).collect())) == sorted(map(str, whole.select(*names).collect()))


def test_dates_that_left_silver_leave_gold(spark, tmp_path, events):
    paths = LakePaths(str(tmp_path / "gone"))
    two = events({**PURCHASE}, {**PURCHASE, "event_timestamp": at(60 * 24), "ingestion_timestamp": at(60 * 24)})
    two.write.partitionBy("event_date").parquet(paths.bronze)
    assert run_batch(spark, paths) is not None
    days = [r[0] for r in spark.read.parquet(paths.gold("kpi_revenue_daily")).select("event_date").orderBy("event_date").collect()]
    silver_rows = spark.read.parquet(paths.silver).filter(F.col("event_date") != days[0]).collect()
    write_silver(spark.createDataFrame(silver_rows, spark.read.parquet(paths.silver).schema), paths.silver)
    assert run_gold(spark, paths, [days[0]])
    for table in ("kpi_revenue_daily", "kpi_dau", "fact_events", "user_day", "kpi_category_sales"):
        left = {r[0] for r in spark.read.parquet(paths.gold(table)).select("event_date").distinct().collect()}
        assert left == {days[1]}, table


def test_a_slice_touches_its_dates_only(spark, tmp_path, events):
    paths = LakePaths(str(tmp_path / "lake"))
    day = 60 * 24
    rows = [{"event_id": f"e{d}", "event_timestamp": at(d * day), "ingestion_timestamp": at(d * day + 5)} for d in range(4)]
    assert len(update_silver(spark, paths, events(*rows))) == 4
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "lake/silver").rglob("part-*")}
    # A late copy of e3 on day 0 is dropped; an earlier copy of e1, dated to day 0, takes its place and empties day 1.
    more = events(
        {"event_id": "new", "event_timestamp": at(5), "ingestion_timestamp": at(9)},
        {"event_id": "e3", "event_timestamp": at(6), "ingestion_timestamp": at(9 * day)},
        {"event_id": "e1", "event_timestamp": at(7), "ingestion_timestamp": at(8)},
    )
    assert [d.day for d in update_silver(spark, paths, more)] == [1, 2, 4]
    found = {(r.event_id, r.event_date.day) for r in spark.read.parquet(paths.silver).collect()}
    assert found == {("e0", 1), ("new", 1), ("e1", 1), ("e2", 3), ("e3", 4)}
    assert not (tmp_path / "lake/silver/user_events/event_date=2024-01-02").exists()
    untouched = [p for p in files if "event_date=2024-01-03" in str(p)]
    assert untouched and all(p.stat().st_mtime_ns == files[p] for p in untouched)


def test_a_folder_without_files_is_empty(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    (tmp_path / "bronze" / "user_events").mkdir(parents=True)
    assert run_batch(spark, paths) is None


def test_missing_and_empty_bronze(spark, tmp_path, events):
    paths = LakePaths(str(tmp_path / "none"))
    with pytest.raises(MissingTableError):
        run_batch(spark, paths)
    assert not table_exists(spark, paths.bronze)
    events({}).limit(0).write.parquet(paths.bronze)
    assert run_batch(spark, paths) is None
    assert not passes(check_lake(spark, paths))


def test_audit(spark, lake):
    assert run_silver(spark, lake)
    row = silver_audit(spark, lake).first()
    assert row["rows_kept"] == spark.read.parquet(lake.silver).count()
    assert row["rows_read"] == row["rows_kept"] + row["rows_dropped"]


def test_publish_replaces_only_its_dates(spark, tmp_path):
    path = str(tmp_path / "kpi")
    def kpi(*rows):
        return spark.createDataFrame(rows, "event_date date, n int")
    publish_gold(kpi((date(2024, 1, 1), 1), (date(2024, 1, 2), 2)), path)
    publish_gold(kpi((date(2024, 1, 2), 20), (date(2024, 1, 3), 30)), path)
    got = {r["event_date"].day: r["n"] for r in spark.read.parquet(path).collect()}
    assert got == {1: 1, 2: 20, 3: 30}


def test_quality_report(spark, events):
    report = quality_report({"full": events({}), "empty": events({}).limit(0), "gone": None}, spark)
    assert {r["table"]: (r["exists"], r["rows"], r["is_empty"]) for r in report.collect()} == {
        "full": (True, 1, False), "empty": (True, 0, True), "gone": (False, 0, True)
    }
    assert not passes(report) and passes(quality_report({"full": events({})}))
    assert has_rows(events({})) and not has_rows(events({}).limit(0))


def test_event_quality(spark, events):
    df = events(
        {"event_id": "a"}, {"event_id": "a"}, {"event_id": None}, {"event_id": None},
        {"category": "Gadgets"}, {**PURCHASE, "price": None}, {"event_timestamp": at(500)},
        {"ingestion_timestamp": at(20)},
    )
    row = event_quality(df, F.lit(at(400))).first().asDict()
    assert row == {
        "rows": 8, "duplicate_ids": 1, "schema_violations": 2, "invalid_categories": 1, "missing_prices": 1,
        "future_timestamps": 1, "late_arrivals": 1,
    }


def test_out_of_order(spark, events):
    df = events(
        {"event_timestamp": at(5), "ingestion_timestamp": at(6)},
        {"event_timestamp": at(4), "ingestion_timestamp": at(7)},
        {"event_timestamp": at(3), "ingestion_timestamp": at(7, seconds=5)},
        {"event_timestamp": at(9), "ingestion_timestamp": at(9)},
    )
    got = {r["arrival_minute"]: r["out_of_order"] for r in out_of_order(df).collect()}
    assert [got[k] for k in sorted(got)] == [0, 2, 0]


def test_ranges(events):
    df = events(*[{"event_timestamp": at(60 * h)} for h in (0, 1, 20, 24)])
    as_of = at(60 * 24)
    for span, count in {"1h": 1, "6h": 2, "24h": 4, "nonsense": 4, "7d": 4}.items():
        assert timerange.in_range(df, "event_timestamp", span, as_of).count() == count, span
    assert timerange.in_range(df, "event_timestamp", "1h", timerange.latest(df)).count() == 1


def test_first_day_has_no_growth(spark):
    dau = spark.createDataFrame([(date(2024, 1, 1), 0), (date(2024, 1, 2), 4), (date(2024, 1, 3), 5)], "event_date date, dau_count long")
    t = serving.ServingTables(daily_active_users=dau)
    got = {r["event_date"].day: (r["previous_day"], r["daily_change"], r["growth_percent"]) for r in serving.dau_growth(t).collect()}
    assert got == {1: (None, None, None), 2: (0, 4, None), 3: (4, 1, 25.0)}


def test_year_over_year(spark):
    revenue = spark.createDataFrame([(date(2023, 3, 1), 100.0), (date(2024, 3, 1), 150.0)], "event_date date, total_revenue double")
    t = serving.ServingTables(revenue_daily=revenue)
    got = {r["event_date"].year: r["change_pct"] for r in serving.revenue_year_over_year(t).collect()}
    assert got == {2023: None, 2024: 50.0}


def test_only_known_tables():
    with pytest.raises(ValueError):
        serving.ServingTables(other=None)


def test_free_sql_and_first_rows(spark, events):
    t = serving.ServingTables(revenue_daily=kpi_revenue_daily(events(PURCHASE)))
    serving.register_views(t)
    assert serving.run_sql(spark, "SELECT sum(total_purchases) AS n FROM revenue_daily").first()["n"] == 1
    assert serving.first_rows(events(*[{}] * 12)).count() == 10


def test_scratch_follows_the_cluster_setting(spark, shared_folder):
    assert new_folder(spark, "x").startswith(shared_folder)
    assert cut_lineage(spark.range(3)).count() == 3
    assert shared_folder in spark.sparkContext.getCheckpointDir()
