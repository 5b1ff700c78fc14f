import pytest
from pyspark.sql import functions as F

from eventlake.functions.parsing import parse_events, to_json_records
from eventlake.operators import silver
from eventlake.operators.upserts import latest_by_key
from tests.conftest import PURCHASE, at


def ids(df):
    return sorted(r["event_id"] for r in df.select("event_id").collect())


REJECTED = {
    "no user": {"user_id": None},
    "no session": {"session_id": None},
    "no time": {"event_timestamp": None},
    "no source": {"source": None},
    "no type": {"event_type": None},
    "unknown type": {"event_type": "click"},
    "unknown source": {"source": "kiosk"},
    "user zero": {"user_id": 0},
    "negative user": {"user_id": -1},
    "unknown category": {"category": "Gadgets"},
    "price zero": {"price": 0.0},
    "negative price": {"price": -1.0},
    "purchase without price": {**PURCHASE, "price": None},
    "purchase without product": {**PURCHASE, "product_id": None},
    "purchase without category": {**PURCHASE, "category": None},
}
KEPT = {
    "plain view": {},
    "view with a price": {"price": 0.01},
    "view with a category": {"category": "Food"},
    "purchase": PURCHASE,
    "mobile login": {"event_type": "login", "source": "mobile"},
}


@pytest.mark.parametrize("name", REJECTED)
def test_rejects(events, name):
    assert silver.clean_events(events(REJECTED[name])).isEmpty()


@pytest.mark.parametrize("name", KEPT)
def test_keeps(events, name):
    assert silver.clean_events(events(KEPT[name])).count() == 1


def test_null_rules_count_as_broken(events):
    broken = silver.reject_counts(events({"event_type": None, "user_id": None})).filter("rejected > 0")
    assert {r["rule"] for r in broken.collect()} == {
        "required_fields", "event_type", "user_id", "purchase_complete"
    }


def test_first_arrival_is_kept(events):
    df = events(
        {"event_id": "a", "page": "/late", "ingestion_timestamp": at(5)},
        {"event_id": "a", "page": "/early", "ingestion_timestamp": at(1)},
        {"event_id": "a", "page": "/later", "ingestion_timestamp": at(9)},
        {"event_id": "b", "page": "/only"},
    )
    kept = {r["event_id"]: r["page"] for r in silver.dedupe_first(df).collect()}
    assert kept == {"a": "/early", "b": "/only"}


def test_ties_do_not_depend_on_partitioning(events):
    rows = [{"event_id": "a", "page": f"/{n}"} for n in range(50)]
    df = events(*rows)
    answers = {
        silver.dedupe_first(df.repartition(n, F.rand(n))).first()["page"] for n in (1, 3, 7)
    }
    assert answers == {"/0"}


def test_hot_key_is_cut_before_the_shuffle(events):
    plan = silver.dedupe_first(events({})) ._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_exchange


def test_silver_is_idempotent(events):
    df = events({"event_id": "a"}, {"event_id": "a", "ingestion_timestamp": at(3)}, PURCHASE, {"user_id": 0})
    once = silver.silver(df)
    assert sorted(once.collect()) == sorted(silver.silver(once).collect())


def test_clean_report(events):
    df = events(
        {"event_id": "a"}, {"event_id": "a"}, {"event_id": "b", "user_id": 0}, {"event_id": "c"},
        {"event_id": "d", "event_timestamp": None},
    )
    row = silver.clean_report(df).first()
    assert (row["rows_read"], row["rows_kept"], row["rows_dropped"], row["rows_undated"]) == (5, 2, 3, 1)


def test_merge_equals_rebuild(events):
    first = events({"event_id": "a", "ingestion_timestamp": at(5)}, {"event_id": "b"})
    second = events(
        {"event_id": "a", "page": "/earlier", "ingestion_timestamp": at(1)}, {"event_id": "c", "user_id": 0},
        {"event_id": "d", "ingestion_timestamp": at(2)},
    )
    merged = silver.merge_silver(silver.silver(first), second)
    rebuilt = silver.silver(first.unionByName(second))
    assert sorted(merged.collect()) == sorted(rebuilt.collect())
    assert {r["event_id"]: r["page"] for r in merged.collect()}["a"] == "/earlier"


def test_latest_by_key(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 3, 30), ("a", 2, 20), ("b", 1, 5)], "k string, v int, x int")
    assert {r["k"]: r["x"] for r in latest_by_key(df, ["k"], "v").collect()} == {"a": 30, "b": 5}


def raw(spark, *values):
    return spark.createDataFrame([(v, at(7)) for v in values], "value string, timestamp timestamp")


def test_parse_survives_dirty_records(spark):
    good = (
        '{"event_id":"x","user_id":42,"event_type":"purchase","timestamp":"2024-01-01T12:00:00.000000+00:00",'
        '"source":"web","session_id":"s","page":"/checkout","price":129.5,"category":"Electronics","product_id":"P"}'
    )
    bad_user = good.replace("42", '"x"').replace('"event_id":"x"', '"event_id":"y"')
    bad_time = good.replace("2024-01-01T12:00:00.000000+00:00", "soon").replace('"event_id":"x"', '"event_id":"z"')
    bad_price = good.replace("129.5", '"free"').replace('"event_id":"x"', '"event_id":"w"')
    rows = {r["event_id"]: r for r in parse_events(raw(spark, good, bad_user, bad_time, bad_price, "not json")).collect()}
    assert rows["x"]["price"] == 129.5 and rows["x"]["user_id"] == 42
    assert str(rows["x"]["event_timestamp"]) == "2024-01-01 12:00:00" and str(rows["x"]["event_date"]) == "2024-01-01"
    assert rows["y"]["user_id"] is None and rows["y"]["price"] == 129.5
    assert rows["z"]["event_timestamp"] is None and rows["z"]["event_date"] is None
    assert rows["w"]["price"] is None and rows["w"]["category"] == "Electronics"
    assert all(rows[None][c] is None for c in ("user_id", "event_type", "price"))


def test_parse_without_record_time(spark):
    columns = parse_events(raw(spark, "{}"), with_ingestion=False).columns
    assert "ingestion_timestamp" not in columns and "event_date" not in columns


def test_json_round_trip(events):
    df = events(PURCHASE, {"page": None})
    back = parse_events(to_json_records(df)).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_duplicate_keys(events):
    rows = silver.duplicate_keys(events({"event_id": "a"}, {"event_id": "a"}, {}), ["event_id"]).collect()
    assert [(r["event_id"], r["count"]) for r in rows] == [("a", 2)]
