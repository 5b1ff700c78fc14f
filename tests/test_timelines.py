"""Sessions and long windows against brute force, with one user that makes most of the events."""

import random
from collections import defaultdict
from datetime import timedelta
from statistics import mean, stdev

import pytest
from pyspark.sql import functions as F

from eventlake.config import SessionConfig
from eventlake.operators import baselines, features, purchases, sessions
from eventlake.operators.timeline import over_previous_rows, over_trailing_range
from tests.conftest import PURCHASE, at


def skewed_rows(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        user = 1 if rng.random() < 0.6 else rng.randint(2, 6)
        kind = rng.choices(["view", "add_to_cart", "purchase", "logout"], [6, 2, 2, 2])[0]
        # Coarse times make many ties, also of a logout with other events.
        when = at(rng.randint(0, 600), seconds=rng.choice([0, 0, 30]))
        extra = PURCHASE if kind == "purchase" else {}
        rows.append({"user_id": user, **extra, "event_type": kind, "event_timestamp": when})
    return rows


def brute_sessions(rows, gap):
    """(user, start) -> (end, events, logged out), walking each user's instants in order."""
    per_user = defaultdict(lambda: defaultdict(list))
    for r in rows:
        per_user[r["user_id"]][r["event_timestamp"]].append(r["event_type"])
    out = {}
    for user, instants in per_user.items():
        start, last, closed = None, None, False
        for when in sorted(instants):
            if last is None or closed or when > last + gap:
                start = when
                out[user, start] = [when, 0, False]
            entry = out[user, start]
            entry[0] = when
            entry[1] += len(instants[when])
            closed = "logout" in instants[when]
            entry[2] = entry[2] or closed
            last = when
    return {k: tuple(v) for k, v in out.items()}


@pytest.mark.parametrize("seed,gap,chunk", [(1, 30, "minute"), (2, 5, "minute"), (3, 5, "second"), (4, 1, "minute")])
def test_sessions_match_brute_force(events, seed, gap, chunk):
    rows = skewed_rows(seed)
    got = sessions.sessions(events(*rows), SessionConfig(gap=f"{gap} minutes", chunk=chunk)).collect()
    found = {
        (r["user_id"], r["session_start"]): (r["session_end"], r["events"], r["logged_out"])
        for r in got
    }
    assert found == brute_sessions(rows, timedelta(minutes=gap))


def test_labels_agree_with_sessions(events):
    df = events(*skewed_rows(5))
    cfg = SessionConfig(gap="10 minutes")
    labelled = sessions.assign_sessions(df, cfg)
    assert labelled.count() == df.count()
    counts = {(r[0], r[1]): r[2] for r in labelled.groupBy("user_id", "session_start").count().collect()}
    assert counts == {(r["user_id"], r["session_start"]): r["events"] for r in sessions.sessions(df, cfg).collect()}


def test_gap_is_inclusive_and_logout_closes(events):
    df = events(
        {"event_timestamp": at(0)}, {"event_timestamp": at(30)}, {"event_timestamp": at(60, micros=1)},
        {"event_timestamp": at(61), "event_type": "logout"}, {"event_timestamp": at(61, seconds=10)},
    )
    got = sessions.sessions(df).orderBy("session_start").collect()
    assert [(r["events"], r["logged_out"]) for r in got] == [(2, False), (2, True), (1, False)]


def test_gap_shorter_than_a_chunk_is_refused(events):
    with pytest.raises(ValueError):
        sessions.sessions(events({}), SessionConfig(gap="10 seconds"))


def test_many_logouts_in_one_minute(events):
    rows = [
        {"event_timestamp": at(0, seconds=n // 2, micros=n), "event_type": "logout" if n % 3 == 0 else "view"}
        for n in range(100)
    ]
    got = sessions.sessions(events(*rows)).collect()
    assert {
        (r["user_id"], r["session_start"]): (r["session_end"], r["events"], r["logged_out"]) for r in got
    } == brute_sessions([{"user_id": 1, **r} for r in rows], timedelta(minutes=30))


def test_trailing_range_matches_brute_force(spark):
    rng = random.Random(7)
    rows = [(1 if rng.random() < 0.5 else rng.randint(2, 4), at(rng.randint(0, 300), seconds=rng.randint(0, 59)), n)
            for n in range(300)]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz, n int")
    for include in (True, False):
        got = over_trailing_range(
            df, ["k"], "t", 600, {"c": lambda w: F.count("n").over(w)}, include_current=include
        )
        found = {r["n"]: r["c"] for r in got.collect()}
        for k, t, n in rows:
            want = sum(
                1 for k2, t2, _ in rows
                if k2 == k and t - timedelta(minutes=10) <= t2 and (t2 <= t if include else t2 < t)
            )
            assert found[n] == want


@pytest.mark.parametrize("block", [7, 13, 1000])
def test_previous_rows_match_brute_force(spark, block):
    rng = random.Random(3)
    times = sorted(rng.sample(range(0, 60 * 24 * 4), 90))
    values = [rng.random() for _ in times]
    df = spark.createDataFrame([(at(t), v) for t, v in zip(times, values)], "t timestamp_ntz, v double").repartition(5)
    got = over_previous_rows(
        df, "t", 5, {"m": lambda w: F.avg("v").over(w), "c": lambda w: F.count("v").over(w)}, block
    ).orderBy("t").collect()
    assert len(got) == len(times)
    for i, r in enumerate(got):
        before = values[max(0, i - 5) : i]
        assert r["c"] == len(before)
        assert (r["m"] is None) if not before else abs(r["m"] - mean(before)) < 1e-9


def test_a_frame_longer_than_a_block_is_refused(spark):
    df = spark.createDataFrame([(at(0), 1.0)], "t timestamp_ntz, v double")
    with pytest.raises(ValueError):
        over_previous_rows(df, "t", 12, {"c": lambda w: F.count("v").over(w)}, 5)


def test_baseline_anomalies_use_full_baselines(spark):
    from tests.test_detectors import QUIET, SCHEMA

    levels = [1500 + (i % 3) for i in range(12)] + [1600, 1501]
    rows = [(at(5 * i), at(5 * i + 5), *{**QUIET, "total_events": n}.values()) for i, n in enumerate(levels)]
    found = baselines.baseline_anomalies(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r["window_start"], r["anomaly_type"], r["severity"]) for r in found] == [
        (at(60), "traffic_spike", "critical")
    ]
    base = levels[:12]
    assert abs(found[0]["deviation"] - (1600 - mean(base)) / stdev(base)) < 1e-9


def test_revenue_below_daily_average(spark):
    rows = [(at(i), 100.0) for i in range(10)] + [(at(10), 79.0), (at(11), 81.0)]
    df = spark.createDataFrame(rows, "window_start timestamp_ntz, revenue double")
    assert [r["window_start"] for r in baselines.revenue_below_daily_average(df).collect()] == [at(10)]


def test_bursts_span_chunks(events):
    df = events(*[{**PURCHASE, "event_timestamp": at(m)} for m in (8, 9, 11, 40)])
    found = purchases.purchase_bursts(df, 600, 3).collect()
    assert [(r["event_timestamp"], r["recent_purchases"]) for r in found] == [(at(11), 3)]


def test_dense_ids(spark):
    df = spark.createDataFrame([(f"p{i % 500}",) for i in range(2000)], "p string")
    ids = sorted(r["n"] for r in features.dense_ids(df, "p", "n", buckets=16).collect())
    assert ids == list(range(500))


def test_duration_outliers(events):
    rows = []
    for user in range(1, 40):
        rows += [{"user_id": user, "event_timestamp": at(0)}, {"user_id": user, "event_timestamp": at(5)}]
    rows += [{"user_id": 99, "event_timestamp": at(m)} for m in range(0, 200, 20)]
    found = sessions.session_duration_anomalies(sessions.sessions(events(*rows))).collect()
    assert [(r["user_id"], r["kind"]) for r in found] == [(99, "too_long")]
