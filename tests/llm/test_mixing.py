import duckdb
import pytest

from eventlake.llm import mixing
from eventlake.llm.expected import SOURCE_MIX
from eventlake.llm.mixing import MixConfig


def corpus():
    listed = [(i, f"{'word ' * (5 + i % 7)}n{i}", "big") for i in range(300)]
    listed += [(1000 + i, f"{'word ' * (3 + i % 5)}n{i}", "middle") for i in range(60)]
    listed += [(2000 + i, f"word n{i}", "small") for i in range(20)] + [(3000, "one word", None), (None, "no id", "small")]
    return listed + [(4000, None, "blank"), (4001, "", "blank"), (0, listed[0][1], "big")]


def in_sql(documents):
    con = duckdb.connect()
    con.register("documents", documents.toPandas())
    return sorted(con.execute(SOURCE_MIX).fetchall(), key=repr)


def test_against_sql(documents):
    docs = documents(*[r for r in corpus() if r[0] is not None])
    got = mixing.placements(docs).select("doc_id", "source", "copies", "epoch", "start", "n_tokens").collect()
    assert sorted(map(tuple, got), key=repr) == in_sql(docs)


def test_every_document_at_least_once_and_small_sources_more_often(documents, clashing):
    docs = clashing(documents(*corpus()))
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    times = {}
    for r in mixed.collect():
        times[r.doc_id, r.source] = times.get((r.doc_id, r.source), 0) + 1
    assert set(times) == {(i, s) for i, _, s in corpus()}
    assert times[0, "big"] == 2  # two equal rows, once each
    assert all(times[i, "big"] == 1 for i in range(1, 300))
    assert max(times.values()) == 2


def test_places_follow_each_other(documents):
    rows = mixing.placements(documents(*corpus()), MixConfig(max_repetition=5.0)).collect()
    for source, epoch in {(r.source, r.epoch) for r in rows}:
        own = sorted((r.start, r.n_tokens) for r in rows if (r.source, r.epoch) == (source, epoch))
        at = 0
        for start, n in own:
            assert start == at
            at += n
    orders = {e: [r.doc_id for r in sorted((r for r in rows if r.source == "small" and r.epoch == e), key=lambda r: r.start)] for e in (0, 1)}
    assert sorted(orders[0], key=repr) != orders[0] and orders[0] != orders[1]


@pytest.mark.parametrize("budget", [100, 1_000, 20_000])
def test_budget(documents, budget):
    cfg = MixConfig(budget=budget, max_repetition=8.0)
    docs = documents(*corpus())
    plan = {r.key: r for r in mixing.source_plan(mixing.source_totals(mixing.slim(docs)), cfg).collect()}
    assert abs(sum(r.budget for r in plan.values()) - budget) <= len(plan)
    given = {}
    for r in mixing.placements(docs, cfg).collect():
        key = "n" if r.source is None else f"s{r.source}"
        given[key] = given.get(key, 0) + r.n_tokens
    for key, r in plan.items():
        assert r.budget - 24 < given.get(key, 0) <= r.budget  # only whole documents


@pytest.mark.parametrize("target", [0.5, 0.8, 0.95, 1.0])
def test_exponent(documents, target):
    totals = mixing.source_totals(mixing.slim(documents(*corpus())))
    from pyspark.sql import functions as F

    n = totals.agg(F.sum("tokens")).first()[0]
    shares = totals.withColumn("p", F.col("tokens") / n)
    a = mixing.exponent(shares, MixConfig(target_entropy=target, max_repetition=1e9))
    ends = mixing.at_exponents(shares, [0.0, a, min(1.0, a + 1e-6), 1.0])
    goal = target * ends[0.0][1]
    assert ends[1.0][1] >= goal - 1e-9 if a == 1.0 else ends[a][1] >= goal - 1e-8 >= ends[min(1.0, a + 1e-6)][1] - 1e-5


def test_empty_table(documents):
    assert mixing.placements(documents()).count() == 0
    assert mixing.mixed(documents((1, None, "a"))).count() == 1
