import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventlake.llm import simhash
from eventlake.llm.common import BATCH_ROWS, written
from eventlake.llm.components import connected_components
from eventlake.llm.simhash import SimhashConfig
from tests.llm import brute


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def want(listed):
    prints = [brute.fingerprint(t) for _, t in listed]
    root = brute.components(prints)
    least = {}
    for (i, _), r in zip(listed, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return sorted(((i, signed(p), least.get(r)) for (i, _), p, r in zip(listed, prints, root)), key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_hard_documents(hard_docs, hard_rows):
    assert got(simhash.near_duplicates(hard_docs)) == want([r[:2] for r in hard_rows])


def test_near_copies(documents):
    rng = random.Random(4)
    base = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(40)) for _ in range(300)) for _ in range(6)]
    listed = [(i, base[i % 6]) for i in range(12)]
    for i in range(12, 60):
        words = base[i % 6].split()
        words[rng.randrange(300)] = "changed"
        listed.append((i, " ".join(words)))
    result = got(simhash.near_duplicates(documents(*listed)))
    assert result == want(listed)
    assert len({c for _, _, c in result}) < 60


@pytest.mark.parametrize("limit", [0, 2, 1000])
def test_links_of_crowded_blocks_connect_all_close_pairs(spark, limit):
    rng = random.Random(limit)
    centers = [rng.getrandbits(64) for _ in range(4)]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for c in centers for _ in range(60)}
    prints |= {c ^ sum(1 << b for b in rng.sample(range(8), rng.randrange(4))) for c in centers for _ in range(60)}
    prints = sorted(prints)
    frame = spark.createDataFrame([(signed(p),) for p in prints], "print bigint")
    links = simhash.close_links(frame, SimhashConfig(pair_limit=limit))
    assert links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 2).count() == 0
    roots = {r.node: r.root for r in connected_components(links).collect()}
    groups = {}
    for p, r in zip(prints, brute.components(prints)):
        groups.setdefault(r, set()).add(signed(p))
    assert {p: roots.get(p, p) for g in groups.values() for p in g} == {p: min(g) for g in groups.values() for p in g}


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    roots = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert roots == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_one_of_each_group_stays(hard_docs, hard_rows, clashing):
    docs = clashing(hard_docs)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    prints = [brute.fingerprint(t) for _, t, _ in hard_rows]
    roots = brute.components(prints)
    rows = kept.collect()
    assert len(rows) == len(set(roots))
    place = {(i, t): r for (i, t, _), r in zip(hard_rows, roots)}
    assert {place[r.doc_id, r.text] for r in rows} == set(roots)
    least = {}
    for (i, _, _), r in zip(hard_rows, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    assert all(r.doc_id == least.get(place[r.doc_id, r.text]) for r in rows)


def test_empty_table(documents):
    assert simhash.near_duplicates(documents()).count() == 0
    assert simhash.keep_one(documents()).count() == 0


def test_texts_are_sorted_only_where_rows_return(documents):
    docs = documents((1, "one two three four"), (2, "five six seven eight"), (2, "five six seven eight"), (None, "nine ten"), (None, "nine ten"))
    kept = simhash.keep_one(docs)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
    assert got(kept.select("doc_id", "text")) == [(1, "one two three four"), (2, "five six seven eight"), (None, "nine ten")]


def test_written_tables_hand_texts_over_in_small_batches(spark, tmp_path):
    before = spark.conf.get(BATCH_ROWS)
    sizes = spark.range(5_000, numPartitions=1).mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"]) for b in batches), "n bigint")
    assert max(r.n for r in written(sizes, str(tmp_path), "sizes").collect()) <= 1_000
    assert spark.conf.get(BATCH_ROWS) == before
