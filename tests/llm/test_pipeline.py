import duckdb
import pytest

import corpus_pipeline
from eventlake.llm.expected import SOURCE_MIX
from eventlake.llm.quality import QualityConfig
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def expected(docs, trusted, items):
    """The rows of each stage, one document after another; `docs` is a pandas frame."""
    rows = docs.to_dict("records")
    stages = []
    cfg = QualityConfig()
    listed = [(r["doc_id"], r["text"]) for r in rows]
    good = [
        r for r, mean in zip(rows, brute.mean_ratios(listed, trusted, cfg))
        if not brute.base_measures(r["text"])[5] and mean >= cfg.min_mean_llr
    ]
    stages.append(good)
    roots = brute.components([brute.fingerprint(r["text"]) for r in good])
    least = {}
    for r, root in zip(good, roots):
        least[root] = min(r["doc_id"], least.get(root, r["doc_id"]))
    single = [r for r, root in zip(good, roots) if r["doc_id"] == least[root]]
    stages.append(single)
    windows = brute.windows_of(items)
    clean = [r for r in single if not brute.leaks(r["text"], windows)[4]]
    stages.append(clean)
    con = duckdb.connect()
    con.register("documents", docs[docs.doc_id.isin([r["doc_id"] for r in clean])])
    times = {}
    for doc_id, _, copies, *_ in con.execute(SOURCE_MIX).fetchall():
        times[doc_id] = times.get(doc_id, 0) + copies
    mixed = [r for r in clean for _ in range(times[r["doc_id"]])]
    stages.append(mixed)
    from tests.llm.test_tokens import library_once

    stages.append(brute.token_rows(sorted((r["doc_id"], r["text"]) for r in mixed), library_once()))
    return stages


def test_against_brute_force(spark):
    docs, labels, benchmark = (spark.read.parquet(f"{SMALL}/{t}.parquet").toPandas() for t in ("documents", "labels", "benchmark"))
    want = expected(docs, set(labels[labels.quality == 1].doc_id), list(zip(benchmark.item_id, benchmark.text)))
    assert len(docs) > len(want[0]) > len(want[1]) > len(want[2]) > 0 and len(want[3]) >= len(want[2])
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    for (name, stage), rows in zip(corpus_pipeline.STAGES[:-1], want):
        frame = spark.createDataFrame(stage(spark, frame, SMALL).collect(), frame.schema)
        assert frame.columns == COLUMNS
        assert sorted(r.doc_id for r in frame.collect()) == sorted(r["doc_id"] for r in rows), name
    result = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, result.collect()), key=lambda r: r[1]) == want[-1]


def test_every_query_of_the_pipeline_is_registered(spark):
    import __spark_entry__

    assert {"pipeline"} < set(__spark_entry__.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in __spark_entry__.queries() if n.startswith("op")) == list(range(1, 14))


@pytest.mark.parametrize("number", range(4))
def test_stages_take_hard_rows(spark, hard_docs, clashing, number):
    docs = clashing(hard_docs)
    out = corpus_pipeline.STAGES[number][1](spark, docs, SMALL)
    assert out.columns == docs.columns
    assert out.count() <= 2 * docs.count()
    empty = corpus_pipeline.STAGES[number][1](spark, docs.limit(0), SMALL)
    assert empty.columns == docs.columns and empty.count() == 0
