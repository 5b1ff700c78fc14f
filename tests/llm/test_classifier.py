import zlib

import numpy as np

from eventlake.llm import classifier
from eventlake.llm.factorization import Machine, MachineConfig, Rows, fit

SMALL = "/root/testdata/sf0.01"


def test_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    machine = Machine(0.3, rng.normal(size=30), rng.normal(size=(30, 4)))
    rows = [(rng.choice(30, n, replace=False), rng.normal(size=n)) for n in (1, 5, 12)]
    got, _ = machine.sums(Rows.of(rows))
    for (index, value), score in zip(rows, got):
        pairs = sum(machine.factors[a] @ machine.factors[b] * x * y for i, (a, x) in enumerate(zip(index, value)) for b, y in list(zip(index, value))[i + 1 :])
        assert np.isclose(score, 0.3 + machine.linear[index] @ value + pairs)


def test_learns_a_pair():
    """Neither word decides alone; only the two together do."""
    rng = np.random.default_rng(2)
    bits = rng.integers(0, 2, (3000, 2))
    rows = [(np.array([a, 2 + b]), np.ones(2)) for a, b in bits]
    labels = (bits[:, 0] ^ bits[:, 1]).astype(float)
    machine = fit(Rows.of(rows), labels, MachineConfig(4, epochs=30, rate=0.2))
    assert ((machine.probabilities(Rows.of(rows)) >= 0.5) == labels).mean() > 0.99


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    rows = classifier.quality_scores(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert np.mean([r.score >= 0.7 for r in held if r.quality == 1]) > 0.95


def test_only_text_and_metadata_count(hard_docs, clashing, spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(5, 0, 0), (None, 1, 0), (6, None, 0)], "doc_id bigint, quality int, toxic int")
    docs = clashing(hard_docs)
    one = classifier.quality_scores(docs, labels)
    other = classifier.scored(docs.selectExpr("* EXCEPT (lang, source)", "'xx' AS lang", "'other' AS source"), labels, ["doc_id"])
    assert one.count() == docs.count()
    assert sorted((str(r.doc_id), r.score) for r in one.collect()) == sorted((str(r.doc.doc_id), r.score) for r in other.collect())
    assert all(0 <= r.score <= 1 and not (r.doc_id is None and r.held_out) for r in one.collect())


def test_without_labels_or_rows(documents, spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert [r.score for r in classifier.quality_scores(documents((1, "a"), (2, None)), none).collect()] == [0.5, 0.5]
    assert classifier.quality_scores(documents(), none).count() == 0
