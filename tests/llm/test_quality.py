from eventlake.llm import quality
from eventlake.llm.quality import QualityConfig
from tests.llm import brute

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select("doc.doc_id", "doc.text", *columns).collect()), key=repr)


def test_base_measures(hard_docs, hard_rows, spark):
    none = spark.createDataFrame([], "doc_id bigint")
    got = rows(quality.assess(hard_docs, none), *BASE, "mean_llr")
    assert got == sorted(((i, t, *brute.base_measures(t), 0) for i, t, _ in hard_rows), key=repr)


def test_repeats_inside_a_text(documents, spark):
    words = " ".join(f"w{i}" for i in range(30))
    texts = [words, f"{words} {words}", "a " * 40, f"x {words} y {words} z", "#a# *b*\n\n#a# *b*\n \n#a# *b*", words + " " + " ".join(words.split()[3:12])]
    docs = documents(*enumerate(texts))
    got = rows(quality.assess(docs, spark.createDataFrame([], "doc_id bigint")), *BASE)
    assert got == sorted(((i, t, *brute.base_measures(t)) for i, t in enumerate(texts)), key=repr)


def test_ratio_and_verdict(documents, spark):
    good = " ".join(f"good{i % 17}" for i in range(60))
    bad = " ".join(f"bad{i * i % 23}" for i in range(60))
    listed = [(i, good + f" end{i}") for i in range(6)] + [(i, bad + f" end{i}") for i in range(6, 12)] + [(12, good), (None, bad)]
    docs = documents(*listed)
    trusted = spark.createDataFrame([(i,) for i in (0, 1, 2, 2, None)], "doc_id bigint")
    cfg = QualityConfig(buckets=512, max_repeat_percent=100)
    got = rows(quality.assess(docs, trusted, cfg), "mean_llr", "kept")
    want = brute.mean_ratios(listed, {0, 1, 2}, cfg)
    assert got == sorted(((i, t, m, m >= cfg.min_mean_llr) for (i, t), m in zip(listed, want)), key=repr)
    assert {i for i, _, _, kept in got if kept} == {0, 1, 2, 3, 4, 5, 12}


def test_kept_rows_have_their_columns(documents, clashing, spark):
    docs = clashing(documents((1, " ".join(f"w{i}" for i in range(25))), (2, "too short")))
    kept = quality.keep_good(docs, spark.createDataFrame([], "doc_id bigint"))
    assert kept.columns == docs.columns
    assert [(r.doc_id, r.kept) for r in kept.collect()] == [(1, "mine")]


def test_empty_table(documents, spark):
    assert quality.assess(documents(), spark.createDataFrame([], "doc_id bigint")).count() == 0


def test_trust_is_looked_up_without_a_sort_of_texts(documents, spark):
    listed = [(1, "a b c d"), (1, "a b c d"), (1, "e f"), (2, "a x y"), (None, "b c"), (3, None), (4, "c d e f a")]
    trusted = spark.createDataFrame([(1,), (1,), (3,), (None,), (9,)], "doc_id bigint")
    docs, cfg = documents(*listed), QualityConfig(buckets=64)
    plan = quality.log_ratios(docs, trusted, cfg)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Broadcast" not in plan
    want = brute.mean_ratios(listed, {1, 3}, cfg)
    assert rows(quality.assess(docs, trusted, cfg), "mean_llr") == sorted(((i, t, m) for (i, t), m in zip(listed, want)), key=repr)
