import pytest

from eventlake.llm import decontaminate
from eventlake.llm.decontaminate import DecontaminationConfig
from tests.llm import brute

ITEM = "The quick brown fox jumps over the lazy dog while seven wizards watch quietly from afar"
ITEMS = [
    (1, ITEM), (2, "Ünïcode wörds, only four"), (3, None), (4, "... !!"), (10, ITEM.upper()),
    (None, "an item without any id has words too but is not listed at all"), (5, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"),
]


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


def texts():
    words = ITEM.split()
    return [
        ITEM, "before " + ITEM + " after", ", ".join(words[:10]) + ".", " ".join(words[:9]), "xThe " + " ".join(words[1:11]),
        "ünïcode", "Some ünïcode wörds only four, here", "ÜNÏCODE WÖRDS only four", " ".join(words * 3),
        "an item without any id has words too but is not listed at all", " ".join(f"w{i}" for i in range(40)),
        "the\x00quick\x7fbrown@fox`jumps{over[the|lazy dog while", None, "", "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 the quick",
    ]


@pytest.mark.parametrize("block_bytes", [4 << 20, 150])
def test_against_brute_force(documents, benchmark, block_bytes):
    listed = list(enumerate(texts())) + [(None, ITEM), (0, ITEM)]
    report = decontaminate.leak_report(documents(*listed), benchmark, DecontaminationConfig(block_bytes=block_bytes))
    windows = brute.windows_of(ITEMS)
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    got = sorted((tuple(r[c] for c in columns) for r in report.collect()), key=repr)
    assert got == sorted(((i, *brute.leaks(t, windows)) for i, t in listed), key=repr)


def test_spans_of_the_original(documents, benchmark):
    text = f"À début: {ITEM}! Fin; ünïcode WÖRDS only four."
    (row,) = decontaminate.leak_report(documents((1, text)), benchmark).collect()
    assert [text[s.start : s.end] for s in row.spans] == [ITEM, "ünïcode WÖRDS only four"] or row.n_items == 2


def test_clean_documents_stay(hard_docs, benchmark, clashing, documents):
    docs = clashing(hard_docs.unionByName(documents((50, ITEM))))
    kept = decontaminate.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, docs.where("doc_id IS NULL OR doc_id <> 50").collect()))


def test_empty_tables(documents, benchmark, spark):
    assert decontaminate.leak_report(documents(), benchmark).count() == 0
    none = spark.createDataFrame([], benchmark.schema)
    assert [r.contaminated for r in decontaminate.leak_report(documents((1, ITEM)), none).collect()] == [False]
