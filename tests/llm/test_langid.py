import zlib

import zstandard

from eventlake.llm import langid, queries
from eventlake.llm.langid import LanguageConfig, Model

SMALL = "/root/testdata/sf0.01"


def test_smallest_dictionary_wins():
    english, german = b"the water of the river was cold and the wind came from the north", b"das wasser des flusses war kalt und der wind kam aus dem norden"
    model = Model([("en", english), ("de", german)], LanguageConfig())
    sizes = {}
    for name, content in (("en", english), ("de", german)):
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        sizes[name] = len(zstandard.ZstdCompressor(level=5, dict_data=raw).compress(b"and the wind of the river"))
    assert sizes["en"] < sizes["de"]
    assert model.judge("AND the wind, of THE river!")[0] == "en" and model.judge("und der Wind aus dem Fluss")[0] == "de"


def test_equal_sizes_go_to_the_first():
    model = Model([("b", b"same words here"), ("a", b"same words here")], LanguageConfig())
    assert model.judge("something else") == ("b", 0.0)


def test_no_piece_is_left_out():
    model = Model([("en", b"the water of the river"), ("de", b"das wasser des flusses")], LanguageConfig())
    noise = " ".join(f"q{chr(97 + i % 26)}x{chr(97 + i * 7 % 26)}z" for i in range(3_000))
    assert model.judge(noise + " das wasser des flusses" * 3)[0] == "de"
    assert model.judge(noise + " the water of the river" * 3)[0] == "en"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = queries.QUERIES["op11_language_id"](spark, SMALL).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert {r.lang_pred for r in rows} <= {"en", "de", "fr", "es", "und"} and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.98
    sure = [r for r in held if r.accepted]
    assert len(sure) / len(held) > 0.9 and sum(r.lang_pred == r.lang for r in sure) / len(sure) > 0.985


def test_learns_from_its_share_only(spark):
    """Other labels of held-out documents, other ids of rows without a label and other sources change nothing."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(300)
    other = docs.selectExpr("doc_id", "text", "IF(crc32(CAST(doc_id AS STRING)) % 3 = 1, 'xx', lang) AS lang", "'other' AS source", "n_chars")
    one, two = (sorted((r.doc.doc_id, r.language, r.score) for r in langid.identified(d, ["doc_id"]).collect()) for d in (docs, other))
    assert one == two


def test_hard_documents(hard_docs, hard_rows, clashing):
    docs = clashing(hard_docs).selectExpr("*", "'mine' AS language", "1 AS turn", "'mine' AS excerpt", "2 AS n")
    rows = langid.identified(docs, ["doc_id"]).collect()
    assert sorted(str(r.doc.doc_id) for r in rows) == sorted(str(r[0]) for r in hard_rows)
    for r in rows:
        if r.doc.doc_id in (1, 2, 3):
            assert (r.language, r.score, r.accepted) == ("und", 0.0, False)
        elif r.doc.doc_id is not None:
            assert (r.language, r.score, r.accepted) == ("en", 1.0, True)  # the only language


def test_nothing_to_learn_from(spark, documents):
    docs = documents((1, "words"), (2, None)).selectExpr("* EXCEPT (lang)", "CAST(NULL AS STRING) AS lang")
    assert [(r.language, r.score) for r in langid.identified(docs, ["doc_id"]).collect()] == [("und", 0.0)] * 2
    assert langid.identified(documents(), ["doc_id"]).count() == 0


def test_bounds_of_the_sample(spark):
    rows = [(i, f"word{i} " * 50, f"l{i % 7}", "s", 1) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    cfg = LanguageConfig(max_languages=3, sample_docs=5, excerpt_chars=40, dictionary_bytes=100)
    drawn = langid.samples(docs, cfg)
    assert len(drawn) == 3 and all(0 < len(content) <= 100 for _, content in drawn)
