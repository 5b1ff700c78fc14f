import pytest
from pyspark.sql import functions as F

from eventlake.llm import merkle, queries
from eventlake.llm.merkle import MerkleConfig
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def audited(spark, docs, cfg=MerkleConfig()):
    values = [F.translate("text", queries.UPPER, queries.LOWER) if c == "text" else F.col(c) for c in cfg.fields]
    false = (F.crc32(F.col("doc_id").cast("string")) % 3 == 0) & F.col("text").isNotNull()
    manifest = merkle.write_manifest(docs, {"claim": F.when(false, merkle.leaf_digest(*values))}, cfg)
    return sorted((tuple(r) for r in merkle.audit(spark, manifest, "claim").collect()), key=repr)


def rows_of(*sizes):
    """Documents of several languages, the first of which is NULL."""
    out = []
    for g, size in enumerate(sizes):
        lang = None if g == 0 else f"{'é' if g % 2 else 'z'}{g}"
        out += [(1000 * g + 7 * i % 911, f"s{i % 3}" if i % 5 else None, lang, i, f"Text {i} of {lang}") for i in range(size)]
    return out


@pytest.mark.parametrize("sizes", [(1,), (0, 1), (1, 1), (8,), (9,), (64, 65), (3, 513, 8, 1, 130), tuple(range(20))])
def test_against_brute_force(spark, sizes):
    listed = rows_of(*sizes)
    assert audited(spark, spark.createDataFrame(listed, DOCS).repartition(5)) == sorted(brute.merkle_rows(listed), key=repr)


def test_strides_give_one_root(spark):
    docs = spark.createDataFrame(rows_of(5, 600), DOCS)
    assert audited(spark, docs) == audited(spark, docs, MerkleConfig(stride=1)) == audited(spark, docs, MerkleConfig(stride=3))


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()
    rows = queries.QUERIES["op13_merkle_manifest"](spark, SMALL).collect()
    assert sorted(map(tuple, rows)) == sorted(brute.merkle_rows(list(map(tuple, docs))))
    assert 0.5 < sum(r.verified for r in rows) / len(rows) < 0.9


def test_hard_documents(spark, hard_docs, clashing):
    docs = clashing(hard_docs).selectExpr("* EXCEPT (lang)", "IF(doc_id % 2 = 0, lang, NULL) AS lang", "'mine' AS idx", "'mine' AS digest")
    listed = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert audited(spark, docs) == sorted(brute.merkle_rows(listed), key=repr)


def test_proofs_fold_to_the_root(spark):
    docs = spark.createDataFrame(rows_of(70, 3, 9), DOCS)
    manifest = merkle.write_manifest(docs)
    rows = merkle.proofs(spark, manifest).collect()
    assert len(rows) == 82 and len({r.root for r in rows}) == 1 and len({r.subroot for r in rows}) == 3
    for r in rows:
        path = [(s.left, s.right) for s in r.path]
        assert merkle.fold(r.leaf, path) == r.root != merkle.fold(merkle.digest("other"), path)


def test_stored_levels_only(spark):
    manifest = merkle.write_manifest(spark.createDataFrame(rows_of(0, 5000), DOCS))
    assert [spark.read.parquet(t).count() for t in manifest.groups] == [5000, 79, 2, 1]


def test_empty_table(spark):
    assert audited(spark, spark.createDataFrame([], DOCS)) == []
