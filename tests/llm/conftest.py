import pytest

from eventlake.llm.common import ship

LONG = "Sphinx of black quartz judge my vow " * 6_000

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source)."""

    def build(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return build


@pytest.fixture
def hard_rows():
    """NULLs in all columns, empty, blank and very long texts, repeated rows, one id with two texts."""
    return [
        (None, None, None), (None, "nobody knows who wrote these few words down here", "src0"), (1, None, "src1"), (2, "", "src1"),
        (3, " \t\n ", None), (4, "a b c d e f g h i j k l m n o p q r s t u v w x y z", "src0"),
        (5, LONG, "src0"), (6, LONG, "src0"), (7, "again and again the same row", "src2"), (7, "again and again the same row", "src2"),
        (8, "first text of eight", "src2"), (8, "second text of eight", "src2"), (9, "ÀÉÎ öü ß 日本 \U0001f600 naïve", "src1"),
        (10, "x" * 5_000, "src3"), (11, "one line is here for all\none line is here for all\nanother", "src3"),
    ]


@pytest.fixture
def hard_docs(documents, hard_rows):
    return documents(*hard_rows)


#: Names that the operators use themselves.
CLASHES = (
    "doc", "kept", "n_words", "content", "_content", "text_md5", "print", "root", "found", "hits", "rank", "spans", "key", "epoch", "score",
    "hashes", "mean_llr", "units", "times", "id", "hash",
)


@pytest.fixture
def clashing(spark):
    """Adds columns whose names clash with those of the operators."""

    def add(df):
        return df.selectExpr("*", *[f"'mine' AS `{n}`" for n in CLASHES if n not in df.columns])

    return add
