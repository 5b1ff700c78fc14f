"""Quality rules: base measures of a text and a likelihood ratio between trusted and raw text.

The n-grams of a document (single words and pairs of neighbours, hashed into a fixed number of
buckets) are scored with the log of the ratio between two multinomials: one counted over the
trusted documents, one over all documents. The mean per n-gram decides, so that long and short
documents stand on one scale. Log ratios are kept as whole millionths; sums are exact and the
verdict of a document does not depend on the order of tasks.

Everything is a DataFrame expression. The counts are one aggregate over all documents whose result
has at most `buckets` rows; the table of ratios is a scalar subquery of that fixed size.

Defined cases: a NULL or blank text has no words and fails the base rules. Repeated rows are
judged alike and each of them counts. A document is trusted if any row of the trusted ids has its
id; a NULL id is never trusted. Without trusted documents all ratios are 0 and only the base rules decide.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import SPACE, bind, packed, unpacked, words_of


@dataclass(frozen=True)
class QualityConfig:
    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    buckets: int = 1 << 14
    smoothing: float = 0.5
    #: Smallest mean log ratio per n-gram, in millionths of a nat.
    min_mean_llr: int = -100_000


MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "mean_llr", "kept",
)


def dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return bind(lines, lambda a: F.size(a) - F.size(F.array_distinct(a)))


def repeat_words(hashes: Column, window: int) -> Column:
    """Words inside windows that occur twice or more, from the hashes of the words.

    Windows are compared by 64-bit hashes. Only a text with equal windows pays for the sort, which
    puts equal windows side by side; the words they cover are summed over their sorted places.
    """
    places = F.sequence(F.lit(0), F.size(hashes) - window)
    keys = F.transform(places, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)]))

    def covered(sorted_keys: Column) -> Column:
        def repeated(item: Column, i: Column) -> Column:
            before, after = F.get(sorted_keys, i - 1), F.get(sorted_keys, i + 1)
            same = (F.coalesce(before["key"] == item["key"], F.lit(False)), F.coalesce(after["key"] == item["key"], F.lit(False)))
            return same[0] | same[1]

        starts = F.sort_array(F.transform(F.filter(sorted_keys, repeated), lambda item: item["place"]))
        return bind(
            starts,
            lambda s: F.aggregate(
                F.transform(s, lambda p, i: F.least(F.lit(window), F.coalesce(F.get(s, i + 1) - p, F.lit(window)))),
                F.lit(0), lambda total, n: total + n,
            ),
        )

    def counted(k: Column) -> Column:
        pairs = F.sort_array(F.transform(k, lambda key, i: F.struct(key.alias("key"), i.alias("place"))))
        return F.when(F.size(F.array_distinct(k)) < F.size(k), bind(pairs, covered)).otherwise(0)

    return F.when(F.size(hashes) > window, bind(keys, counted)).otherwise(0)


def ngram_buckets(hashes: Column, buckets: int) -> Column:
    """Buckets, counted from 1, of all words and of all pairs of neighbours."""
    count = F.lit(buckets).cast("bigint")
    single = F.transform(hashes, lambda h: F.pmod(h, count).cast("int") + 1)
    pairs = F.transform(
        F.sequence(F.lit(1), F.size(hashes) - 1),
        lambda i: F.pmod(F.xxhash64(F.get(hashes, i - 1), F.get(hashes, i)), count).cast("int") + 1,
    )
    return F.when(F.size(hashes) > 1, F.concat(single, pairs)).otherwise(single)


def word_hashes(text: Column) -> Column:
    return F.transform(words_of(text), lambda w: F.xxhash64(w))


def log_ratios(docs: DataFrame, trusted_ids: DataFrame, cfg: QualityConfig) -> DataFrame:
    """One row with an array of `buckets` whole millionths: log of trusted share over raw share."""
    trusted = trusted_ids.select(F.col(trusted_ids.columns[0]).alias("trusted_id")).where("trusted_id IS NOT NULL").distinct()
    # The trusted ids grow with the corpus: never broadcast them, and have one plan at every size. Each task looks
    # its rows up among the trusted ids of its own partition, so that no text is sorted or kept.
    marked = docs.select("doc_id", "text").join(trusted.hint("shuffle_hash"), F.col("doc_id") == F.col("trusted_id"), "left")
    counts = (
        marked.select(F.col("trusted_id").isNotNull().alias("trusted"), word_hashes(F.col("text")).alias("hashes"))
        .select("trusted", F.explode(ngram_buckets(F.col("hashes"), cfg.buckets)).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.count_if("trusted").alias("good"))
    )
    listed = counts.agg(
        F.sum("raw").alias("all_raw"), F.sum("good").alias("all_good"),
        F.map_from_entries(F.collect_list(F.struct("bucket", F.struct("raw", "good")))).alias("by_bucket"),
    )
    spread = cfg.smoothing * cfg.buckets

    def ratio(bucket: Column) -> Column:
        n = F.element_at("by_bucket", bucket)
        good = (F.coalesce(n["good"], F.lit(0)) + cfg.smoothing) / (F.col("all_good") + spread)
        raw = (F.coalesce(n["raw"], F.lit(0)) + cfg.smoothing) / (F.col("all_raw") + spread)
        return F.when(F.coalesce(F.col("all_good"), F.lit(0)) == 0, F.lit(0)).otherwise(
            F.round(F.log(good / raw) * 1e6)
        ).cast("bigint")

    return listed.select(F.transform(F.sequence(F.lit(1), F.lit(cfg.buckets)), ratio).alias("ratios"))


def assess(docs: DataFrame, trusted_ids: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """`doc` (the row as a struct) and the measures of each document."""
    # `buckets` numbers, whatever the input; Spark folds the expression into one constant array.
    ratios = log_ratios(docs, trusted_ids, cfg).select(F.array_join("ratios", ",")).first()[0]
    table = F.split(F.lit(ratios), ",").cast("array<bigint>")
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    base = packed(docs).select("doc", word_hashes(text).alias("hashes"))
    total = F.aggregate(
        ngram_buckets(F.col("hashes"), cfg.buckets),
        F.lit(0).cast("bigint"),
        lambda sum_, bucket: sum_ + F.element_at(table, bucket),
    )
    n_words = F.size("hashes")
    measured = base.select(
        "doc",
        n_words.cast("bigint").alias("n_words"),
        F.length(F.regexp_replace(text, SPACE, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("bigint").alias("n_symbols"),
        dup_lines(text).cast("bigint").alias("n_dup_lines"),
        repeat_words(F.col("hashes"), cfg.window).cast("bigint").alias("n_repeat_words"),
        F.floor(total / F.greatest(2 * n_words - 1, F.lit(1))).cast("bigint").alias("mean_llr"),
        F.monotonically_increasing_id().alias("row"),
    )
    failed = (F.col("n_words") < cfg.min_words) | (
        100 * F.col("n_repeat_words") > cfg.max_repeat_percent * F.col("n_words")
    )
    # `row` has no say in the verdict, but Spark pushes no filter below a column that is not deterministic. Else a
    # filter on `kept` would copy the measures into itself and hash a text once for each of its words.
    kept = ~F.col("base_failed") & (F.col("mean_llr") >= cfg.min_mean_llr) & (F.col("row") >= 0)
    return measured.withColumn("base_failed", failed).withColumn("kept", kept)


def keep_good(docs: DataFrame, trusted_ids: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """The documents whose verdict is to be kept, with their own columns."""
    return unpacked(assess(docs, trusted_ids, cfg).where("kept"), docs.columns)
