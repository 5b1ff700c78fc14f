"""The registered queries of the subpackage: thin digests over the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import classifier, decontaminate, extraction, langid, lines, merkle, mixing, periods, quality, simhash, substrings, tokens, urlfilter
from eventlake.llm.common import bind, read_tables, ship, words_of


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where("quality = 1").select("doc_id")


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    (docs,) = read_tables(spark, folder, "documents")
    return lines.removal_report(docs)


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = read_tables(spark, folder, "documents", "benchmark")
    return decontaminate.leak_report(docs, benchmark).drop("spans")


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read_tables(spark, folder, "documents", "labels")
    return classifier.quality_scores(docs, labels)


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    (docs,) = read_tables(spark, folder, "documents")
    return substrings.removal_report(docs)


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    (docs,) = read_tables(spark, folder, "documents")
    return tokens.round_trip(docs)


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    (pages,) = read_tables(spark, folder, "pages")
    return extraction.extract(pages, ["page_id", "url"]).select(
        "page.page_id", "page.url", "text", F.length("text").cast("bigint").alias("n_chars")
    )


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read_tables(spark, folder, "documents", "labels")
    return quality.assess(docs, trusted_ids(labels)).select("doc.doc_id", *quality.MEASURES)


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    (docs,) = read_tables(spark, folder, "documents")
    found = simhash.near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op9_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    (docs,) = read_tables(spark, folder, "documents")
    return mixing.placements(docs).select("doc_id", "source", "copies", "epoch", "start", "n_tokens")


def url_captures(pages: DataFrame) -> DataFrame:
    """The pages as captures: each has a time of its own within a year."""
    seconds = F.col("page_id") * 7919 % (366 * 86_400)
    return pages.select("page_id", "url", F.timestamp_seconds(F.lit(1_704_067_200) + seconds).alias("fetched_at"))


def url_entries(pages: DataFrame) -> DataFrame:
    """Dated list entries from the hosts and URLs of the pages, added and in part removed and added again."""
    known = pages.select("page_id", "url", urlfilter.host_of(F.col("url")).alias("host")).where("host <> ''")
    hosts = known.groupBy("host").agg(F.min("page_id").alias("page_id"))
    number = F.conv(F.substring(F.md5("host"), 1, 7), 16, 10).cast("bigint")
    day = number % 300
    parent = F.substring_index("host", ".", -3)

    def entry(list_: str, kind: str, pattern: Column, action: str, days: Column) -> Column:
        at = F.timestamp_seconds(F.lit(1_704_067_200) + days * 86_400 + number % 86_400)
        return F.struct(
            F.lit(list_).alias("list"), F.lit(kind).alias("kind"), pattern.alias("pattern"), F.lit(action).alias("action"), at.alias("at")
        )

    host = F.col("host")
    of_hosts = hosts.select(
        F.explode(
            F.flatten(F.array(
                F.when(number % 3 == 0, F.array(entry("spam", "host", host, "add", day), entry("spam", "host", host, "remove", day + 20 + number % 60))).otherwise(F.array()),
                F.when(number % 6 == 0, F.array(entry("spam", "host", host, "add", day + 90))).otherwise(F.array()),
                F.when(number % 5 == 0, F.array(entry("malware", "prefix", F.concat(host, F.lit("/en/")), "add", day))).otherwise(F.array()),
                F.when(number % 7 == 0, F.array(entry("trusted", "host", host, "add", day - 10))).otherwise(F.array()),
                F.when(number % 97 == 0, F.array(entry("adult", "domain", parent, "add", day), entry("adult", "domain", parent, "remove", day + 1))).otherwise(F.array()),
            ))
        ).alias("entry")
    ).select("entry.*")
    pattern = F.concat(host, F.regexp_extract("url", urlfilter.URL, 2), F.regexp_extract("url", urlfilter.URL, 3))
    of_pages = known.where("page_id % 11 = 0").select(entry("takedown", "url", pattern, "add", F.col("page_id") % 366).alias("entry")).select("entry.*")
    return of_hosts.unionByName(of_pages)


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    (pages,) = read_tables(spark, folder, "pages")
    judged = urlfilter.judge(url_captures(pages), url_entries(pages))
    return judged.select(
        "capture.page_id", "capture.url", F.size("lists").cast("bigint").alias("n_lists"),
        F.array_join("lists", ",").alias("lists"), F.array_join("patterns", " ").alias("patterns"), "blocked",
    )


def op11_language_id(spark: SparkSession, folder: str) -> DataFrame:
    (docs,) = read_tables(spark, folder, "documents")
    cfg = langid.LanguageConfig()
    held_out = F.coalesce(langid.remainder(F.col("doc.doc_id"), cfg) == cfg.held_out, F.lit(False))
    return langid.identified(docs, ["doc_id"], cfg).select(
        "doc.doc_id", held_out.alias("held_out"), F.col("language").alias("lang_pred"), "score", "accepted"
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document by hash repeats some of its words from a place of its own to its end."""
    number = F.crc32(F.col("doc_id").cast("string"))
    turn = F.floor(number / 10).cast("bigint")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        start = turn % n
        period = 1 + F.floor((n - start) / (3 + turn % 8)).cast("bigint")

        def word(own: Column, i: Column) -> Column:
            return F.when(i < start, own).otherwise(F.get(words, (start + (i - start) % period).cast("int")))

        return F.when(n > 0, F.array_join(F.transform(words, word), " ")).otherwise(F.col("text"))

    planted = F.when(number % 10 == 0, bind(words_of(F.col("text")), repeated)).otherwise(F.col("text"))
    return docs.select("doc_id", planted.alias("text"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    (docs,) = read_tables(spark, folder, "documents")
    found = periods.periodic_runs(with_planted_runs(docs), ["doc_id"])
    longest = F.get(F.array_sort("runs", lambda a, b: F.when(a.length > b.length, -1).when(a.length < b.length, 1).when(a.start < b.start, -1).when(a.start > b.start, 1).otherwise(a.period - b.period).cast("int")), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc.doc_id", F.size("runs").cast("bigint").alias("n_runs"), longest.alias("run"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "run.start", "run.length", "run.period",
        F.expr("1000 * run.length div run.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document proven against the manifest; a third of them by a claim with the text in lower case."""
    (docs,) = read_tables(spark, folder, "documents")
    values = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in merkle.MerkleConfig().fields]
    false = (F.crc32(F.col("doc_id").cast("string")) % 3 == 0) & F.col("text").isNotNull()
    manifest = merkle.write_manifest(docs, {"claim": F.when(false, merkle.leaf_digest(*values))})
    return merkle.audit(spark, manifest, "claim").withColumnRenamed("row_id", "doc_id")


Query = Callable[[SparkSession, str], DataFrame]


def shipped(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


QUERIES: dict[str, Query] = {
    f.__name__: shipped(f)
    for f in (
        op1_line_dedup, op2_decontamination, op3_quality_classifier, op4_substring_dedup, op5_token_files, op6_html_extraction, op7_quality_rules, op8_simhash, op9_source_mix,
        op10_url_filter, op11_language_id, op12_periodic_runs, op13_merkle_manifest,
    )
}
