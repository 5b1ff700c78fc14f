"""From raw documents to token files: five stages, each written as Parquet and read again.

Every stage takes (session, documents, folder of the tables) and works on all that its predecessor
kept. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventlake.llm import decontaminate, mixing, quality, simhash, tokens
from eventlake.llm.common import read_tables, ship
from eventlake.llm.queries import trusted_ids
from eventlake.sources.scratch import new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    (labels,) = read_tables(spark, sf_dir, "labels")
    return quality.keep_good(docs, trusted_ids(labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash with the shingle length and the largest distance of its contract."""
    ship(spark)
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    (benchmark,) = read_tables(spark, sf_dir, "benchmark")
    return decontaminate.keep_clean(docs, benchmark)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; small sources more often, within the repetition limit."""
    return mixing.mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return tokens.round_trip(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_files", token_files),
]

#: Fingerprints, hashed n-grams and the vocabulary have no form in SQL; tests use a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = read_tables(spark, sf_dir, "documents")
    folder = new_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        written = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(written)
        docs = spark.read.parquet(written)
    return docs
