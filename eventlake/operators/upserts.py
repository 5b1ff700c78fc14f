"""Newest-version reads of tables that are written as a sequence of versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], version: str = "updated_at") -> DataFrame:
    """The row with the highest version of each key; ties are broken by the other columns.

    Each map task keeps one row per key before the shuffle, so old versions do not travel.
    """
    rest = [F.desc(c) for c in df.columns if c not in (*keys, version)]
    newest = W.partitionBy(*keys).orderBy(F.desc(version), *rest)
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")
