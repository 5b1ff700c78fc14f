"""Batch tables of the lake."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


MISSING = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "DELTA_TABLE_NOT_FOUND", "DELTA_MISSING_DELTA_TABLE")


class MissingTableError(RuntimeError):
    """A table that a job needs is not there."""


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan one lake table. ``fmt='delta'`` works where the Delta package is on the classpath.

    A folder without files is an empty table; other faults than a missing path are raised as they are.
    """
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() in MISSING:
            raise MissingTableError(f"no {fmt} table at {path}: {error}") from error
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return spark.createDataFrame([], StructType())
        raise


def read_jdbc_table(spark: SparkSession, url: str, table: str, **properties: str) -> DataFrame:
    """Scan one KPI table of an external store; its driver must be on the classpath."""
    return spark.read.jdbc(url, table, properties=properties)


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    try:
        read_table(spark, path, fmt)
    except MissingTableError:
        return False
    return True


def has_rows(df: DataFrame) -> bool:
    """Gate of a batch run: stops at the first row found."""
    return not df.isEmpty()
