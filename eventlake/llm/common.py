"""Small helpers that the operators share."""

from __future__ import annotations

import math
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as a Java character class
SPACE = r"[\x20\x09-\x0D]"


def columns_of(df: DataFrame) -> list[Column]:
    """All columns of a frame, also those with dots in their names."""
    return [F.col(f"`{name}`") for name in df.columns]


def packed(df: DataFrame) -> DataFrame:
    """The rows of a frame as one struct `doc`, so that new columns cannot clash with its own."""
    return df.select(F.struct(*columns_of(df)).alias("doc"))


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col("doc").getField(name).alias(name) for name in columns])


def bind(value: Column, body) -> Column:
    """Evaluate `value` once and use it in `body` many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The runs of other characters than ASCII white space; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


def read_tables(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{folder}/{name}.parquet") for name in names]


def remove_folders(spark: SparkSession, root: str, *names: str) -> None:
    """Delete working tables that nothing reads any more."""
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Spark's setting for dropping shuffle files at the end of a query.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that go to a Python worker together. Each batch of whole texts is held by the worker and, outside the heap, by the executor.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """A frame as a table in the shared folder. Spark drops the shuffle files of its making once it is written."""
    path, conf = f"{folder}/{name}", df.sparkSession.conf
    before = {key: conf.get(key) for key in (CLEANUP, BATCH_ROWS)}
    conf.set(CLEANUP, "true")
    conf.set(BATCH_ROWS, "1000")
    try:
        df.select("*").write.option("compression", "zstd").parquet(path)
    finally:
        for key, value in before.items():
            conf.set(key, value)
    return df.sparkSession.read.parquet(path)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches. A Python worker lives on after its task, so memory that Arrow only keeps for later goes back at the end."""
    yield from batches
    pa.default_memory_pool().release_unused()


def parts_for(size: int, each: int) -> int:
    return max(1, math.ceil(size / each))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors once per application, through Spark's own file distribution."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)
