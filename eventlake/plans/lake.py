"""The stored lake that serving queries read: built once for a folder of events and kept in the shared folder."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.config import DetectorConfig
from eventlake.operators import anomalies, realtime
from eventlake.plans.batch import LakePaths, run_batch
from eventlake.sources.fixtures import read_bronze
from eventlake.sources.scratch import shared_folder
from eventlake.streaming.sinks import write_log, write_realtime

_built: dict[tuple[str, str], str] = {}


def state_of(spark: SparkSession, path: str) -> str:
    """A digest of the files of a table: names, sizes and times of change."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True)
    seen = []
    while files.hasNext():
        status = files.next()
        seen.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()[:20]


def realtime_root(root: str) -> str:
    return f"{root}/realtime"


def newest_instant(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/clock")


def build(spark: SparkSession, folder: str, root: str, detector: DetectorConfig) -> None:
    """Bronze to gold, the minute cube, and a log of the findings at the end of each window."""
    paths = LakePaths(root)
    read_bronze(spark, folder).hint("rebalance", "event_date").write.partitionBy("event_date").parquet(paths.bronze)
    bronze = spark.read.parquet(paths.bronze)
    run_batch(spark, paths)
    write_realtime(realtime.minute_cube(bronze), 0, f"{realtime_root(root)}/minute_cube")
    findings = anomalies.detect(anomalies.window_metrics_exact(bronze, detector.width), detector)
    found_at = F.col("window_start") + F.expr(f"INTERVAL {detector.width}")
    write_log(anomalies.log_entries(findings, found_at), 0, f"{realtime_root(root)}/anomalies")
    bronze.agg(F.max("event_timestamp").alias("event_timestamp")).write.parquet(f"{root}/clock")


def stored_lake(spark: SparkSession, folder: str, detector: DetectorConfig) -> str:
    """The root of the lake of a folder. A change of the events or of the detector makes another one.

    It is built aside and renamed, so a lake is whole or not there.
    """
    key = hashlib.sha256(f"{state_of(spark, f'{folder}/events.parquet')} {detector}".encode()).hexdigest()[:20]
    known = (spark.sparkContext.applicationId, key)
    if known not in _built:
        shared = shared_folder(spark).rstrip("/")
        root, aside = f"{shared}/lake-{key}", f"{shared}/lake-{key}-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path
        files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(path(root)):
            build(spark, folder, aside, detector)
            files.rename(path(aside), path(root))
        _built[known] = root
    return _built[known]
