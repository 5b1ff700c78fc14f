"""Micro-batch sinks that may be replayed without changing the result.

A table is a folder of versions, ``run_id=…/batch_id=…/step=…/event_date=…``. Batch ids start again at 0
with a new checkpoint, so the run id, which lives and dies with the checkpoint, comes first: a later run never replaces
the folder of an earlier one, and its rows win. Step 1 is a compacted version of all up to its batch.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventlake.config import AlertConfig
from eventlake.operators.alerts import alert_payloads, route_alerts
from eventlake.operators.anomalies import anomaly_summary, log_entries, merge_summaries
from eventlake.operators.upserts import latest_by_key
from eventlake.sources.tables import MissingTableError, read_table

FIRST_RUN = "0-0"
VERSION = ("run_id", "batch_id", "step")


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The run of a checkpoint, kept inside it; ids of later checkpoints sort after earlier ones."""
    path = f"{checkpoint}/run"
    try:
        return read_table(spark, path, "text").first()[0]
    except MissingTableError:
        name = f"{time.time_ns() // 1_000_000:013d}-{uuid.uuid4().hex[:8]}"
        spark.createDataFrame([(name,)], "value string").coalesce(1).write.text(path)
        return name


def batch_path(path: str, batch_id: int, run: str = FIRST_RUN, step: int = 0) -> str:
    return f"{path}/run_id={run}/batch_id={batch_id}/step={step}"


def _write(df: DataFrame, target: str, time: str = "window_start") -> None:
    (
        df.withColumn("event_date", F.to_date(time))
        .hint("rebalance", "event_date")
        .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("event_date").parquet(target)
    )


def write_realtime(df: DataFrame, batch_id: int, path: str, run: str = FIRST_RUN) -> None:
    """Write one micro-batch of window rows to its own folder.

    Update mode emits the running total of a window again and again. Each version is kept under
    its run and batch; a replayed batch replaces its folder. Errors reach the query, which then retries.
    A batch without rows makes a folder without files: asking first would run the whole batch twice.
    """
    _write(df.withColumn("updated_at", F.current_timestamp()), batch_path(path, batch_id, run))


def write_log(entries: DataFrame, batch_id: int, path: str, run: str = FIRST_RUN) -> None:
    _write(entries, batch_path(path, batch_id, run), "detected_at")


def read_versions(spark: SparkSession, path: str, since: Column | None = None) -> DataFrame:
    """All versions of a table with ``_version``; ``since`` is the first date that is needed."""
    # Run ids are text, whatever they look like.
    stored = spark.read.parquet(path).withColumn("run_id", F.col("run_id").cast("string"))
    rows = stored.withColumn("_version", F.struct(*VERSION)).drop(*VERSION)
    return rows if since is None else rows.filter(F.col("event_date") >= since)


def read_realtime(
    spark: SparkSession, path: str, keys: Sequence[str], since: Column | None = None, dated: bool = False
) -> DataFrame:
    """Current rows of a window table: the newest version of each key, with their date if ``dated``.

    The date is a folder, so a filter on it, given here or put on the result, prunes the scan.
    """
    newest = latest_by_key(read_versions(spark, path, since), [*keys, "event_date"], "_version")
    return newest.drop("_version", "updated_at", *(() if dated else ("event_date",)))


def read_log(spark: SparkSession, path: str, since: Column | None = None) -> DataFrame:
    """The anomaly log: the findings of each window from the newest run that speaks of it.

    A run speaks of a window once, so its rows are read as they are, and a filter on the date of detection, given here or put on the
    result, reaches the scan as a partition filter. An earlier run gives the windows of which no later one speaks.
    """
    rows = read_versions(spark, path, since)
    whole = spark.read.parquet(path)
    runs = _runs(spark, path)
    log = None
    for place, run in enumerate(runs):
        own = rows.filter(F.col("_version.run_id") == run)
        later = runs[place + 1 :]
        if later:
            own = own.join(whole.filter(F.col("run_id").isin(later)).select("window_start").distinct(), "window_start", "left_anti")
        log = own if log is None else log.unionByName(own)
    return (rows if log is None else log).drop("_version")


def _runs(spark: SparkSession, path: str) -> list[str]:
    """The runs of a table, the earliest first."""
    return [name.split("=", 1)[1] for name in _names(spark, f"{path}/run_id=*")]


def _names(spark: SparkSession, pattern: str) -> list[str]:
    root = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(root) or []
    return sorted({status.getPath().getName() for status in found})


def stored_dates(spark: SparkSession, path: str) -> list[date]:
    """The dates of a table of versions, the newest first, from the names of its folders."""
    names = _names(spark, f"{path}/run_id=*/batch_id=*/step=*/event_date=*")
    days = [name.split("=", 1)[1] for name in names]
    return sorted((date.fromisoformat(d) for d in days if not d.startswith("__")), reverse=True)


def _folders(spark: SparkSession, path: str) -> tuple[object, list[tuple[tuple[str, int, int], object]]]:
    """The file system, and the versions of a table in order with their folders."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/run_id=*/batch_id=*/step=*")) or []:
        run, batch, step = (part.split("=", 1)[1] for part in status.getPath().toString().rsplit("/", 3)[1:])
        found.append(((run, int(batch), int(step)), status))
    return files, sorted(found, key=lambda f: f[0])


def compact_realtime(spark: SparkSession, path: str, keys: Sequence[str], retain_seconds: float = 3600.0) -> None:
    """Put the newest version of each key so far in one folder, and drop folders that an older compaction replaced.

    The new folder is written aside and renamed, which readers see at once or not at all. Folders it replaces stay
    until the next compaction finds it older than ``retain_seconds``, so readers that listed them can finish.
    """
    files, found = _folders(spark, path)
    kept = [f for f in found if f[0][2] == 1 and f[1].getModificationTime() < (time.time() - retain_seconds) * 1000]
    if kept:
        for _, status in (f for f in found if f[0] < kept[-1][0]):
            files.delete(status.getPath(), True)
        found = [f for f in found if f[0] >= kept[-1][0]]
    if not found or found[-1][0][2] == 1:
        return
    newest = found[-1][0]
    rows = spark.read.option("basePath", path).parquet(*[s.getPath().toString() for _, s in found])
    versions = rows.withColumn("_version", F.struct(*VERSION)).drop(*VERSION)
    aside = f"{path}/_compacting-{uuid.uuid4().hex}"
    _write(latest_by_key(versions, [*keys, "event_date"], "_version").drop("_version"), aside)
    target = spark._jvm.org.apache.hadoop.fs.Path(batch_path(path, newest[1], newest[0], step=1))
    if not files.rename(spark._jvm.org.apache.hadoop.fs.Path(aside), target):
        raise OSError(f"cannot rename {aside}")


def realtime_writer(path: str, run: str = FIRST_RUN) -> Callable[[DataFrame, int], None]:
    return lambda df, batch_id: write_realtime(df, batch_id, path, run)


def anomaly_writer(
    log_path: str, alert_path: str | None = None, cfg: AlertConfig = AlertConfig(), run: str = FIRST_RUN,
    summary_path: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """Append findings to the log and their messages, with their channel, to an outbox, both replaceable by run and batch.

    Where findings carry `is_first`, only those are sent. With ``summary_path`` the batch also adds its part to the kept summary.
    The batch is persisted, so it is computed once for all of them.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        findings = df.persist()
        try:
            if findings.isEmpty():
                return
            write_log(log_entries(findings, F.current_timestamp()), batch_id, log_path, run)
            if summary_path is not None:
                write_summary(df.sparkSession, batch_id, log_path, summary_path, run)
            if alert_path is not None:
                worth = findings.filter("is_first") if "is_first" in findings.columns else findings
                messages = route_alerts(alert_payloads(worth, cfg, sent_at=F.current_timestamp()))
                _write(messages, batch_path(alert_path, batch_id, run))
        finally:
            findings.unpersist()

    return write


# --- kept summary ------------------------------------------------------------------------------

SUMMARY_KEYS = ("anomaly_date", "severity", "anomaly_type")


def write_summary(spark: SparkSession, batch_id: int, log_path: str, path: str, run: str) -> None:
    """Add what one batch of the log changes to the kept summary, under its run and batch, so a replay replaces it.

    The findings of the batch count up. Findings of the same windows that the log holds from earlier runs count down, since the
    batch takes their place; they lie in folders of other runs, and none is read while there is only one run.
    """
    own = spark.read.parquet(batch_path(log_path, batch_id, run))
    change = anomaly_summary(own)
    earlier = [str(status.getPath()) for (other, _, _), status in _folders(spark, log_path)[1] if other < run]
    if earlier:
        before = spark.read.option("basePath", log_path).parquet(*earlier)
        first, last = own.agg(F.min("window_start"), F.max("window_start")).first()
        near = before.filter(F.col("window_start").between(F.lit(first), F.lit(last)))  # two numbers that the files' statistics know
        ranked = near.withColumn("_version", F.struct(*VERSION))
        newest = ranked.withColumn("_newest", F.max("_version").over(W.partitionBy("window_start"))).filter("_version = _newest")
        replaced = newest.join(own.select("window_start").distinct(), "window_start", "left_semi")
        change = merge_summaries(
            change.unionByName(anomaly_summary(replaced).withColumn("anomaly_count", -F.col("anomaly_count")))
        )
    change.coalesce(1).write.mode("overwrite").parquet(batch_path(path, batch_id, run))


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """Findings per day, severity and type, summed from the parts of the batches. Reads no row of the log."""
    parts = [str(status.getPath()) for _, status in _current_parts(_folders(spark, path)[1])]
    if not parts:
        raise MissingTableError(path)
    return merge_summaries(spark.read.parquet(*parts)).filter("anomaly_count <> 0")


def _current_parts(found: list) -> list:
    """The newest folded version and what came after it."""
    folded = [i for i, ((_, _, step), _) in enumerate(found) if step == 1]
    return found[folded[-1] :] if folded else found


def compact_summary(spark: SparkSession, path: str, retain_seconds: float = 3600.0) -> None:
    """Fold all parts so far into one, which takes the place of the last, and drop parts that an older folding replaced."""
    files, found = _folders(spark, path)
    current = _current_parts(found)
    old = (time.time() - retain_seconds) * 1000
    for _, status in found[: len(found) - len(current)]:
        if current[0][1].getModificationTime() < old:
            files.delete(status.getPath(), True)
    if len(current) < 2:
        return
    newest = current[-1][0]
    aside = f"{path}/_folding-{uuid.uuid4().hex}"
    merge_summaries(spark.read.parquet(*[str(s.getPath()) for _, s in current])).coalesce(1).write.parquet(aside)
    target = spark._jvm.org.apache.hadoop.fs.Path(batch_path(path, newest[1], newest[0], step=1))
    if not files.rename(spark._jvm.org.apache.hadoop.fs.Path(aside), target):
        raise OSError(f"cannot rename {aside}")
