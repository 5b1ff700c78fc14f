"""The health of the streams: their progress as a stored table, and findings over it.

Spark keeps the progress of the last hundred batches of a running query. `ProgressLog` hears every batch and stores it: one
small file per batch, in the folder of its date, named by the run of the query and the batch, so a batch that is reported twice is stored
once. `compact_progress` turns the files of past dates into one per date.
"""

from __future__ import annotations

import json
import uuid
from datetime import date

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from eventlake.sources.tables import MissingTableError

PROGRESS = (
    "query string, run_id string, batch_id bigint, started_at string, input_rows bigint, duration_ms bigint, "
    "input_rate double, processed_rate double, state_rows bigint, late_rows bigint, watermark string"
)
_KINDS = {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64()}
_SCHEMA = pa.schema([(n, _KINDS[kind]) for n, kind in (f.split() for f in PROGRESS.split(", "))])


def progress_row(p: dict, name: str | None = None) -> dict:
    """One batch, from the progress that Spark reports as JSON."""
    state = p.get("stateOperators") or []
    return {
        "query": name or p.get("name") or p["id"],
        "run_id": str(p["runId"]),
        "batch_id": p["batchId"],
        "started_at": p["timestamp"],
        "input_rows": int(p["numInputRows"]),
        "duration_ms": int((p.get("durationMs") or {}).get("triggerExecution", 0)),
        "input_rate": float(p.get("inputRowsPerSecond") or 0.0),
        "processed_rate": float(p.get("processedRowsPerSecond") or 0.0),
        "state_rows": sum(int(s.get("numRowsTotal") or 0) for s in state),
        "late_rows": sum(int(s.get("numRowsDroppedByWatermark") or 0) for s in state),
        "watermark": (p.get("eventTime") or {}).get("watermark"),
    }


def progress_rows(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Recent progress of a query as a frame: the bounded list that Spark keeps."""
    return spark.createDataFrame([tuple(progress_row(json.loads(p.json)).values()) for p in query.recentProgress], PROGRESS)


class ProgressLog(StreamingQueryListener):
    """Stores the progress of all queries of a session, or of those named."""

    def __init__(self, path: str, queries: tuple[str, ...] | None = None):
        self.files, self.root = pafs.FileSystem.from_uri(path)
        self.queries = queries

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = progress_row(json.loads(event.progress.json))
        if self.queries is None or row["query"] in self.queries:
            folder = f"{self.root}/event_date={row['started_at'][:10]}"
            self.files.create_dir(folder, recursive=True)
            name = f"{row['run_id']}-{row['batch_id']:012d}.parquet"
            aside = f"{folder}/.{name}-{uuid.uuid4().hex}"
            pq.write_table(pa.Table.from_pylist([row], _SCHEMA), aside, filesystem=self.files)
            self.files.move(aside, f"{folder}/{name}")


def read_progress(spark: SparkSession, path: str, since: date | None = None) -> DataFrame:
    """Stored progress, each batch of a run once."""
    try:
        rows = spark.read.schema(f"{PROGRESS}, event_date date").parquet(path)
    except Exception as error:
        raise MissingTableError(path) from error
    rows = rows if since is None else rows.filter(F.col("event_date") >= F.lit(since))
    return rows.dropDuplicates(["run_id", "batch_id"])


def compact_progress(spark: SparkSession, path: str, before: date) -> list[str]:
    """One file for each date before ``before``. The new file stands before the old ones go, and readers take each batch once."""
    files, root = pafs.FileSystem.from_uri(path)
    done = []
    for folder in sorted(files.get_file_info(pafs.FileSelector(root)), key=lambda f: f.path):
        day = folder.path.rsplit("event_date=", 1)[-1]
        if folder.type != pafs.FileType.Directory or day >= before.isoformat():
            continue
        own = [f.path for f in files.get_file_info(pafs.FileSelector(folder.path)) if f.path.endswith(".parquet")]
        if len(own) > 1:
            rows = pa.concat_tables([pq.read_table(p, filesystem=files, partitioning=None) for p in own])  # a row per batch of one day
            aside = f"{folder.path}/.day-{uuid.uuid4().hex}"
            pq.write_table(rows, aside, filesystem=files)
            files.move(aside, f"{folder.path}/day-{uuid.uuid4().hex}.parquet")
            for old in own:
                files.delete_file(old)
            done.append(day)
    return done


def pipeline_health(progress: DataFrame, max_duration_ms: int = 30_000, drop_share: float = 0.5, usual: int = 12) -> DataFrame:
    """Findings about the pipeline itself: slow batches, growing backlog, sudden loss of rows, late rows.

    A batch is compared with those before it in the same run of its query: one row per micro-batch.
    """
    names = [c for c in ("query", "run_id") if c in progress.columns]
    before = W.partitionBy(*names).orderBy("batch_id").rowsBetween(-usual, -1)
    checked = progress.withColumn("usual_rows", F.avg("input_rows").over(before))
    late = [F.when(F.col("late_rows") > 0, "late_rows")] if "late_rows" in progress.columns else []
    found = F.array(
        F.when(F.col("duration_ms") > max_duration_ms, "pipeline_delay"),
        F.when(
            (F.col("processed_rate") > 0) & (F.col("input_rate") > F.col("processed_rate")), "input_backlog"
        ),
        F.when(F.col("input_rows") < (1 - drop_share) * F.col("usual_rows"), "row_drop"),
        *late,
    )
    return checked.select(
        *names, "batch_id", "input_rows", "duration_ms",
        F.explode(F.filter(found, lambda f: f.isNotNull())).alias("anomaly_type"),
    )
