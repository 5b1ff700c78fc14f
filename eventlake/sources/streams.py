"""Event stream sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Without a bound the first batch of a new checkpoint would be all that the topic retains.
KAFKA_DEFAULTS = {"startingOffsets": "earliest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "1000000"}
RATE_OPTION = {"kafka": "maxOffsetsPerTrigger", "text": "maxFilesPerTrigger", "parquet": "maxFilesPerTrigger"}


def read_event_stream(
    spark: SparkSession, fmt: str = "kafka", path: str | None = None, per_trigger: int | None = None, **options: str
) -> DataFrame:
    """Unbounded frame with the raw record in ``value`` and the record time in ``timestamp``.

    ``kafka`` takes the broker and topic as options (``kafka.bootstrap.servers``, ``subscribe``)
    and needs the public Kafka package on the classpath. ``text`` follows a folder of files with
    one JSON event per line; the record time is the time the file was written. ``parquet``
    follows a folder of files with ``value`` and ``timestamp`` columns. ``per_trigger`` bounds a
    micro-batch: records of a topic, files of a folder.
    """
    if per_trigger is not None and fmt in RATE_OPTION:
        options = {RATE_OPTION[fmt]: str(per_trigger), **options}
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        stream = reader.options(**{**KAFKA_DEFAULTS, **options}).load()
        return stream.select("value", "timestamp")
    if path is None:
        raise ValueError(f"a {fmt!r} event stream needs a path")
    if fmt == "text":
        stream = reader.options(**options).load(path)
        return stream.select("value", F.col("_metadata.file_modification_time").alias("timestamp"))
    if fmt == "parquet":
        return reader.schema("value string, timestamp timestamp").options(**options).load(path)
    raise ValueError(f"unknown event stream format {fmt!r}")
