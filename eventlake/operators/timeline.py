"""Windows over long timelines without a task that holds a whole timeline.

A range frame over one user, or over all window rows, would sort the whole group in one task. The
timeline is cut into chunks instead. A row near a chunk border is also sent to the chunk that needs
it as context, and each chunk answers only for its own rows. Results equal the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F


def micros(column: str) -> Column:
    """Microseconds on the row's own clock; differences do not depend on the session zone."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", start, F.col(column).cast("timestamp_ntz"))


def over_trailing_range(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    lookback_seconds: int,
    measures: dict[str, Callable[[WindowSpec], Column]],
    include_current: bool = True,
) -> DataFrame:
    """Add measures over the rows of the same keys in the ``lookback_seconds`` before each row.

    Chunks are as wide as the lookback, so each row is context for the next chunk only: the input
    is doubled once and a chunk never holds more than two lookbacks of one key.
    """
    lookback = lookback_seconds * 1_000_000
    own = F.floor(F.col("_at") / lookback)
    spread = (
        df.withColumn("_at", micros(time))
        .withColumn("_own", own)
        .withColumn("_chunk", F.explode(F.array(F.col("_own"), F.col("_own") + 1)))
    )
    frame = (
        W.partitionBy(*keys, "_chunk")
        .orderBy("_at")
        .rangeBetween(-lookback, 0 if include_current else -1)
    )
    measured = spread.select("*", *[measure(frame).alias(name) for name, measure in measures.items()])
    return measured.filter("_chunk = _own").drop("_at", "_own", "_chunk")


def over_previous_rows(
    df: DataFrame,
    time: str,
    rows: int,
    measures: dict[str, Callable[[WindowSpec], Column]],
    block: int = 100_000,
) -> DataFrame:
    """Add measures over the ``rows`` rows before each row in time order (current row excluded).

    ``time`` must be unique. Rows get a dense position from per-day counts (one number per day
    crosses the single-task running sum), and blocks of positions are windowed in parallel. A block
    lends rows to the next one only, so it must be at least as long as the frame.
    """
    if rows > block:
        raise ValueError(f"a frame of {rows} rows needs blocks of at least as many, not {block}")
    dated = df.withColumn("_day", F.to_date(time))
    days = dated.groupBy("_day").agg(F.count("*").alias("_n"))
    earlier = W.orderBy("_day").rowsBetween(W.unboundedPreceding, -1)
    offsets = days.select("_day", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = dated.join(offsets, "_day").withColumn(
        "_pos", F.col("_before") + F.row_number().over(W.partitionBy("_day").orderBy(time)) - 1
    )
    own = F.floor(F.col("_pos") / block)
    needed_next = F.col("_pos") % block >= block - rows
    spread = numbered.withColumn("_own", own).withColumn(
        "_block",
        F.explode(F.when(needed_next, F.array(own, own + 1)).otherwise(F.array(own))),
    )
    frame = W.partitionBy("_block").orderBy("_pos").rowsBetween(-rows, -1)
    measured = spread.select("*", *[measure(frame).alias(name) for name, measure in measures.items()])
    return measured.filter("_block = _own").drop("_day", "_before", "_pos", "_own", "_block")
