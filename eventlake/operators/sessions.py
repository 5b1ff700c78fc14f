"""Sessions from idle gaps, without a task that holds all events of a user.

Events are combined per (user, instant), and the timeline of a user is cut into short chunks. Inside
a chunk only a logout can break a session, so the logouts cut it into pieces. A piece between two
logouts of one chunk is a whole session. Only the first and the last piece of each chunk are put in
order per user: at most two rows per chunk, however many events the user makes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventlake.config import SessionConfig
from eventlake.functions.predicates import is_purchase


ACTIVITY = ("events", "views", "cart_adds", "purchases", "revenue")


def _chunk(cfg: SessionConfig) -> Column:
    return F.date_trunc(cfg.chunk, F.col("event_timestamp")).alias("chunk")


def _ends(idle_from: Column, start: Column, logout: Column, cfg: SessionConfig) -> Column:
    """True where the earlier session is over when ``start`` comes."""
    return F.coalesce((start > idle_from + F.expr(f"INTERVAL {cfg.gap}")) | logout, F.lit(False))


def instants(events: DataFrame, *more: Column) -> DataFrame:
    """Activity per (user, instant), in batch and stream."""
    return events.groupBy("user_id", *more, "event_timestamp").agg(
        F.count("*").alias("events"),
        F.count_if(F.col("event_type") == "view").alias("views"),
        F.count_if(F.col("event_type") == "add_to_cart").alias("cart_adds"),
        F.count_if(is_purchase()).alias("purchases"),
        F.sum(F.when(is_purchase(), F.col("price"))).alias("revenue"),
        F.max(F.col("event_type") == "logout").alias("logout"),
    )


def _instants(events: DataFrame, cfg: SessionConfig) -> DataFrame:
    """Instants with the number of the piece of their chunk they belong to."""
    chunk = W.partitionBy("user_id", "chunk").orderBy("event_timestamp")
    earlier = chunk.rowsBetween(W.unboundedPreceding, -1)
    later = chunk.rowsBetween(1, W.unboundedFollowing)
    return instants(events, _chunk(cfg)).select(
        "*",
        F.count_if("logout").over(earlier).alias("piece"),
        F.count(F.lit(1)).over(later).alias("instants_after"),
    )


def _pieces(events: DataFrame, cfg: SessionConfig) -> DataFrame:
    """Pieces with the start of the session they belong to."""
    pieces = _instants(events, cfg).groupBy("user_id", "chunk", "piece").agg(
        F.min("event_timestamp").alias("piece_start"),
        F.max("event_timestamp").alias("piece_end"),
        *[F.sum(c).alias(c) for c in ACTIVITY],
        F.max("logout").alias("logout"),
        F.min("instants_after").alias("instants_after"),
    )
    inner = (F.col("piece") > 0) & (F.col("instants_after") > 0)
    lane = W.partitionBy("user_id", "lane").orderBy("piece_start")
    opens = F.col("lane").isNotNull() | F.lag("piece_end").over(lane).isNull() | _ends(
        F.lag("piece_end").over(lane), F.col("piece_start"), F.lag("logout").over(lane), cfg
    )
    laned = pieces.withColumn("lane", F.when(inner, F.col("chunk"))).withColumn("opens", opens)
    return laned.withColumn(
        "session_start",
        F.last(F.when(F.col("opens"), F.col("piece_start")), ignorenulls=True).over(lane),
    )


def _check(cfg: SessionConfig) -> None:
    if cfg.chunk not in ("second", "minute"):
        raise ValueError("chunk must be 'second' or 'minute'")
    if not cfg.gap.strip().split()[-1].rstrip("s") in ("minute", "hour", "day"):
        raise ValueError("gap must be given in minutes, hours or days")


def sessions(events: DataFrame, cfg: SessionConfig = SessionConfig()) -> DataFrame:
    """One row per session, known by its user and start, with its span and activity.

    A session ends after ``gap`` without events, or with a logout. A logout at the same instant as
    other events of the user closes the session after them.
    """
    _check(cfg)
    return (
        _pieces(events, cfg)
        .groupBy("user_id", "session_start")
        .agg(
            F.max("piece_end").alias("session_end"),
            *[F.sum(c).alias(c) for c in ACTIVITY],
            F.max("logout").alias("logged_out"),
        )
        .withColumn("duration_seconds", _span_seconds("session_start", "session_end"))
    )


def assign_sessions(events: DataFrame, cfg: SessionConfig = SessionConfig()) -> DataFrame:
    """Each event with the start of its session. The join keys include the instant, so none is hot."""
    _check(cfg)
    pieces = _pieces(events, cfg).select("user_id", "chunk", "piece", "session_start")
    starts = (
        _instants(events, cfg)
        .join(pieces, ["user_id", "chunk", "piece"])
        .select("user_id", "event_timestamp", "session_start")
    )
    return events.join(starts, ["user_id", "event_timestamp"])


def _span_seconds(start: str, end: str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.col(start), F.col(end)) / 1_000_000


def session_windows(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Streaming form: gap sessions per user as event-time session windows.

    ``session_window`` ends a session when the gap has passed, so two events exactly one gap apart
    fall into two sessions here and into one in :func:`sessions`; logouts do not end a session.
    """
    grouped = events.groupBy("user_id", F.session_window("event_timestamp", gap).alias("span"))
    return grouped.agg(F.count("*").alias("events"), F.count_if(is_purchase()).alias("purchases")).select(
        "user_id",
        F.col("span.start").alias("session_start"),
        F.col("span.end").alias("session_end"),
        "events",
        "purchases",
    )


# --- analytics over sessions -------------------------------------------------------------------


def session_duration_anomalies(
    session_rows: DataFrame, sigma: float = 3.0
) -> DataFrame:
    """Sessions much shorter or longer than the average multi-event session."""
    timed = session_rows.filter("events > 1")
    stats = timed.agg(
        F.struct(
            F.avg("duration_seconds").alias("mean"), F.stddev("duration_seconds").alias("std")
        ).alias("stats")
    ).scalar()
    scored = timed.withColumn("_stats", stats).withColumn(
        "duration_zscore",
        F.try_divide(
            F.col("duration_seconds") - F.col("_stats.mean"), F.nullif(F.col("_stats.std"), F.lit(0.0))
        ),
    )
    return scored.filter(F.abs("duration_zscore") > sigma).select(
        "user_id", "session_start", "duration_seconds", "duration_zscore",
        F.when(F.col("duration_zscore") > 0, "too_long").otherwise("too_short").alias("kind"),
    )


def category_affinity(events: DataFrame) -> DataFrame:
    """Share of each category in the product events of a user, with the number of sessions."""
    touched = events.filter(F.col("category").isNotNull())
    # Per (user, category, session) first: the session count needs no second distinct pass.
    visits = touched.groupBy("user_id", "category", "session_id").agg(F.count("*").alias("events"))
    per_category = visits.groupBy("user_id", "category").agg(
        F.sum("events").alias("events"), F.count("*").alias("sessions")
    )
    # At most one row per known category and user remains, so this window stays small.
    per_user = W.partitionBy("user_id")
    return per_category.withColumn("affinity", F.round(F.col("events") / F.sum("events").over(per_user), 4))
