"""URL filters as a join in time: every capture is judged by the list entries active when it was fetched.

Entries are dated additions and removals of patterns: a whole URL, a host, a domain with all below it, or a path prefix.
Each capture gives the patterns it could match (its host, the domains above it, the prefixes of its
path, itself), and those are matched by equality, so no pattern is compared with every capture.

Additions and removals become validity intervals, cut at the borders of days. For each day on which a pattern
has an entry or a capture, the state at its start is carried over from the last entry before it: a window
over the days of a pattern, not over its entries or captures. Captures and intervals then meet by
pattern and day, and each capture falls into one interval at most, so a hot host is spread over days and
its join can be split.

Defined cases: an addition holds from its instant on, a removal ends it at its instant; at one instant a removal wins.
A NULL or broken URL, or a NULL time, matches nothing. Host names are compared in lower case, without user, port and final
dot, also in entries; a fragment is left out. A prefix ends at a slash, given or not. Entries with a NULL field, or of an unknown kind or action, have no effect.
Repeated captures are judged alike, and each has its row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.sources.scratch import cut_lineage

URL = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)(?::[0-9]*)?([^?#]*)(\?[^#]*)?"


@dataclass(frozen=True)
class UrlFilterConfig:
    #: Lists whose entries let a capture pass whatever the others say.
    allow_lists: tuple[str, ...] = ("trusted",)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_extract(url, URL, 1), r"\.$", ""))


def patterns_of(url: Column) -> Column:
    """All patterns that match a URL, as kind:value."""
    host = host_of(url)
    path, query = F.regexp_extract(url, URL, 2), F.regexp_extract(url, URL, 3)
    labels, segments = F.split(host, r"\."), F.split(path, "/")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("domain:"), F.array_join(F.slice(labels, i, F.size(labels)), "."))
    )
    prefixes = F.when(
        F.size(segments) > 1,
        F.transform(
            F.sequence(F.lit(1), F.size(segments) - 1),
            lambda i: F.concat(F.lit("prefix:"), host, F.array_join(F.slice(segments, 1, i), "/"), F.lit("/")),
        ),
    ).otherwise(F.array().cast("array<string>"))
    whole = F.array(F.concat(F.lit("host:"), host), F.concat(F.lit("url:"), host, path, query))
    return F.when(F.coalesce(host, F.lit("")) != "", F.array_distinct(F.concat(whole, domains, prefixes))).otherwise(
        F.array().cast("array<string>")
    )


def entry_pattern(kind: Column, pattern: Column) -> Column:
    """A list pattern as captures give theirs: the host by the rules of :func:`host_of`, a prefix with a final slash; empty if it has no host."""
    url = F.when(pattern.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), pattern).otherwise(F.concat(F.lit("any://"), pattern))
    host, path, query = host_of(url), F.regexp_extract(url, URL, 2), F.regexp_extract(url, URL, 3)
    prefix = F.when(path.endswith("/"), path).otherwise(F.concat(path, F.lit("/")))
    value = F.when(kind == "url", F.concat(host, path, query)).when(kind == "prefix", F.concat(host, prefix)).otherwise(host)
    return F.when(host != "", F.concat(kind, F.lit(":"), value))


def changes(entries: DataFrame) -> DataFrame:
    """(list, pattern, day, at, active): one change per instant."""
    known = F.col("kind").isin("url", "host", "domain", "prefix") & F.col("action").isin("add", "remove")
    return (
        entries.where(known & F.col("at").isNotNull() & F.col("pattern").isNotNull() & F.col("list").isNotNull())
        .select("list", entry_pattern(F.col("kind"), F.col("pattern")).alias("pattern"), F.col("at").cast("timestamp").alias("at"), (F.col("action") == "add").alias("active"))
        .where("pattern IS NOT NULL").groupBy("list", "pattern", "at").agg(F.min("active").alias("active"))
        .withColumn("day", F.to_date("at"))
    )


def validity(changed: DataFrame, capture_days: DataFrame) -> DataFrame:
    """(list, pattern, day, since, until): when entries were active, within the days that matter."""
    marks = (
        changed.groupBy("list", "pattern", "day").agg(F.max_by("active", "at").alias("last"))
        .unionByName(
            capture_days.join(changed.select("list", "pattern").distinct(), "pattern").select(
                "list", "pattern", "day", F.lit(None).cast("boolean").alias("last")
            )
        )
        .groupBy("list", "pattern", "day").agg(F.max("last").alias("last"))
    )
    before = Window.partitionBy("list", "pattern").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.withColumn("carried", F.last("last", ignorenulls=True).over(before)).where("carried").select(
        "list", "pattern", "day", F.col("day").cast("timestamp").alias("at"), F.lit(True).alias("active"), F.lit(0).alias("turn")
    )
    # A change at the very start of a day follows what is carried into it.
    inside = Window.partitionBy("list", "pattern", "day").orderBy("at", "turn")
    steps = carried.unionByName(changed.withColumn("turn", F.lit(1)))
    end = F.coalesce(F.lead("at").over(inside), (F.col("day") + F.expr("INTERVAL 1 DAY")).cast("timestamp"))
    return steps.withColumn("until", end).where("active AND at < until").select("list", "pattern", "day", F.col("at").alias("since"), "until")


def judge(captures: DataFrame, entries: DataFrame, cfg: UrlFilterConfig = UrlFilterConfig()) -> DataFrame:
    """Captures (with columns url and fetched_at) and `lists`, `patterns`, `blocked`."""
    changed = changes(entries)
    timed = captures.select("url", F.col("fetched_at").cast("timestamp").alias("fetched_at")).where("fetched_at IS NOT NULL")
    # Exploded where the captures lie; then repeats go.
    offered = timed.select(
        "url", "fetched_at", F.to_date("fetched_at").alias("day"), F.explode(patterns_of(F.col("url"))).alias("pattern")
    ).distinct()
    spans = validity(changed, offered.select("pattern", "day").distinct())
    hits = offered.join(spans, ["pattern", "day"]).where((F.col("fetched_at") >= F.col("since")) & (F.col("fetched_at") < F.col("until")))
    # A capture has as many hits as it has patterns on lists.
    verdicts = cut_lineage(
        hits.groupBy("url", "fetched_at").agg(
            F.array_sort(F.collect_set("list")).alias("lists"), F.array_sort(F.collect_set("pattern")).alias("patterns")
        )
    )
    rows = captures.select(F.struct(*[F.col(f"`{c}`") for c in captures.columns]).alias("capture"))
    joined = rows.join(
        verdicts,
        (F.col("capture.url") == verdicts.url) & (F.col("capture.fetched_at").cast("timestamp") == verdicts.fetched_at), "left",
    )
    none = F.array().cast("array<string>")
    lists = F.coalesce("lists", none)
    allowed = F.arrays_overlap(lists, F.array(*[F.lit(a) for a in cfg.allow_lists]).cast("array<string>"))
    return joined.select(
        "capture", lists.alias("lists"), F.coalesce("patterns", none).alias("patterns"),
        ((F.size(lists) > 0) & ~allowed).alias("blocked"),
    )
