"""The batch medallion: bronze to silver to gold, with checks."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.operators import gold
from eventlake.operators.quality import quality_report
from eventlake.operators.silver import clean_events, clean_report, merge_silver, silver
from eventlake.sources.scratch import cut_lineage
from eventlake.sources.sinks import drop_dates, publish_gold, write_gold, write_silver
from eventlake.sources.tables import MissingTableError, has_rows, read_table, table_exists


@dataclass(frozen=True)
class LakePaths:
    root: str
    fmt: str = "parquet"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/user_events"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/user_events"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"


def run_silver(spark: SparkSession, paths: LakePaths) -> bool:
    """Rebuild silver from bronze. Returns whether bronze had any rows."""
    bronze = read_table(spark, paths.bronze, paths.fmt)
    if not has_rows(bronze):
        return False
    write_silver(silver(bronze), paths.silver, paths.fmt)
    return True


def silver_audit(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """How many rows of bronze each rule rejects."""
    return clean_report(read_table(spark, paths.bronze, paths.fmt))


def extend_silver(spark: SparkSession, paths: LakePaths, slice_: DataFrame, target: str) -> None:
    """Write silver plus one more slice of bronze to ``target``: the same rows as a rebuild."""
    existing = read_table(spark, paths.silver, paths.fmt)
    write_silver(merge_silver(existing, slice_), target, paths.fmt)


def update_silver(spark: SparkSession, paths: LakePaths, slice_: DataFrame) -> list[date]:
    """Merge a slice of bronze into silver: the same rows as a rebuild, but only touched dates are written again.

    Touched are the dates of the slice and those on which one of its event ids already stands, as the
    earlier arrival of the two stays. They are found on ids alone. Returns them.
    """
    if not table_exists(spark, paths.silver, paths.fmt):
        write_silver(silver(slice_), paths.silver, paths.fmt)
        return sorted(r.event_date for r in read_table(spark, paths.silver, paths.fmt).select("event_date").distinct().collect())
    existing = read_table(spark, paths.silver, paths.fmt)
    cleaned = clean_events(slice_)
    standing = existing.select("event_id", "event_date").join(cleaned.select("event_id"), "event_id", "left_semi")
    touched = cleaned.select("event_date").union(standing.select("event_date")).distinct()
    dates = sorted(r.event_date for r in touched.collect())  # one row per date
    merged = cut_lineage(merge_silver(existing.filter(F.col("event_date").isin(dates)), slice_))
    kept = {r.event_date for r in merged.select("event_date").distinct().collect()}
    write_silver(merged, paths.silver, paths.fmt, whole=False)
    drop_dates(spark, paths.silver, [d for d in dates if d not in kept])
    return dates


#: Gold tables that are written at a time.
WRITERS = 4

# Rollups by date that read silver; the tables below them read only these.
DATE_ROLLUPS = {
    "user_day": gold.user_day,
    "page_day": gold.page_day,
    "kpi_category_sales": gold.kpi_category_sales,
    "kpi_cart_abandonment": gold.kpi_cart_abandonment,
}

DERIVED = {
    "dim_users": (gold.dim_users_from_rollup, "user_day"),
    "dim_pages": (gold.dim_pages_from_rollup, "page_day"),
    "kpi_dau": (gold.dau_from_rollup, "user_day"),
    "kpi_events_per_source": (gold.events_per_source_from_rollup, "user_day"),
    "kpi_purchases_per_page": (gold.purchases_per_page_from_rollup, "page_day"),
    "kpi_revenue_daily": (gold.revenue_from_category_sales, "kpi_category_sales"),
    "kpi_conversion_rate": (gold.conversion_from_rollup, "user_day"),
}


def run_gold(
    spark: SparkSession, paths: LakePaths, dates: Sequence[date] | None = None, facts: bool = True
) -> bool:
    """Build the gold tables. With ``dates`` only those partitions of silver are read again; a date
    among them that has left silver leaves the gold tables too.

    Silver is scanned once per rollup with that rollup's columns. The rollups are written tables:
    what follows reads compact data, and a lost executor recomputes no silver. Returns whether
    silver had any rows.
    """
    events = read_table(spark, paths.silver, paths.fmt)
    gone: list[date] = []
    if dates is not None:
        events = events.filter(F.col("event_date").isin(list(dates)))
        present = {r.event_date for r in events.select("event_date").distinct().collect()}  # no more than ``dates``
        gone = [d for d in dates if d not in present]
    elif not has_rows(events):
        return False
    for name in (*DATE_ROLLUPS, *(("fact_events",) if facts else ())):
        drop_dates(spark, paths.gold(name), gone)
    from_silver = {**DATE_ROLLUPS, **({"fact_events": gold.fact_events} if facts else {})}

    def write_rollup(name: str) -> None:
        publish_gold(from_silver[name](events), paths.gold(name), paths.fmt, whole=dates is None)

    def write_derived(name: str) -> None:
        derive, rollup = DERIVED[name]
        made = derive(read_table(spark, paths.gold(rollup), paths.fmt).drop("updated_at"))
        if "event_date" in made.columns:
            publish_gold(made, paths.gold(name), paths.fmt, whole=True)
        else:
            write_gold(made.withColumn("updated_at", F.current_timestamp()), paths.gold(name), paths.fmt)

    # The tables of a step do not need each other, and most are too small to fill a cluster alone.
    with ThreadPoolExecutor(WRITERS) as pool:
        for step, names in ((write_rollup, from_silver), (write_derived, DERIVED)):
            list(pool.map(step, names))
    return True


CHECKED = ("kpi_dau", "kpi_events_per_source", "kpi_conversion_rate", "fact_events")


def check_lake(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """Presence and emptiness of silver and of the main gold tables."""
    tables: dict[str, DataFrame | None] = {}
    for name, path in {"silver": paths.silver, **{t: paths.gold(t) for t in CHECKED}}.items():
        try:
            tables[name] = read_table(spark, path, paths.fmt)
        except MissingTableError:
            tables[name] = None
    return quality_report(tables, spark)


def run_batch(spark: SparkSession, paths: LakePaths) -> DataFrame | None:
    """Gate, silver, gold and checks. ``None`` means there was nothing to do."""
    if not run_silver(spark, paths) or not run_gold(spark, paths):
        return None
    return check_lake(spark, paths)
