"""Serving queries over the KPI, minute and anomaly tables.

Every query takes the tables and an explicit ``as_of`` instant, so "today" and "the last hour" are
arguments and not the clock of the machine. Orderings end in a unique column where a limit follows.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventlake.functions.timerange import before, in_range, instant, since, today, yesterday
from eventlake.operators import gold, realtime
from eventlake.operators.quality import row_counts
from eventlake.plans.batch import LakePaths
from eventlake.sources.tables import read_table
from eventlake.streaming.sinks import read_log, read_realtime, stored_dates


TABLE_NAMES = (
    "daily_active_users", "events_per_source_daily", "purchases_per_page_daily", "conversion_rate_daily",
    "revenue_daily", "category_sales_daily", "cart_abandonment_daily", "events_per_minute",
    "purchases_per_minute", "revenue_per_minute", "category_velocity", "logins_per_source", "anomalies",
)

Source = DataFrame | Callable[[], DataFrame]


class ServingTables:
    """The tables dashboards and analysts read, each built when a query first asks for it."""

    def __init__(self, dates: dict[str, Callable[[], list[date]]] | None = None, **sources: Source):
        unknown = set(sources) - set(TABLE_NAMES)
        if unknown:
            raise ValueError(f"not serving tables: {sorted(unknown)}")
        self._sources = sources
        self._dates = dates or {}

    def dates(self, name: str) -> list[date]:
        """The dates of a table that is stored by date, the newest first; none if that is not known."""
        return self._dates[name]() if name in self._dates else []

    def __getattr__(self, name: str) -> DataFrame:
        sources = self.__dict__.get("_sources", {})
        if name not in sources:
            raise AttributeError(name)
        source = sources[name]
        if not isinstance(source, DataFrame):
            source = sources[name] = source()
        return source

    @classmethod
    def from_events(
        cls, events: DataFrame, silver: Callable[[], DataFrame], anomalies: Callable[[], DataFrame]
    ) -> ServingTables:
        """Compute every table from events; ``silver`` and ``anomalies`` are built on demand."""
        clean = cache(silver)
        return cls(
            daily_active_users=lambda: gold.kpi_dau(clean()),
            events_per_source_daily=lambda: gold.kpi_events_per_source(clean()),
            purchases_per_page_daily=lambda: gold.kpi_purchases_per_page(clean()),
            conversion_rate_daily=lambda: gold.kpi_conversion_rate(clean()),
            revenue_daily=lambda: gold.kpi_revenue_daily(clean()),
            category_sales_daily=lambda: gold.kpi_category_sales(clean()),
            cart_abandonment_daily=lambda: gold.kpi_cart_abandonment(clean()),
            events_per_minute=lambda: realtime.events_per_minute(events),
            purchases_per_minute=lambda: realtime.purchases_per_minute(events),
            revenue_per_minute=lambda: realtime.revenue_per_minute(events),
            category_velocity=lambda: realtime.category_velocity(events),
            logins_per_source=lambda: realtime.logins_per_source(events),
            anomalies=anomalies,
        )

    @classmethod
    def from_lake(cls, spark: SparkSession, paths: LakePaths, realtime_root: str) -> ServingTables:
        """The stored tables: gold KPIs, minute tables over the newest rows of the stored cube, the anomaly log.

        A filter on ``event_date`` prunes the scan of each of them; the date of a finding is that of its detection.
        """
        def kpi(name: str) -> Source:
            return lambda: read_table(spark, paths.gold(name), paths.fmt).drop("updated_at")

        cube_path, log_path = f"{realtime_root}/minute_cube", f"{realtime_root}/anomalies"
        cube_dates, log_dates = (cache(lambda path=path: stored_dates(spark, path)) for path in (cube_path, log_path))
        minute_tables = ("events_per_minute", "purchases_per_minute", "revenue_per_minute", "category_velocity", "logins_per_source")
        cube = cache(lambda: read_realtime(spark, f"{realtime_root}/minute_cube", realtime.MINUTE_CUBE_KEYS, dated=True))
        return cls(
            {**dict.fromkeys(minute_tables, cube_dates), "anomalies": log_dates},
            daily_active_users=kpi("kpi_dau"),
            events_per_source_daily=kpi("kpi_events_per_source"),
            purchases_per_page_daily=kpi("kpi_purchases_per_page"),
            conversion_rate_daily=kpi("kpi_conversion_rate"),
            revenue_daily=kpi("kpi_revenue_daily"),
            category_sales_daily=kpi("kpi_category_sales"),
            cart_abandonment_daily=kpi("kpi_cart_abandonment"),
            events_per_minute=lambda: realtime.events_from_cube(cube()),
            purchases_per_minute=lambda: realtime.purchases_from_cube(cube()),
            revenue_per_minute=lambda: realtime.revenue_from_cube(cube()),
            category_velocity=lambda: realtime.category_velocity_from_cube(cube()),
            logins_per_source=lambda: realtime.logins_from_cube(cube()),
            anomalies=lambda: read_log(spark, f"{realtime_root}/anomalies"),
        )

    def named(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLE_NAMES if name in self._sources}


def register_views(tables: ServingTables) -> None:
    """Make every table a temporary view, so that free SQL can be run over them."""
    for name, df in tables.named().items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, sql: str) -> DataFrame:
    return spark.sql(sql)


def first_rows(table: DataFrame, n: int = 10) -> DataFrame:
    return table.limit(n)


# --- helpers ---------------------------------------------------------------------------------


def _newest(df: DataFrame, n: int = 1, time: str = "event_date") -> DataFrame:
    return df.orderBy(F.desc(time)).limit(n)


def _newest_rows(t: ServingTables, name: str, n: int, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The first ``n`` rows that ``build`` makes of a table, newest first, from no more of its newest dates than it takes."""
    table, dates = getattr(t, name), t.dates(name)
    taken = 1
    while taken < len(dates):
        recent = build(table.filter(F.col("event_date") >= F.lit(dates[taken - 1])))
        if recent.limit(n).count() == n:
            return recent.limit(n)
        taken *= 4
    return build(table).limit(n)


def _pct(ratio: str = "conversion_rate") -> Column:
    return F.round(F.col(ratio) * 100, 2)


def _on_latest_date(df: DataFrame) -> DataFrame:
    newest = df.agg(F.max("event_date").alias("d")).scalar()
    return df.filter(F.col("event_date") == newest)


def _on(df: DataFrame, day: Column) -> DataFrame:
    return df.filter(F.col("event_date") == day)


def _since(df: DataFrame, as_of, span: str, time: str = "window_start") -> DataFrame:
    return since(df, time, before(as_of, span))


def _share(value: str, *keys: str) -> Column:
    return F.round(100.0 * F.col(value) / F.sum(value).over(W.partitionBy(*keys)), 2)


# --- headline numbers (dashboard) --------------------------------------------------------------


def latest_dau(t: ServingTables) -> DataFrame:
    return _newest(t.daily_active_users).select("dau_count")


def latest_conversion_pct(t: ServingTables) -> DataFrame:
    return _newest(t.conversion_rate_daily).select(_pct().alias("conversion_pct"))


def latest_revenue(t: ServingTables) -> DataFrame:
    return _newest(t.revenue_daily).select("total_revenue")


def total_events_latest_date(t: ServingTables) -> DataFrame:
    return _on_latest_date(t.events_per_source_daily).agg(
        F.coalesce(F.sum("event_count"), F.lit(0)).alias("total_events")
    )


def latest_total_purchases(t: ServingTables) -> DataFrame:
    return _newest(t.revenue_daily).select("total_purchases")


def total_events_today(t: ServingTables, as_of) -> DataFrame:
    return _on(t.events_per_source_daily, today(as_of)).agg(F.sum("event_count").alias("total_events"))


def event_series(t: ServingTables, as_of, span: str = "24h") -> DataFrame:
    return (
        in_range(t.events_per_minute, "window_start", span, as_of)
        .groupBy("window_start", "event_type")
        .agg(F.sum("event_count").alias("event_count"))
        .orderBy("window_start", "event_type")
    )


def revenue_series(t: ServingTables, as_of, span: str = "24h") -> DataFrame:
    return (
        in_range(t.revenue_per_minute, "window_start", span, as_of)
        .select("window_start", "revenue")
        .orderBy("window_start")
    )


def top_categories_latest_date(t: ServingTables, n: int = 10) -> DataFrame:
    return _top_categories(_on_latest_date(t.category_sales_daily), n)


def _top_categories(sales: DataFrame, n: int) -> DataFrame:
    return sales.select("category", "units_sold").orderBy(F.desc("units_sold"), "category").limit(n)


def events_last_hour(t: ServingTables, as_of) -> DataFrame:
    return (
        _since(t.events_per_minute, as_of, "1 hour")
        .select("window_start", "event_type", "event_count")
        .orderBy("window_start", "event_type")
    )


def events_by_source_today(t: ServingTables, as_of) -> DataFrame:
    return _on(t.events_per_source_daily, today(as_of)).select("source", "event_count")


def top_pages_today(t: ServingTables, as_of, n: int = 10) -> DataFrame:
    return (
        _on(t.purchases_per_page_daily, today(as_of))
        .select("page", "purchase_count")
        .orderBy(F.desc("purchase_count"), "page")
        .limit(n)
    )


# --- anomaly log -------------------------------------------------------------------------------


def active_alerts(t: ServingTables, as_of) -> DataFrame:
    recent = _since(t.anomalies, as_of, "1 hour", "detected_at")
    return recent.filter("acknowledged = 0").agg(F.count("*").alias("active_alerts"))


def critical_alerts(t: ServingTables, as_of) -> DataFrame:
    recent = _since(t.anomalies, as_of, "24 hours", "detected_at")
    return recent.filter("severity = 'critical'").agg(F.count("*").alias("critical_alerts"))


def alerts_by_severity(t: ServingTables, as_of) -> DataFrame:
    recent = _since(t.anomalies, as_of, "24 hours", "detected_at")
    return recent.groupBy("severity").agg(F.count("*").alias("value"))


def alerts_by_type(t: ServingTables, as_of) -> DataFrame:
    recent = _since(t.anomalies, as_of, "24 hours", "detected_at")
    return (
        recent.groupBy("anomaly_type").agg(F.count("*").alias("value")).orderBy(F.desc("value"), "anomaly_type")
    )


def _newest_first(log: DataFrame) -> DataFrame:
    return log.orderBy(F.desc("detected_at"), F.desc("window_start"), "anomaly_type")


def recent_alerts(t: ServingTables, as_of, n: int = 100) -> DataFrame:
    recent = _newest_first(_since(t.anomalies, as_of, "6 hours", "detected_at")).limit(n)
    return recent.select(
        F.date_format("detected_at", "yyyy-MM-dd HH:mm:ss").alias("detected_at"),
        "severity",
        "anomaly_type",
        "description",
        F.col("metric_value").alias("current"),
        F.col("expected_value").alias("expected"),
        F.when(F.col("acknowledged") == 1, "✅ Acked").otherwise("❌ Active").alias("status"),
    )


def anomaly_timeline(t: ServingTables, as_of) -> DataFrame:
    recent = _since(t.anomalies, as_of, "24 hours", "detected_at")
    hour = F.date_trunc("hour", F.col("detected_at")).alias("time")
    return recent.groupBy(hour, "severity").agg(F.count("*").alias("value")).orderBy("time", "severity")


def severity_counts_today(t: ServingTables, as_of) -> DataFrame:
    todays = since(t.anomalies, "detected_at", today(as_of))
    return todays.groupBy("severity").agg(F.count("*").alias("total"))


def weekly_review(t: ServingTables, as_of) -> DataFrame:
    recent = since(t.anomalies, "detected_at", F.date_sub(today(as_of), 7))
    return (
        recent.groupBy("anomaly_type")
        .agg(
            F.count("*").alias("total"),
            F.count_if(F.col("severity") == "critical").alias("critical"),
            F.count_if(F.col("severity") == "high").alias("high"),
        )
        .orderBy(F.desc("total"), "anomaly_type")
    )


def latest_anomalies(t: ServingTables, n: int = 10) -> DataFrame:
    return _newest_rows(t, "anomalies", n, _newest_first).select(
        F.date_format("detected_at", "HH:mm:ss").alias("time"), "severity", "anomaly_type", "description"
    )


# --- minute tables (analyst) -------------------------------------------------------------------


def recent_activity(t: ServingTables, n: int = 20) -> DataFrame:
    def build(rows: DataFrame) -> DataFrame:
        totals = rows.groupBy("window_start", "event_type").agg(F.sum("event_count").alias("total_events"))
        return totals.orderBy(F.desc("window_start"), "event_type")

    return _newest_rows(t, "events_per_minute", n, build)


def latest_windows(t: ServingTables, n: int = 10) -> DataFrame:
    return _newest_rows(
        t, "events_per_minute", n,
        lambda rows: rows.select("window_start", "event_type", "event_count").orderBy(F.desc("window_start"), "event_type"),
    )


def current_minute_events(t: ServingTables, as_of) -> DataFrame:
    now = F.date_trunc("minute", instant(as_of))
    return (
        since(t.events_per_minute, "window_start", now).filter(F.col("window_start") == now)
        .groupBy("event_type")
        .agg(F.sum("event_count").alias("count"))
        .orderBy(F.desc("count"), "event_type")
    )


def hourly_totals_by_type(t: ServingTables, as_of, span: str = "1 hour") -> DataFrame:
    return (
        _since(t.events_per_minute, as_of, span)
        .groupBy("event_type")
        .agg(
            F.sum("event_count").alias("total"),
            F.avg("event_count").alias("avg_per_minute"),
            F.max("event_count").alias("peak"),
        )
        .orderBy(F.desc("total"), "event_type")
    )


def logins_by_source(t: ServingTables, as_of, span: str = "30 minutes") -> DataFrame:
    return (
        _since(t.logins_per_source, as_of, span)
        .groupBy("source")
        .agg(F.sum("login_count").alias("total_logins"))
        .orderBy(F.desc("total_logins"), "source")
    )


def login_trend(t: ServingTables, n: int = 20) -> DataFrame:
    def build(rows: DataFrame) -> DataFrame:
        logins = rows.groupBy("window_start", "source").agg(F.sum("login_count").alias("logins"))
        return logins.orderBy(F.desc("window_start"), "source")

    return _newest_rows(t, "logins_per_source", n, build)


def login_series(t: ServingTables) -> DataFrame:
    return t.logins_per_source.select("window_start", "source", "login_count").orderBy(
        "window_start", "source"
    )


def recent_purchases(t: ServingTables, n: int = 10) -> DataFrame:
    def build(rows: DataFrame) -> DataFrame:
        return rows.groupBy("window_start").agg(F.sum("purchase_count").alias("purchases")).orderBy(F.desc("window_start"))

    return _newest_rows(t, "purchases_per_minute", n, build)


def purchase_rate(t: ServingTables, as_of, span: str = "1 hour") -> DataFrame:
    """Purchases per active minute. The window rows are unique per minute after the upsert."""
    recent = _since(t.purchases_per_minute, as_of, span)
    minutes, purchases = F.countDistinct("window_start"), F.sum("purchase_count")
    return recent.agg(
        minutes.alias("minutes"),
        purchases.alias("total_purchases"),
        F.round(F.try_divide(purchases, minutes), 2).alias("avg_per_minute"),
    )


def events_per_second(t: ServingTables, as_of, span: str = "5 minutes") -> DataFrame:
    return (
        _since(t.events_per_minute, as_of, span)
        .groupBy("window_start")
        .agg((F.sum("event_count") / 60.0).cast("double").alias("events_per_second"))
        .orderBy("window_start")
    )


def purchases_in_span(t: ServingTables, as_of, span: str = "10 minutes") -> DataFrame:
    return (
        _since(t.purchases_per_minute, as_of, span)
        .select("window_start", "purchase_count")
        .orderBy("window_start")
    )


def purchases_by_minute(t: ServingTables, as_of, span: str = "1 hour") -> DataFrame:
    return (
        _since(t.purchases_per_minute, as_of, span)
        .groupBy(F.date_trunc("minute", F.col("window_start")).alias("time"))
        .agg(F.sum("purchase_count").alias("value"))
        .orderBy("time")
    )


def events_in_span(t: ServingTables, as_of, span: str = "5 minutes") -> DataFrame:
    return _since(t.events_per_minute, as_of, span).agg(F.sum("event_count").alias("events"))


def activity_by_minute(t: ServingTables, as_of, span: str = "1 hour") -> DataFrame:
    return (
        _since(t.events_per_minute, as_of, span)
        .groupBy(F.date_trunc("minute", F.col("window_start")).alias("time"), "event_type")
        .agg(F.sum("event_count").alias("events"))
        .orderBy(F.desc("time"), "event_type")
    )


def missing_minutes(t: ServingTables, as_of) -> DataFrame:
    """Minutes of the last hour without a row. The spine has sixty rows."""
    first = F.date_trunc("minute", before(as_of, "1 hour"))
    minute = F.expr("INTERVAL 1 MINUTE")
    spine = t.events_per_minute.sparkSession.range(1).select(
        F.explode(F.sequence(first, first + F.expr("INTERVAL 59 MINUTES"), minute)).alias("expected_minute")
    )
    seen = _since(t.events_per_minute, as_of, "1 hour").select(F.col("window_start").alias("expected_minute"))
    return spine.join(seen, "expected_minute", "left_anti").orderBy(F.desc("expected_minute"))


def revenue_windows(t: ServingTables, as_of, span: str = "1 hour") -> DataFrame:
    return _since(t.revenue_per_minute, as_of, span).agg(F.count("*").alias("windows"))


def purchases_last_hour(t: ServingTables, as_of) -> DataFrame:
    return _since(t.purchases_per_minute, as_of, "1 hour").agg(
        F.coalesce(F.sum("purchase_count"), F.lit(0)).alias("purchases")
    )


def revenue_now(t: ServingTables) -> DataFrame:
    newest = _newest_rows(t, "revenue_per_minute", 1, lambda rows: rows.orderBy(F.desc("window_start")))
    return newest.select("window_start", "revenue", "purchase_count")


# --- daily KPIs (analyst) ------------------------------------------------------------------------


def dau_history(t: ServingTables) -> DataFrame:
    return t.daily_active_users.orderBy(F.desc("event_date"))


def dau_growth(t: ServingTables) -> DataFrame:
    """Day-over-day change; the first day has no previous day and is NULL. One row per day."""
    previous = F.lag("dau_count").over(W.orderBy("event_date"))
    change = F.col("dau_count") - F.col("previous_day")
    return (
        t.daily_active_users.withColumn("previous_day", previous)
        .select(
            "event_date",
            "dau_count",
            "previous_day",
            change.alias("daily_change"),
            F.round(F.try_divide(100.0 * change.cast("double"), F.col("previous_day")), 2).alias("growth_percent"),
        )
        .orderBy(F.desc("event_date"))
    )


def dau_week_over_week(t: ServingTables) -> DataFrame:
    last_week = F.lag("dau_count", 7).over(W.orderBy("event_date"))
    change = (F.col("dau_count") - F.col("dau_last_week")).cast("double")
    return (
        t.daily_active_users.withColumn("dau_last_week", last_week)
        .select(
            "event_date",
            "dau_count",
            "dau_last_week",
            F.round(F.try_divide(100.0 * change, F.col("dau_last_week")), 1).alias("growth_pct"),
        )
        .orderBy(F.desc("event_date"))
    )


def _last_days(df: DataFrame, as_of, days: int) -> DataFrame:
    return df.filter(F.col("event_date") >= F.date_sub(today(as_of), days))


def dau_trend(t: ServingTables, as_of, days: int = 7) -> DataFrame:
    return _last_days(t.daily_active_users, as_of, days).select("event_date", "dau_count").orderBy("event_date")


def _conversion_rows(t: ServingTables) -> DataFrame:
    """Conversion with the purchases of the day, which live in the revenue table."""
    purchases = t.revenue_daily.select("event_date", "total_purchases")
    return t.conversion_rate_daily.join(purchases, "event_date", "left").select(
        "event_date",
        _pct().alias("conversion_pct"),
        F.coalesce("total_purchases", F.lit(0)).alias("total_purchases"),
        "dau_count",
    )


def conversion_today(t: ServingTables, as_of) -> DataFrame:
    return _on(_conversion_rows(t), today(as_of))


def conversion_trend(t: ServingTables, n: int = 7) -> DataFrame:
    return _newest(_conversion_rows(t), n)


def conversion_series(t: ServingTables) -> DataFrame:
    return t.conversion_rate_daily.select("event_date", _pct().alias("conversion_pct")).orderBy("event_date")


def source_share(t: ServingTables, as_of) -> DataFrame:
    todays = _on(t.events_per_source_daily, today(as_of))
    return todays.select(
        "source", "event_count", _share("event_count", "event_date").alias("percentage")
    ).orderBy(F.desc("event_count"), "source")


def mobile_vs_web(t: ServingTables) -> DataFrame:
    def count_of(source: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("source") == source, F.col("event_count"))), F.lit(0))

    return (
        t.events_per_source_daily.groupBy("event_date")
        .agg(
            count_of("mobile").alias("mobile_events"),
            count_of("web").alias("web_events"),
            F.round(100.0 * count_of("mobile") / F.sum("event_count").cast("double"), 2).alias("mobile_percentage"),
        )
        .orderBy(F.desc("event_date"))
    )


def page_share(t: ServingTables, as_of) -> DataFrame:
    todays = _on(t.purchases_per_page_daily, today(as_of))
    return todays.select(
        "page", "purchase_count", _share("purchase_count", "event_date").alias("percentage")
    ).orderBy(F.desc("purchase_count"), "page")


def daily_summary(t: ServingTables, as_of) -> DataFrame:
    """Users, conversion, purchases and events of one day. Each side is filtered to it first."""
    day = today(as_of)
    conversion = _on(t.conversion_rate_daily, day).select("event_date", _pct().alias("conversion_pct"))
    purchases = _on(t.revenue_daily, day).select("event_date", "total_purchases")
    events = _on(t.events_per_source_daily, day)
    return (
        _on(t.daily_active_users, day)
        .join(conversion, "event_date")
        .join(purchases, "event_date", "left")
        .join(events, "event_date")
        .groupBy("event_date", F.col("dau_count").alias("active_users"), "conversion_pct", "total_purchases")
        .agg(F.sum("event_count").alias("total_events"))
    )


def current_hour_vs_average(t: ServingTables, as_of) -> DataFrame:
    """Events of the running hour next to the average of the (date, source) rows.

    The average is over rows of the per-source table, not over days; the column says so.
    """
    hour = F.date_trunc("hour", instant(as_of))
    average = t.events_per_source_daily.agg(F.avg("event_count").alias("a")).scalar()
    this_hour = since(t.events_per_minute, "window_start", hour).agg(
        F.sum("event_count").alias("events_this_hour")
    )
    return this_hour.withColumn("avg_events_per_day_and_source", average).withColumn(
        "current_vs_avg_pct",
        F.round(
            F.try_divide(100.0 * F.col("events_this_hour").cast("double"), F.col("avg_events_per_day_and_source")), 2
        ),
    )


def table_row_counts(t: ServingTables) -> DataFrame:
    return row_counts(t.named())


def revenue_yesterday(t: ServingTables, as_of) -> DataFrame:
    return _on(t.revenue_daily, yesterday(as_of)).select(
        "total_revenue", "total_purchases", "avg_order_value"
    )


def top_categories_today(t: ServingTables, as_of, n: int = 5) -> DataFrame:
    return _top_categories(_on(t.category_sales_daily, today(as_of)), n)


def revenue_trend(t: ServingTables, n: int = 7) -> DataFrame:
    return _newest(t.revenue_daily, n).select("event_date", "total_revenue")


def top_categories_all_time(t: ServingTables, n: int = 3) -> DataFrame:
    return (
        t.category_sales_daily.groupBy("category")
        .agg(F.sum("units_sold").alias("total"))
        .orderBy(F.desc("total"), "category")
        .limit(n)
    )


def average_abandonment(t: ServingTables, as_of, days: int = 7) -> DataFrame:
    return _last_days(t.cart_abandonment_daily, as_of, days).agg(
        F.avg("abandonment_rate").alias("avg_rate")
    )


def revenue_total(t: ServingTables, as_of, days: int = 7) -> DataFrame:
    return _last_days(t.revenue_daily, as_of, days).agg(F.sum("total_revenue").alias("total_revenue"))


def latest_conversion_row(t: ServingTables) -> DataFrame:
    return _newest(t.conversion_rate_daily).select(
        "event_date", "dau_count", "unique_buyers", _pct().alias("conv_pct")
    )


def latest_revenue_row(t: ServingTables) -> DataFrame:
    return _newest(t.revenue_daily).select(
        "total_revenue", "total_purchases", F.round("avg_order_value", 2).alias("aov")
    )


def category_revenue_today(t: ServingTables, as_of) -> DataFrame:
    return (
        _on(t.category_sales_daily, today(as_of))
        .select("category", "units_sold", F.round("category_revenue", 2).alias("revenue"))
        .orderBy(F.desc("units_sold"), "category")
    )


def category_pie(t: ServingTables, as_of) -> DataFrame:
    return _on(t.category_sales_daily, today(as_of)).select("category", "category_revenue")


# --- plain KPI look-ups ----------------------------------------------------------------------------


def order_value_trend(t: ServingTables) -> DataFrame:
    return t.revenue_daily.select("event_date", "avg_order_value").orderBy("event_date")


def purchases_today(t: ServingTables, as_of) -> DataFrame:
    return _on(t.revenue_daily, today(as_of)).select("total_purchases")


def conversion_above(t: ServingTables, limit: float = 0.03) -> DataFrame:
    return _newest(t.conversion_rate_daily).select(
        "conversion_rate", (F.col("conversion_rate") > limit).alias("above_limit")
    )


def category_sales(t: ServingTables, as_of, category: str) -> DataFrame:
    return _on(t.category_sales_daily, today(as_of)).filter(F.col("category") == category).select(
        "category", "units_sold", "category_revenue"
    )


def carts_abandoned_yesterday(t: ServingTables, as_of) -> DataFrame:
    return _on(t.cart_abandonment_daily, yesterday(as_of)).select(
        "sessions_with_cart", "abandoned_carts", "abandonment_rate"
    )


# --- requests over silver (no stored KPI answers them) ---------------------------------------------


def revenue_and_conversion(t: ServingTables, day: Column) -> DataFrame:
    conversion = _on(t.conversion_rate_daily, day).select("event_date", "conversion_rate")
    return (
        _on(t.revenue_daily, day)
        .join(conversion, "event_date")
        .select("event_date", "total_revenue", "total_purchases", "conversion_rate")
    )


def purchases_vs_previous_day(t: ServingTables) -> DataFrame:
    by_date = W.orderBy("event_date")
    return (
        t.revenue_daily.select(
            "event_date",
            "total_purchases",
            F.lag("total_purchases").over(by_date).alias("previous_purchases"),
        )
        .withColumn("change", F.col("total_purchases") - F.col("previous_purchases"))
        .orderBy("event_date")
    )


def _purchases(silver: DataFrame) -> DataFrame:
    return silver.filter(F.col("event_type") == "purchase")


def revenue_by_hour(silver: DataFrame) -> DataFrame:
    return (
        _purchases(silver)
        .groupBy(F.date_trunc("hour", F.col("event_timestamp")).alias("hour"))
        .agg(F.sum("price").alias("revenue"), F.count("*").alias("purchases"))
    )


def categories_by_week(silver: DataFrame) -> DataFrame:
    return (
        _purchases(silver)
        .groupBy(F.date_trunc("week", F.col("event_timestamp")).alias("week"), "category")
        .agg(F.count("*").alias("units_sold"), F.sum("price").alias("category_revenue"))
    )


def revenue_growth(t: ServingTables) -> DataFrame:
    by_date = W.orderBy("event_date")
    previous = F.col("previous_revenue")
    return (
        t.revenue_daily.select(
            "event_date", "total_revenue", F.lag("total_revenue").over(by_date).alias("previous_revenue")
        )
        .withColumn("growth_pct", F.round(100.0 * F.try_divide(F.col("total_revenue") - previous, previous), 2))
        .orderBy("event_date")
    )


def revenue_year_over_year(t: ServingTables, months: int = 12) -> DataFrame:
    """Revenue of each day next to the same day ``months`` months before."""
    earlier = t.revenue_daily.select(
        F.add_months("event_date", months).alias("event_date"),
        F.col("total_revenue").alias("earlier_revenue"),
    )
    # Month ends of different length can fall on one date; add them up so that no day doubles.
    earlier = earlier.groupBy("event_date").agg(F.sum("earlier_revenue").alias("earlier_revenue"))
    change = F.col("total_revenue") - F.col("earlier_revenue")
    return (
        t.revenue_daily.select("event_date", "total_revenue")
        .join(earlier, "event_date", "left")
        .withColumn("change_pct", F.round(100.0 * F.try_divide(change, F.col("earlier_revenue")), 2))
    )


def revenue_excluding_small(silver: DataFrame, minimum: float = 50.0) -> DataFrame:
    return gold.kpi_revenue_daily(silver.filter(F.col("price") >= minimum))


def mobile_events_per_minute(events: DataFrame) -> DataFrame:
    return realtime.events_per_minute(events.filter(F.col("source") == "mobile"))


def single_category_daily(t: ServingTables, category: str) -> DataFrame:
    return t.category_sales_daily.filter(F.col("category") == category)


def top_products(silver: DataFrame, n: int = 10) -> DataFrame:
    return (
        _purchases(silver)
        .groupBy("product_id")
        .agg(F.count("*").alias("units_sold"))
        .orderBy(F.desc("units_sold"), "product_id")
        .limit(n)
    )


def top_users(silver: DataFrame, n: int = 10) -> DataFrame:
    return (
        _purchases(silver)
        .groupBy("user_id")
        .agg(F.count("*").alias("purchases"))
        .orderBy(F.desc("purchases"), "user_id")
        .limit(n)
    )


def abandonment_by_category(silver: DataFrame) -> DataFrame:
    """Cart sessions per category that did not buy in that category on that date."""
    return gold.abandonment(gold.cart_sessions(silver, "category"), "category")


def top_categories_with_abandonment(silver: DataFrame, n: int = 3) -> DataFrame:
    units = _purchases(silver).groupBy("category").agg(F.count("*").alias("units_sold"))
    best = units.orderBy(F.desc("units_sold"), "category").limit(n)
    return best.join(abandonment_by_category(silver), "category", "left").select(
        "category", "units_sold", "abandonment_rate"
    )


def abandonment_by_hour(silver: DataFrame) -> DataFrame:
    """Abandonment at hour grain: a cart counts in each hour it was filled in."""
    hourly = silver.withColumn("hour", F.date_trunc("hour", F.col("event_timestamp")))
    return gold.abandonment(gold.cart_sessions(hourly, "hour"), "hour")


def revenue_by_category(t: ServingTables) -> DataFrame:
    totals = t.category_sales_daily.groupBy("category").agg(F.sum("category_revenue").alias("revenue"))
    share = 100.0 * F.col("revenue") / F.sum("revenue").over(W.partitionBy())
    return totals.withColumn("revenue_pct", F.round(share, 2))
