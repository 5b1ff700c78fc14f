"""Named queries over a folder of tables: each maps (session, folder) to a DataFrame.

Money and rates are rounded here, at the edge, because sums of doubles depend on task order in
their last digits. Times are given without a zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.config import BaselineConfig, DetectorConfig, SessionConfig
from eventlake.functions import timerange
from eventlake.functions.parsing import parse_events, to_json_records
from eventlake.operators import (
    alerts, anomalies, baselines, features, gold, purchases, quality, realtime, sessions, silver, upserts,
)
from eventlake.plans import lake, models, serving
from eventlake.plans.batch import LakePaths
from eventlake.sources.fixtures import read_bronze
from eventlake.sources.scratch import cut_lineage, new_folder
from eventlake.sources.sinks import store_daily
from eventlake.sources.tables import read_table, table_exists

Query = Callable[[SparkSession, str], DataFrame]

# Detector settings for about fourteen events an hour instead of five a second.
LOOSE_BASELINE = BaselineConfig(
    traffic_sigma=(2.0, 2.5, 3.0), abandonment_sigma=1.5, abandonment_rate=0.5, revenue_drop=(0.5, 0.7, 0.9)
)

HOURLY = DetectorConfig(
    width="1 hour",
    revenue_baseline=130.0,
    traffic_min=10, traffic_max=18, traffic_low_high=8, traffic_low_critical=6,
    traffic_peak_high=21, traffic_peak_critical=24,
    cart_min_adds=3, abandonment_max=0.50, abandonment_high=0.70, abandonment_critical=0.90,
    conversion_min_users=8, conversion_min=0.12, conversion_high=0.08, conversion_critical=0.04,
    category_min_purchases=3, category_dominance=0.30,
)
SESSION_GAP = SessionConfig(gap="6 hours")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns])


def utc(column: str) -> Column:
    """Zone-less UTC time of an instant, whatever the session zone is."""
    local = F.col(column).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local).alias(column)


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    return silver.silver(read_bronze(spark, folder))


def _as_of(spark: SparkSession, folder: str) -> Column:
    return timerange.latest(spark.read.parquet(f"{folder}/events.parquet"), "ts")


def _hourly_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return anomalies.window_metrics_exact(read_bronze(spark, folder), HOURLY.width)


def _approximate_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """The approximate distinct counts, judged against the exact ones of the same windows."""
    approximate = anomalies.window_metrics(read_bronze(spark, folder), HOURLY.width)
    counts = {"users_close": "unique_users", "sessions_close": "unique_sessions", "buyers_close": "buyers"}
    exact = _hourly_metrics(spark, folder).select(
        "window_start", *[F.col(c).alias(f"exact_{c}") for c in counts.values()]
    )
    close = [
        (F.abs(F.col(c) - F.col(f"exact_{c}")) <= F.greatest(F.lit(2), 0.2 * F.col(f"exact_{c}"))).alias(name)
        for name, c in counts.items()
    ]
    return approximate.join(exact, "window_start").select(
        "window_start", "total_events", "purchase_count", "cart_adds", *close
    )


def _findings(spark: SparkSession, folder: str) -> DataFrame:
    return anomalies.detect(_hourly_metrics(spark, folder), HOURLY)


def _log(spark: SparkSession, folder: str) -> DataFrame:
    return anomalies.log_entries(
        _findings(spark, folder), F.col("window_start") + F.expr("INTERVAL 1 HOUR")
    )


def _tables(spark: SparkSession, folder: str) -> serving.ServingTables:
    """The stored tables of the lake of a folder."""
    root = lake.stored_lake(spark, folder, HOURLY)
    return serving.ServingTables.from_lake(spark, LakePaths(root), lake.realtime_root(root))


def _stored_now(spark: SparkSession, folder: str) -> Column:
    """The newest event time of a folder, as the lake keeps it."""
    return timerange.latest(lake.newest_instant(spark, lake.stored_lake(spark, folder, HOURLY)))


# --- makers of queries -------------------------------------------------------------------------


def _on_bronze(build: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, folder: build(read_bronze(spark, folder), *args, **kwargs)


def _on_silver(build: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, folder: build(_silver(spark, folder), *args, **kwargs)


def _on_stored(build: Callable[..., DataFrame], layer: str, *args, **kwargs) -> Query:
    """An analyst's query over the stored bronze or silver table of the lake."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        paths = LakePaths(lake.stored_lake(spark, folder, HOURLY))
        return build(read_table(spark, getattr(paths, layer)), *args, **kwargs)

    return run


def _serve(build: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, folder: build(_tables(spark, folder), *args, **kwargs)


def _serve_at(build: Callable[..., DataFrame], *args, **kwargs) -> Query:
    """A serving query at the newest event time of the folder."""
    return lambda spark, folder: build(_tables(spark, folder), _stored_now(spark, folder), *args, **kwargs)


def _money(query: Query, *columns: str, digits: int = 2) -> Query:
    return lambda spark, folder: rounded(query(spark, folder), digits, *columns)


def _detector(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _numeric(anomalies.detect(_hourly_metrics(spark, folder), HOURLY, only=(name,)))

    return run


def _numeric(findings: DataFrame) -> DataFrame:
    """Text of numbers differs between engines; compare the metric as a number."""
    return findings.withColumn("metric_value", F.round(F.col("metric_value").try_cast("double"), 4))


# --- single queries ------------------------------------------------------------------------------


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    events = parse_events(to_json_records(read_bronze(spark, folder)))
    return events.select(
        *[utc(c) if c == "event_timestamp" else F.col(c) for c in events.columns if c != "event_date"]
    ).withColumn("event_date", F.to_date("event_timestamp"))


def _last_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze as a versioned table: the last arrival of each event id wins."""
    rows = read_bronze(spark, folder)
    return upserts.latest_by_key(rows, ["event_id"], "ingestion_timestamp").select(
        "event_id", "page", "ingestion_timestamp"
    )


def _buyers_join(spark: SparkSession, folder: str) -> DataFrame:
    rows = _silver(spark, folder)
    return gold.join_buyers(gold.kpi_dau(rows), gold.unique_buyers(rows))


def _rollup_kpis(spark: SparkSession, folder: str) -> DataFrame:
    """KPIs of a day from the shared rollups, side by side."""
    rows = _silver(spark, folder)
    users, sales = gold.user_day(rows), gold.kpi_category_sales(rows)
    conversion = gold.conversion_from_rollup(users)
    revenue = gold.revenue_from_category_sales(sales)
    return rounded(conversion.join(revenue, "event_date", "left"), 2, "total_revenue")


def _cube_tables(spark: SparkSession, folder: str, derive: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return derive(realtime.minute_cube(read_bronze(spark, folder)))


def _summary_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Daily summary kept as partial sums: even and odd hours stand for two batches with common keys."""
    log = _log(spark, folder)
    early = anomalies.anomaly_summary(log.filter("hour(detected_at) % 2 = 0"))
    late = anomalies.anomaly_summary(log.filter("hour(detected_at) % 2 = 1"))
    return anomalies.merge_summaries(early.unionByName(late))


def _baselines(spark: SparkSession, folder: str) -> DataFrame:
    rows = baselines.anomaly_baselines(_hourly_metrics(spark, folder), "1hour")
    return rounded(rows, 4, "avg_value", "stddev_value", "min_value", "max_value", "percentile_95")


def _stored_baselines(spark: SparkSession, folder: str) -> DataFrame:
    """Baselines merged from stored sketches of the days, some of which are written twice; the rank of the 95th percentile is checked."""
    metrics = cut_lineage(_hourly_metrics(spark, folder))
    path = new_folder(spark, "baselines")
    first = metrics.filter("dayofmonth(window_start) <= 20")
    second = metrics.filter("dayofmonth(window_start) >= 15")
    for part in (first, second):
        store_daily(baselines.daily_baselines(part), path)
    rows = baselines.merged_baselines(read_table(spark, path), "1hour")
    names = ", ".join(f"'{n}', CAST({n} AS DOUBLE)" for n in baselines.BASELINE_METRICS)
    values = metrics.selectExpr(f"stack({len(baselines.BASELINE_METRICS)}, {names}) AS (metric_name, value)").where("value IS NOT NULL")
    # The share of values up to the estimate, and below it, must enclose 0.95 up to the error.
    ranks = values.join(rows.select("metric_name", "percentile_95"), "metric_name").groupBy("metric_name").agg(
        F.avg((F.col("value") <= F.col("percentile_95")).cast("double")).alias("up_to"),
        F.avg((F.col("value") < F.col("percentile_95")).cast("double")).alias("below"),
    )
    error = baselines.RANK_ERROR
    checked = rows.join(ranks, "metric_name").withColumn("rank_is_right", (F.col("up_to") >= 0.95 - error) & (F.col("below") <= 0.95 + error))
    return rounded(checked.drop("percentile_95", "up_to", "below"), 4, "avg_value", "stddev_value", "min_value", "max_value")


def _rolling(spark: SparkSession, folder: str) -> DataFrame:
    rows = baselines.rolling_baseline(
        _hourly_metrics(spark, folder).select("window_start", "total_events", "total_revenue"),
        ("total_events", "total_revenue"),
    )
    numbers = [c for c in rows.columns if c.startswith(("total_events_", "total_revenue"))]
    return rounded(rows.withColumn("total_revenue", F.col("total_revenue")), 4, *numbers)


def _baseline_alerts(spark: SparkSession, folder: str) -> DataFrame:
    rows = baselines.baseline_anomalies(_hourly_metrics(spark, folder), LOOSE_BASELINE)
    return rounded(rows, 4, "value", "baseline", "deviation")


def _alert_payloads(spark: SparkSession, folder: str) -> DataFrame:
    rows = alerts.alert_payloads(_findings(spark, folder))
    message = "$.attachments[0].blocks"
    return rows.select(
        "window_start", "anomaly_type", "severity", "color", "title",
        F.get_json_object("payload_json", f"{message}[0].text.text").alias("heading"),
        F.get_json_object("payload_json", f"{message}[1].fields[1].text").alias("time_field"),
        F.get_json_object("payload_json", f"{message}[2].text.text").alias("details"),
        F.get_json_object("payload_json", f"{message}[3].elements[1].value").alias("acknowledge"),
    )


def _in_range(spark: SparkSession, folder: str) -> DataFrame:
    rows = timerange.in_range(
        read_bronze(spark, folder), "event_timestamp", "7d", _as_of(spark, folder)
    )
    return rows.select("event_id", "event_timestamp", "page")


def _session_rows(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.sessions(_silver(spark, folder), SESSION_GAP)


def _labelled_events(spark: SparkSession, folder: str) -> DataFrame:
    rows = sessions.assign_sessions(_silver(spark, folder), SESSION_GAP)
    return rows.select("event_id", "user_id", "session_start")


def _zscores(spark: SparkSession, folder: str) -> DataFrame:
    names = tuple(n for n in baselines.FEATURES if n != "unique_users_per_minute")
    rows = baselines.minute_features(read_bronze(spark, folder), "1 hour")
    flagged = baselines.zscore_flags(rows, names, 2.0)
    return flagged.select(
        "window_start", *[F.round(f"{n}_zscore", 4).alias(f"{n}_zscore") for n in names], "is_anomaly"
    )


def _revenue_drops(spark: SparkSession, folder: str) -> DataFrame:
    hourly = realtime.revenue_per_minute(read_bronze(spark, folder), "1 hour")
    return rounded(baselines.revenue_below_daily_average(hourly), 4, "revenue", "average_24h")


def _forecast(spark: SparkSession, folder: str) -> DataFrame:
    rows = _silver(spark, folder)
    return features.revenue_forecast(gold.kpi_category_sales(rows), F.to_date(_as_of(spark, folder)))


def _filled_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Five-minute metrics of all events with the silent windows filled in."""
    events = read_bronze(spark, folder)
    first = F.date_trunc("hour", events.agg(F.min("event_timestamp").alias("t")).scalar())
    last = F.date_trunc("hour", _as_of(spark, folder)) + F.expr("INTERVAL 1 HOUR")
    metrics = anomalies.window_metrics_exact(events)
    filled = anomalies.fill_empty_windows(metrics, first, last, "5 minutes")
    return filled.select(
        "window_start", "window_end", "total_events", "purchase_count", F.round("total_revenue", 2).alias("total_revenue")
    )


def _quality(spark: SparkSession, folder: str) -> DataFrame:
    tables = _tables(spark, folder).named()
    names = ("daily_active_users", "events_per_source_daily", "conversion_rate_daily")
    return quality.quality_report({n: tables[n] for n in names})


def _event_quality(spark: SparkSession, folder: str) -> DataFrame:
    noon = F.date_trunc("day", _as_of(spark, folder)) + F.expr("INTERVAL 12 HOURS")
    return quality.event_quality(read_bronze(spark, folder), noon, late_after="1 minute")


def _free_sql(spark: SparkSession, folder: str) -> DataFrame:
    serving.register_views(_tables(spark, folder))
    return serving.run_sql(
        spark,
        """
        SELECT d.event_date, d.dau_count, r.total_purchases
        FROM daily_active_users d JOIN revenue_daily r ON d.event_date = r.event_date
        WHERE r.total_purchases > 60
        """,
    )


def _table_by_path(spark: SparkSession, folder: str) -> DataFrame:
    """A stored table named by its path in SQL."""
    path = LakePaths(lake.stored_lake(spark, folder, HOURLY)).gold("kpi_conversion_rate")
    return spark.sql(f"SELECT event_date, conversion_rate FROM parquet.`{path}` WHERE conversion_rate > 0.3")


def _table_presence(spark: SparkSession, folder: str) -> DataFrame:
    """Which stored tables are there, and how many rows they have."""
    paths = LakePaths(lake.stored_lake(spark, folder, HOURLY))
    names = ("kpi_dau", "kpi_revenue_daily", "fact_events", "kpi_unknown")
    there = [n for n in names if table_exists(spark, paths.gold(n))]
    counts = quality.row_counts({n: read_table(spark, paths.gold(n)) for n in there})
    listed = spark.createDataFrame([(n,) for n in names], "table string")
    return listed.join(counts, "table", "left").select("table", F.col("rows").isNotNull().alias("present"), "rows")


def _revenue_day(spark: SparkSession, folder: str) -> DataFrame:
    day = timerange.yesterday(_stored_now(spark, folder))
    return serving.revenue_and_conversion(_tables(spark, folder), day)


def _anomaly_columns(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(spark, folder).withColumn(
            "current", F.round(F.col("current").try_cast("double"), 4)
        )

    return run


def batch_queries() -> dict[str, Query]:
    """Every batch operator and serving query by name."""
    q: dict[str, Query] = {}

    # Sources, parsing, silver
    q["s2_table_scan"] = lambda spark, folder: read_table(spark, f"{folder}/events.parquet").select(
        "event_id", "ts", "user_id", "event_type", "value", "props"
    )
    q["s9_alert_payloads"] = _alert_payloads
    q["s11_latest_by_key"] = _last_versions
    q["p1_parse_events"] = _parsed
    q["p3_required_fields"] = _on_bronze(lambda b: silver.valid_required(b).select("event_id", "page"))
    q["p4_valid_domains"] = _on_bronze(lambda b: silver.valid_domains(b).select("event_id", "page"))
    q["p8_complete_purchases"] = _on_bronze(lambda b: silver.valid_purchase(b).select("event_id", "page"))
    q["p9_clean_events"] = _on_bronze(silver.clean_events)
    q["p10_fact_events"] = _on_silver(gold.fact_events)
    q["p13_clean_report"] = _on_bronze(silver.clean_report)
    q["p13_reject_counts"] = _on_bronze(silver.reject_counts)
    q["p14_time_range"] = _in_range
    q["d1_dedupe_first"] = _on_bronze(silver.dedupe_first)
    q["d2_silver"] = _silver
    q["d4_duplicate_keys"] = _on_bronze(silver.duplicate_keys, ["event_id"])

    # Joins
    q["j1_cart_sessions"] = _on_silver(gold.cart_sessions)
    q["j2_buyers_join"] = _buyers_join

    # Gold
    q["k1_dim_users"] = _on_silver(gold.dim_users)
    q["k2_dim_pages"] = _on_silver(gold.dim_pages)
    q["k3_daily_active_users"] = _on_silver(gold.kpi_dau)
    q["k4_events_per_source"] = _on_silver(gold.kpi_events_per_source)
    q["k5_purchases_per_page"] = _on_silver(gold.kpi_purchases_per_page)
    q["k6_revenue_daily"] = _money(_on_silver(gold.kpi_revenue_daily), "total_revenue")
    q["k7_conversion_rate"] = _on_silver(gold.kpi_conversion_rate)
    q["k8_category_sales"] = _money(_on_silver(gold.kpi_category_sales), "category_revenue")
    q["k9_cart_abandonment"] = _on_silver(gold.kpi_cart_abandonment)
    q["k_rollup_kpis"] = _rollup_kpis
    q["k14_anomaly_summary"] = lambda spark, folder: anomalies.anomaly_summary(_log(spark, folder))
    q["k14_summary_merge"] = _summary_merge
    q["a12_anomaly_baselines"] = _baselines

    # Minute tables
    q["a12_stored_baselines"] = _stored_baselines
    q["r1_events_per_minute"] = _on_bronze(realtime.events_per_minute)
    q["r2_revenue_per_minute"] = _money(_on_bronze(realtime.revenue_per_minute), "revenue")
    q["r3_purchases_per_minute"] = _on_bronze(realtime.purchases_per_minute)
    q["r4_category_velocity"] = _money(_on_bronze(realtime.category_velocity), "revenue")
    q["r6_five_minute_events"] = _on_bronze(realtime.events_per_minute, "5 minutes")
    q["r11_logins_per_source"] = _on_bronze(realtime.logins_per_source)
    q["r_minute_cube"] = _money(_on_bronze(realtime.minute_cube), "revenue")
    q["r1_from_cube"] = lambda spark, folder: _cube_tables(spark, folder, realtime.events_from_cube)
    q["r2_from_cube"] = _money(
        lambda spark, folder: _cube_tables(spark, folder, realtime.revenue_from_cube), "revenue"
    )
    q["r4_from_cube"] = _money(
        lambda spark, folder: _cube_tables(spark, folder, realtime.category_velocity_from_cube), "revenue"
    )

    # Sessions
    q["r12_sessions"] = _money(_session_rows, "revenue", "duration_seconds", digits=6)
    q["r12_session_labels"] = _labelled_events
    q["c9_session_duration"] = _money(
        lambda spark, folder: sessions.session_duration_anomalies(_session_rows(spark, folder), 2.0),
        "duration_seconds", "duration_zscore", digits=6,
    )
    q["c9_category_affinity"] = _on_silver(sessions.category_affinity)

    # Anomalies
    q["ad_window_metrics"] = _money(_hourly_metrics, "total_revenue", "avg_purchase_price", digits=6)
    q["ad_approximate_metrics"] = _approximate_metrics
    q["ad1_revenue_drop"] = _detector("revenue_drop")
    q["ad2_traffic"] = _detector("traffic")
    q["ad3_cart_abandonment"] = _detector("cart_abandonment")
    q["ad4_conversion_drop"] = _detector("conversion_drop")
    q["ad5_data_quality"] = _detector("data_quality")
    q["ad6_category_imbalance"] = _detector("category_imbalance")
    q["ad7_all_detectors"] = lambda spark, folder: _numeric(_findings(spark, folder))
    q["ad_filled_windows"] = _filled_windows
    q["w5_rolling_baseline"] = _rolling
    q["c1_zscore_flags"] = _zscores
    q["c2_baseline_anomalies"] = _baseline_alerts
    q["c3_first_alerts"] = lambda spark, folder: _numeric(
        alerts.first_alerts(
            _findings(spark, folder), alerts.AlertConfig(dedup_window="6 hours")
        )
    )
    q["c4_alert_routes"] = lambda spark, folder: alerts.route_alerts(_findings(spark, folder)).select(
        "window_start", "anomaly_type", "severity", "channel"
    )
    q["c10_revenue_below_average"] = _revenue_drops

    # Dashboards
    q["q1_latest_dau"] = _serve(serving.latest_dau)
    q["q2_latest_conversion"] = _serve(serving.latest_conversion_pct)
    q["q3_latest_revenue"] = _money(_serve(serving.latest_revenue), "total_revenue")
    q["q4_total_events_latest_date"] = _serve(serving.total_events_latest_date)
    q["q5_event_series"] = _serve_at(serving.event_series)
    q["q6_revenue_series"] = _money(_serve_at(serving.revenue_series), "revenue")
    q["q7_top_categories_latest"] = _serve(serving.top_categories_latest_date)
    q["q8_latest_purchases"] = _serve(serving.latest_total_purchases)
    q["q9_events_today"] = _serve_at(serving.total_events_today)
    q["q10_events_last_hour"] = _serve_at(serving.events_last_hour)
    q["q11_events_by_source"] = _serve_at(serving.events_by_source_today)
    q["q12_top_pages"] = _serve_at(serving.top_pages_today)
    q["q13_active_alerts"] = _serve_at(serving.active_alerts)
    q["q14_critical_alerts"] = _serve_at(serving.critical_alerts)
    q["q15_alerts_by_severity"] = _serve_at(serving.alerts_by_severity)
    q["q16_alerts_by_type"] = _serve_at(serving.alerts_by_type)
    q["q17_recent_alerts"] = _anomaly_columns(_serve_at(serving.recent_alerts))
    q["q18_anomaly_timeline"] = _serve_at(serving.anomaly_timeline)

    # Analysts
    q["q19_recent_activity"] = _serve(serving.recent_activity)
    q["q19_latest_windows"] = _serve(serving.latest_windows)
    q["q20_current_minute"] = _serve_at(serving.current_minute_events)
    q["q21_hourly_totals"] = _serve_at(serving.hourly_totals_by_type)
    q["q22_logins_by_source"] = _serve_at(serving.logins_by_source, "12 hours")
    q["q22_login_trend"] = _serve(serving.login_trend)
    q["q22_login_series"] = _serve(serving.login_series)
    q["q23_recent_purchases"] = _serve(serving.recent_purchases)
    q["q23_purchase_rate"] = _serve_at(serving.purchase_rate, "12 hours")
    q["q24_dau_history"] = _serve(serving.dau_history)
    q["q24_dau_growth"] = _serve(serving.dau_growth)
    q["q24_week_over_week"] = _serve(serving.dau_week_over_week)
    q["q24_dau_trend"] = _serve_at(serving.dau_trend)
    q["q25_conversion_today"] = _serve_at(serving.conversion_today)
    q["q25_conversion_trend"] = _serve(serving.conversion_trend)
    q["q25_conversion_series"] = _serve(serving.conversion_series)
    q["q26_source_share"] = _serve_at(serving.source_share)
    q["q26_mobile_vs_web"] = _serve(serving.mobile_vs_web)
    q["q27_page_share"] = _serve_at(serving.page_share)
    q["q28_daily_summary"] = _serve_at(serving.daily_summary)
    q["q29_hour_vs_average"] = _money(
        _serve_at(serving.current_hour_vs_average), "avg_events_per_day_and_source", digits=4
    )
    q["q30_missing_minutes"] = _serve_at(serving.missing_minutes)
    q["q31_row_counts"] = _serve(serving.table_row_counts)
    q["q31_revenue_windows"] = _serve_at(serving.revenue_windows, "12 hours")
    q["q32_events_per_second"] = _money(
        _serve_at(serving.events_per_second, "1 hour"), "events_per_second", digits=6
    )
    q["q33_purchases_in_span"] = _serve_at(serving.purchases_in_span, "6 hours")
    q["q33_purchases_by_minute"] = _serve_at(serving.purchases_by_minute, "6 hours")
    q["q34_events_in_span"] = _serve_at(serving.events_in_span, "2 hours")
    q["q34_activity_by_minute"] = _serve_at(serving.activity_by_minute)
    q["q35_severity_today"] = _serve_at(serving.severity_counts_today)
    q["q35_weekly_review"] = _serve_at(serving.weekly_review)
    q["q35_latest_anomalies"] = _serve(serving.latest_anomalies)
    q["q36_revenue_yesterday"] = _money(_serve_at(serving.revenue_yesterday), "total_revenue")
    q["q36_top_categories_today"] = _serve_at(serving.top_categories_today)
    q["q37_revenue_trend"] = _money(_serve(serving.revenue_trend), "total_revenue")
    q["q37_top_categories"] = _serve(serving.top_categories_all_time)
    q["q37_average_abandonment"] = _money(_serve_at(serving.average_abandonment), "avg_rate", digits=6)
    q["q37_revenue_week"] = _money(_serve_at(serving.revenue_total), "total_revenue")
    q["q38_conversion_row"] = _serve(serving.latest_conversion_row)
    q["q38_revenue_row"] = _money(_serve(serving.latest_revenue_row), "total_revenue")
    q["q38_category_revenue"] = _serve_at(serving.category_revenue_today)
    q["q39_category_pie"] = _money(_serve_at(serving.category_pie), "category_revenue")
    q["q40_free_sql"] = _free_sql
    q["q40_table_by_path"] = _money(_table_by_path, "conversion_rate", digits=9)
    q["q41_order_value_trend"] = _serve(serving.order_value_trend)
    q["q41_purchases_today"] = _serve_at(serving.purchases_today)
    q["q41_conversion_above"] = _serve(serving.conversion_above)
    q["q41_category_sales"] = _money(_serve_at(serving.category_sales, "Electronics"), "category_revenue")
    q["q41_abandoned_yesterday"] = _serve_at(serving.carts_abandoned_yesterday)
    q["q41_purchases_last_hour"] = _serve_at(serving.purchases_last_hour)
    q["q41_revenue_now"] = _money(_serve(serving.revenue_now), "revenue")
    q["q42_revenue_and_conversion"] = _money(_revenue_day, "total_revenue")
    q["q43_purchases_vs_previous"] = _serve(serving.purchases_vs_previous_day)
    q["q44_revenue_by_hour"] = _money(_on_stored(serving.revenue_by_hour, "silver"), "revenue")
    q["q44_categories_by_week"] = _money(_on_stored(serving.categories_by_week, "silver"), "category_revenue")
    q["q45_revenue_growth"] = _money(
        _serve(serving.revenue_growth), "total_revenue", "previous_revenue"
    )
    q["q45_revenue_year_over_year"] = _money(
        _serve(serving.revenue_year_over_year), "total_revenue", "earlier_revenue"
    )
    q["q46_revenue_without_small"] = _money(
        _on_stored(serving.revenue_excluding_small, "silver"), "total_revenue"
    )
    q["q46_mobile_events"] = _on_stored(serving.mobile_events_per_minute, "bronze")
    q["q46_single_category"] = _money(_serve(serving.single_category_daily, "Electronics"), "category_revenue")
    q["q47_top_products"] = _on_stored(serving.top_products, "silver")
    q["q47_top_users"] = _on_stored(serving.top_users, "silver")
    q["q48_abandonment_by_category"] = _on_stored(serving.abandonment_by_category, "silver")
    q["q48_top_categories_rate"] = _on_stored(serving.top_categories_with_abandonment, "silver")
    q["q49_abandonment_by_hour"] = _on_stored(serving.abandonment_by_hour, "silver")
    q["q50_revenue_by_category"] = _money(_serve(serving.revenue_by_category), "revenue")

    # Quality
    q["dq1_quality_report"] = _quality
    q["dq2_table_presence"] = _table_presence
    q["dq3_event_quality"] = _event_quality
    q["dq3_out_of_order"] = _on_bronze(quality.out_of_order)

    # Purchases and models
    q["c8_purchase_bursts"] = _on_silver(purchases.purchase_bursts, 86_400, 3)
    q["c8_abnormal_prices"] = _money(
        _on_silver(purchases.abnormal_prices, 2.0), "price_zscore", digits=4
    )
    q["c6_user_features"] = _rounded_features
    q["c7_revenue_forecast"] = _money(
        _forecast, "predicted_revenue", "lower_bound", "upper_bound", digits=3
    )
    q["c11_session_features"] = _money(
        lambda spark, folder: features.session_features(_session_rows(spark, folder)),
        "duration_seconds", digits=6,
    )
    q["c5_purchase_counts"] = _on_silver(features.purchase_counts)
    q["c5_recommendations"] = _on_silver(models.recommendations)
    q["c5_recommendation_facts"] = lambda spark, folder: models.recommendation_facts(
        models.recommendations(_silver(spark, folder)), _silver(spark, folder)
    )
    q["c6_segment_facts"] = lambda spark, folder: models.segment_facts(models.customer_segments(_silver(spark, folder)))
    q["c11_conversion_facts"] = lambda spark, folder: models.conversion_facts(
        models.conversion_scores(_session_rows(spark, folder))
    )
    q["c6_customer_segments"] = _on_silver(models.customer_segments)
    q["c11_conversion_scores"] = lambda spark, folder: models.conversion_scores(
        _session_rows(spark, folder)
    )
    return q


def _rounded_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.user_features(_silver(spark, folder))
    return rounded(rows, 6, *[c for c in rows.columns if c not in ("user_id", "purchases")])
