"""One event id, user, session, page and minute hold a third of all rows: no task may hold them."""

import pytest

from eventlake.config import AlertConfig
from eventlake.operators import alerts, anomalies, baselines, gold, purchases, quality, realtime, sessions, silver, upserts
from eventlake.plans import serving

ROWS = 60_000
LIMIT = ROWS // 6


@pytest.fixture(scope="module")
def session(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "32")
    own.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    own.conf.set("spark.sql.session.timeZone", "UTC")
    return own


@pytest.fixture(scope="module")
def skewed(session, tmp_path_factory):
    """A third of the rows are one user in one session within twenty minutes; the rest is spread."""
    path = str(tmp_path_factory.mktemp("skew") / "bronze")
    rows = session.range(ROWS).selectExpr("id", "id % 3 = 0 AS hot", "pmod(xxhash64(id), 1000000) AS h").selectExpr(
        "CAST(id AS STRING) AS event_id",
        "CAST(IF(hot, 1, 2 + h % 5000) AS INT) AS user_id",
        "element_at(array('view', 'view', 'add_to_cart', 'purchase', 'logout'), CAST(h % 5 + 1 AS INT)) AS event_type",
        "IF(hot, '/home', concat('/p', h % 10)) AS page",
        """TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0,
           IF(hot, h % 1200, h * 2.5)) AS event_timestamp""",
        "IF(hot, 'web', 'mobile') AS source",
        "IF(hot, 'hot', concat('s', h % 7000)) AS session_id",
        "CAST(1 + h % 90 AS DOUBLE) AS price",
        "IF(hot, 'Electronics', 'Books') AS category",
        "concat('PROD-', IF(hot, 0, h % 3000)) AS product_id",
        "hot",
    )
    rows = rows.selectExpr(
        "*", "event_timestamp AS ingestion_timestamp", "to_date(event_timestamp) AS event_date"
    )
    rows.repartition(16).write.parquet(path)
    return session.read.parquet(path)


@pytest.fixture(scope="module")
def copies(skewed):
    """The same rows, with a third of them copies of one event."""
    return skewed.selectExpr("IF(hot, 'copy', event_id) AS event_id", *[c for c in skewed.columns if c not in ("event_id", "hot")])


def largest_task(df):
    """Most shuffle records that one task of the query reads."""
    context = df.sparkSession.sparkContext
    store = context._jsc.sc().statusStore()
    group = f"skew-{id(df)}"
    context.setJobGroup(group, group)
    try:
        df.write.format("noop").mode("overwrite").save()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    context._jsc.sc().listenerBus().waitUntilEmpty()
    most = 0
    tracker = context.statusTracker()
    for job in tracker.getJobIdsForGroup(group):
        for stage in tracker.getJobInfo(job).stageIds:
            tasks = store.taskList(stage, 0, 100_000)
            for i in range(tasks.size()):
                metrics = tasks.apply(i).taskMetrics()
                if metrics.isDefined():
                    most = max(most, metrics.get().shuffleReadMetrics().recordsRead())
    return most


ON_EVENTS = {
    "dim_users": gold.dim_users,
    "dim_pages": gold.dim_pages,
    "dau": gold.kpi_dau,
    "sources": gold.kpi_events_per_source,
    "pages": gold.kpi_purchases_per_page,
    "revenue": gold.kpi_revenue_daily,
    "conversion": gold.kpi_conversion_rate,
    "categories": gold.kpi_category_sales,
    "carts": gold.kpi_cart_abandonment,
    "user_day": gold.user_day,
    "minutes": realtime.events_per_minute,
    "cube": realtime.minute_cube,
    "metrics": anomalies.window_metrics,
    "exact_metrics": anomalies.window_metrics_exact,
    "sessions": sessions.sessions,
    "durations": lambda e: sessions.session_duration_anomalies(sessions.sessions(e)),
    "affinity": sessions.category_affinity,
    "bursts": lambda e: purchases.purchase_bursts(e, 60, 3),
    "prices": lambda e: purchases.abnormal_prices(e, 2.0),
    "rolling": lambda e: baselines.baseline_anomalies(anomalies.window_metrics(e)),
    "zscores": lambda e: baselines.zscore_flags(baselines.minute_features(e)),
    "first_alerts": lambda e: alerts.first_alerts(anomalies.detect_anomalies(e), AlertConfig()),
    "top_products": serving.top_products,
    "top_users": serving.top_users,
    "abandonment_by_category": serving.abandonment_by_category,
    "out_of_order": quality.out_of_order,
}


def test_the_measure_sees_a_hot_task(skewed):
    assert largest_task(skewed.repartition(32, "user_id")) > LIMIT


@pytest.mark.parametrize("name", ON_EVENTS)
def test_hot_user_session_and_minutes(skewed, name):
    assert largest_task(ON_EVENTS[name](skewed)) < LIMIT


ON_COPIES = {
    "silver": silver.silver,
    "dedupe": silver.dedupe_first,
    "report": silver.clean_report,
    "duplicates": lambda e: silver.duplicate_keys(e, ["event_id"]),
    "latest": lambda e: upserts.latest_by_key(e, ["event_id"], "ingestion_timestamp"),
    "quality": lambda e: quality.event_quality(e, e.agg({"event_timestamp": "max"}).scalar()),
}


@pytest.mark.parametrize("name", ON_COPIES)
def test_hot_event_id(copies, name):
    assert largest_task(ON_COPIES[name](copies)) < LIMIT
