"""Expected result of each catalogue query as SQL."""

from __future__ import annotations

from oracle.relations import (
    COMPLETE, DETECTORS, DOMAINS, RELATIONS, REQUIRED, half_up, window_columns, with_relations,
)

NOW = "(SELECT max(ts) FROM events)"
TODAY = f"CAST({NOW} AS DATE)"
YESTERDAY = f"({TODAY} - 1)"
LATEST = "ORDER BY event_date DESC LIMIT 1"
NUMERIC = "window_start, anomaly_type, severity, description, round(metric_value, 4) AS metric_value, expected_value"


def since(span: str, column: str = "window_start") -> str:
    return f"{column} >= {NOW} - INTERVAL '{span}'"


def _bodies() -> dict[str, str]:
    q: dict[str, str] = {}
    q["s2_table_scan"] = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
    q["s9_alert_payloads"] = """
SELECT window_start, anomaly_type, severity,
  CASE severity WHEN 'critical' THEN '#FF0000' ELSE '#FF6600' END AS color,
  label || ' Detected!' AS title, symbol || ' ' || label || ' Detected!' AS heading,
  '*Time:*' || chr(10) || strftime(window_start, '%Y-%m-%d %H:%M:%S') AS time_field,
  '*Details:*' || chr(10) || description AS details, 'ack_' || anomaly_type AS acknowledge
FROM findings JOIN (VALUES ('revenue_drop', 'Revenue Drop', '💰'), ('traffic_spike', 'Traffic Spike', '📈'),
  ('traffic_drop', 'Traffic Drop', '📉'), ('cart_abandonment_spike', 'Cart Abandonment Spike', '🛒'),
  ('conversion_drop', 'Conversion Drop', '📊'), ('category_imbalance', 'Category Imbalance', '⚖️'),
  ('data_quality', 'Data Quality', '⚠️')) AS names(anomaly_type, label, symbol) USING (anomaly_type)
WHERE severity IN ('critical', 'high')"""
    q["s11_latest_by_key"] = """
SELECT event_id, page, ingestion_timestamp FROM bronze
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingestion_timestamp DESC) = 1"""
    q["p1_parse_events"] = "SELECT * FROM bronze"
    q["p3_required_fields"] = f"SELECT event_id, page FROM bronze WHERE {REQUIRED}"
    q["p4_valid_domains"] = f"SELECT event_id, page FROM bronze WHERE {DOMAINS}"
    q["p8_complete_purchases"] = f"SELECT event_id, page FROM bronze WHERE {COMPLETE}"
    q["p9_clean_events"] = "SELECT * FROM clean"
    q["p10_fact_events"] = """
SELECT event_id, user_id, event_type, page, event_timestamp, source, event_date FROM silver"""
    q["p13_clean_report"] = """
SELECT (SELECT count(*) FROM bronze) AS rows_read, (SELECT count(*) FROM silver) AS rows_kept,
  (SELECT count(*) FROM bronze) - (SELECT count(*) FROM silver) AS rows_dropped,
  (SELECT count(*) FROM bronze WHERE event_date IS NULL) AS rows_undated"""
    known = "('Electronics', 'Fashion', 'Home', 'Books', 'Sports', 'Beauty', 'Toys', 'Food')"
    rejects = {
        "required_fields": f"NOT ({REQUIRED})",
        "event_type": "event_type IS NULL OR event_type NOT IN ('login', 'view', 'add_to_cart', 'purchase', 'logout')",
        "source": "source IS NULL OR source NOT IN ('web', 'mobile')",
        "user_id": "user_id IS NULL OR user_id <= 0",
        "category": f"category NOT IN {known}",
        "price": "price <= 0",
        "purchase_complete": f"NOT {COMPLETE}",
    }
    q["p13_reject_counts"] = " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) AS rejected FROM bronze WHERE {test}" for name, test in rejects.items()
    )
    q["p14_time_range"] = f"""
SELECT event_id, event_timestamp, page FROM bronze WHERE {since('7 days', 'event_timestamp')}"""
    q["d1_dedupe_first"] = """
SELECT * FROM bronze QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingestion_timestamp) = 1"""
    q["d2_silver"] = "SELECT * FROM silver"
    q["d4_duplicate_keys"] = """
SELECT event_id, count(*) AS "count" FROM bronze GROUP BY 1 HAVING count(*) > 1"""

    q["j1_cart_sessions"] = "SELECT * FROM cart_sessions"
    q["j2_buyers_join"] = "SELECT * FROM conversion_rate_daily"

    q["k1_dim_users"] = """
SELECT user_id, count(*) AS total_events, count(DISTINCT source) AS source_count FROM silver GROUP BY 1"""
    q["k2_dim_pages"] = "SELECT page, count(*) AS total_events FROM silver GROUP BY 1"
    q["k3_daily_active_users"] = "SELECT * FROM daily_active_users"
    q["k4_events_per_source"] = "SELECT * FROM events_per_source_daily"
    q["k5_purchases_per_page"] = "SELECT * FROM purchases_per_page_daily"
    q["k6_revenue_daily"] = """
SELECT event_date, round(total_revenue, 2) AS total_revenue, total_purchases, avg_order_value FROM revenue_daily"""
    q["k7_conversion_rate"] = "SELECT * FROM conversion_rate_daily"
    q["k8_category_sales"] = """
SELECT event_date, category, units_sold, round(category_revenue, 2) AS category_revenue FROM category_sales_daily"""
    q["k9_cart_abandonment"] = "SELECT * FROM cart_abandonment_daily"
    q["k_rollup_kpis"] = """
SELECT c.*, round(total_revenue, 2) AS total_revenue, total_purchases, avg_order_value
FROM conversion_rate_daily c LEFT JOIN revenue_daily r ON c.event_date = r.event_date"""
    summary = """
SELECT CAST(detected_at AS DATE) AS anomaly_date, severity, anomaly_type, count(*) AS anomaly_count
FROM anomalies GROUP BY ALL"""
    q["k14_anomaly_summary"] = summary
    q["k14_summary_merge"] = summary
    names = (
        "total_events", "unique_users", "unique_sessions", "total_revenue", "purchase_count",
        "avg_purchase_price", "cart_adds", "buyers",
    )
    values = " UNION ALL ".join(
        f"SELECT '{n}' AS metric_name, CAST({n} AS DOUBLE) AS v FROM metrics" for n in names
    )
    q["a12_anomaly_baselines"] = f"""
SELECT metric_name, '1hour' AS window_size, round(avg(v), 4) AS avg_value,
  round(stddev_samp(v), 4) AS stddev_value, round(min(v), 4) AS min_value, round(max(v), 4) AS max_value,
  round(quantile_disc(v, 0.95), 4) AS percentile_95, count(v) AS sample_count
FROM ({values}) GROUP BY 1"""

    q["a12_stored_baselines"] = f"""
SELECT metric_name, '1hour' AS window_size, round(avg(v), 4) AS avg_value,
  round(stddev_samp(v), 4) AS stddev_value, round(min(v), 4) AS min_value, round(max(v), 4) AS max_value,
  count(v) AS sample_count, true AS rank_is_right
FROM ({values}) GROUP BY 1"""

    q["r1_events_per_minute"] = "SELECT * FROM events_per_minute"
    revenue = "SELECT window_start, window_end, round(revenue, 2) AS revenue, purchase_count FROM revenue_per_minute"
    velocity = """
SELECT window_start, window_end, category, purchase_count, round(revenue, 2) AS revenue FROM category_velocity"""
    q["r2_revenue_per_minute"] = revenue
    q["r3_purchases_per_minute"] = "SELECT * FROM purchases_per_minute"
    q["r4_category_velocity"] = velocity
    q["r6_five_minute_events"] = f"""
SELECT {window_columns('5 minutes')}, event_type, count(*) AS event_count FROM bronze GROUP BY ALL"""
    q["r11_logins_per_source"] = "SELECT * FROM logins_per_source"
    q["r_minute_cube"] = f"""
SELECT {window_columns('1 minute')}, event_type, source, category, count(*) AS event_count,
  round(sum(price) FILTER (event_type = 'purchase'), 2) AS revenue
FROM bronze GROUP BY window_start, window_end, event_type, source, category"""
    q["r1_from_cube"] = q["r1_events_per_minute"]
    q["r2_from_cube"] = revenue
    q["r4_from_cube"] = velocity

    q["r12_sessions"] = """
SELECT * REPLACE (round(revenue, 6) AS revenue, round(duration_seconds, 6) AS duration_seconds) FROM session_rows"""
    q["r12_session_labels"] = "SELECT event_id, user_id, session_start FROM labelled"
    q["c9_session_duration"] = """
WITH timed AS (SELECT * FROM session_rows WHERE events > 1),
stats AS (SELECT avg(duration_seconds) AS m, stddev_samp(duration_seconds) AS s FROM timed)
SELECT user_id, session_start, round(duration_seconds, 6) AS duration_seconds,
  round((duration_seconds - m) / s, 6) AS duration_zscore,
  CASE WHEN duration_seconds > m THEN 'too_long' ELSE 'too_short' END AS kind
FROM timed, stats WHERE abs((duration_seconds - m) / s) > 2.0"""
    q["c9_category_affinity"] = """
SELECT user_id, category, count(*) AS events, count(DISTINCT session_id) AS sessions,
  round(count(*) / sum(count(*)) OVER (PARTITION BY user_id), 4) AS affinity
FROM silver WHERE category IS NOT NULL GROUP BY 1, 2"""

    q["ad_window_metrics"] = """
SELECT * REPLACE (round(total_revenue, 6) AS total_revenue, round(avg_purchase_price, 6) AS avg_purchase_price)
FROM metrics"""
    q["ad_approximate_metrics"] = """
SELECT window_start, total_events, purchase_count, cart_adds, true AS users_close, true AS sessions_close,
  true AS buyers_close FROM metrics"""
    for number, name in enumerate(DETECTORS, start=1):
        q[f"ad{number}_{name}"] = f"SELECT {NUMERIC} FROM {name}"
    q["ad7_all_detectors"] = f"SELECT {NUMERIC} FROM findings"
    q["ad_filled_windows"] = f"""
SELECT s AS window_start, s + INTERVAL '5 minutes' AS window_end, coalesce(total_events, 0) AS total_events,
  coalesce(purchase_count, 0) AS purchase_count,
  CASE WHEN total_events IS NULL THEN 0.0 ELSE round(total_revenue, 2) END AS total_revenue
FROM (SELECT unnest(generate_series(date_trunc('hour', (SELECT min(ts) FROM events)),
    date_trunc('hour', {NOW}) + INTERVAL '55 minutes', INTERVAL '5 minutes')) AS s) spine
LEFT JOIN five_minute_metrics ON s = window_start"""
    q["w5_rolling_baseline"] = """
SELECT window_start, total_events, round(total_revenue, 4) AS total_revenue,
  round(avg(total_events) OVER w, 4) AS total_events_mean,
  round(stddev_samp(total_events) OVER w, 4) AS total_events_std,
  CAST(min(total_events) OVER w AS BIGINT) AS total_events_min,
  CAST(max(total_events) OVER w AS BIGINT) AS total_events_max,
  round(avg(total_revenue) OVER w, 4) AS total_revenue_mean,
  round(stddev_samp(total_revenue) OVER w, 4) AS total_revenue_std,
  round(min(total_revenue) OVER w, 4) AS total_revenue_min,
  round(max(total_revenue) OVER w, 4) AS total_revenue_max,
  count(*) OVER w AS baseline_windows
FROM metrics WINDOW w AS (ORDER BY window_start ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)"""
    feature_names = (
        "events_per_minute", "revenue_per_minute", "avg_price", "cart_abandonment_rate", "purchases_per_minute",
    )
    score = {n: f"(({n}) - {n}_m) / ({n}_s + 0.0001)" for n in feature_names}
    q["c1_zscore_flags"] = f"""
WITH features AS (SELECT time_bucket(INTERVAL '1 hour', event_timestamp) AS window_start,
  count(*) AS events_per_minute,
  sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0 END) AS revenue_per_minute,
  avg(price) AS avg_price,
  1 - count(*) FILTER (event_type = 'purchase') / (count(*) FILTER (event_type = 'add_to_cart') + 1)
    AS cart_abandonment_rate,
  count(*) FILTER (event_type = 'purchase') AS purchases_per_minute FROM bronze GROUP BY 1),
stats AS (SELECT {', '.join(f'avg({n}) AS {n}_m, stddev_samp({n}) AS {n}_s' for n in feature_names)} FROM features)
SELECT window_start, {', '.join(f'round({z}, 4) AS {n}_zscore' for n, z in score.items())},
  {' OR '.join(f'coalesce(abs({z}) > 2.0, false)' for z in score.values())} AS is_anomaly
FROM features, stats"""
    deviations = """
WITH m AS (SELECT window_start, total_events, total_revenue,
    CASE WHEN cart_adds > 0 THEN 1 - purchase_count / cart_adds ELSE 0 END AS abandonment FROM {source}),
b AS (SELECT *, avg(total_events) OVER w AS em, stddev_samp(total_events) OVER w AS es,
    avg(abandonment) OVER w AS am, stddev_samp(abandonment) OVER w AS asd,
    avg(total_revenue) OVER w AS rm, count(*) OVER w AS n
  FROM m WINDOW w AS (ORDER BY window_start ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)),
z AS (SELECT *, (total_events - em) / nullif(es, 0) AS ez, (abandonment - am) / nullif(asd, 0) AS az,
    (total_revenue - rm) / nullif(rm, 0) AS rc FROM b WHERE n = 12)
SELECT window_start, CASE WHEN ez > 0 THEN 'traffic_spike' ELSE 'traffic_drop' END AS anomaly_type,
  CASE WHEN abs(ez) > 3.0 THEN 'critical' WHEN abs(ez) > 2.5 THEN 'high' ELSE 'medium' END AS severity,
  round(CAST(total_events AS DOUBLE), 4) AS value, round(em, 4) AS baseline, round(ez, 4) AS deviation
FROM z WHERE abs(ez) > 2.0
UNION ALL SELECT window_start, 'cart_abandonment_spike',
  CASE WHEN abandonment > 0.9 THEN 'critical' WHEN abandonment > 0.8 THEN 'high' ELSE 'medium' END,
  round(abandonment, 4), round(am, 4), round(az, 4) FROM z WHERE az > 1.5 AND abandonment > 0.5
UNION ALL SELECT window_start, 'revenue_drop',
  CASE WHEN -rc > 0.9 THEN 'critical' WHEN -rc > 0.7 THEN 'high' ELSE 'medium' END,
  round(total_revenue, 4), round(rm, 4), round(rc, 4) FROM z WHERE -rc > 0.5"""
    q["c2_baseline_anomalies"] = deviations.replace("{source}", "metrics")
    q["c2_streamed_deviations"] = deviations.replace("{source}", "hourly_timeline")
    q["c3_first_alerts"] = f"""
SELECT {NUMERIC} FROM findings JOIN (
  WITH RECURSIVE sent AS (
    SELECT anomaly_type, min(window_start) AS window_start FROM findings GROUP BY 1
    UNION ALL
    SELECT s.anomaly_type, (SELECT min(f.window_start) FROM findings f
      WHERE f.anomaly_type = s.anomaly_type AND f.window_start >= s.window_start + INTERVAL '6 hours')
    FROM sent s WHERE s.window_start IS NOT NULL)
  SELECT * FROM sent) USING (anomaly_type, window_start)"""
    q["c4_alert_routes"] = """
SELECT window_start, anomaly_type, severity, CASE WHEN severity = 'critical' THEN 'critical'
  WHEN anomaly_type IN ('revenue_drop', 'conversion_drop') THEN 'revenue' ELSE 'technical' END AS channel
FROM findings"""
    q["c10_revenue_below_average"] = """
WITH hourly AS (SELECT time_bucket(INTERVAL '1 hour', event_timestamp) AS window_start, sum(price) AS revenue
  FROM bronze WHERE event_type = 'purchase' GROUP BY 1),
based AS (SELECT window_start, revenue, avg(revenue) OVER (ORDER BY window_start
    RANGE BETWEEN INTERVAL '24 hours' PRECEDING AND INTERVAL '1 microsecond' PRECEDING) AS average_24h FROM hourly)
SELECT window_start, round(revenue, 4) AS revenue, round(average_24h, 4) AS average_24h
FROM based WHERE revenue < 0.8 * average_24h"""

    # Dashboards
    q["q1_latest_dau"] = f"SELECT dau_count FROM daily_active_users {LATEST}"
    q["q2_latest_conversion"] = f"""
SELECT round(conversion_rate * 100, 2) AS conversion_pct FROM conversion_rate_daily {LATEST}"""
    q["q3_latest_revenue"] = f"SELECT round(total_revenue, 2) AS total_revenue FROM revenue_daily {LATEST}"
    q["q4_total_events_latest_date"] = """
SELECT coalesce(CAST(sum(event_count) AS BIGINT), 0) AS total_events FROM events_per_source_daily
WHERE event_date = (SELECT max(event_date) FROM events_per_source_daily)"""
    q["q5_event_series"] = f"""
SELECT window_start, event_type, CAST(sum(event_count) AS BIGINT) AS event_count FROM events_per_minute
WHERE {since('24 hours')} GROUP BY 1, 2"""
    q["q6_revenue_series"] = f"""
SELECT window_start, round(revenue, 2) AS revenue FROM revenue_per_minute WHERE {since('24 hours')}"""
    q["q7_top_categories_latest"] = """
SELECT category, units_sold FROM category_sales_daily
WHERE event_date = (SELECT max(event_date) FROM category_sales_daily)
ORDER BY units_sold DESC, category LIMIT 10"""
    q["q8_latest_purchases"] = f"SELECT total_purchases FROM revenue_daily {LATEST}"
    q["q9_events_today"] = f"""
SELECT CAST(sum(event_count) AS BIGINT) AS total_events FROM events_per_source_daily WHERE event_date = {TODAY}"""
    q["q10_events_last_hour"] = f"""
SELECT window_start, event_type, event_count FROM events_per_minute WHERE {since('1 hour')}"""
    q["q11_events_by_source"] = f"""
SELECT source, event_count FROM events_per_source_daily WHERE event_date = {TODAY}"""
    q["q12_top_pages"] = f"""
SELECT page, purchase_count FROM purchases_per_page_daily WHERE event_date = {TODAY}
ORDER BY purchase_count DESC, page LIMIT 10"""
    q["q13_active_alerts"] = f"""
SELECT count(*) AS active_alerts FROM anomalies WHERE {since('1 hour', 'detected_at')} AND acknowledged = 0"""
    q["q14_critical_alerts"] = f"""
SELECT count(*) AS critical_alerts FROM anomalies
WHERE severity = 'critical' AND {since('24 hours', 'detected_at')}"""
    q["q15_alerts_by_severity"] = f"""
SELECT severity, count(*) AS value FROM anomalies WHERE {since('24 hours', 'detected_at')} GROUP BY 1"""
    q["q16_alerts_by_type"] = f"""
SELECT anomaly_type, count(*) AS value FROM anomalies WHERE {since('24 hours', 'detected_at')} GROUP BY 1"""
    q["q17_recent_alerts"] = f"""
SELECT strftime(detected_at, '%Y-%m-%d %H:%M:%S') AS detected_at, severity, anomaly_type, description,
  round(metric_value, 4) AS "current", expected_value AS expected,
  CASE WHEN acknowledged = 1 THEN '✅ Acked' ELSE '❌ Active' END AS status
FROM (SELECT * FROM anomalies WHERE {since('6 hours', 'detected_at')}
  ORDER BY detected_at DESC, window_start DESC, anomaly_type LIMIT 100)"""
    q["q18_anomaly_timeline"] = f"""
SELECT date_trunc('hour', detected_at) AS "time", severity, count(*) AS value FROM anomalies
WHERE {since('24 hours', 'detected_at')} GROUP BY 1, 2"""

    # Analysts
    q["q19_recent_activity"] = """
SELECT window_start, event_type, CAST(sum(event_count) AS BIGINT) AS total_events FROM events_per_minute
GROUP BY 1, 2 ORDER BY window_start DESC, event_type LIMIT 20"""
    q["q19_latest_windows"] = """
SELECT window_start, event_type, event_count FROM events_per_minute
ORDER BY window_start DESC, event_type LIMIT 10"""
    q["q20_current_minute"] = f"""
SELECT event_type, CAST(sum(event_count) AS BIGINT) AS "count" FROM events_per_minute
WHERE window_start = date_trunc('minute', {NOW}) GROUP BY 1"""
    q["q21_hourly_totals"] = f"""
SELECT event_type, CAST(sum(event_count) AS BIGINT) AS total, avg(event_count) AS avg_per_minute,
  max(event_count) AS peak FROM events_per_minute WHERE {since('1 hour')} GROUP BY 1"""
    q["q22_logins_by_source"] = f"""
SELECT source, CAST(sum(login_count) AS BIGINT) AS total_logins FROM logins_per_source
WHERE {since('12 hours')} GROUP BY 1"""
    q["q22_login_trend"] = """
SELECT window_start, source, CAST(sum(login_count) AS BIGINT) AS logins FROM logins_per_source
GROUP BY 1, 2 ORDER BY window_start DESC, source LIMIT 20"""
    q["q22_login_series"] = "SELECT window_start, source, login_count FROM logins_per_source"
    q["q23_recent_purchases"] = """
SELECT window_start, CAST(sum(purchase_count) AS BIGINT) AS purchases FROM purchases_per_minute
GROUP BY 1 ORDER BY window_start DESC LIMIT 10"""
    q["q23_purchase_rate"] = f"""
SELECT count(DISTINCT window_start) AS minutes, CAST(sum(purchase_count) AS BIGINT) AS total_purchases,
  round(sum(purchase_count) / count(DISTINCT window_start), 2) AS avg_per_minute
FROM purchases_per_minute WHERE {since('12 hours')}"""
    q["q24_dau_history"] = "SELECT * FROM daily_active_users"
    q["q24_dau_growth"] = """
SELECT event_date, dau_count, lag(dau_count) OVER w AS previous_day,
  dau_count - lag(dau_count) OVER w AS daily_change,
  round(100.0 * CAST(dau_count - lag(dau_count) OVER w AS DOUBLE) / lag(dau_count) OVER w, 2) AS growth_percent
FROM daily_active_users WINDOW w AS (ORDER BY event_date)"""
    q["q24_week_over_week"] = """
SELECT event_date, dau_count, lag(dau_count, 7) OVER w AS dau_last_week,
  round(100.0 * CAST(dau_count - lag(dau_count, 7) OVER w AS DOUBLE) / lag(dau_count, 7) OVER w, 1) AS growth_pct
FROM daily_active_users WINDOW w AS (ORDER BY event_date)"""
    q["q24_dau_trend"] = f"""
SELECT event_date, dau_count FROM daily_active_users WHERE event_date >= {TODAY} - 7"""
    conversion = """
SELECT c.event_date, round(conversion_rate * 100, 2) AS conversion_pct,
  coalesce(total_purchases, 0) AS total_purchases, dau_count
FROM conversion_rate_daily c LEFT JOIN revenue_daily r ON c.event_date = r.event_date"""
    q["q25_conversion_today"] = f"{conversion} WHERE c.event_date = {TODAY}"
    q["q25_conversion_trend"] = f"{conversion} ORDER BY c.event_date DESC LIMIT 7"
    q["q25_conversion_series"] = """
SELECT event_date, round(conversion_rate * 100, 2) AS conversion_pct FROM conversion_rate_daily"""
    q["q26_source_share"] = f"""
SELECT source, event_count, round(100.0::DOUBLE * event_count / sum(event_count) OVER (), 2) AS percentage
FROM events_per_source_daily WHERE event_date = {TODAY}"""
    q["q26_mobile_vs_web"] = """
SELECT event_date, coalesce(max(event_count) FILTER (source = 'mobile'), 0) AS mobile_events,
  coalesce(max(event_count) FILTER (source = 'web'), 0) AS web_events,
  round(100.0::DOUBLE * coalesce(max(event_count) FILTER (source = 'mobile'), 0) / sum(event_count), 2)
    AS mobile_percentage
FROM events_per_source_daily GROUP BY 1"""
    q["q27_page_share"] = f"""
SELECT page, purchase_count, round(100.0::DOUBLE * purchase_count / sum(purchase_count) OVER (), 2) AS percentage
FROM purchases_per_page_daily WHERE event_date = {TODAY}"""
    q["q28_daily_summary"] = f"""
SELECT d.event_date, d.dau_count AS active_users, round(c.conversion_rate * 100, 2) AS conversion_pct,
  r.total_purchases, CAST(sum(e.event_count) AS BIGINT) AS total_events
FROM daily_active_users d JOIN conversion_rate_daily c ON d.event_date = c.event_date
LEFT JOIN revenue_daily r ON d.event_date = r.event_date
JOIN events_per_source_daily e ON d.event_date = e.event_date
WHERE d.event_date = {TODAY} GROUP BY 1, 2, 3, 4"""
    q["q29_hour_vs_average"] = f"""
SELECT events_this_hour, round(a, 4) AS avg_events_per_day_and_source,
  round(100.0::DOUBLE * events_this_hour / a, 2) AS current_vs_avg_pct FROM
  (SELECT CAST(sum(event_count) AS BIGINT) AS events_this_hour FROM events_per_minute
   WHERE window_start >= date_trunc('hour', {NOW})) h,
  (SELECT avg(event_count) AS a FROM events_per_source_daily) d"""
    q["q30_missing_minutes"] = f"""
SELECT expected_minute FROM (SELECT date_trunc('minute', {NOW} - INTERVAL '1 hour')
    + to_minutes(CAST(range AS INTEGER)) AS expected_minute FROM range(60)) spine
WHERE expected_minute NOT IN (SELECT window_start FROM events_per_minute WHERE {since('1 hour')})"""
    tables = (
        "daily_active_users", "events_per_source_daily", "purchases_per_page_daily", "conversion_rate_daily",
        "revenue_daily", "category_sales_daily", "cart_abandonment_daily", "events_per_minute",
        "purchases_per_minute", "revenue_per_minute", "category_velocity", "logins_per_source", "anomalies",
    )
    q["q31_row_counts"] = " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", count(*) AS "rows" FROM {t}""" for t in tables
    )
    q["q31_revenue_windows"] = f"SELECT count(*) AS windows FROM revenue_per_minute WHERE {since('12 hours')}"
    q["q32_events_per_second"] = f"""
SELECT window_start, round(CAST(sum(event_count) AS DOUBLE) / 60.0, 6) AS events_per_second
FROM events_per_minute WHERE {since('1 hour')} GROUP BY 1"""
    q["q33_purchases_in_span"] = f"""
SELECT window_start, purchase_count FROM purchases_per_minute WHERE {since('6 hours')}"""
    q["q33_purchases_by_minute"] = f"""
SELECT date_trunc('minute', window_start) AS "time", CAST(sum(purchase_count) AS BIGINT) AS value
FROM purchases_per_minute WHERE {since('6 hours')} GROUP BY 1"""
    q["q34_events_in_span"] = f"""
SELECT CAST(sum(event_count) AS BIGINT) AS events FROM events_per_minute WHERE {since('2 hours')}"""
    q["q34_activity_by_minute"] = f"""
SELECT date_trunc('minute', window_start) AS "time", event_type, CAST(sum(event_count) AS BIGINT) AS events
FROM events_per_minute WHERE {since('1 hour')} GROUP BY 1, 2"""
    q["q35_severity_today"] = f"""
SELECT severity, count(*) AS total FROM anomalies WHERE CAST(detected_at AS DATE) >= {TODAY} GROUP BY 1"""
    q["q35_weekly_review"] = f"""
SELECT anomaly_type, count(*) AS total, count(*) FILTER (severity = 'critical') AS critical,
  count(*) FILTER (severity = 'high') AS high
FROM anomalies WHERE CAST(detected_at AS DATE) >= {TODAY} - 7 GROUP BY 1"""
    q["q35_latest_anomalies"] = """
SELECT strftime(detected_at, '%H:%M:%S') AS "time", severity, anomaly_type, description FROM
  (SELECT * FROM anomalies ORDER BY detected_at DESC, window_start DESC, anomaly_type LIMIT 10)"""
    q["q36_revenue_yesterday"] = f"""
SELECT round(total_revenue, 2) AS total_revenue, total_purchases, avg_order_value FROM revenue_daily
WHERE event_date = {YESTERDAY}"""
    q["q36_top_categories_today"] = f"""
SELECT category, units_sold FROM category_sales_daily WHERE event_date = {TODAY}
ORDER BY units_sold DESC, category LIMIT 5"""
    q["q37_revenue_trend"] = """
SELECT event_date, round(total_revenue, 2) AS total_revenue FROM revenue_daily ORDER BY event_date DESC LIMIT 7"""
    q["q37_top_categories"] = """
SELECT category, CAST(sum(units_sold) AS BIGINT) AS total FROM category_sales_daily GROUP BY 1
ORDER BY total DESC, category LIMIT 3"""
    q["q37_average_abandonment"] = f"""
SELECT round(avg(abandonment_rate), 6) AS avg_rate FROM cart_abandonment_daily WHERE event_date >= {TODAY} - 7"""
    q["q37_revenue_week"] = f"""
SELECT round(sum(total_revenue), 2) AS total_revenue FROM revenue_daily WHERE event_date >= {TODAY} - 7"""
    q["q38_conversion_row"] = f"""
SELECT event_date, dau_count, unique_buyers, round(conversion_rate * 100, 2) AS conv_pct
FROM conversion_rate_daily {LATEST}"""
    q["q38_revenue_row"] = f"""
SELECT round(total_revenue, 2) AS total_revenue, total_purchases, round(avg_order_value, 2) AS aov
FROM revenue_daily {LATEST}"""
    q["q38_category_revenue"] = f"""
SELECT category, units_sold, round(category_revenue, 2) AS revenue FROM category_sales_daily
WHERE event_date = {TODAY}"""
    q["q39_category_pie"] = f"""
SELECT category, round(category_revenue, 2) AS category_revenue FROM category_sales_daily
WHERE event_date = {TODAY}"""
    q["q40_free_sql"] = """
SELECT d.event_date, d.dau_count, r.total_purchases FROM daily_active_users d
JOIN revenue_daily r ON d.event_date = r.event_date WHERE r.total_purchases > 60"""
    q["q41_order_value_trend"] = "SELECT event_date, avg_order_value FROM revenue_daily"
    q["q41_purchases_today"] = f"SELECT total_purchases FROM revenue_daily WHERE event_date = {TODAY}"
    q["q41_conversion_above"] = f"""
SELECT conversion_rate, conversion_rate > 0.03 AS above_limit FROM conversion_rate_daily {LATEST}"""
    q["q41_category_sales"] = f"""
SELECT category, units_sold, round(category_revenue, 2) AS category_revenue FROM category_sales_daily
WHERE event_date = {TODAY} AND category = 'Electronics'"""
    q["q41_abandoned_yesterday"] = f"""
SELECT sessions_with_cart, abandoned_carts, abandonment_rate FROM cart_abandonment_daily
WHERE event_date = {YESTERDAY}"""
    q["q41_purchases_last_hour"] = f"""
SELECT coalesce(CAST(sum(purchase_count) AS BIGINT), 0) AS purchases FROM purchases_per_minute
WHERE {since('1 hour')}"""
    q["q41_revenue_now"] = """
SELECT window_start, round(revenue, 2) AS revenue, purchase_count FROM revenue_per_minute
ORDER BY window_start DESC LIMIT 1"""
    q["q42_revenue_and_conversion"] = f"""
SELECT r.event_date, round(total_revenue, 2) AS total_revenue, total_purchases, conversion_rate
FROM revenue_daily r JOIN conversion_rate_daily c ON r.event_date = c.event_date
WHERE r.event_date = {YESTERDAY}"""
    q["q43_purchases_vs_previous"] = """
SELECT event_date, total_purchases, lag(total_purchases) OVER w AS previous_purchases,
  total_purchases - lag(total_purchases) OVER w AS change
FROM revenue_daily WINDOW w AS (ORDER BY event_date)"""
    q["q44_revenue_by_hour"] = """
SELECT date_trunc('hour', event_timestamp) AS "hour", round(sum(price), 2) AS revenue, count(*) AS purchases
FROM silver WHERE event_type = 'purchase' GROUP BY 1"""
    q["q44_categories_by_week"] = """
SELECT CAST(date_trunc('week', event_timestamp) AS TIMESTAMP) AS "week", category, count(*) AS units_sold,
  round(sum(price), 2) AS category_revenue FROM silver WHERE event_type = 'purchase' GROUP BY 1, 2"""
    q["q45_revenue_growth"] = """
SELECT event_date, round(total_revenue, 2) AS total_revenue,
  round(lag(total_revenue) OVER w, 2) AS previous_revenue,
  round(100.0 * (total_revenue - lag(total_revenue) OVER w) / lag(total_revenue) OVER w, 2) AS growth_pct
FROM revenue_daily WINDOW w AS (ORDER BY event_date)"""
    q["q45_revenue_year_over_year"] = """
SELECT r.event_date, round(r.total_revenue, 2) AS total_revenue, round(e.total_revenue, 2) AS earlier_revenue,
  round(100.0 * (r.total_revenue - e.total_revenue) / e.total_revenue, 2) AS change_pct
FROM revenue_daily r LEFT JOIN revenue_daily e ON r.event_date = e.event_date + INTERVAL '12 months'"""
    q["q46_revenue_without_small"] = """
SELECT event_date, round(sum(price), 2) AS total_revenue, count(*) AS total_purchases,
  round(round(sum(price), 6) / count(*), 2) AS avg_order_value
FROM silver WHERE event_type = 'purchase' AND price >= 50 GROUP BY 1"""
    q["q46_mobile_events"] = f"""
SELECT {window_columns('1 minute')}, event_type, count(*) AS event_count FROM bronze
WHERE source = 'mobile' GROUP BY ALL"""
    q["q46_single_category"] = """
SELECT event_date, category, units_sold, round(category_revenue, 2) AS category_revenue
FROM category_sales_daily WHERE category = 'Electronics'"""
    q["q47_top_products"] = """
SELECT product_id, count(*) AS units_sold FROM silver WHERE event_type = 'purchase' GROUP BY 1
ORDER BY units_sold DESC, product_id LIMIT 10"""
    q["q47_top_users"] = """
SELECT user_id, count(*) AS purchases FROM silver WHERE event_type = 'purchase' GROUP BY 1
ORDER BY purchases DESC, user_id LIMIT 10"""

    def abandonment(key: str) -> str:
        return f"""
SELECT {key}, count(*) AS sessions_with_cart, count(*) FILTER (bought = 0) AS abandoned_carts,
  round(count(*) FILTER (bought = 0) / count(*), 4) AS abandonment_rate
FROM (SELECT event_date, session_id, {key}, count(*) FILTER (event_type = 'add_to_cart') AS carts,
    count(*) FILTER (event_type = 'purchase') AS bought
  FROM (SELECT *, date_trunc('hour', event_timestamp) AS "hour" FROM silver) GROUP BY ALL) WHERE carts > 0 GROUP BY 1"""

    q["q48_abandonment_by_category"] = abandonment("category")
    q["q48_top_categories_rate"] = f"""
SELECT b.category, units_sold, abandonment_rate FROM
  (SELECT category, count(*) AS units_sold FROM silver WHERE event_type = 'purchase' GROUP BY 1
   ORDER BY units_sold DESC, category LIMIT 3) b
LEFT JOIN ({abandonment('category')}) a ON a.category = b.category"""
    q["q49_abandonment_by_hour"] = abandonment('"hour"')
    q["q50_revenue_by_category"] = """
SELECT category, round(sum(category_revenue), 2) AS revenue,
  round(100.0 * sum(category_revenue) / sum(sum(category_revenue)) OVER (), 2) AS revenue_pct
FROM category_sales_daily GROUP BY 1"""

    # Quality
    checked = ("daily_active_users", "events_per_source_daily", "conversion_rate_daily")
    q["dq1_quality_report"] = " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", true AS "exists", count(*) AS "rows", count(*) = 0 AS is_empty FROM {t}"""
        for t in checked
    )
    q["dq3_event_quality"] = f"""
SELECT count(*) AS "rows", count(event_id) - count(DISTINCT event_id) AS duplicate_ids,
  count(*) FILTER (NOT ({REQUIRED})) AS schema_violations,
  count(*) FILTER (category NOT IN {known}) AS invalid_categories,
  count(*) FILTER (event_type = 'purchase' AND price IS NULL) AS missing_prices,
  count(*) FILTER (event_timestamp > date_trunc('day', {NOW}) + INTERVAL '12 hours') AS future_timestamps,
  count(*) FILTER (ingestion_timestamp > event_timestamp + INTERVAL '1 minute') AS late_arrivals
FROM bronze"""
    q["dq3_out_of_order"] = """
SELECT date_trunc('minute', ingestion_timestamp) AS arrival_minute,
  count(*) FILTER (event_timestamp < newest) AS out_of_order
FROM (SELECT *, max(event_timestamp) OVER (ORDER BY ingestion_timestamp
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS newest FROM bronze) GROUP BY 1"""

    # Purchases and models
    q["c8_purchase_bursts"] = """
WITH p AS (SELECT user_id, event_timestamp, count(*) AS n FROM silver WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT * FROM (SELECT user_id, event_timestamp, CAST(sum(n) OVER (PARTITION BY user_id ORDER BY event_timestamp
    RANGE BETWEEN INTERVAL '24 hours' PRECEDING AND CURRENT ROW) AS BIGINT) AS recent_purchases FROM p)
WHERE recent_purchases >= 3"""
    q["c8_abnormal_prices"] = """
SELECT event_id, user_id, category, price, round((price - m) / s, 4) AS price_zscore FROM silver JOIN
  (SELECT category AS c, avg(price) AS m, stddev_samp(price) AS s FROM silver WHERE event_type = 'purchase' GROUP BY 1)
  ON category = c WHERE event_type = 'purchase' AND abs((price - m) / s) > 2.0"""
    categories = ("Electronics", "Fashion", "Home", "Books", "Sports", "Beauty", "Toys", "Food")
    q["c6_user_features"] = f"""
SELECT user_id, count(*) AS purchases, round(avg(price), 6) AS avg_order_value,
  {', '.join(f"round(count(*) FILTER (category = '{c}') / count(*), 6) AS share_{c.lower()}" for c in categories)}
FROM silver WHERE event_type = 'purchase' GROUP BY 1"""
    q["c7_revenue_forecast"] = f"""
WITH d AS (SELECT category, unnest(generate_series(min(event_date)::TIMESTAMP, {TODAY}::TIMESTAMP - INTERVAL '1 day', INTERVAL '1 day'))::DATE AS event_date
  FROM category_sales_daily GROUP BY 1),
h AS (SELECT category, date_diff('day', {TODAY}, event_date) AS x, coalesce(category_revenue, 0) AS y
  FROM d LEFT JOIN category_sales_daily USING (category, event_date)),
f AS (SELECT category, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, sqrt(greatest(regr_syy(y, x)
    - regr_sxy(y, x) * regr_sxy(y, x) / regr_sxx(y, x), 0) / (count(*) - 2)) AS e FROM h GROUP BY 1)
SELECT category, {TODAY} + CAST(ahead AS INTEGER) AS forecast_date, round(a + b * ahead, 3) AS predicted_revenue,
  round(a + b * ahead - 2 * e, 3) AS lower_bound, round(a + b * ahead + 2 * e, 3) AS upper_bound
FROM f, range(1, 8) AS days(ahead)"""
    q["c11_session_features"] = """
SELECT user_id, session_start, events - purchases AS other_events, views, cart_adds,
  round(duration_seconds, 6) AS duration_seconds, CAST(purchases > 0 AS INTEGER) AS converted FROM session_rows"""
    q["c5_recommendation_facts"] = """
SELECT user_id, least(10, (SELECT count(DISTINCT product_id) FROM silver WHERE event_type = 'purchase')) AS products,
  true AS ranks_without_gap, true AS known_products, true AS scores_fall
FROM (SELECT DISTINCT user_id FROM silver WHERE event_type = 'purchase')"""
    q["c6_segment_facts"] = """
SELECT DISTINCT user_id, true AS nearest FROM silver WHERE event_type = 'purchase'"""
    q["c11_conversion_facts"] = """
SELECT count(*) AS sessions, CAST(count(*) FILTER (purchases > 0) AS BIGINT) AS converted, true AS gradient_is_zero,
  true AS probabilities FROM session_rows"""
    q["c5_purchase_counts"] = """
SELECT user_id, product_id, count(*) AS purchases FROM silver WHERE event_type = 'purchase' GROUP BY 1, 2"""

    q["q40_table_by_path"] = """
SELECT event_date, round(conversion_rate, 9) AS conversion_rate FROM conversion_rate_daily WHERE conversion_rate > 0.3"""
    q["dq2_table_presence"] = """
SELECT 'kpi_dau' AS "table", true AS present, count(*) AS rows FROM daily_active_users
UNION ALL SELECT 'kpi_revenue_daily', true, count(*) FROM revenue_daily
UNION ALL SELECT 'fact_events', true, count(*) FROM silver
UNION ALL SELECT 'kpi_unknown', false, NULL"""

    # Whole jobs
    q["dq4_stream_progress"] = "SELECT count(*) AS input_rows, true AS batches_in_order FROM events"
    q["dq4_stored_health"] = """
WITH days AS (SELECT row_number() OVER (ORDER BY CAST(ts AS DATE)) - 1 AS batch_id, count(*) AS input_rows FROM events GROUP BY CAST(ts AS DATE))
SELECT batch_id, input_rows, CASE WHEN input_rows < 0.9 * avg(input_rows) OVER w THEN 'row_drop' END AS anomaly_type
FROM days WINDOW w AS (ORDER BY batch_id ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)"""
    q["r10_late_rows"] = f"""
SELECT {window_columns('1 hour')}, event_type, count(*) AS event_count, true AS rows_were_late
FROM bronze WHERE event_date > (SELECT min(event_date) FROM bronze)
GROUP BY window_start, window_end, event_type HAVING window_start + INTERVAL '1 hour' <= {NOW} - INTERVAL '10 minutes'"""
    q["r13_landed_bronze"] = "SELECT * FROM bronze"
    q["r_streamed_cube"] = q["r_minute_cube"]
    q["s6_cube_after_restart"] = q["r_minute_cube"]
    q["r1_from_streamed_cube"] = "SELECT * FROM events_per_minute"
    counts = {
        "events_per_minute": "event_count", "revenue_per_minute": "purchase_count",
        "purchases_per_minute": "purchase_count", "category_velocity": "purchase_count",
    }
    q["r9_streamed_minute_tables"] = " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, window_start, CAST(sum({c}) AS BIGINT) AS total, count(*) AS table_rows
FROM {t} GROUP BY window_start""" for t, c in counts.items()
    )
    q["ad7_streamed_anomalies"] = f"""
SELECT {NUMERIC} FROM findings WHERE window_start + INTERVAL '1 hour' <= {NOW} - INTERVAL '10 minutes'"""
    q["ad7_sketched_anomalies"] = q["ad7_streamed_anomalies"]
    q["c3_streamed_outbox"] = f"""
WITH severe AS (SELECT * FROM findings
  WHERE severity IN ('critical', 'high') AND window_start + INTERVAL '1 hour' <= {NOW} - INTERVAL '10 minutes'),
kept AS (
  WITH RECURSIVE sent AS (
    SELECT anomaly_type, min(window_start) AS window_start FROM severe GROUP BY 1
    UNION ALL
    SELECT s.anomaly_type, (SELECT min(f.window_start) FROM severe f
      WHERE f.anomaly_type = s.anomaly_type AND f.window_start >= s.window_start + INTERVAL '6 hours')
    FROM sent s WHERE s.window_start IS NOT NULL)
  SELECT * FROM sent)
SELECT window_start, anomaly_type, severity,
  array_to_string(list_transform(string_split(anomaly_type, '_'), lambda w: upper(w[1]) || w[2:]), ' ') || ' Detected!' AS title,
  CASE WHEN severity = 'critical' THEN 'critical'
    WHEN anomaly_type IN ('revenue_drop', 'conversion_drop') THEN 'revenue' ELSE 'technical' END AS channel
FROM severe JOIN kept USING (anomaly_type, window_start)"""
    q["k14_kept_summary"] = f"""
SELECT severity, anomaly_type, count(*) AS anomaly_count FROM findings
WHERE window_start + INTERVAL '1 hour' <= {NOW} - INTERVAL '10 minutes' GROUP BY ALL"""
    parts = ", ".join(
        f"round({call}({m}) OVER w, 4) AS {m}_{part}" for m in ("total_events", "total_revenue", "abandonment")
        for part, call in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
    )
    q["w5_streamed_timeline"] = f"""
SELECT window_start, window_end, total_events, purchase_count, round(total_revenue, 4) AS total_revenue,
  count(*) OVER w AS baseline_windows, {parts}
FROM (SELECT *, CASE WHEN cart_adds > 0 THEN 1 - purchase_count / cart_adds ELSE 0 END AS abandonment FROM five_minute_timeline)
WINDOW w AS (ORDER BY window_start ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)"""
    q["ad2_streamed_silence"] = """
SELECT window_start, 'critical' AS severity,
  'Traffic DROP: 0 events (expected >1000). Possible system issue or producer failure.' AS description
FROM five_minute_timeline WHERE total_events = 0"""
    q["r12_streamed_logout_sessions"] = f"""
SELECT * REPLACE (round(revenue, 6) AS revenue, round(duration_seconds, 6) AS duration_seconds) FROM session_rows
WHERE session_end + INTERVAL '6 hours' <= {NOW} - INTERVAL '10 minutes'
  OR (logged_out AND session_end <= {NOW} - INTERVAL '10 minutes')"""
    q["d3_streamed_unique_events"] = """
SELECT DISTINCT event_id, user_id, event_type, event_timestamp, source, session_id, price, category, product_id FROM bronze"""
    q["r12_streamed_sessions"] = f"""
SELECT user_id, min(event_timestamp) AS session_start, max(event_timestamp) + INTERVAL '6 hours' AS session_end,
  count(*) AS events, count(*) FILTER (event_type = 'purchase') AS purchases
FROM (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY event_timestamp
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n
  FROM (SELECT *, CASE WHEN event_timestamp < lag(event_timestamp) OVER w + INTERVAL '6 hours' THEN 0 ELSE 1 END
      AS starts FROM bronze WINDOW w AS (PARTITION BY user_id ORDER BY event_timestamp)))
GROUP BY user_id, n HAVING max(event_timestamp) + INTERVAL '6 hours' <= {NOW} - INTERVAL '10 minutes'"""
    q["s4_incremental_silver"] = "SELECT * FROM silver"
    q["s7_lake_kpis"] = q["k_rollup_kpis"]
    return q


def expected_sql() -> dict[str, str]:
    return {name: half_up(_complete(body)) for name, body in _bodies().items()}


def _complete(body: str) -> str:
    """Merge a query's own WITH list with the relations it needs."""
    text = body.strip()
    if not text.startswith("WITH "):
        return with_relations(text)
    prefix = with_relations(text)
    if prefix == text:
        return text
    relations, own = prefix[: -len(text)].rstrip(), text[len("WITH "):]
    return f"{relations},\n{own}"


__all__ = ["expected_sql", "RELATIONS"]
