"""Named SQL relations the expected results are written over (DuckDB dialect)."""

from __future__ import annotations

import re

RELATIONS: dict[str, str] = {}

RELATIONS["keyed"] = """
SELECT event_id, user_id, ts, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  CASE event_type WHEN 'signup' THEN 'login' WHEN 'view' THEN 'view' WHEN 'click' THEN 'add_to_cart'
    WHEN 'purchase' THEN 'purchase' WHEN 'error' THEN 'logout' END AS event_type
FROM events"""

RELATIONS["bronze"] = """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS INTEGER) AS user_id, event_type,
  CASE WHEN copy = 1 THEN '/retry' ELSE ['/home', '/profile', '/settings', '/products',
    '/products/detail', '/search', '/about', '/help', '/cart', '/checkout'][k % 10 + 1] END AS page,
  ts AS event_timestamp,
  CASE WHEN k = 99 THEN 'kiosk' WHEN event_id % 2 = 0 THEN 'web' ELSE 'mobile' END AS source,
  CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
  CASE WHEN event_type IN ('login', 'logout') THEN NULL
    WHEN event_type = 'purchase' AND k IN (90, 91) THEN NULL
    WHEN event_type = 'view' AND k = 92 THEN -1.0 ELSE value END AS price,
  CASE WHEN event_type IN ('login', 'logout') THEN NULL WHEN k = 93 THEN 'Gadgets'
    ELSE ['Electronics', 'Fashion', 'Home', 'Books', 'Sports', 'Beauty', 'Toys', 'Food'][k % 8 + 1]
    END AS category,
  CASE WHEN event_type IN ('login', 'logout') THEN NULL ELSE 'PROD-' || CAST(k AS VARCHAR) END AS product_id,
  ts + to_seconds(event_id % 5 + CASE WHEN copy = 1 THEN 60 ELSE 0 END) AS ingestion_timestamp,
  CAST(ts AS DATE) AS event_date
FROM keyed, (VALUES (0), (1)) AS copies(copy)
WHERE copy = 0 OR event_id % 50 = 0"""

REQUIRED = """event_id IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL
  AND event_timestamp IS NOT NULL AND source IS NOT NULL AND session_id IS NOT NULL"""
DOMAINS = """event_type IN ('login', 'view', 'add_to_cart', 'purchase', 'logout')
  AND source IN ('web', 'mobile') AND user_id > 0
  AND (category IS NULL OR category IN
    ('Electronics', 'Fashion', 'Home', 'Books', 'Sports', 'Beauty', 'Toys', 'Food'))
  AND (price IS NULL OR price > 0)"""
COMPLETE = """(event_type <> 'purchase'
  OR (price IS NOT NULL AND product_id IS NOT NULL AND category IS NOT NULL))"""

RELATIONS["clean"] = f"SELECT * FROM bronze WHERE {REQUIRED} AND {DOMAINS} AND {COMPLETE}"

RELATIONS["silver"] = """
SELECT * FROM clean
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingestion_timestamp, page) = 1"""

RELATIONS["now_at"] = "SELECT max(ts) AS t FROM events"

# --- gold ---
RELATIONS["daily_active_users"] = """
SELECT event_date, count(DISTINCT user_id) AS dau_count FROM silver GROUP BY 1"""
RELATIONS["events_per_source_daily"] = """
SELECT event_date, source, count(*) AS event_count FROM silver GROUP BY 1, 2"""
RELATIONS["purchases_per_page_daily"] = """
SELECT event_date, page, count(*) AS purchase_count FROM silver WHERE event_type = 'purchase' GROUP BY 1, 2"""
RELATIONS["revenue_daily"] = """
SELECT event_date, sum(price) AS total_revenue, count(*) AS total_purchases,
  round(round(sum(price), 6) / count(*), 2) AS avg_order_value
FROM silver WHERE event_type = 'purchase' GROUP BY 1"""
RELATIONS["category_sales_daily"] = """
SELECT event_date, category, count(*) AS units_sold, sum(price) AS category_revenue
FROM silver WHERE event_type = 'purchase' GROUP BY 1, 2"""
RELATIONS["buyers_daily"] = """
SELECT event_date, count(DISTINCT user_id) AS buyers FROM silver WHERE event_type = 'purchase' GROUP BY 1"""
RELATIONS["conversion_rate_daily"] = """
SELECT d.event_date, dau_count, coalesce(buyers, 0) AS unique_buyers,
  round(coalesce(buyers, 0) / dau_count, 4) AS conversion_rate
FROM daily_active_users d LEFT JOIN buyers_daily b ON d.event_date = b.event_date"""
RELATIONS["cart_sessions"] = """
SELECT c.event_date, c.session_id, c.cart_add_count, p.purchase_count FROM
  (SELECT event_date, session_id, count(*) AS cart_add_count FROM silver
   WHERE event_type = 'add_to_cart' GROUP BY 1, 2) c
LEFT JOIN
  (SELECT event_date, session_id, count(*) AS purchase_count FROM silver
   WHERE event_type = 'purchase' GROUP BY 1, 2) p
ON c.event_date = p.event_date AND c.session_id = p.session_id"""
RELATIONS["cart_abandonment_daily"] = """
SELECT event_date, count(*) AS sessions_with_cart,
  CAST(sum(CASE WHEN purchase_count IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS abandoned_carts,
  round(sum(CASE WHEN purchase_count IS NULL THEN 1 ELSE 0 END) / count(*), 4) AS abandonment_rate
FROM cart_sessions GROUP BY 1"""


# --- minute tables ---
def window_columns(width: str) -> str:
    start = f"time_bucket(INTERVAL '{width}', event_timestamp)"
    return f"{start} AS window_start, {start} + INTERVAL '{width}' AS window_end"


_MINUTE = window_columns("1 minute")
RELATIONS["events_per_minute"] = f"""
SELECT {_MINUTE}, event_type, count(*) AS event_count FROM bronze GROUP BY ALL"""
RELATIONS["revenue_per_minute"] = f"""
SELECT {_MINUTE}, sum(price) AS revenue, count(*) AS purchase_count
FROM bronze WHERE event_type = 'purchase' GROUP BY ALL"""
RELATIONS["purchases_per_minute"] = f"""
SELECT {_MINUTE}, count(*) AS purchase_count FROM bronze WHERE event_type = 'purchase' GROUP BY ALL"""
RELATIONS["category_velocity"] = f"""
SELECT {_MINUTE}, category, count(*) AS purchase_count, sum(price) AS revenue
FROM bronze WHERE event_type = 'purchase' GROUP BY ALL"""
RELATIONS["logins_per_source"] = f"""
SELECT {_MINUTE}, source, count(*) AS login_count FROM bronze WHERE event_type = 'login' GROUP BY ALL"""


# --- anomalies ---
def metrics(width: str) -> str:
    return f"""
SELECT {window_columns(width)}, count(*) AS total_events,
  count(DISTINCT user_id) AS unique_users, count(DISTINCT session_id) AS unique_sessions,
  sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0 END) AS total_revenue,
  count(*) FILTER (event_type = 'purchase') AS purchase_count,
  avg(price) FILTER (event_type = 'purchase') AS avg_purchase_price,
  count(*) FILTER (event_type = 'add_to_cart') AS cart_adds,
  count(DISTINCT user_id) FILTER (event_type = 'purchase') AS buyers,
  count(*) FILTER (event_type = 'purchase' AND price IS NULL) AS purchases_missing_price,
  count(*) FILTER (event_type = 'purchase' AND category IS NULL) AS purchases_missing_category,
  count(*) FILTER (event_type = 'purchase' AND category = 'Electronics') AS electronics_purchases,
  count(*) FILTER (event_type = 'purchase' AND category = 'Fashion') AS fashion_purchases
FROM bronze GROUP BY ALL"""


RELATIONS["metrics"] = metrics("1 hour")
RELATIONS["five_minute_metrics"] = metrics("5 minutes")


def timeline(width: str, source: str) -> str:
    """Closed windows in order, silent ones with zeros."""
    return f"""
SELECT s AS window_start, s + INTERVAL '{width}' AS window_end, coalesce(total_events, 0) AS total_events,
  coalesce(purchase_count, 0) AS purchase_count, coalesce(cart_adds, 0) AS cart_adds,
  CASE WHEN total_events IS NULL THEN 0.0 ELSE total_revenue END AS total_revenue
FROM (SELECT unnest(generate_series((SELECT min(window_start) FROM {source}),
    time_bucket(INTERVAL '{width}', (SELECT max(ts) FROM events) - INTERVAL '10 minutes') - INTERVAL '{width}', INTERVAL '{width}')) AS s) spine
LEFT JOIN {source} ON s = window_start"""


RELATIONS["hourly_timeline"] = timeline("1 hour", "metrics")
RELATIONS["five_minute_timeline"] = timeline("5 minutes", "five_minute_metrics")


def _whole(value: str) -> str:
    return f"CAST(CAST(trunc({value}) AS BIGINT) AS VARCHAR)"


_CHANGE = "(total_revenue - 130.0) / (130.0::DOUBLE + 0.01::DOUBLE)"
RELATIONS["revenue_drop"] = f"""
SELECT window_start, 'revenue_drop' AS anomaly_type,
  CASE WHEN change < -0.50 THEN 'critical' WHEN change < -0.40 THEN 'high' ELSE 'medium' END AS severity,
  CASE WHEN total_revenue = 0 THEN 'Revenue dropped to ZERO - possible payment system failure'
    ELSE 'Revenue dropped by ' || {_whole('change * -100')} || '% from baseline ($130 → $'
      || {_whole('total_revenue')} || ')' END AS description,
  CAST(total_revenue AS DOUBLE) AS metric_value, '130.0' AS expected_value
FROM (SELECT *, {_CHANGE} AS change FROM metrics) WHERE change < -0.30"""
RELATIONS["traffic"] = """
SELECT window_start,
  CASE WHEN total_events > 18 THEN 'traffic_spike' ELSE 'traffic_drop' END AS anomaly_type,
  CASE WHEN total_events < 6 THEN 'critical' WHEN total_events > 24 THEN 'critical'
    WHEN total_events < 8 THEN 'high' WHEN total_events > 21 THEN 'high' ELSE 'medium' END AS severity,
  CASE WHEN total_events > 18 THEN 'Traffic SPIKE: ' || total_events
      || ' events (expected <18). Possible bot attack or viral event.'
    ELSE 'Traffic DROP: ' || total_events
      || ' events (expected >10). Possible system issue or producer failure.' END AS description,
  CAST(total_events AS DOUBLE) AS metric_value,
  CASE WHEN total_events > 18 THEN '<18' ELSE '>10' END AS expected_value
FROM metrics WHERE total_events < 10 OR total_events > 18"""
RELATIONS["cart_abandonment"] = f"""
SELECT window_start, 'cart_abandonment_spike' AS anomaly_type,
  CASE WHEN rate > 0.90 THEN 'critical' WHEN rate > 0.70 THEN 'high' ELSE 'medium' END AS severity,
  'Cart abandonment SPIKE: ' || {_whole('rate * 100')} || '% (expected ~50%). Possible checkout bug '
    || 'or payment issue. ' || cart_adds || ' carts added, only ' || purchase_count || ' purchases.'
    AS description,
  rate * 100 AS metric_value, '50%' AS expected_value
FROM (SELECT *, CASE WHEN cart_adds > 0 THEN 1 - purchase_count / cart_adds ELSE 0 END AS rate FROM metrics)
WHERE cart_adds > 3 AND rate > 0.50"""
RELATIONS["conversion_drop"] = """
SELECT window_start, 'conversion_drop' AS anomaly_type,
  CASE WHEN rate < 0.04 THEN 'critical' WHEN rate < 0.08 THEN 'high' ELSE 'medium' END AS severity,
  'Conversion rate VERY LOW: ' || CAST(CAST(rate * 100 AS DECIMAL(5, 2)) AS VARCHAR) || '% (' || buyers
    || ' buyers / ' || unique_users || ' users). Expected >12%. Check purchase flow.' AS description,
  rate * 100 AS metric_value, '12.0' AS expected_value
FROM (SELECT *, buyers / unique_users AS rate FROM metrics)
WHERE unique_users > 8 AND rate < 0.12"""
RELATIONS["data_quality"] = f"""
SELECT window_start, 'data_quality' AS anomaly_type,
  CASE WHEN share > 0.50 THEN 'critical' WHEN share > 0.25 THEN 'high' ELSE 'medium' END AS severity,
  'DATA QUALITY ISSUE: ' || {_whole('share * 100')} || '% of purchases missing price ('
    || purchases_missing_price || '/' || purchase_count
    || ' purchases). Check producer or data pipeline.' AS description,
  CAST(purchases_missing_price AS DOUBLE) AS metric_value, '0' AS expected_value
FROM (SELECT *, purchases_missing_price / purchase_count AS share FROM metrics WHERE purchase_count > 0)
WHERE share > 0.10"""
RELATIONS["category_imbalance"] = f"""
SELECT window_start, 'category_imbalance' AS anomaly_type, 'low' AS severity,
  'CATEGORY IMBALANCE: Electronics accounts for ' || {_whole('share * 100')} || '% of purchases ('
    || electronics_purchases || '/' || purchase_count
    || '). Expected distribution more balanced. Possible bot or unusual promotion.' AS description,
  share * 100 AS metric_value, '25' AS expected_value
FROM (SELECT *, electronics_purchases / purchase_count AS share FROM metrics WHERE purchase_count > 3)
WHERE share > 0.30"""
DETECTORS = (
    "revenue_drop", "traffic", "cart_abandonment", "conversion_drop", "data_quality", "category_imbalance",
)
RELATIONS["findings"] = " UNION ALL ".join(f"SELECT * FROM {name}" for name in DETECTORS)
RELATIONS["anomalies"] = """
SELECT *, window_start + INTERVAL '1 hour' AS detected_at, 0 AS acknowledged FROM findings"""

# --- sessions: plain gap logic over one window per user ---
RELATIONS["marked_events"] = """
SELECT *, max(CASE WHEN event_type = 'logout' THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id, event_timestamp) AS instant_logout FROM silver"""
RELATIONS["instants"] = """
SELECT user_id, event_timestamp, max(instant_logout) AS logout FROM marked_events GROUP BY 1, 2"""
RELATIONS["session_starts"] = """
SELECT *, CASE WHEN lag(event_timestamp) OVER w IS NULL
    OR event_timestamp > lag(event_timestamp) OVER w + INTERVAL '6 hours'
    OR lag(logout) OVER w = 1 THEN 1 ELSE 0 END AS starts
FROM instants WINDOW w AS (PARTITION BY user_id ORDER BY event_timestamp)"""
RELATIONS["labels"] = """
SELECT user_id, event_timestamp,
  CAST(sum(starts) OVER (PARTITION BY user_id ORDER BY event_timestamp) AS BIGINT) AS session_no
FROM session_starts"""
RELATIONS["labelled"] = """
SELECT s.*, min(s.event_timestamp) OVER (PARTITION BY s.user_id, session_no) AS session_start
FROM silver s JOIN labels l ON s.user_id = l.user_id AND s.event_timestamp = l.event_timestamp"""
RELATIONS["session_rows"] = """
SELECT user_id, session_start, max(event_timestamp) AS session_end,
  count(*) AS events, count(*) FILTER (event_type = 'view') AS views,
  count(*) FILTER (event_type = 'add_to_cart') AS cart_adds,
  count(*) FILTER (event_type = 'purchase') AS purchases,
  sum(price) FILTER (event_type = 'purchase') AS revenue,
  bool_or(event_type = 'logout') AS logged_out,
  date_diff('microsecond', min(event_timestamp), max(event_timestamp)) / 1000000 AS duration_seconds
FROM labelled GROUP BY 1, 2"""


def half_up(text: str) -> str:
    """Spell out every ``round(x, n)`` as rounding half up of the decimal number.

    That is what rounding means in the results to match. DuckDB rounds the binary number, so that
    53.405 becomes 53.4.
    """
    start = re.search(r"\bround\(", text)
    if start is None:
        return text
    depth, comma, end = 1, 0, start.end()
    while depth:
        character = text[end]
        depth += {"(": 1, ")": -1}.get(character, 0)
        if character == "," and depth == 1:
            comma = end
        end += 1
    value, digits = half_up(text[start.end() : comma]), text[comma + 1 : end - 1].strip()
    exact = f"CAST(CAST({value} AS VARCHAR) AS DECIMAL(34, 16))"
    # The name differs in case, so that the call is not spelled out again.
    return f"{text[: start.start()]}CAST(ROUND({exact}, {digits}) AS DOUBLE){half_up(text[end:])}"


def with_relations(body: str) -> str:
    """Prefix a query with the relations it uses, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name, sql in RELATIONS.items():
            if name not in ordered and re.search(rf"\b(FROM|JOIN)\s+{name}\b|,\s+{name}\s+\w", text):
                visit(sql)
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    if not ordered:
        return body
    parts = ",\n".join(f"{name} AS ({RELATIONS[name].strip()})" for name in ordered)
    return f"WITH {parts}\n{body.strip()}"
