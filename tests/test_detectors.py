"""One metrics row just inside and just outside every threshold."""

import pytest
from pyspark.sql import functions as F

from eventlake.config import AlertConfig, DetectorConfig
from eventlake.operators import alerts, anomalies
from eventlake.sources.fixtures import read_bronze
from tests.conftest import PURCHASE, SMALL, at

QUIET = {
    "total_events": 1500, "unique_users": 10, "unique_sessions": 10, "total_revenue": 100.0,
    "purchase_count": 0, "avg_purchase_price": None, "cart_adds": 0, "buyers": 5,
    "purchases_missing_price": 0, "purchases_missing_category": 0, "electronics_purchases": 0,
    "fashion_purchases": 0,
}
SCHEMA = "window_start timestamp_ntz, window_end timestamp_ntz, " + ", ".join(
    f"{c} {'double' if c in ('total_revenue', 'avg_purchase_price') else 'long'}" for c in QUIET
)


def fire(spark, detector, **metrics):
    row = (at(0), at(5), *{**QUIET, **metrics}.values())
    found = anomalies.detect(spark.createDataFrame([row], SCHEMA), only=(detector,)).collect()
    assert len(found) <= 1
    return found[0] if found else None


CASES = [
    ("revenue_drop", {"total_revenue": 35.0}, None),
    ("revenue_drop", {"total_revenue": 34.99}, "medium"),
    ("revenue_drop", {"total_revenue": 29.99}, "high"),
    ("revenue_drop", {"total_revenue": 24.99}, "critical"),
    ("revenue_drop", {"total_revenue": 0.0}, "critical"),
    ("revenue_drop", {"total_revenue": None}, None),
    ("traffic", {"total_events": 1000}, None),
    ("traffic", {"total_events": 2000}, None),
    ("traffic", {"total_events": 999}, "medium"),
    ("traffic", {"total_events": 750}, "medium"),
    ("traffic", {"total_events": 749}, "high"),
    ("traffic", {"total_events": 500}, "high"),
    ("traffic", {"total_events": 499}, "critical"),
    ("traffic", {"total_events": 2001}, "medium"),
    ("traffic", {"total_events": 2500}, "medium"),
    ("traffic", {"total_events": 2501}, "high"),
    ("traffic", {"total_events": 3000}, "high"),
    ("traffic", {"total_events": 3001}, "critical"),
    ("cart_abandonment", {"cart_adds": 5, "purchase_count": 0}, None),
    ("cart_abandonment", {"cart_adds": 10, "purchase_count": 4}, None),
    ("cart_abandonment", {"cart_adds": 100, "purchase_count": 25}, "medium"),
    ("cart_abandonment", {"cart_adds": 100, "purchase_count": 15}, "high"),
    ("cart_abandonment", {"cart_adds": 100, "purchase_count": 5}, "critical"),
    ("cart_abandonment", {"cart_adds": 10, "purchase_count": 50}, None),
    ("conversion_drop", {"unique_users": 20, "buyers": 0}, None),
    ("conversion_drop", {"unique_users": 100, "buyers": 3}, None),
    ("conversion_drop", {"unique_users": 100, "buyers": 2}, "medium"),
    ("conversion_drop", {"unique_users": 100, "buyers": 1}, "high"),
    ("conversion_drop", {"unique_users": 1000, "buyers": 5}, "critical"),
    ("data_quality", {"purchase_count": 0}, None),
    ("data_quality", {"purchase_count": 10, "purchases_missing_price": 1}, None),
    ("data_quality", {"purchase_count": 100, "purchases_missing_price": 11}, "medium"),
    ("data_quality", {"purchase_count": 100, "purchases_missing_price": 26}, "high"),
    ("data_quality", {"purchase_count": 100, "purchases_missing_price": 51}, "critical"),
    ("data_quality", {"purchase_count": 100, "purchases_missing_category": 90}, None),
    ("category_imbalance", {"purchase_count": 10, "electronics_purchases": 10}, None),
    ("category_imbalance", {"purchase_count": 100, "electronics_purchases": 60}, None),
    ("category_imbalance", {"purchase_count": 100, "electronics_purchases": 61}, "low"),
    ("category_imbalance", {"purchase_count": 100, "fashion_purchases": 99}, None),
]


@pytest.mark.parametrize("detector,metrics,severity", CASES)
def test_thresholds(spark, detector, metrics, severity):
    found = fire(spark, detector, **metrics)
    assert (found and found["severity"]) == severity


TEXTS = [
    ("revenue_drop", {"total_revenue": 0.0}, "Revenue dropped to ZERO - possible payment system failure", "0.0", "50.0"),
    ("revenue_drop", {"total_revenue": 24.99}, "Revenue dropped by 50% from baseline ($50 → $24)", "24.99", "50.0"),
    ("traffic", {"total_events": 3001}, "Traffic SPIKE: 3001 events (expected <2000). Possible bot attack or viral event.", "3001", "<2000"),
    ("traffic", {"total_events": 12}, "Traffic DROP: 12 events (expected >1000). Possible system issue or producer failure.", "12", ">1000"),
    (
        "cart_abandonment", {"cart_adds": 100, "purchase_count": 5},
        "Cart abandonment SPIKE: 95% (expected ~50%). Possible checkout bug or payment issue. "
        "100 carts added, only 5 purchases.", "95.0", "50%",
    ),
    (
        "conversion_drop", {"unique_users": 100, "buyers": 2},
        "Conversion rate VERY LOW: 2.00% (2 buyers / 100 users). Expected >3%. Check purchase flow.", "2.0", "3.0",
    ),
    (
        "data_quality", {"purchase_count": 100, "purchases_missing_price": 29},
        "DATA QUALITY ISSUE: 28% of purchases missing price (29/100 purchases). Check producer or data pipeline.",
        "29", "0",
    ),
    (
        "category_imbalance", {"purchase_count": 100, "electronics_purchases": 75},
        "CATEGORY IMBALANCE: Electronics accounts for 75% of purchases (75/100). Expected distribution more "
        "balanced. Possible bot or unusual promotion.", "75.0", "25",
    ),
]


@pytest.mark.parametrize("detector,metrics,text,value,expected", TEXTS)
def test_texts(spark, detector, metrics, text, value, expected):
    found = fire(spark, detector, **metrics)
    assert (found["description"], found["metric_value"], found["expected_value"]) == (text, value, expected)


def test_all_detectors_come_from_one_aggregate(events):
    df = events({**PURCHASE, "price": None}, *[{"event_type": "add_to_cart"}] * 6)
    found = {r["anomaly_type"] for r in anomalies.detect_anomalies(df).collect()}
    # A lone purchase without a price leaves revenue at zero and is a quality issue.
    assert found == {"revenue_drop", "traffic_drop", "cart_abandonment_spike", "data_quality"}
    plan = anomalies.detect_anomalies(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_purchases_without_any_price_leave_revenue_null(events):
    metrics = anomalies.window_metrics(events({**PURCHASE, "price": None})).first()
    assert metrics["total_revenue"] is None and metrics["purchases_missing_price"] == 1


def test_exact_metrics_equal_approximate_ones_where_those_are_exact(spark):
    bronze = read_bronze(spark, SMALL)
    names = [c for c in anomalies.METRIC_COLUMNS if c not in ("unique_users", "unique_sessions", "buyers")]
    def rows(df):
        return sorted(
            tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*names).collect()
        )
    assert rows(anomalies.window_metrics(bronze, "1 day")) == rows(anomalies.window_metrics_exact(bronze, "1 day"))


def test_silent_windows_alert_once_filled(events):
    metrics = anomalies.window_metrics(events({}, {"event_timestamp": at(11)}))
    filled = anomalies.fill_empty_windows(
        metrics, F.lit(at(0)), F.lit(at(20)), "5 minutes"
    ).orderBy("window_start")
    assert [r["total_events"] for r in filled.collect()] == [1, 0, 1, 0]
    drops = anomalies.detect(filled, only=("traffic",)).collect()
    assert len(drops) == 4


def test_payload(spark):
    rows = [
        (at(0), "revenue_drop", "critical", "d", "1", "2"), (at(0), "traffic_spike", "high", "d", "1", "2"),
        (at(0), "traffic_drop", "medium", "d", "1", "2"), (at(0), "category_imbalance", "low", "d", "1", "2"),
    ]
    df = spark.createDataFrame(
        rows, "window_start timestamp_ntz, anomaly_type string, severity string, description string, "
        "metric_value string, expected_value string",
    )
    import json

    sent = {r["anomaly_type"]: r for r in alerts.alert_payloads(df, AlertConfig(dashboard_url="https://x.example")).collect()}
    assert set(sent) == {"revenue_drop", "traffic_spike"}
    assert sent["revenue_drop"]["title"] == "Revenue Drop Detected!" and sent["revenue_drop"]["color"] == "#FF0000"
    message = json.loads(sent["traffic_spike"]["payload_json"])
    blocks = message["attachments"][0]["blocks"]
    assert message["attachments"][0]["color"] == "#FF6600"
    assert blocks[0] == {"type": "header", "text": {"type": "plain_text", "text": "📈 Traffic Spike Detected!"}}
    assert [f["text"] for f in blocks[1]["fields"]] == [
        "*Severity:*\nHIGH", "*Time:*\n2024-01-01 00:00:00", "*Current Value:*\n1", "*Expected:*\n2"
    ]
    assert blocks[2] == {"type": "section", "text": {"type": "mrkdwn", "text": "*Details:*\nd"}}
    assert blocks[3]["elements"] == [
        {"type": "button", "text": {"type": "plain_text", "text": "View Dashboard"}, "url": "https://x.example", "style": "primary"},
        {"type": "button", "text": {"type": "plain_text", "text": "Acknowledge"}, "value": "ack_traffic_spike"},
    ]


def test_first_alert_per_quarter_hour(spark):
    rows = [(at(m), "traffic_drop", "high", f"{m}", "1", "2") for m in (0, 5, 10, 15, 20)]
    df = spark.createDataFrame(
        rows, "window_start timestamp_ntz, anomaly_type string, severity string, description string, "
        "metric_value string, expected_value string",
    )
    assert sorted(r["description"] for r in alerts.first_alerts(df).collect()) == ["0", "15"]


def test_time_counts_from_the_last_alert_sent(spark):
    rows = [(at(m), kind, "high", f"{m}", "1", "2") for kind in ("traffic_drop", "revenue_drop") for m in (10, 14, 15, 20, 29, 31, 60, 74, 75)]
    df = spark.createDataFrame(
        rows, "window_start timestamp_ntz, anomaly_type string, severity string, description string, "
        "metric_value string, expected_value string",
    )
    sent = alerts.first_alerts(df).filter("anomaly_type = 'traffic_drop'").orderBy("window_start").collect()
    assert [r["description"] for r in sent] == ["10", "29", "60", "75"]
    assert alerts.first_alerts(df).count() == 8


def test_scaled_settings_change_the_texts(spark):
    row = (at(0), at(5), *{**QUIET, "total_revenue": 1.0}.values())
    found = anomalies.detect(
        spark.createDataFrame([row], SCHEMA), DetectorConfig(revenue_baseline=200.0), only=("revenue_drop",)
    ).first()
    assert found["expected_value"] == "200.0" and "($200 → $1)" in found["description"]
