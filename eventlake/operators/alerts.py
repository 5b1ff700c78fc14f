"""Alert messages, their de-duplication and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventlake.config import AlertConfig
from eventlake.functions.text import lookup

# Colours, symbols and labels of a message.
COLORS = {"critical": "#FF0000", "high": "#FF6600", "medium": "#FFCC00", "low": "#0099FF"}
DEFAULT_COLOR = "#888888"
SYMBOLS = {
    "revenue_drop": "💰",
    "traffic_spike": "📈",
    "traffic_drop": "📉",
    "cart_abandonment_spike": "🛒",
    "conversion_drop": "📊",
    "category_imbalance": "⚖️",
    "data_quality": "⚠️",
    "pipeline_delay": "⏱️",
}
DEFAULT_SYMBOL = "🚨"

_TEXT = "struct<type:string,text:string>"
_BLOCK = (
    f"struct<type:string,text:{_TEXT},fields:array<{_TEXT}>,"
    f"elements:array<struct<type:string,text:{_TEXT},url:string,style:string,value:string>>>"
)


def alert_title(kind: Column) -> Column:
    return F.concat(F.initcap(F.translate(kind, "_", " ")), F.lit(" Detected!"))


def _text(kind: str, text: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), text.alias("text"))


def _field(label: str, value: Column) -> Column:
    return _text("mrkdwn", F.concat(F.lit(f"*{label}:*\n"), value))


def _block(**parts: Column) -> Column:
    """A block with its own fields; the NULL rest is left out of the JSON."""
    names = ("type", "text", "fields", "elements")
    return F.struct(*[parts.get(n, F.lit(None)).alias(n) for n in names]).cast(_BLOCK)


def _button(label: str, **attributes: Column) -> Column:
    names = ("url", "style", "value")
    return F.struct(
        F.lit("button").alias("type"),
        _text("plain_text", F.lit(label)).alias("text"),
        *[attributes.get(n, F.lit(None).cast("string")).alias(n) for n in names],
    )


def alert_payloads(
    anomalies: DataFrame, cfg: AlertConfig = AlertConfig(), sent_at: Column | None = None
) -> DataFrame:
    """Messages for the severities that are worth one.

    ``sent_at`` is the time printed in the message; by default the window start.
    """
    time = F.date_format(F.col("window_start") if sent_at is None else sent_at, "yyyy-MM-dd HH:mm:ss")
    kind, severity = F.col("anomaly_type"), F.col("severity")
    color = lookup(severity, COLORS, DEFAULT_COLOR)
    title = alert_title(kind)
    heading = F.concat(lookup(kind, SYMBOLS, DEFAULT_SYMBOL), F.lit(" "), title)
    blocks = F.array(
        _block(type=F.lit("header"), text=_text("plain_text", heading)),
        _block(
            type=F.lit("section"),
            fields=F.array(
                _field("Severity", F.upper(severity)),
                _field("Time", time),
                _field("Current Value", F.col("metric_value")),
                _field("Expected", F.col("expected_value")),
            ),
        ),
        _block(type=F.lit("section"), text=_field("Details", F.col("description"))),
        _block(
            type=F.lit("actions"),
            elements=F.array(
                _button("View Dashboard", url=F.lit(cfg.dashboard_url), style=F.lit("primary")),
                _button("Acknowledge", value=F.concat(F.lit("ack_"), kind)),
            ),
        ),
    )
    message = F.struct(F.array(F.struct(color.alias("color"), blocks.alias("blocks"))).alias("attachments"))
    return anomalies.filter(severity.isin(*cfg.severities)).select(
        "window_start",
        "anomaly_type",
        "severity",
        color.alias("color"),
        title.alias("title"),
        F.to_json(message).alias("payload_json"),
    )


def first_alerts(anomalies: DataFrame, cfg: AlertConfig = AlertConfig()) -> DataFrame:
    """Alerts of a type of which none was sent within the de-duplication window before; the rest is held back.

    Alerts further apart than the window start chains of their own. A chain has one row per time
    window, and whether one of its alerts is sent depends only on the last one sent, so a fold over the sorted chain decides.
    """
    span = F.expr(f"INTERVAL {cfg.dedup_window}")
    rest = [c for c in anomalies.columns if c not in ("window_start", "anomaly_type")]
    single = anomalies.groupBy("anomaly_type", "window_start").agg(F.min(F.struct("window_start", *rest)).alias("row"))
    in_time = W.partitionBy("anomaly_type").orderBy("window_start")  # one row per time window
    starts = F.coalesce(F.col("window_start") >= F.lag("window_start").over(in_time) + span, F.lit(True))
    chained = single.withColumn("starts", starts).withColumn("chain", F.count_if("starts").over(in_time))
    chains = chained.groupBy("anomaly_type", "chain").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    none = F.array().cast(dict(chains.dtypes)["rows"])
    sent = F.aggregate(
        "rows", none,
        lambda kept, row: F.when(
            (F.size(kept) == 0) | (row["window_start"] >= F.try_element_at(kept, F.lit(-1))["window_start"] + span),
            F.array_append(kept, row),
        ).otherwise(kept),
    )
    return chains.select("anomaly_type", F.explode(sent).alias("row")).select("anomaly_type", "row.*").select(*anomalies.columns)


def route_alerts(anomalies: DataFrame) -> DataFrame:
    """Channel of each alert: critical ones first, then by the kind of anomaly."""
    channel = (
        F.when(F.col("severity") == "critical", "critical")
        .when(F.col("anomaly_type").isin("revenue_drop", "conversion_drop"), "revenue")
        .otherwise("technical")
    )
    return anomalies.withColumn("channel", channel)
