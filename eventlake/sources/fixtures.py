"""Adapter from the generic ``events`` table to bronze click-stream events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlake.schemas import CATEGORIES, PAGES


def _pick(values: tuple[str, ...]) -> str:
    names = ", ".join(f"'{v}'" for v in values)
    return f"array({names})[k % {len(values)}]"


def clickstream_from_events(events: DataFrame) -> DataFrame:
    """Bronze rows derived from ``events``, with a known share of invalid and repeated records.

    One in fifty events arrives twice; the later copy is told apart by its page. Both come from
    one scan: ``posexplode`` repeats ``k`` once per copy. As the output of a generator ``k`` is also
    parsed once per event, and not again in every filter that Spark pushes down.
    """
    keyed = events.selectExpr(
        "event_id",
        "user_id",
        "ts",
        "value",
        """posexplode(array_repeat(
             named_struct(
               'k', try_cast(get_json_object(props, '$.k') AS INT),
               'event_type', CASE event_type WHEN 'signup' THEN 'login' WHEN 'view' THEN 'view'
                 WHEN 'click' THEN 'add_to_cart' WHEN 'purchase' THEN 'purchase'
                 WHEN 'error' THEN 'logout' END),
             IF(event_id % 50 = 0, 2, 1))) AS (copy, fields)""",
    ).selectExpr("event_id", "user_id", "ts", "value", "copy", "fields.k AS k", "fields.event_type AS event_type")
    no_product = "event_type IN ('login', 'logout')"
    return keyed.selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "CAST(user_id AS INT) AS user_id",
        "event_type",
        f"IF(copy = 1, '/retry', {_pick(PAGES)}) AS page",
        "ts AS event_timestamp",
        "CASE WHEN k = 99 THEN 'kiosk' WHEN event_id % 2 = 0 THEN 'web' ELSE 'mobile' END AS source",
        "concat_ws('-', CAST(user_id AS STRING), CAST(to_date(ts) AS STRING)) AS session_id",
        f"""CASE WHEN {no_product} OR (event_type = 'purchase' AND k IN (90, 91)) THEN NULL
            WHEN event_type = 'view' AND k = 92 THEN -1.0D ELSE value END AS price""",
        f"CASE WHEN {no_product} THEN NULL WHEN k = 93 THEN 'Gadgets' ELSE {_pick(CATEGORIES)} END AS category",
        f"IF({no_product}, NULL, concat('PROD-', CAST(k AS STRING))) AS product_id",
        "ts + make_dt_interval(0, 0, 0, event_id % 5 + copy * 60) AS ingestion_timestamp",
        "to_date(ts) AS event_date",
    )


def read_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clickstream_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
