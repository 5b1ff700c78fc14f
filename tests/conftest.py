import os
import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"

EVENT_COLUMNS = (
    "event_id string, user_id int, event_type string, page string, event_timestamp timestamp_ntz, "
    "source string, session_id string, price double, category string, product_id string, "
    "ingestion_timestamp timestamp_ntz"
)


@pytest.fixture(scope="session")
def shared_folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("shared"))


@pytest.fixture(scope="session")
def spark(shared_folder):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("eventlake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", shared_folder)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def events(spark):
    """Build a bronze frame from partial rows; what a row leaves out is a valid web view."""
    count = iter(range(1, 1_000_000))

    def build(*rows):
        full = []
        for row in rows:
            number = next(count)
            base = {
                "event_id": f"e{number}", "user_id": 1, "event_type": "view", "page": "/home",
                "event_timestamp": at(0), "source": "web", "session_id": "s1", "price": None,
                "category": None, "product_id": None, "ingestion_timestamp": at(0),
            }
            base.update(row)
            full.append(tuple(base[c.split()[0]] for c in EVENT_COLUMNS.split(", ")))
        return spark.createDataFrame(full, EVENT_COLUMNS).selectExpr("*", "to_date(event_timestamp) AS event_date")

    return build


def at(minutes, day=1, seconds=0, micros=0):
    from datetime import timedelta

    return datetime(2024, 1, day) + timedelta(minutes=minutes, seconds=seconds, microseconds=micros)


PURCHASE = {"event_type": "purchase", "price": 10.0, "category": "Books", "product_id": "PROD-1"}
