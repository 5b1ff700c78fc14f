"""Every query against its expected SQL on the smallest folder."""

import pytest

import __spark_entry__ as entry_points
from check_oracle import compare, connect
from tests.conftest import SMALL

NAMES = list(entry_points.queries())


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_expected_result_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, name):
    outcome, rows = compare(spark, con, name, SMALL)
    assert outcome in ("ok", "no SQL"), outcome
    if outcome == "no SQL":
        assert rows > 0


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {
        "event_date", "total_revenue", "total_purchases", "avg_order_value"
    }
