"""The silver rules, each as one boolean column that is never NULL."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlake.schemas import CATEGORIES, EVENT_TYPES, REQUIRED_FIELDS, SOURCES


def is_purchase() -> Column:
    return F.col("event_type") == "purchase"


def has_required_fields() -> Column:
    return reduce(and_, (F.col(name).isNotNull() for name in REQUIRED_FIELDS))


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def has_valid_event_type() -> Column:
    return _holds(F.col("event_type").isin(*EVENT_TYPES))


def has_valid_source() -> Column:
    return _holds(F.col("source").isin(*SOURCES))


def has_valid_user() -> Column:
    return _holds(F.col("user_id") > 0)


def has_valid_category() -> Column:
    return F.col("category").isNull() | _holds(F.col("category").isin(*CATEGORIES))


def has_valid_price() -> Column:
    return F.col("price").isNull() | _holds(F.col("price") > 0)


def is_complete_purchase() -> Column:
    """A purchase carries price, product and category; other events are free not to."""
    complete = F.col("price").isNotNull() & F.col("product_id").isNotNull() & F.col("category").isNotNull()
    return _holds(F.col("event_type") != "purchase") | complete


SILVER_RULES = {
    "required_fields": has_required_fields,
    "event_type": has_valid_event_type,
    "source": has_valid_source,
    "user_id": has_valid_user,
    "category": has_valid_category,
    "price": has_valid_price,
    "purchase_complete": is_complete_purchase,
}


def is_clean() -> Column:
    return reduce(and_, (rule() for rule in SILVER_RULES.values()))
