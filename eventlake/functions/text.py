"""Text assembled from columns."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F


def render(template: str, **values: Column) -> Column:
    """Fill ``{name}`` places of a template with columns. NULL in any value makes NULL."""
    parts: list[Column] = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(values[name].cast("string"))
    return F.concat(*parts)


def whole(value: Column) -> Column:
    """Cut a number to its whole part, as text inputs want it (never rounds)."""
    return value.try_cast("bigint")


def percent(ratio: Column) -> Column:
    return whole(ratio * 100)


def lookup(key: Column, table: dict[str, str], default: str) -> Column:
    """Constant map lookup as a ``CASE`` expression."""
    result = None
    for name, value in table.items():
        result = F.when(key == name, value) if result is None else result.when(key == name, value)
    return F.lit(default) if result is None else result.otherwise(default)
