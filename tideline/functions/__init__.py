"""Column expressions shared by the operators; all stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def as_column(value: str | Column) -> Column:
    """A literal for plain text, the column itself otherwise."""
    return value if isinstance(value, Column) else F.lit(value)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
