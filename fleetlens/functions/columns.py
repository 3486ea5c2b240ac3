"""Small helpers for building columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(value: ColumnLike) -> Column:
    """A column from a column or a column name."""
    return F.col(value) if isinstance(value, str) else value


def literal_map(entries: dict[str, str]) -> Column:
    """A constant map column."""
    return F.create_map(*[F.lit(part) for pair in entries.items() for part in pair])


def blank_to_null(value: ColumnLike) -> Column:
    """NULL where the text is empty."""
    return F.nullif(col(value), F.lit(""))


def whole_div(value: Column, divisor: int) -> Column:
    """Integer division that truncates toward zero."""
    return F.call_function("div", value, F.lit(divisor))
