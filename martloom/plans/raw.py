"""Raw layer: typing, dates, and the filtered copy that feeds the core layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martloom.functions.conform import conform
from martloom.functions.dates import parse_order_date
from martloom.schemas import DATE_COLUMNS, ORDER_LINES_TEXT


def raw_typed(text: DataFrame, key_type: str = "BIGINT") -> DataFrame:
    """Coerce each text field to its declared type; one bad value fails the load."""
    return conform(text, ORDER_LINES_TEXT, key_type)


def raw_dates(typed: DataFrame) -> DataFrame:
    """Rewrite both date columns from month/day/year text to DATE."""
    return typed.withColumns({name: parse_order_date(F.col(name)) for name in DATE_COLUMNS})


def core_raw(raw: DataFrame, segment: str) -> DataFrame:
    """All columns of the lines of one customer segment."""
    return raw.filter(F.col("segment") == F.lit(segment)).select("*")
