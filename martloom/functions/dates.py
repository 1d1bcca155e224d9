"""Date columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: month/day/year; single letters take one or two digits.
ORDER_DATE_MASK = "M/d/yyyy"


def parse_order_date(text: Column) -> Column:
    """Month/day/year text to DATE; text that is no such date is an error under ANSI."""
    return F.to_date(text, ORDER_DATE_MASK)


def calendar_parts(day: Column) -> dict[str, Column]:
    """Calendar columns of a date. Week and weekday are ISO, so 1 January can fall
    into week 53 of the calendar year that has just begun."""
    return {
        "day": F.dayofmonth(day),
        "month": F.month(day),
        "year": F.year(day),
        "quarter": F.quarter(day),
        "day_of_week": (F.weekday(day) + 1).cast("string"),
        "week": F.weekofyear(day),
    }
