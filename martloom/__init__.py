"""Retail order-line warehouse on Spark: raw lines, snowflake core, sales marts."""

from martloom.config import MartConfig

__all__ = ["MartConfig"]
