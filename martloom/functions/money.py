"""Exact decimal arithmetic. Every rounding is to two digits, half away from zero.

Spark derives the scale of a decimal quotient from the operand types, so the casts
below are part of the result: each keeps enough digits that a value is never moved
across a rounding tie.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F


def list_price(sales: Column, discount: Column, quantity: Column) -> Column:
    """Unit price before discount. Quantity 0 is a division error under ANSI.

    decimal(10,2) / decimal(4,2) has scale 7. That is enough: a quotient that is no tie
    lies at least 1/(39800 * quantity) from one, and a tie has at most three digits
    before the division by the quantity.
    """
    full = sales.cast("decimal(10,2)") / (F.lit(Decimal("1.00")) - discount.cast("decimal(2,2)"))
    return F.round(full / quantity.cast("int"), 2)


def mean_price(total: Column, lines: Column) -> Column:
    """Mean of two-digit prices from their sum and count; NULL without prices.

    The quotient has scale 17, exact up to about 10^14 lines of one product.
    """
    return F.round(total.cast("decimal(23,2)") / F.nullif(lines.cast("bigint"), F.lit(0)), 2)


def effective_discount(list_value: Column, sales: Column) -> Column:
    """Share of the list value that was not charged."""
    full = list_value.cast("decimal(18,2)")
    return F.round((full - sales.cast("decimal(18,2)")) / full, 2)
