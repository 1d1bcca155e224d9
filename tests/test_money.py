"""Rounded money against exact fractions."""

from __future__ import annotations

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from martloom.functions.money import effective_discount, list_price, mean_price


def half_up(value: Fraction) -> Decimal:
    scaled = abs(value) * 100
    whole = (2 * scaled.numerator + scaled.denominator) // (2 * scaled.denominator)
    return Decimal(whole if value >= 0 else -whole).scaleb(-2)


LINES = st.lists(
    st.tuples(
        st.integers(-10**9, 10**9),  # cents
        st.integers(-99, 99),  # discount, hundredths
        st.integers(1, 10**6),  # quantity
        st.integers(0, 5),  # product
    ),
    min_size=1, max_size=200,
)


@settings(max_examples=10, deadline=None)
@given(LINES)
def test_prices_are_exact(spark, lines):
    rows = [
        (g, Decimal(c).scaleb(-2), Decimal(d).scaleb(-2), q) for c, d, q, g in lines
    ]
    df = spark.createDataFrame(
        rows, "product int, sales decimal(10,2), discount decimal(2,2), quantity int"
    ).withColumn("price", list_price(F.col("sales"), F.col("discount"), F.col("quantity")))
    expected = [half_up(Fraction(c, 100) / Fraction(100 - d, 100) / q) for c, d, q, _ in lines]
    assert [r["price"] for r in df.collect()] == expected

    groups = defaultdict(list)
    for (*_, g), price in zip(lines, expected):
        groups[g].append(Fraction(price))
    means = df.groupBy("product").agg(mean_price(F.sum("price"), F.count("price")).alias("mean"))
    assert {r["product"]: r["mean"] for r in means.collect()} == {
        g: half_up(sum(prices) / len(prices)) for g, prices in groups.items()
    }


def test_mean_of_many_lines_near_a_tie(spark):
    """1.00 and 1.01 in equal numbers give 1.005; one line more tips it."""
    n = 300_000
    df = spark.range(2 * n + 1).select(
        F.when(F.col("id") < n, F.lit(Decimal("1.01"))).otherwise(F.lit(Decimal("1.00"))).alias("p")
    )
    got = df.agg(mean_price(F.sum("p"), F.count("p"))).first()[0]
    assert got == Decimal("1.00")
    tie = df.filter(F.col("id") < 2 * n).agg(mean_price(F.sum("p"), F.count("p"))).first()[0]
    assert tie == half_up(Fraction(n * 101 + n * 100, 2 * n * 100))


def test_mean_without_prices_is_null(spark):
    df = spark.createDataFrame([(None,)], "p decimal(13,2)")
    assert df.agg(mean_price(F.sum("p"), F.count("p"))).first()[0] is None


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 10**12), st.integers(-10**10, 10**10)), min_size=1))
def test_discounts_are_exact(spark, pairs):
    df = spark.createDataFrame(
        [(Decimal(a).scaleb(-2), Decimal(b).scaleb(-2)) for a, b in pairs],
        "full decimal(18,2), paid decimal(18,2)",
    )
    got = [r[0] for r in df.select(effective_discount(F.col("full"), F.col("paid"))).collect()]
    assert got == [half_up(Fraction(a - b, a)) for a, b in pairs]
