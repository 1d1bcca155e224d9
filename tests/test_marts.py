"""Marts and the random category."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from martloom.plans.marts import (
    known_category,
    mart_for_random_category,
    mart_sales_by_year,
    mart_sub_category_sales,
    random_category,
)


@pytest.fixture(scope="module")
def tables(make_lines, build):
    office = {"category": "Office Supplies", "sub_category": "Paper", "product_id": "P-2"}
    tech = {"category": "Technology", "sub_category": "Phones", "product_id": "P-3"}
    return build(make_lines(
        {"order_id": "O-1", "sales": Decimal("10.00")},
        {"order_id": "O-2", "sales": Decimal("5.00"), "sub_category": "Tables",
         "product_id": "P-9"},
        {"order_id": "O-3", "sales": Decimal("2.00"), "order_date": date(2016, 3, 1)},
        {"order_id": "O-4", "sales": Decimal("7.00"), **office},
        {"order_id": "O-5", "sales": Decimal("9.00"), **tech},
    ))


def test_sales_by_year(tables):
    assert [tuple(r) for r in mart_sales_by_year(tables).collect()] == [
        (2015, "Furniture", Decimal("15.00")),
        (2015, "Office Supplies", Decimal("7.00")),
        (2015, "Technology", Decimal("9.00")),
        (2016, "Furniture", Decimal("2.00")),
    ]


@pytest.mark.parametrize("segment, year, category, want", [
    ("Corporate", 2015, "Furniture", [("Chairs", "10.00"), ("Tables", "5.00")]),
    ("Corporate", 2016, "Furniture", [("Chairs", "2.00")]),
    ("Corporate", 2015, "Technology", [("Phones", "9.00")]),
    ("Consumer", 2015, "Furniture", []),
    ("Corporate", 2015, "it's none", []),
])
def test_sub_category_sales(tables, segment, year, category, want):
    got = mart_sub_category_sales(tables, segment, year, category).collect()
    assert [(r[0], str(r[1])) for r in got] == want


def test_random_category_reaches_all(tables):
    names = {random_category(tables["dim_category"], seed).first()[0] for seed in range(30)}
    assert names == {"Furniture", "Office Supplies", "Technology"}
    assert random_category(tables["dim_category"]).count() == 1


def test_random_category_chooses_the_mart(tables):
    seen = set()
    for seed in range(10):
        picked = random_category(tables["dim_category"], seed).first()[0]
        got = mart_for_random_category(tables, "Corporate", 2015, seed).collect()
        want = mart_sub_category_sales(tables, "Corporate", 2015, picked).collect()
        assert got == want
        seen.add(picked)
    assert len(seen) > 1


def test_unknown_or_missing_category(tables, make_lines, build):
    assert known_category(tables["dim_category"], "Technology") == "Technology"
    with pytest.raises(ValueError, match="Toys"):
        known_category(tables["dim_category"], "Toys")
    empty = build(make_lines({}).limit(0))
    with pytest.raises(ValueError, match="no category"):
        mart_for_random_category(empty, "Corporate", 2015)
    assert mart_sales_by_year(empty).collect() == []
