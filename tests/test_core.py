"""Dimensions and fact on hand-made lines, with every incomplete key."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from conftest import LINE
from pyspark.sql import functions as F

from martloom.functions.conform import conform
from martloom.operators.checks import constraint_report, sales_reconciliation
from martloom.plans import natural
from martloom.plans.core import BUILDERS, NEEDS
from martloom.plans.dims import product_grain, product_price
from martloom.plans.raw import core_raw


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_every_table_stands_after_its_needs():
    seen: set[str] = set()
    for name, needs in NEEDS.items():
        assert set(needs) <= seen
        seen.add(name)
    assert seen == set(BUILDERS)


def test_calendar(make_lines, build):
    lines = make_lines(
        {"order_date": date(2016, 1, 1), "ship_date": date(2016, 1, 3)},
        {"order_date": date(2016, 1, 1), "ship_date": date(2015, 12, 31)},
    )
    dates = build(lines, only={"dim_date"})["dim_date"]
    assert rows(dates, "date_id", "date_origin", "year", "quarter", "week", "day_of_week") == [
        (1, date(2015, 12, 31), 2015, 4, 53, "4"),
        (2, date(2016, 1, 1), 2016, 1, 53, "5"),
        (3, date(2016, 1, 3), 2016, 1, 53, "7"),
    ]
    assert rows(dates, "day", "month") == [(1, 1), (3, 1), (31, 12)]


def test_price_rounds_each_line_then_the_mean(make_lines):
    tie = {"sales": Decimal("261.96"), "discount": Decimal("0.20"), "quantity": 2}
    lines = make_lines(
        {**tie, "product_id": "P-tie"},  # 163.725
        {"product_id": "P-mean", "sales": Decimal("1.00"), "quantity": 1},
        {"product_id": "P-mean", "sales": Decimal("1.01"), "quantity": 1},  # 1.005
        {"product_id": "P-loss", "sales": Decimal("-1.01"), "quantity": 2},  # -0.505
    )
    got = {r["product_id"]: r["price"] for r in product_price(product_grain(lines)).collect()}
    assert got == {
        "P-tie": Decimal("163.73"), "P-mean": Decimal("1.01"), "P-loss": Decimal("-0.51"),
    }


def test_price_is_one_for_a_product_in_two_categories(make_lines, build):
    lines = make_lines(
        {"sales": Decimal("1.00"), "quantity": 1},
        {"sales": Decimal("3.00"), "quantity": 1, "sub_category": "Desks"},
    )
    products = build(lines, only={"dim_product"})["dim_product"]
    assert rows(products, "price") == [(Decimal("2.00"),)] * 2


def test_quantity_zero_is_a_division_error(make_lines):
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        product_price(product_grain(make_lines({"quantity": 0}))).collect()


def test_lines_of_one_key_are_summed(make_lines, build):
    lines = make_lines(
        {"sales": Decimal("10.00"), "quantity": 1, "profit": Decimal("1.5000")},
        {"sales": Decimal("8.00"), "quantity": 1, "discount": Decimal("0.20"),
         "profit": Decimal("-2.2500")},
    )
    fact = build(lines)["fact_sales"]
    # price 10.00, list value 20.00, charged 18.00
    assert rows(fact, "sum_of_sale", "quantity", "discount", "profit") == [
        (Decimal("18.00"), 2, Decimal("0.10"), Decimal("-0.7500"))
    ]


# Each case: what sets its second line apart from its first.
SHARED = {
    "order id on two dates": {"order_date": date(2015, 2, 1)},
    "customer id with two names": {"customer_name": "Bob", "order_id": "O-2"},
    "sub-category in two categories": {
        "category": "Office", "product_id": "P-2", "product_name": "Clip", "order_id": "O-2"},
    "product in two sub-categories": {"sub_category": "Desks", "order_id": "O-2"},
    "region in two countries": {
        "country": "CA", "state": "ON", "city": "Hull", "postal_code": 200, "order_id": "O-2"},
    "state in two regions": {
        "region": "West", "city": "Reno", "postal_code": 200, "order_id": "O-2"},
    "code in two cities": {"city": "Utica", "order_id": "O-2"},
}
PREFIXED = (
    "order_id", "customer_id", "product_id", "country", "region", "state", "city", "category",
    "sub_category",
)


@pytest.fixture(scope="module")
def shared_lines(make_lines):
    """Two lines of 20.00 per case; no case shares a key with another."""
    lines = []
    for number, change in enumerate(SHARED.values()):
        for over in ({}, change):
            line = {**LINE, **over}
            line.update({c: f"{number} {line[c]}" for c in PREFIXED})
            line["postal_code"] += 1000 * number
            del line["row_id"]
            lines.append(line)
    return make_lines(*lines)


@pytest.mark.parametrize("strict", [False, True])
def test_incomplete_key_repeats_lines_unless_strict(shared_lines, build, strict):
    tables = build(shared_lines, strict=strict)
    got = {
        r["number"]: r["sales"]
        for r in natural.facts(tables)
        .groupBy(F.split("order_id_from_raw", " ")[0].alias("number"))
        .agg(F.sum("sum_of_sale").alias("sales"))
        .collect()
    }
    want = Decimal("40.00") if strict else Decimal("80.00")
    assert {case: got[str(number)] for number, case in enumerate(SHARED)} == {
        case: want for case in SHARED
    }
    totals = sales_reconciliation(shared_lines, tables["fact_sales"]).first()
    assert (totals["line_sales"] == totals["fact_sales"]) is strict
    assert not constraint_report({"core_raw": shared_lines, **tables}).filter(
        "violations > 0"
    ).collect()


def test_state_in_two_regions_is_inherited_by_city_and_code(make_lines, build):
    lines = make_lines({}, {"region": "West", "order_id": "O-2"})
    tables = build(lines)
    assert natural.states(tables).count() == 2
    assert natural.cities(tables).count() == 2
    assert natural.postal_codes(tables).count() == 2
    assert tables["fact_sales"].count() == 4


def test_null_dates_and_codes_leave_the_fact(make_lines, build):
    lines = make_lines(
        {}, {"ship_date": None, "order_id": "O-2"}, {"postal_code": None, "order_id": "O-3"},
    )
    tables = build(lines)
    assert tables["fact_sales"].count() == 1
    assert tables["dim_date"].filter("date_origin IS NULL").count() == 1
    assert tables["dim_postal_code"].filter("postal_code IS NULL").count() == 1


def test_sums_skip_null_measures(make_lines, build):
    lines = make_lines({"profit": None}, {"quantity": 4, "sales": Decimal("40.00")})
    assert rows(build(lines)["fact_sales"], "quantity", "profit") == [(6, Decimal("1.0000"))]


def test_product_name_that_fits_raw_is_too_long_for_the_dimension(make_lines, build):
    lines = make_lines({"product_name": "x" * 160})
    conform(lines, "core_raw").collect()
    with pytest.raises(Exception, match="longer than 150"):
        build(lines, only={"dim_product"})


def test_fact_sum_over_its_type_fails(make_lines, build):
    big = {"sales": Decimal("99999999.99"), "quantity": 1000}
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        build(make_lines(big, big))


def test_empty_segment_gives_empty_tables(make_lines, build):
    tables = build(core_raw(make_lines({}), "Consumer"))
    assert {name: df.count() for name, df in tables.items()} == {name: 0 for name in NEEDS}


def test_core_raw_keeps_one_segment(make_lines):
    lines = make_lines({}, {"segment": "Consumer"}, {"segment": None})
    assert rows(core_raw(lines, "Corporate"), "row_id") == [(1,)]


def test_keys_do_not_depend_on_row_order_or_partitions(make_lines, build):
    lines = make_lines(*[
        {"order_id": f"O-{i % 13}", "customer_id": f"C-{i % 7}", "postal_code": i % 5,
         "city": f"City {i % 5}", "product_id": f"P-{i % 11}"}
        for i in range(60)
    ])
    first = build(lines)
    second = build(lines.orderBy("profit", "row_id").repartition(5))
    for name in NEEDS:
        assert sorted(map(tuple, first[name].collect()), key=str) == sorted(
            map(tuple, second[name].collect()), key=str
        ), name
