"""Sizes of joins known before they run."""

from __future__ import annotations

import random
import uuid
from datetime import date

import pytest
from test_csv import ROW, write

from martloom.config import MartConfig
from martloom.operators.checks import ConstraintError, sales_reconciliation
from martloom.operators.join_size import join_size
from martloom.plans.core import NEEDS
from martloom.plans.fan_out import fan_out_report, fan_out_totals, require_no_fan_out
from martloom.plans.refresh import refresh
from martloom.sources.tables import Warehouse

# an order id of two dates, a postal code of two cities, a sub-category of two categories
SHARED = [
    {},
    {"order_date": date(2015, 2, 1)},
    {"city": "Utica", "order_id": "O-2"},
    {"category": "Office", "product_id": "P-2", "order_id": "O-3", "customer_id": "C-2"},
]


def size(child, parent, keys):
    return join_size(child, parent, keys).first().asDict()


@pytest.mark.parametrize("seed", range(3))
def test_size_of_a_join_is_that_of_the_join(spark, seed):
    draw = random.Random(seed)
    names = [None, *"abcdefg"]
    rows = [[(draw.choice(names), draw.choice([None, 1, 2])) for _ in range(n)] for n in (200, 9)]
    child, parent = (spark.createDataFrame(r, "name string, kind int") for r in rows)
    for keys in (["name"], ["name", "kind"]):
        joined, alone = child.join(parent, keys), child.join(parent, keys, "left_anti")
        per_key = parent.join(child, keys, "left_semi").groupBy(*keys).count()
        assert size(child, parent, keys) == {
            "child_rows": 200,
            "joined_rows": joined.count(),
            "unmatched_rows": alone.count(),
            "repeated_keys": per_key.filter("count > 1").count(),
            "most_parents": per_key.agg({"count": "max"}).first()[0] or 0,
        }


def test_size_of_empty_joins(spark):
    some, none = spark.createDataFrame([("a",)], "name string"), spark.createDataFrame([], "name string")
    zero = dict.fromkeys(("child_rows", "joined_rows", "unmatched_rows", "repeated_keys", "most_parents"), 0)
    assert size(none, some, ["name"]) == size(none, none, ["name"]) == zero
    assert size(some, none, ["name"]) == {**zero, "child_rows": 1, "unmatched_rows": 1}


@pytest.mark.parametrize("strict", [False, True])
def test_totals_are_those_of_the_fact(make_lines, build, strict):
    lines = make_lines(*SHARED)
    tables = build(lines, strict)
    config = MartConfig(strict_keys=strict)
    assert fan_out_totals(lines, tables, config).first() == sales_reconciliation(lines, tables["fact_sales"]).first()
    report = {r["join_name"]: r["joined_rows"] - r["child_rows"] for r in fan_out_report(lines, tables, config).collect()}
    # each line of O-1 twice; all codes are 100, of two cities; P-1 and P-2 have two categories each
    extra = {
        "dim_product to dim_sub_category": 2, "fact_sales to dim_order": 2, "fact_sales to dim_postal_code": 4,
        "fact_sales to dim_product": 4,
    }
    assert {name: n for name, n in report.items() if n} == ({} if strict else extra)


def test_the_report_needs_no_fact(make_lines, build):
    lines = make_lines(*SHARED)
    tables = build(lines, only=set(NEEDS["fact_sales"]))
    assert "fact_sales" not in tables
    with pytest.raises(ConstraintError, match="fact_sales to dim_order: 6 rows of 4"):
        require_no_fan_out(lines, tables, MartConfig())


def test_a_load_may_refuse_to_repeat_lines(spark, tmp_path):
    warehouse = Warehouse(
        spark, str(tmp_path / "layers"), MartConfig(year=2016, key_buckets=8), f"t{uuid.uuid4().hex[:8]}_"
    )
    warehouse.create_layers()
    shared = [ROW, {**ROW, "Row ID": "2", "City": "Lexington"}]
    try:
        with pytest.raises(ConstraintError, match="dim_postal_code"):
            refresh(warehouse, write(tmp_path / "a.csv", shared), category="Furniture", allow_fan_out=False)
        assert warehouse.read_table("order_lines").count() == 0
        refresh(warehouse, write(tmp_path / "b.csv", [ROW]), category="Furniture", allow_fan_out=False)
        assert warehouse.read_table("fact_sales").count() == 1
        refresh(warehouse, write(tmp_path / "a.csv", shared), category="Furniture")
        assert warehouse.read_table("fact_sales").count() == 2
    finally:
        warehouse.drop_layers()
