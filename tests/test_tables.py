"""Layer tables: full refresh, failed loads, arrival of files."""

from __future__ import annotations

import csv
import os
import time
import uuid
from decimal import Decimal

import pytest
from test_csv import HEADERS, ROW, write

from martloom.config import MartConfig
from martloom.operators.checks import ConstraintError
from martloom.plans.refresh import load_raw, publish_mart, refresh
from martloom.schemas import CORE, MART, RAW, TABLES
from martloom.sources.staging import Staging, shared_folder
from martloom.sources.tables import Warehouse
from martloom.streaming.arrival import refresh_on_arrival


@pytest.fixture
def warehouse(spark, tmp_path):
    made = Warehouse(
        spark, str(tmp_path / "layers"), MartConfig(year=2016, key_buckets=8),
        prefix=f"t{uuid.uuid4().hex[:8]}_",
    )
    made.create_layers()
    yield made
    made.drop_layers()


def ids(warehouse):
    return sorted(r["row_id"] for r in warehouse.read_table("order_lines").collect())


def test_declared_types(spark, warehouse):
    for layer, tables in TABLES.items():
        for table in tables:
            got = spark.sql(f"DESCRIBE TABLE {warehouse.name_of(table)}").collect()
            assert [r["col_name"] for r in got] == [name for name, _ in TABLES[layer][table]]
    kinds = dict(
        (r["col_name"], r["data_type"])
        for r in spark.sql(f"DESCRIBE TABLE {warehouse.name_of('dim_product')}").collect()
    )
    assert kinds == {
        "product_id": "bigint", "product_id_from_raw": "varchar(20)",
        "product_name": "varchar(150)", "price": "decimal(8,2)", "sub_category_id": "bigint",
    }
    assert set(TABLES) == {RAW, CORE, MART}


def test_each_load_replaces_the_last(warehouse, make_lines):
    assert ids(warehouse) == []
    for count in (3, 1, 2, 0):
        warehouse.write_table("order_lines", make_lines(*[{}] * count) if count
                              else make_lines({}).limit(0))
        assert ids(warehouse) == list(range(1, count + 1))


def test_columns_are_written_by_name(warehouse, make_lines):
    lines = make_lines({"city": "Troy", "state": "NY"})
    warehouse.write_table("order_lines", lines.select(*reversed(lines.columns)))
    row = warehouse.read_table("order_lines").first()
    assert (row["city"], row["state"]) == ("Troy", "NY")
    with pytest.raises(ValueError, match="color"):
        warehouse.write_table("order_lines", lines.withColumnRenamed("city", "color"))


def test_failed_load_leaves_the_old_rows(warehouse, make_lines):
    warehouse.write_table("order_lines", make_lines({}, {}))
    with pytest.raises(Exception, match="longer than 30"):
        warehouse.write_table("order_lines", make_lines({}, {"city": "x" * 31}))
    assert ids(warehouse) == [1, 2]
    with pytest.raises(ConstraintError):
        warehouse.write_table("order_lines", make_lines({}, {"row_id": 1}))
    assert ids(warehouse) == [1, 2]
    warehouse.write_table("order_lines", make_lines({}))
    assert ids(warehouse) == [1]


def test_query_over_a_table(warehouse, make_lines):
    warehouse.write_table("order_lines", make_lines({}, {}))
    got = warehouse.read_table("order_lines", "SELECT count(*) AS n, sum(sales) AS s FROM {table}")
    assert tuple(got.first()) == (2, Decimal("40.00"))


def test_a_table_can_be_made_from_its_own_rows(warehouse, make_lines):
    warehouse.write_table("order_lines", make_lines({}, {}, {}))
    warehouse.write_table("order_lines", warehouse.read_table("order_lines").filter("row_id > 1"))
    assert ids(warehouse) == [2, 3]


def test_published_mart(spark, warehouse):
    rows = spark.sql("SELECT 2015 AS year, 'Paper' AS category_name, 1.50BD AS sum_of_sale")
    publish_mart(warehouse, "mart_sales_by_year", rows)
    publish_mart(warehouse, "mart_sales_by_year", rows)
    assert [tuple(r) for r in warehouse.read_table("mart_sales_by_year").collect()] == [
        (2015, "Paper", Decimal("1.50"))
    ]


def test_ansi_is_required(spark, tmp_path):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(ValueError, match="ansi"):
            Warehouse(spark, str(tmp_path), MartConfig())
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_shared_folder_is_the_session_setting(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert Staging(spark).root.startswith(shared_folder(spark))
    assert Staging(spark).root != Staging(spark).root


class _Session:
    """What shared_folder asks a session for."""

    def __init__(self, master, settings):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})
        self.conf = type("Conf", (), {"get": staticmethod(settings.get)})


def test_shared_folder_without_a_setting():
    setting = {"spark.checkpoint.dir": "hdfs:///shared/"}
    assert shared_folder(_Session("yarn", setting)) == "hdfs:///shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session("yarn", {}))
    local = shared_folder(_Session("local[2]", {}))
    assert local == shared_folder(_Session("local[2]", {}))


def test_refresh_then_failed_refresh(warehouse, tmp_path):
    rows = [
        {**ROW, "Row ID": "1"},
        {**ROW, "Row ID": "2", "Segment": "Consumer"},
        {**ROW, "Row ID": "3", "Order ID": "CA-2", "Sales": "38.04"},
    ]
    refresh(warehouse, write(tmp_path / "a.csv", rows), category="Furniture", verify=True)
    year = [(2016, "Furniture", Decimal("300.00"))]
    sub = [("Bookcases", Decimal("300.00"))]

    def state():
        return (
            ids(warehouse),
            warehouse.read_table("core_raw").count(),
            [tuple(r) for r in warehouse.read_table("mart_sales_by_year").collect()],
            [tuple(r) for r in warehouse.read_table("mart_sub_category_sales").collect()],
        )

    assert state() == ([1, 2, 3], 2, year, sub)
    # fits the raw layer, is too long for the product dimension
    bad = [*rows, {**ROW, "Row ID": "4", "Product ID": "P-x", "Product Name": "x" * 160}]
    with pytest.raises(Exception, match="longer than 150"):
        refresh(warehouse, write(tmp_path / "b.csv", bad), category="Furniture")
    assert state() == ([1, 2, 3], 2, year, sub)


def test_repeated_row_id_fails_the_load(warehouse, tmp_path):
    with pytest.raises(ConstraintError, match="order_lines"):
        load_raw(warehouse, write(tmp_path / "a.csv", [ROW, ROW]))


def test_each_landed_file_is_loaded_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    seen: list[str] = []

    def arrive():
        return refresh_on_arrival(spark, str(landing), str(tmp_path / "seen"), seen.append)

    write(landing / "day 1.csv", [ROW])
    write(landing / "day 2.csv", [ROW])
    assert arrive() == 2
    assert sorted(p.rsplit("/", 1)[1] for p in seen) == ["day 1.csv", "day 2.csv"]
    assert arrive() == 0
    write(landing / "day 3.csv", [ROW])
    assert arrive() == 1 and seen[-1].endswith("day 3.csv")
    with open(seen[-1].removeprefix("file:"), newline="") as landed:
        assert next(csv.reader(landed)) == HEADERS


def test_a_failed_reload_is_repeated(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    write(landing / "a.csv", [ROW])
    calls: list[str] = []

    def fail_once(path):
        calls.append(path)
        if len(calls) == 1:
            raise RuntimeError("load failed")

    with pytest.raises(Exception, match="load failed"):
        refresh_on_arrival(spark, str(landing), str(tmp_path / "seen"), fail_once)
    assert refresh_on_arrival(spark, str(landing), str(tmp_path / "seen"), fail_once) == 1
    assert calls[0] == calls[1]


def test_marker_completes_a_folder(spark, tmp_path):
    landing = tmp_path / "landing"
    (landing / "day1").mkdir(parents=True)
    write(landing / "day1" / "a.csv", [ROW])
    seen: list[str] = []

    def arrive():
        return refresh_on_arrival(
            spark, str(landing), str(tmp_path / "seen"), seen.append, marker="READY"
        )

    assert arrive() == 0
    (landing / "day1" / "READY").write_text("complete\n")
    assert arrive() == 1 and seen[0].endswith("/day1")


def test_a_landing_of_any_age_is_loaded(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    seen: list[str] = []

    def arrive():
        return refresh_on_arrival(spark, str(landing), str(tmp_path / "seen"), seen.append)

    write(landing / "new.csv", [ROW])
    assert arrive() == 1
    write(landing / "old.csv", [ROW])
    long_ago = time.time() - 400 * 86400
    os.utime(landing / "old.csv", (long_ago, long_ago))
    assert arrive() == 1 and seen[-1].endswith("old.csv")


def test_an_empty_marker_is_an_error_until_it_is_filled(spark, tmp_path):
    (tmp_path / "landing/day").mkdir(parents=True)
    marker = tmp_path / "landing/day/READY"
    marker.touch()
    seen: list[str] = []

    def arrive():
        return refresh_on_arrival(
            spark, str(tmp_path / "landing"), str(tmp_path / "seen"), seen.append, marker="READY"
        )

    with pytest.raises(Exception, match="holds nothing yet"):
        arrive()
    assert seen == []
    marker.write_text("complete\n")
    assert arrive() == 1 and seen[0].endswith("/day")
    assert arrive() == 0


def test_staging_as_a_context_leaves_nothing(spark):
    with pytest.raises(RuntimeError):
        with Staging(spark) as staging:
            staging.save("rows", spark.range(3))
            assert os.path.isdir(staging.root)
            raise RuntimeError
    assert not os.path.exists(staging.root)


# loads of several tables


class Dying(Warehouse):
    """Dies after some pointer moves."""

    moves_left = None

    def _point(self, table, path, load):
        if self.moves_left is not None:
            if self.moves_left == 0:
                raise ConnectionAbortedError(table)
            self.moves_left -= 1
        super()._point(table, path, load)


def shown(warehouse):
    """(first row id, sales of the mart) as plain readers of tables see them."""
    mart = warehouse.read_table("mart_sales_by_year").first()
    return min(ids(warehouse)), mart["sum_of_sale"]


def one_load(warehouse):
    tables = warehouse.read_load("order_lines", "mart_sales_by_year")
    return tables["order_lines"].first()["row_id"], tables["mart_sales_by_year"].first()["sum_of_sale"]


OLD, NEW = (1, Decimal("261.96")), (2, Decimal("99.00"))


@pytest.fixture
def half_published(spark, tmp_path):
    """A warehouse that stopped between two pointer moves, and another that finds it so."""
    place = str(tmp_path / "layers"), MartConfig(year=2016, key_buckets=8), f"t{uuid.uuid4().hex[:8]}_"
    dying = Dying(spark, *place)
    dying.create_layers()
    refresh(dying, write(tmp_path / "a.csv", [ROW]), category="Furniture")
    assert shown(dying) == one_load(dying) == OLD
    dying.moves_left = 4
    with pytest.raises(ConnectionAbortedError):
        refresh(dying, write(tmp_path / "b.csv", [{**ROW, "Row ID": "2", "Sales": "99"}]), category="Furniture")
    found = Warehouse(spark, *place)
    yield found
    found.drop_layers()


def test_readers_of_a_load_never_see_two(half_published):
    # tables one by one: the lines are new, the mart is old
    assert shown(half_published) == (NEW[0], OLD[1])
    assert one_load(half_published) == NEW


def test_the_next_call_completes_a_half_published_load(half_published, make_lines):
    half_published.write_table("order_lines", make_lines({"row_id": 9}))
    assert shown(half_published) == (9, NEW[1])
    assert half_published.loads.unfinished() is None
    loads = half_published.loads.history().collect()
    assert [len(load["tables"]) for load in loads] == [19, 19, 1]
    assert half_published.load_of("dim_city") == loads[1]["load"]
    assert half_published.load_of("order_lines") == loads[2]["load"]


def test_the_next_refresh_starts_from_one_load(half_published, tmp_path):
    refresh(half_published, write(tmp_path / "c.csv", [{**ROW, "Row ID": "3"}]), category="Furniture")
    assert shown(half_published) == one_load(half_published) == (3, OLD[1])
    assert half_published.loads.history().count() == 3


def test_a_load_whose_rows_are_gone_is_taken_back(half_published):
    import shutil

    move = half_published.loads.unfinished().tables["mart_sales_by_year"]
    shutil.rmtree(move.after.removeprefix("file:"))
    half_published.recover()
    assert shown(half_published) == one_load(half_published) == OLD
    assert half_published.recover() is None and half_published.loads.history().count() == 1


def test_a_driver_that_dies_before_the_first_move_or_after_the_last(spark, tmp_path, make_lines, monkeypatch):
    place = str(tmp_path / "layers"), MartConfig(key_buckets=8), f"t{uuid.uuid4().hex[:8]}_"
    dying = Dying(spark, *place)
    dying.create_layers()
    assert dying.loads.history().count() == 0 and dying.load_of("order_lines") is None
    dying.moves_left = 0
    with pytest.raises(ConnectionAbortedError):
        dying.write_table("order_lines", make_lines({}))
    assert ids(dying) == []
    dying.moves_left = None
    dying.recover()
    assert ids(dying) == [1]
    with monkeypatch.context() as patch:
        patch.setattr(dying.loads, "forget", lambda: None)
        dying.write_table("order_lines", make_lines({}, {}))
    dying.recover()
    assert ids(dying) == [1, 2] and dying.loads.history().count() == 2
    dying.drop_layers()
