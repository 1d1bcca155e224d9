"""Registered queries: every operator over the star-schema tables of one folder.

Queries that look at the core layer share one build of it per session, folder and
variant, as users of a warehouse do. `build_core` and `fact_sales_build` build anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce
from threading import Lock

from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.config import MartConfig
from martloom.functions.conform import conform
from martloom.operators.checks import (
    constraint_report,
    foreign_key_violations,
    primary_key_violations,
    sales_reconciliation,
)
from martloom.operators.keys import surrogate_key
from martloom.plans import natural
from martloom.plans.core import GRAINS, NEEDS, build_core
from martloom.plans.dims import product_grain, product_price
from martloom.plans.fan_out import fan_out_report, fan_out_totals
from martloom.plans.marts import (
    mart_for_each_category,
    mart_for_random_category,
    mart_sales_by_year,
    mart_sub_category_sales,
    random_category,
    sales_grain,
)
from martloom.plans.raw import core_raw, raw_dates, raw_typed
from martloom.plans.refresh import publish_mart, refresh
from martloom.schemas import BUCKETED, FOREIGN_KEYS, TABLES
from martloom.sources.buckets import Buckets
from martloom.sources.order_lines_csv import read_raw_csv
from martloom.sources.staging import Staging, delete_files, shuffles_freed, write_marker
from martloom.sources.star_schema import (
    LANDED_GZIP,
    as_text,
    joined_lines,
    land_csv,
    land_fields,
    made_lines,
    order_lines,
)
from martloom.sources.tables import Warehouse
from martloom.streaming.arrival import refresh_on_arrival

# The test tables have other segments, years and categories than a shop's own file.
SEGMENT = "BUILDING"
YEAR = 1998
CATEGORY = "ECONOMY"

Query = Callable[[SparkSession, str], DataFrame]


def settings(strict: bool = False) -> MartConfig:
    return MartConfig(segment=SEGMENT, year=YEAR, strict_keys=strict, order_buckets=16)


class CoreLayer:
    """Core tables of one folder, each written when a query first needs it."""

    def __init__(self, spark: SparkSession, folder: str, variant: str, strict: bool) -> None:
        self.config = settings(strict)
        self.staging = Staging(spark)
        self.lines = self.staging.save(
            "core_raw", core_raw(order_lines(spark, folder, variant), SEGMENT)
        )
        self._tables: dict[str, DataFrame] = {}
        self._grain: DataFrame | None = None
        self._lock = Lock()

    def save(self, name: str, df: DataFrame) -> DataFrame:
        rows = df if name in GRAINS else conform(df, name)
        buckets = Buckets(BUCKETED[name], self.config.order_buckets) if name in BUCKETED else None
        return self.staging.save(name, rows, buckets=buckets)

    def grain(self) -> DataFrame:
        """The sales grain of both marts, one folder for each year."""
        tables = self.tables()
        with self._lock:
            if self._grain is None:
                self._grain = self.staging.save("sales_grain", sales_grain(tables), by="year")
            return self._grain

    def tables(self, *names: str) -> dict[str, DataFrame]:
        only = set(names) if names else None
        with self._lock:
            self._tables = build_core(self.lines, self.config, self.save, only, self._tables)
            return dict(self._tables)


_layers: dict[tuple[str, str, str, bool], CoreLayer] = {}
_layers_lock = Lock()


def core_layer(
    spark: SparkSession, folder: str, variant: str = "plain", strict: bool = False
) -> CoreLayer:
    key = (spark.sparkContext.applicationId, folder, variant, strict)
    with _layers_lock:
        if key not in _layers:
            _layers[key] = CoreLayer(spark, folder, variant, strict)
        return _layers[key]


def _without_row_id(df: DataFrame) -> DataFrame:
    """Row ids depend on the files, so two engines do not agree on them."""
    return df.drop("row_id")


# sources and raw layer


def q_read_raw_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Lines written as delimited files and read back as text."""
    landing = f"{Staging(spark).root}/csv"
    land_csv(order_lines(spark, folder, whole=True), landing)
    return _without_row_id(read_raw_csv(spark, landing))


def q_read_raw_csv_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """Names with line breaks, quotes and commas, written and read back."""
    landing = f"{Staging(spark).root}/csv"
    lines = order_lines(spark, folder, whole=True)
    broken = F.concat("product_name", F.lit('\n"'), F.col("quantity").cast("string"), F.lit('",\n\nend'))
    land_csv(lines.withColumn("product_name", broken), landing, "gzip")
    return _without_row_id(read_raw_csv(spark, landing))


def q_read_raw_csv_stray_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """Quotes inside plain fields, beside quoted fields with line breaks and doubled quotes."""
    landing = f"{Staging(spark).root}/csv"
    fields = as_text(order_lines(spark, folder, whole=True)).withColumns(
        {
            "city": F.concat(F.lit('3" '), "city"),
            "state": F.concat("state", F.lit('"')),
            "product_name": F.concat(F.lit('"'), "product_name", F.lit('\n""x"", y"')),
        }
    )
    land_fields(fields, landing, compression="gzip")
    return _without_row_id(read_raw_csv(spark, landing))


def _landed_text(spark: SparkSession, text: DataFrame) -> DataFrame:
    """Text columns as a load finds them: written before typing starts."""
    return Staging(spark).save("text", text)


def q_raw_typed(spark: SparkSession, folder: str) -> DataFrame:
    text = _landed_text(spark, as_text(order_lines(spark, folder)))
    return _without_row_id(raw_typed(text))


def q_raw_dates(spark: SparkSession, folder: str) -> DataFrame:
    text = _landed_text(spark, as_text(order_lines(spark, folder)))
    return _without_row_id(raw_dates(raw_typed(text)))


def q_conform(spark: SparkSession, folder: str) -> DataFrame:
    """Text in every column, dates too, brought to the declared types by name."""
    lines = order_lines(spark, folder)
    text = lines.select(*[F.col(c).cast("string").alias(c) for c in reversed(lines.columns)])
    return _without_row_id(conform(_landed_text(spark, text), "order_lines"))


def q_core_raw(spark: SparkSession, folder: str) -> DataFrame:
    return _without_row_id(core_raw(order_lines(spark, folder), SEGMENT))


def _warehouse(spark: SparkSession) -> Warehouse:
    """A warehouse of its own in the shared folder, so queries never meet."""
    staging = Staging(spark)
    warehouse = Warehouse(
        spark, f"{staging.root}/layers", settings(), prefix=f"q{uuid.uuid4().hex[:12]}_"
    )
    warehouse.create_layers()
    return warehouse


def q_write_table(spark: SparkSession, folder: str) -> DataFrame:
    """A table replaced twice holds the second load only."""
    warehouse = _warehouse(spark)
    lines = order_lines(spark, folder)
    warehouse.write_table("order_lines", lines)
    warehouse.write_table("order_lines", core_raw(lines, SEGMENT))
    stored = warehouse.read_table("order_lines")
    warehouse.drop_layers()
    return _without_row_id(stored)


def q_read_table(spark: SparkSession, folder: str) -> DataFrame:
    """A query over a stored table."""
    warehouse = _warehouse(spark)
    warehouse.write_table("order_lines", order_lines(spark, folder))
    rows = warehouse.read_table(
        "order_lines",
        "SELECT segment, category, sum(sales) AS sales, sum(quantity) AS quantity "
        "FROM {table} GROUP BY segment, category",
    )
    warehouse.drop_layers()
    return rows


def q_refresh_on_arrival(spark: SparkSession, folder: str) -> DataFrame:
    """Files land, the stream reloads every layer from them, the first mart is read."""
    warehouse = _warehouse(spark)
    landing = f"{warehouse.staging.root}/landing"
    land_csv(order_lines(spark, folder, whole=True), f"{landing}/day-1", "gzip")
    write_marker(spark, f"{landing}/day-1/READY")
    refresh_on_arrival(
        spark,
        landing,
        f"{warehouse.staging.root}/seen",
        lambda path: refresh(warehouse, path, pattern=LANDED_GZIP, category=CATEGORY),
        marker="READY",
    )
    mart = warehouse.read_table("mart_sales_by_year")
    warehouse.drop_layers()
    return mart


def _landings(
    spark: SparkSession, folder: str, landing: str, *variants: str
) -> Iterator[str]:
    """Folders of gzip files that land one after the other, day-1, day-2 and so on. The tables are
    joined once for all of them, and the files of a day go when the next day is asked for; what
    else lies in its folder stays."""
    days = [f"{landing}/day-{n}" for n in range(1, len(variants) + 1)]
    with Staging(spark) as staging:
        with shuffles_freed(spark):
            joined = staging.save("joined", joined_lines(spark, folder, whole=True))
        for day, variant in zip(days, variants, strict=True):
            land_csv(made_lines(joined, variant), day, "gzip")
            if day == days[-1]:
                break
            yield day
            delete_files(spark, f"{day}/{LANDED_GZIP}")
    yield days[-1]


def q_refresh_on_arrival_twice(spark: SparkSession, folder: str) -> DataFrame:
    """A second landing replaces the first: other lines land, are loaded, then the real ones."""
    warehouse = _warehouse(spark)
    root = warehouse.staging.root
    for day in _landings(spark, folder, f"{root}/landing", "shared_all", "plain"):
        write_marker(spark, f"{day}/READY")
        loaded = refresh_on_arrival(
            spark,
            f"{root}/landing",
            f"{root}/seen",
            lambda path: refresh(warehouse, path, pattern=LANDED_GZIP, category=CATEGORY),
            marker="READY",
        )
        if loaded != 1:
            raise RuntimeError(f"{day}: {loaded} landings were loaded")
    mart = warehouse.read_table("mart_sales_by_year")
    warehouse.drop_layers()
    return mart


class _DyingWarehouse(Warehouse):
    """A warehouse whose driver dies after it has moved some pointers of a load."""

    moves_left: int | None = None

    def _point(self, table: str, path: str, load: str) -> None:
        if self.moves_left is not None:
            if not self.moves_left:
                raise ConnectionAbortedError(f"the driver died before {table} was published")
            self.moves_left -= 1
        super()._point(table, path, load)


def q_refresh_interrupted(spark: SparkSession, folder: str) -> DataFrame:
    """A load replaces another and stops between two tables: what readers of whole loads see before,
    between and after the next use of the warehouse."""
    staging = Staging(spark)
    place = f"{staging.root}/layers", settings(), f"q{uuid.uuid4().hex[:12]}_"
    warehouse = _DyingWarehouse(spark, *place)
    warehouse.create_layers()
    seen = []

    def look(moment: str, reader: Warehouse) -> None:
        tables = reader.read_load("mart_sales_by_year", "order_lines")
        lines = tables["order_lines"].agg(F.sum("quantity").alias("line_quantity"))
        mart = tables["mart_sales_by_year"].agg(F.sum("sum_of_sale").alias("mart_sales"))
        facts = {**lines.first().asDict(), **mart.first().asDict()}
        seen.append((moment, facts["line_quantity"], facts["mart_sales"]))

    landings = _landings(spark, folder, f"{staging.root}/landing", "repeated", "plain")
    for day, moves in zip(landings, (None, 5), strict=True):
        warehouse.moves_left = moves
        try:
            refresh(warehouse, day, pattern=LANDED_GZIP, category=CATEGORY)
        except ConnectionAbortedError:
            look("between", warehouse)
        else:
            look("before", warehouse)
    following = Warehouse(spark, *place)
    following.recover()
    look("after", following)
    loads = {following.load_of(t) for tables in TABLES.values() for t in tables}
    if len(loads) != 1 or following.loads.history().count() != 2:
        raise RuntimeError("tables of several loads are shown")
    following.drop_layers()
    return spark.createDataFrame(seen, "moment string, line_quantity long, mart_sales decimal(38,2)")


def q_publish_mart(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _warehouse(spark)
    rows = mart_sales_by_year(core_layer(spark, folder).tables())
    publish_mart(warehouse, "mart_sales_by_year", rows)
    mart = warehouse.read_table("mart_sales_by_year")
    warehouse.drop_layers()
    return mart


# dimensions, with surrogate keys resolved


def q_dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return core_layer(spark, folder).tables("dim_date")["dim_date"]


def _titles(table: str, key: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return core_layer(spark, folder).tables(table)[table].drop(key)

    return query


def _resolved(
    table: str,
    parents: tuple[str, ...],
    resolve: Callable[[dict[str, DataFrame]], DataFrame],
    key: str,
    variant: str = "plain",
    strict: bool = False,
) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        tables = core_layer(spark, folder, variant, strict).tables(table, *parents)
        return resolve(tables).drop(key)

    return query


_PLACES = ("dim_city", "dim_state", "dim_region", "dim_country")

_DIMENSIONS: dict[str, tuple[tuple[str, ...], Callable, str]] = {
    "dim_order": (("dim_date",), natural.orders, "order_id"),
    "dim_shipment": (("dim_date", "dim_ship_mode"), natural.shipments, "shipment_id"),
    "dim_customer": (("dim_segment",), natural.customers, "customer_id"),
    "dim_sub_category": (("dim_category",), natural.sub_categories, "sub_category_id"),
    "dim_product": (("dim_sub_category", "dim_category"), natural.products, "product_id"),
    "dim_region": (("dim_country",), natural.regions, "region_id"),
    "dim_state": (("dim_region", "dim_country"), natural.states, "state_id"),
    "dim_city": (("dim_state", "dim_region", "dim_country"), natural.cities, "city_id"),
    "dim_postal_code": (_PLACES, natural.postal_codes, "postal_code_id"),
}


def q_product_price(spark: SparkSession, folder: str) -> DataFrame:
    return product_price(product_grain(core_raw(order_lines(spark, folder), SEGMENT)))


def q_surrogate_key(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of all orders: as many as rows, none twice, from 1 without a gap."""
    orders = order_lines(spark, folder).select("order_id").distinct()
    return surrogate_key(orders, "key", ["order_id"], settings().key_buckets).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("key").alias("key_count"),
        F.min("key").alias("first_key"),
        F.max("key").alias("last_key"),
    )


# fact and marts


def _facts(variant: str, strict: bool = False) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return natural.facts(core_layer(spark, folder, variant, strict).tables())

    return query


def _by_year(variant: str, strict: bool = False) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return mart_sales_by_year(core_layer(spark, folder, variant, strict).tables())

    return query


def _by_sub_category(variant: str, strict: bool = False) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        tables = core_layer(spark, folder, variant, strict).tables()
        return mart_sub_category_sales(tables, SEGMENT, YEAR, CATEGORY)

    return query


def q_mart_sales_by_year_grain(spark: SparkSession, folder: str) -> DataFrame:
    """The mart from the written grain."""
    layer = core_layer(spark, folder)
    return mart_sales_by_year(layer.tables(), layer.grain())


def q_mart_sub_category_sales_grain(spark: SparkSession, folder: str) -> DataFrame:
    """The mart from one year's folder of the written grain."""
    layer = core_layer(spark, folder)
    return mart_sub_category_sales(layer.tables(), SEGMENT, YEAR, CATEGORY, layer.grain())


def q_random_category(spark: SparkSession, folder: str) -> DataFrame:
    """What holds for every pick: one row, of a category that there is."""
    categories = core_layer(spark, folder).tables("dim_category")["dim_category"]
    known = categories.select("category_name", F.lit(True).alias("known"))
    return random_category(categories).join(known, "category_name", "left").agg(
        F.count(F.lit(1)).alias("rows_picked"),
        F.coalesce(F.bool_and("known"), F.lit(False)).alias("known"),
    )


def q_mart_for_random_category(spark: SparkSession, folder: str) -> DataFrame:
    """The mart of a pick against the sums of all categories: rows missing and too many."""
    tables = core_layer(spark, folder).tables()
    seed = uuid.uuid4().int % (1 << 31)
    picked = random_category(tables["dim_category"], seed)
    mart = mart_for_random_category(tables, SEGMENT, YEAR, seed)
    want = mart_for_each_category(tables, SEGMENT, YEAR).join(picked, "category_name", "left_semi")
    both = mart.select("*", F.lit(1).alias("got")).unionByName(
        want.select("sub_category_title", "total_sales", F.lit(-1).alias("got"))
    )
    rows = both.groupBy("sub_category_title", "total_sales").agg(F.sum("got").alias("got"))
    zero = F.lit(0).cast("long")
    return rows.agg(
        F.coalesce(F.sum(F.greatest(-F.col("got"), zero)), zero).alias("rows_missing"),
        F.coalesce(F.sum(F.greatest(F.col("got"), zero)), zero).alias("rows_too_many"),
    )


def q_mart_for_each_category(spark: SparkSession, folder: str) -> DataFrame:
    return mart_for_each_category(core_layer(spark, folder).tables(), SEGMENT, YEAR)


# layer build and checks


def fresh_core(
    spark: SparkSession, folder: str, variant: str = "plain", strict: bool = False
) -> dict[str, DataFrame]:
    """All core tables, built now."""
    return CoreLayer(spark, folder, variant, strict).tables()


def q_build_core(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every table of a new core layer."""
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, df in fresh_core(spark, folder).items()
        if name not in GRAINS
    ]
    return reduce(DataFrame.unionByName, counts)


def q_fact_sales_build(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of a fact built anew."""
    return fresh_core(spark, folder)["fact_sales"].agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("sum_of_sale").alias("sum_of_sale"),
        F.sum("quantity").alias("quantity"),
        F.sum("profit").alias("profit"),
    )


def q_check_primary_key(spark: SparkSession, folder: str) -> DataFrame:
    """Order and product would be no primary key of the lines."""
    return primary_key_violations(order_lines(spark, folder), ["order_id", "product_id"])


def q_check_foreign_key(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of the raw lines that the core layer does not know."""
    known = core_layer(spark, folder).tables("dim_customer")["dim_customer"]
    return foreign_key_violations(
        order_lines(spark, folder), "customer_id", known, "customer_id_from_raw"
    )


def q_constraint_report(spark: SparkSession, folder: str) -> DataFrame:
    layer = core_layer(spark, folder, "shared_all")
    return constraint_report({"core_raw": layer.lines, **layer.tables()})


def q_constraint_report_broken(spark: SparkSession, folder: str) -> DataFrame:
    """The report of a layer with a category and some customers taken out, and the shipping
    modes twice."""
    layer = core_layer(spark, folder)
    tables = {"core_raw": layer.lines, **layer.tables()}
    tables["dim_category"] = tables["dim_category"].filter(F.col("category_name") != CATEGORY)
    tables["dim_customer"] = tables["dim_customer"].filter(
        ~F.col("customer_id_from_raw").endswith("7")
    )
    tables["dim_ship_mode"] = tables["dim_ship_mode"].unionAll(tables["dim_ship_mode"])
    return constraint_report(tables)


def _reconciliation(variant: str, strict: bool) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        layer = core_layer(spark, folder, variant, strict)
        return sales_reconciliation(layer.lines, layer.tables()["fact_sales"])

    return query


def _fan_out(variant: str, strict: bool = False, totals: bool = False) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        layer = core_layer(spark, folder, variant, strict)
        work = fan_out_totals if totals else fan_out_report
        return work(layer.lines, layer.tables(*NEEDS["fact_sales"]), layer.config)

    return query


QUERIES: dict[str, Query] = {
    "read_raw_csv": q_read_raw_csv,
    "read_raw_csv_breaks": q_read_raw_csv_breaks,
    "read_raw_csv_stray_quotes": q_read_raw_csv_stray_quotes,
    "raw_typed": q_raw_typed,
    "raw_dates": q_raw_dates,
    "conform": q_conform,
    "core_raw": q_core_raw,
    "write_table": q_write_table,
    "read_table": q_read_table,
    "dim_date": q_dim_date,
    "dim_ship_mode": _titles("dim_ship_mode", "mode_id"),
    "dim_segment": _titles("dim_segment", "segment_id"),
    "dim_category": _titles("dim_category", "category_id"),
    "dim_country": _titles("dim_country", "country_id"),
    **{name: _resolved(name, *how) for name, how in _DIMENSIONS.items()},
    **{
        f"{name}_shared_all": _resolved(name, *how, variant="shared_all")
        for name, how in _DIMENSIONS.items()
    },
    "product_price": q_product_price,
    "surrogate_key": q_surrogate_key,
    "fact_sales": _facts("plain"),
    "fact_sales_shared_code": _facts("shared_code"),
    "fact_sales_shared_all": _facts("shared_all"),
    "fact_sales_repeated": _facts("repeated"),
    "fact_sales_strict": _facts("shared_all", strict=True),
    "fact_sales_build": q_fact_sales_build,
    "mart_sales_by_year": _by_year("plain"),
    "mart_sales_by_year_shared_all": _by_year("shared_all"),
    "mart_sales_by_year_strict": _by_year("shared_all", strict=True),
    "mart_sub_category_sales": _by_sub_category("plain"),
    "mart_sub_category_sales_shared_all": _by_sub_category("shared_all"),
    "mart_sub_category_sales_strict": _by_sub_category("shared_all", strict=True),
    "mart_sales_by_year_grain": q_mart_sales_by_year_grain,
    "mart_sub_category_sales_grain": q_mart_sub_category_sales_grain,
    "random_category": q_random_category,
    "mart_for_random_category": q_mart_for_random_category,
    "mart_for_each_category": q_mart_for_each_category,
    "build_core": q_build_core,
    "publish_mart": q_publish_mart,
    "refresh_on_arrival": q_refresh_on_arrival,
    "refresh_on_arrival_twice": q_refresh_on_arrival_twice,
    "refresh_interrupted": q_refresh_interrupted,
    "check_primary_key": q_check_primary_key,
    "check_foreign_key": q_check_foreign_key,
    "constraint_report": q_constraint_report,
    "constraint_report_broken": q_constraint_report_broken,
    "fan_out_report": _fan_out("shared_all"),
    "fan_out_report_plain": _fan_out("plain"),
    "fan_out_report_strict": _fan_out("shared_all", strict=True),
    "fan_out_totals": _fan_out("shared_all", totals=True),
    "fan_out_totals_strict": _fan_out("shared_all", strict=True, totals=True),
    "reconciliation": _reconciliation("shared_all", strict=False),
    "reconciliation_strict": _reconciliation("shared_all", strict=True),
}

# names of the declared foreign keys, as constraint_report spells them
FOREIGN_KEY_NAMES = tuple(f"{child}.{column} in {parent}" for child, column, parent in FOREIGN_KEYS)
