"""The sales fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martloom.config import MartConfig
from martloom.functions.money import effective_discount
from martloom.operators.join_size import fits_broadcast
from martloom.plans.dims import (
    city_path,
    region_path,
    shipment_path,
    state_path,
    sub_category_path,
)

_LINE_KEYS = [
    "order_id",
    "ship_date",
    "ship_mode",
    "customer_id",
    "postal_code",
    "product_id",
    "product_name",
]
_STRICT_KEYS = [
    "order_date",
    "customer_name",
    "segment",
    "city",
    "state",
    "region",
    "country",
    "sub_category",
    "category",
]


# Whole natural keys, parents first: dimension, its columns that the lines get, its key, each
# under the name that the lines have for it.
_STRICT_STEPS: list[tuple[str, dict[str, str], dict[str, str]]] = [
    ("dim_date", {"date_id": "ship_date_id"}, {"date_origin": "ship_date"}),
    ("dim_ship_mode", {"mode_id": "mode_id"}, {"mode_title": "ship_mode"}),
    ("dim_shipment", {"shipment_id": "shipment_id"}, {"date_id": "ship_date_id", "mode_id": "mode_id"}),
    ("dim_country", {"country_id": "country_id"}, {"country_title": "country"}),
    ("dim_region", {"region_id": "region_id"}, {"region_title": "region", "country_id": "country_id"}),
    ("dim_state", {"state_id": "state_id"}, {"state_title": "state", "region_id": "region_id"}),
    ("dim_city", {"city_id": "city_id"}, {"city_title": "city", "state_id": "state_id"}),
    (
        "dim_postal_code",
        {"postal_code_id": "postal_code_id"},
        {"postal_code": "postal_code", "city_id": "city_id"},
    ),
    ("dim_category", {"category_id": "category_id"}, {"category_name": "category"}),
    (
        "dim_sub_category",
        {"sub_category_id": "sub_category_id"},
        {"sub_category_title": "sub_category", "category_id": "category_id"},
    ),
    (
        "dim_product",
        {"product_id": "product_id", "price": "price"},
        {
            "product_id_from_raw": "product_id_from_raw",
            "product_name": "product_name",
            "sub_category_id": "sub_category_id",
        },
    ),
    ("dim_segment", {"segment_id": "segment_id"}, {"segment_title": "segment"}),
    (
        "dim_customer",
        {"customer_id": "customer_id"},
        {
            "customer_id_from_raw": "customer_id_from_raw",
            "customer_name": "customer_name",
            "segment_id": "segment_id",
        },
    ),
    ("dim_date", {"date_id": "order_date_id"}, {"date_origin": "order_date"}),
    (
        "dim_order",
        {"order_id": "order_id"},
        {"order_id_from_raw": "order_id_from_raw", "date_id": "order_date_id"},
    ),
]

_SUMS = {"sum_of_sale": "sales", "quantity": "quantity", "profit": "profit"}

# core_raw columns under the names that dimensions have for them
_RENAMED = {
    "order_id": "order_id_from_raw",
    "customer_id": "customer_id_from_raw",
    "product_id": "product_id_from_raw",
}


def fact_parents(
    tables: dict[str, DataFrame], config: MartConfig
) -> dict[str, tuple[DataFrame, list[str]]]:
    """What the lines of the fact are joined to, in this order: (dimension with its natural key,
    columns of the key)."""
    strict = config.strict_keys
    shipments = shipment_path(tables["dim_shipment"], tables["dim_date"], tables["dim_ship_mode"])
    codes = tables["dim_postal_code"]
    products = tables["dim_product"]
    customers = tables["dim_customer"]
    orders = tables["dim_order"]
    code_key, product_key = ["postal_code"], ["product_id_from_raw", "product_name"]
    customer_key, order_key = ["customer_id_from_raw"], ["order_id_from_raw"]
    if strict:
        regions = region_path(tables["dim_region"], tables["dim_country"])
        cities = city_path(tables["dim_city"], state_path(tables["dim_state"], regions))
        codes = codes.join(cities, "city_id")
        code_key += ["city", "state", "region", "country"]
        products = products.join(
            sub_category_path(tables["dim_sub_category"], tables["dim_category"]),
            "sub_category_id",
        )
        product_key += ["sub_category", "category"]
        customers = customers.join(tables["dim_segment"], "segment_id").withColumnRenamed(
            "segment_title", "segment"
        )
        customer_key += ["customer_name", "segment"]
        orders = orders.join(
            tables["dim_date"].select("date_id", F.col("date_origin").alias("order_date")),
            "date_id",
        )
        order_key += ["order_date"]
    return {
        "dim_shipment": (shipments, ["ship_date", "ship_mode"]),
        "dim_postal_code": (codes.select("postal_code_id", *code_key), code_key),
        "dim_product": (products.select("product_id", "price", *product_key), product_key),
        "dim_customer": (customers.select("customer_id", *customer_key), customer_key),
        "dim_order": (orders.select("order_id", *order_key), order_key),
    }


def summed_lines(core_raw: DataFrame, config: MartConfig) -> DataFrame:
    """Lines summed per natural key of the fact, under the names of the dimensions."""
    keys = _LINE_KEYS + (_STRICT_KEYS if config.strict_keys else [])
    return core_raw.groupBy(*keys).agg(*_sums()).withColumnsRenamed(_RENAMED)


def _sums() -> list[Column]:
    return [F.sum(column).alias(name) for name, column in _SUMS.items()]


def lines_with_keys(core_raw: DataFrame) -> DataFrame:
    """Lines under the names of the dimensions, none summed."""
    return core_raw.withColumnsRenamed(_RENAMED)


def summed_by_ids(core_raw: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Lines with ids for their whole natural keys, and the price of their product, summed per id.

    The written dimensions are dictionaries: each takes the place of its texts by its id, a
    parent before its children, which then are found by that id. Where Spark will broadcast a
    dimension, by its size, that happens before the lines are summed, so that they are
    shuffled by numbers. A larger dimension, joined with parents of it that are too large
    themselves, meets the sums: no line is shuffled to meet a dimension. A whole key is one row
    of its dimension, so neither order changes the rows.
    """
    lines = core_raw.select(
        *_LINE_KEYS, *_STRICT_KEYS, *[F.col(c) for c in _SUMS.values()]
    ).withColumnsRenamed(_RENAMED)
    later: dict[str, tuple[DataFrame, list[str]]] = {}  # by the id that the lines get
    for table, gained, key in _STRICT_STEPS:
        named = [F.col(c).alias(name) for c, name in {**gained, **key}.items()]
        dictionary, found_by = tables[table].select(*named), list(key.values())
        if set(found_by) <= set(lines.columns) and fits_broadcast(dictionary):
            lines = lines.join(dictionary, found_by).drop(*found_by)
            continue
        for parent in [c for c in found_by if c in later]:
            above, path = later.pop(parent)
            dictionary = dictionary.join(above, parent).drop(parent)
            found_by = [c for c in found_by if c != parent] + path
        later[next(iter(gained.values()))] = dictionary, found_by
    keys = [c for c in lines.columns if c not in _SUMS.values()]
    summed = lines.groupBy(*keys).agg(*_sums())
    for dictionary, found_by in later.values():
        summed = summed.join(dictionary, found_by).drop(*found_by)
    return summed


def fact_sales(
    core_raw: DataFrame, tables: dict[str, DataFrame], config: MartConfig
) -> DataFrame:
    """Sales, quantity, effective discount and profit per order, shipment, customer,
    postal code and product.

    Lines are summed per natural key before any join. A surrogate key stands for one
    natural key, so each sum ends in its own fact rows: a second aggregation is not
    needed, and where an incomplete key finds several dimension rows the whole group is
    repeated, as every one of its lines would be. A group that holds much of the data
    shrinks to one row before the first shuffle. List value is price times quantity, and a
    product has one price, so it too comes from the summed quantity.

    The joins are left to Spark: written dimensions have sizes, small ones are broadcast,
    big ones are merged with skewed keys split at run time. With strict keys, ids of small
    dimensions take the place of texts before the sum (`summed_by_ids`).
    """
    if config.strict_keys:
        keyed = summed_by_ids(core_raw, tables)
    else:
        keyed = summed_lines(core_raw, config)
        for parent, key in fact_parents(tables, config).values():
            keyed = keyed.join(parent, key)
    return keyed.select(
        "order_id",
        "shipment_id",
        "customer_id",
        "postal_code_id",
        "product_id",
        F.col("sum_of_sale").cast("decimal(10,2)").alias("sum_of_sale"),
        F.col("quantity").cast("int").alias("quantity"),
        effective_discount(F.col("price") * F.col("quantity"), F.col("sum_of_sale"))
        .cast("decimal(2,2)")
        .alias("discount"),
        F.col("profit").cast("decimal(10,4)").alias("profit"),
    )
