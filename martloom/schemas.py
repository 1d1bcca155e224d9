"""Declared tables of the raw, core and mart layers."""

from __future__ import annotations

from pyspark.sql import types as T

# Type token replaced by MartConfig.key_type.
KEY = "KEY"

# Headers of the order-line file, our column names, declared types.
ORDER_LINE_COLUMNS = (
    ("Row ID", "row_id", KEY),
    ("Order ID", "order_id", "VARCHAR(20)"),
    ("Order Date", "order_date", "VARCHAR(10)"),
    ("Ship Date", "ship_date", "VARCHAR(10)"),
    ("Ship Mode", "ship_mode", "VARCHAR(100)"),
    ("Customer ID", "customer_id", "VARCHAR(20)"),
    ("Customer Name", "customer_name", "VARCHAR(100)"),
    ("Segment", "segment", "VARCHAR(20)"),
    ("Country", "country", "VARCHAR(30)"),
    ("City", "city", "VARCHAR(30)"),
    ("State", "state", "VARCHAR(30)"),
    ("Postal Code", "postal_code", "INT"),
    ("Region", "region", "VARCHAR(20)"),
    ("Product ID", "product_id", "VARCHAR(20)"),
    ("Category", "category", "VARCHAR(40)"),
    ("Sub-Category", "sub_category", "VARCHAR(40)"),
    ("Product Name", "product_name", "VARCHAR(200)"),
    ("Sales", "sales", "DECIMAL(10,2)"),
    ("Quantity", "quantity", "INT"),
    ("Discount", "discount", "DECIMAL(2,2)"),
    ("Profit", "profit", "DECIMAL(10,4)"),
)
DATE_COLUMNS = ("order_date", "ship_date")

# The names of the three layers.
RAW = "raw_store"
CORE = "core_store"
MART = "mart_store"

_RAW_TEXT = tuple((name, kind) for _, name, kind in ORDER_LINE_COLUMNS)
_RAW_DATED = tuple(
    (name, "DATE" if name in DATE_COLUMNS else kind) for name, kind in _RAW_TEXT
)

# The file after typing, with both dates still text: a step, not a stored table.
ORDER_LINES_TEXT = "order_lines_text"

# Column names, lengths and scales of every table, parents first.
TABLES: dict[str, dict[str, tuple[tuple[str, str], ...]]] = {
    RAW: {"order_lines": _RAW_DATED},
    CORE: {
        "core_raw": _RAW_DATED,
        "dim_date": (
            ("date_id", KEY),
            ("date_origin", "DATE"),
            ("day", "INT"),
            ("month", "INT"),
            ("year", "INT"),
            ("quarter", "INT"),
            ("day_of_week", "VARCHAR(15)"),
            ("week", "INT"),
        ),
        "dim_order": (
            ("order_id", KEY),
            ("order_id_from_raw", "VARCHAR(20)"),
            ("date_id", KEY),
        ),
        "dim_ship_mode": (("mode_id", KEY), ("mode_title", "VARCHAR(100)")),
        "dim_shipment": (("shipment_id", KEY), ("date_id", KEY), ("mode_id", KEY)),
        "dim_segment": (("segment_id", KEY), ("segment_title", "VARCHAR(20)")),
        "dim_customer": (
            ("customer_id", KEY),
            ("customer_id_from_raw", "VARCHAR(20)"),
            ("customer_name", "VARCHAR(100)"),
            ("segment_id", KEY),
        ),
        "dim_category": (("category_id", KEY), ("category_name", "VARCHAR(30)")),
        "dim_sub_category": (
            ("sub_category_id", KEY),
            ("sub_category_title", "VARCHAR(40)"),
            ("category_id", KEY),
        ),
        "dim_product": (
            ("product_id", KEY),
            ("product_id_from_raw", "VARCHAR(20)"),
            ("product_name", "VARCHAR(150)"),
            ("price", "DECIMAL(8,2)"),
            ("sub_category_id", KEY),
        ),
        "dim_country": (("country_id", KEY), ("country_title", "VARCHAR(30)")),
        "dim_region": (
            ("region_id", KEY),
            ("region_title", "VARCHAR(20)"),
            ("country_id", KEY),
        ),
        "dim_state": (
            ("state_id", KEY),
            ("state_title", "VARCHAR(30)"),
            ("region_id", KEY),
        ),
        "dim_city": (
            ("city_id", KEY),
            ("city_title", "VARCHAR(30)"),
            ("state_id", KEY),
        ),
        "dim_postal_code": (
            ("postal_code_id", KEY),
            ("postal_code", "INT"),
            ("city_id", KEY),
        ),
        "fact_sales": (
            ("order_id", KEY),
            ("shipment_id", KEY),
            ("customer_id", KEY),
            ("postal_code_id", KEY),
            ("product_id", KEY),
            ("sum_of_sale", "DECIMAL(10,2)"),
            ("quantity", "INT"),
            ("discount", "DECIMAL(2,2)"),
            ("profit", "DECIMAL(10,4)"),
        ),
    },
    MART: {
        "mart_sales_by_year": (
            ("year", "INT"),
            ("category_name", "VARCHAR(20)"),
            ("sum_of_sale", "DECIMAL(20,2)"),
        ),
        "mart_sub_category_sales": (
            ("sub_category_title", "VARCHAR(30)"),
            ("total_sales", "DECIMAL(20,2)"),
        ),
    },
}

# Primary keys.
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "order_lines": ("row_id",),
    "core_raw": ("row_id",),
    "dim_date": ("date_id",),
    "dim_order": ("order_id",),
    "dim_ship_mode": ("mode_id",),
    "dim_shipment": ("shipment_id",),
    "dim_segment": ("segment_id",),
    "dim_customer": ("customer_id",),
    "dim_category": ("category_id",),
    "dim_sub_category": ("sub_category_id",),
    "dim_product": ("product_id",),
    "dim_country": ("country_id",),
    "dim_region": ("region_id",),
    "dim_state": ("state_id",),
    "dim_city": ("city_id",),
    "dim_postal_code": ("postal_code_id",),
    "fact_sales": (
        "order_id",
        "shipment_id",
        "customer_id",
        "postal_code_id",
        "product_id",
    ),
}

# Fixed values: (child table, foreign key, parent table); parents use the same name.
FOREIGN_KEYS = (
    ("dim_order", "date_id", "dim_date"),
    ("dim_shipment", "date_id", "dim_date"),
    ("dim_shipment", "mode_id", "dim_ship_mode"),
    ("dim_customer", "segment_id", "dim_segment"),
    ("dim_sub_category", "category_id", "dim_category"),
    ("dim_product", "sub_category_id", "dim_sub_category"),
    ("dim_region", "country_id", "dim_country"),
    ("dim_state", "region_id", "dim_region"),
    ("dim_city", "state_id", "dim_state"),
    ("dim_postal_code", "city_id", "dim_city"),
    ("fact_sales", "order_id", "dim_order"),
    ("fact_sales", "shipment_id", "dim_shipment"),
    ("fact_sales", "customer_id", "dim_customer"),
    ("fact_sales", "postal_code_id", "dim_postal_code"),
    ("fact_sales", "product_id", "dim_product"),
)

# Key columns of the dimensions and the fact: what tables of the core layer are joined on.
KEY_COLUMNS = {
    table: tuple(dict.fromkeys([*key, *(c for child, c, _ in FOREIGN_KEYS if child == table)]))
    for table, key in PRIMARY_KEYS.items()
    if table not in ("order_lines", "core_raw")
}


def columns_of(table: str, key_type: str = "BIGINT") -> tuple[tuple[str, str], ...]:
    """(name, SQL type) of each column of a declared table, in table order."""
    for tables in ({ORDER_LINES_TEXT: _RAW_TEXT}, *TABLES.values()):
        if table in tables:
            return tuple(
                (name, key_type if kind == KEY else kind) for name, kind in tables[table]
            )
    raise KeyError(f"no table is declared as {table}")


def struct_of(table: str, key_type: str = "BIGINT") -> T.StructType:
    """Schema of the stored files: lengths are checked before writing, so text is STRING."""
    fields = []
    for name, kind in columns_of(table, key_type):
        data_type = T.StringType() if kind.startswith("VARCHAR") else T.DataType.fromDDL(kind)
        fields.append(T.StructField(name, data_type))
    return T.StructType(fields)


# Tables that are joined on an order, written in buckets of it.
BUCKETED = {"dim_order": "order_id", "fact_sales": "order_id"}


def create_table_sql(
    database: str, table: str, location: str, key_type: str, buckets: str = ""
) -> str:
    """`buckets` is the clause of a table that is written in buckets."""
    body = ", ".join(f"`{name}` {kind}" for name, kind in columns_of(table, key_type))
    return (
        f"CREATE TABLE IF NOT EXISTS `{database}`.`{table}` ({body}) "
        f"USING parquet {buckets} LOCATION '{location}'"
    )
