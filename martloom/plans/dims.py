"""The fourteen dimensions.

Each is made from distinct natural keys and only then meets its parent, so joins see one
row per key and not one per order line. Five distinct tables ("grains") stand between the
lines and the dimensions, so the lines are read once for each of them, and once for the fact.

A parent is looked up by its title alone, which finds several rows when a title stands
for several parents; strict keys look it up by the whole path instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martloom.config import MartConfig
from martloom.functions.dates import calendar_parts
from martloom.functions.money import list_price, mean_price
from martloom.operators.keys import ordered_key, surrogate_key

# grains


def shipping_grain(core_raw: DataFrame) -> DataFrame:
    return core_raw.select("ship_date", "ship_mode").distinct()


def order_grain(core_raw: DataFrame) -> DataFrame:
    return core_raw.select("order_id", "order_date").distinct()


def customer_grain(core_raw: DataFrame) -> DataFrame:
    return core_raw.select("customer_id", "customer_name", "segment").distinct()


def place_grain(core_raw: DataFrame) -> DataFrame:
    return core_raw.select("country", "region", "state", "city", "postal_code").distinct()


def product_grain(core_raw: DataFrame) -> DataFrame:
    """Distinct products and categories with the sum and count of their list prices."""
    price = list_price(F.col("sales"), F.col("discount"), F.col("quantity"))
    return core_raw.groupBy("product_id", "product_name", "category", "sub_category").agg(
        F.sum(price).alias("price_sum"), F.count(price).alias("price_count")
    )


def product_price(products: DataFrame) -> DataFrame:
    """Mean list price of a product id and name over all its lines."""
    return products.groupBy("product_id", "product_name").agg(
        mean_price(F.sum("price_sum"), F.sum("price_count")).cast("decimal(13,2)").alias("price")
    )


# natural paths of the dimensions that have parents


def region_path(dim_region: DataFrame, dim_country: DataFrame) -> DataFrame:
    return dim_region.join(dim_country, "country_id").select(
        "region_id",
        F.col("region_title").alias("region"),
        F.col("country_title").alias("country"),
    )


def state_path(dim_state: DataFrame, regions: DataFrame) -> DataFrame:
    return dim_state.join(regions, "region_id").select(
        "state_id", F.col("state_title").alias("state"), "region", "country"
    )


def city_path(dim_city: DataFrame, states: DataFrame) -> DataFrame:
    return dim_city.join(states, "state_id").select(
        "city_id", F.col("city_title").alias("city"), "state", "region", "country"
    )


def sub_category_path(dim_sub_category: DataFrame, dim_category: DataFrame) -> DataFrame:
    return dim_sub_category.join(dim_category, "category_id").select(
        "sub_category_id",
        F.col("sub_category_title").alias("sub_category"),
        F.col("category_name").alias("category"),
    )


def shipment_path(
    dim_shipment: DataFrame, dim_date: DataFrame, dim_ship_mode: DataFrame
) -> DataFrame:
    return (
        dim_shipment.join(dim_date, "date_id")
        .join(dim_ship_mode, "mode_id")
        .select(
            "shipment_id",
            F.col("date_origin").alias("ship_date"),
            F.col("mode_title").alias("ship_mode"),
        )
    )


# dimensions


def dim_date(orders: DataFrame, shipping: DataFrame) -> DataFrame:
    """Union of order and ship dates with their calendar columns, numbered in date order."""
    days = (
        orders.select(F.col("order_date").alias("date_origin"))
        .unionByName(shipping.select(F.col("ship_date").alias("date_origin")))
        .distinct()
    )
    return ordered_key(
        days.withColumns(calendar_parts(F.col("date_origin"))), "date_id", ["date_origin"]
    )


def dim_order(orders: DataFrame, dates: DataFrame, config: MartConfig) -> DataFrame:
    days = dates.select("date_id", F.col("date_origin").alias("order_date"))
    dated = orders.join(days, "order_date").select(
        F.col("order_id").alias("order_id_from_raw"), "date_id"
    )
    return surrogate_key(dated, "order_id", ["order_id_from_raw", "date_id"], config.key_buckets)


def dim_ship_mode(shipping: DataFrame, config: MartConfig) -> DataFrame:
    modes = shipping.select(F.col("ship_mode").alias("mode_title")).distinct()
    return surrogate_key(modes, "mode_id", ["mode_title"], config.key_buckets)


def dim_shipment(
    shipping: DataFrame, dates: DataFrame, modes: DataFrame, config: MartConfig
) -> DataFrame:
    shipments = (
        shipping.join(dates.select("date_id", F.col("date_origin").alias("ship_date")), "ship_date")
        .join(modes.withColumnRenamed("mode_title", "ship_mode"), "ship_mode")
        .select("date_id", "mode_id")
    )
    return surrogate_key(shipments, "shipment_id", ["date_id", "mode_id"], config.key_buckets)


def dim_segment(customers: DataFrame, config: MartConfig) -> DataFrame:
    segments = customers.select(F.col("segment").alias("segment_title")).distinct()
    return surrogate_key(segments, "segment_id", ["segment_title"], config.key_buckets)


def dim_customer(customers: DataFrame, segments: DataFrame, config: MartConfig) -> DataFrame:
    rows = customers.join(
        segments.withColumnRenamed("segment_title", "segment"), "segment"
    ).select(F.col("customer_id").alias("customer_id_from_raw"), "customer_name", "segment_id")
    return surrogate_key(
        rows,
        "customer_id",
        ["customer_id_from_raw", "customer_name", "segment_id"],
        config.key_buckets,
    )


def dim_category(products: DataFrame, config: MartConfig) -> DataFrame:
    categories = products.select(F.col("category").alias("category_name")).distinct()
    return surrogate_key(categories, "category_id", ["category_name"], config.key_buckets)


def dim_sub_category(products: DataFrame, categories: DataFrame, config: MartConfig) -> DataFrame:
    subs = (
        products.select("sub_category", "category")
        .distinct()
        .join(categories.withColumnRenamed("category_name", "category"), "category")
        .select(F.col("sub_category").alias("sub_category_title"), "category_id")
    )
    return surrogate_key(
        subs, "sub_category_id", ["sub_category_title", "category_id"], config.key_buckets
    )


def dim_product(products: DataFrame, sub_categories: DataFrame, config: MartConfig) -> DataFrame:
    """Products with their mean list price; `sub_categories` is a sub_category_path."""
    kind = ["sub_category", "category"] if config.strict_keys else ["sub_category"]
    rows = (
        products.select("product_id", "product_name", *kind)
        .distinct()
        .join(sub_categories.select("sub_category_id", *kind), kind)
        .join(product_price(products), ["product_id", "product_name"])
        .select(
            F.col("product_id").alias("product_id_from_raw"),
            "product_name",
            F.col("price").cast("decimal(8,2)").alias("price"),
            "sub_category_id",
        )
    )
    return surrogate_key(
        rows,
        "product_id",
        ["product_id_from_raw", "product_name", "sub_category_id"],
        config.key_buckets,
    )


def dim_country(places: DataFrame, config: MartConfig) -> DataFrame:
    countries = places.select(F.col("country").alias("country_title")).distinct()
    return surrogate_key(countries, "country_id", ["country_title"], config.key_buckets)


def dim_region(places: DataFrame, countries: DataFrame, config: MartConfig) -> DataFrame:
    regions = (
        places.select("region", "country")
        .distinct()
        .join(countries.withColumnRenamed("country_title", "country"), "country")
        .select(F.col("region").alias("region_title"), "country_id")
    )
    return surrogate_key(regions, "region_id", ["region_title", "country_id"], config.key_buckets)


def dim_state(places: DataFrame, regions: DataFrame, config: MartConfig) -> DataFrame:
    """`regions` is a region_path."""
    found_by = ["region", "country"] if config.strict_keys else ["region"]
    states = (
        places.select("state", *found_by)
        .distinct()
        .join(regions.select("region_id", *found_by), found_by)
        .select(F.col("state").alias("state_title"), "region_id")
    )
    return surrogate_key(states, "state_id", ["state_title", "region_id"], config.key_buckets)


def dim_city(places: DataFrame, states: DataFrame, config: MartConfig) -> DataFrame:
    """`states` is a state_path."""
    found_by = ["state", "region", "country"] if config.strict_keys else ["state"]
    cities = (
        places.select("city", *found_by)
        .distinct()
        .join(states.select("state_id", *found_by), found_by)
        .select(F.col("city").alias("city_title"), "state_id")
    )
    return surrogate_key(cities, "city_id", ["city_title", "state_id"], config.key_buckets)


def dim_postal_code(places: DataFrame, cities: DataFrame, config: MartConfig) -> DataFrame:
    """`cities` is a city_path. City and state titles together find a city."""
    found_by = ["city", "state"]
    if config.strict_keys:
        found_by += ["region", "country"]
    codes = (
        places.select("postal_code", *found_by)
        .distinct()
        .join(cities.select("city_id", *found_by), found_by)
        .select("postal_code", "city_id")
    )
    return surrogate_key(codes, "postal_code_id", ["postal_code", "city_id"], config.key_buckets)
