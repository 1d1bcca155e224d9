"""Core tables with their surrogate keys resolved to natural ones, for comparing runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martloom.plans.dims import (
    city_path,
    region_path,
    shipment_path,
    state_path,
    sub_category_path,
)

Tables = dict[str, DataFrame]


def regions(t: Tables) -> DataFrame:
    return region_path(t["dim_region"], t["dim_country"])


def states(t: Tables) -> DataFrame:
    return state_path(t["dim_state"], regions(t))


def cities(t: Tables) -> DataFrame:
    return city_path(t["dim_city"], states(t))


def postal_codes(t: Tables) -> DataFrame:
    return t["dim_postal_code"].join(cities(t), "city_id").drop("city_id")


def sub_categories(t: Tables) -> DataFrame:
    return sub_category_path(t["dim_sub_category"], t["dim_category"])


def products(t: Tables) -> DataFrame:
    return t["dim_product"].join(sub_categories(t), "sub_category_id").drop("sub_category_id")


def customers(t: Tables) -> DataFrame:
    return t["dim_customer"].join(t["dim_segment"], "segment_id").drop("segment_id")


def orders(t: Tables) -> DataFrame:
    dates = t["dim_date"].select("date_id", F.col("date_origin").alias("order_date"))
    return t["dim_order"].join(dates, "date_id").drop("date_id")


def shipments(t: Tables) -> DataFrame:
    return shipment_path(t["dim_shipment"], t["dim_date"], t["dim_ship_mode"])


def facts(t: Tables) -> DataFrame:
    return (
        t["fact_sales"]
        .join(shipments(t), "shipment_id")
        .join(postal_codes(t), "postal_code_id")
        .join(products(t), "product_id")
        .join(customers(t), "customer_id")
        .join(orders(t), "order_id")
        .drop("shipment_id", "postal_code_id", "product_id", "customer_id", "order_id")
    )
