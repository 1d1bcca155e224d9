"""The two marts and the random choice between categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martloom.operators.sampling import random_row


def sales_grain(tables: dict[str, DataFrame]) -> DataFrame:
    """Sales by order year, customer and product: what both marts are made of.

    The order join is the only one that the whole fact takes part in. Its result is summed
    up before anything else is joined, so later joins see sums and not lines.
    """
    years = (
        tables["dim_order"].join(tables["dim_date"], "date_id").select("order_id", "year")
    )
    return (
        tables["fact_sales"]
        .select("order_id", "customer_id", "product_id", "sum_of_sale")
        .join(years, "order_id")
        .groupBy("year", "customer_id", "product_id")
        .agg(F.sum("sum_of_sale").cast("decimal(20,2)").alias("sum_of_sale"))
    )


def mart_sales_by_year(
    tables: dict[str, DataFrame], grain: DataFrame | None = None
) -> DataFrame:
    """Sales by order year and category. `grain` is a written `sales_grain`, if there is one."""
    kinds = (
        tables["dim_product"]
        .join(tables["dim_sub_category"], "sub_category_id")
        .join(tables["dim_category"], "category_id")
        .select("product_id", "category_name")
    )
    products = (
        (sales_grain(tables) if grain is None else grain)
        .groupBy("year", "product_id")
        .agg(F.sum("sum_of_sale").alias("sum_of_sale"))
    )
    return (
        products.join(kinds, "product_id")
        .groupBy("year", "category_name")
        .agg(F.sum("sum_of_sale").cast("decimal(20,2)").alias("sum_of_sale"))
        .orderBy("year", "category_name")
    )


def _sub_category_sales(
    tables: dict[str, DataFrame],
    categories: DataFrame,
    segment: str,
    year: int,
    grain: DataFrame | None,
) -> DataFrame:
    """(category_name, sub_category_title, sum_of_sale) of one segment and order year. Each
    condition thins out its dimension, or the year of the grain, before the join."""
    kinds = (
        categories.join(tables["dim_sub_category"], "category_id")
        .join(tables["dim_product"], "sub_category_id")
        .select("product_id", "category_name", "sub_category_title")
    )
    customers = (
        tables["dim_segment"]
        .filter(F.col("segment_title") == F.lit(segment))
        .join(tables["dim_customer"], "segment_id")
        .select("customer_id")
    )
    return (
        (sales_grain(tables) if grain is None else grain)
        .filter(F.col("year") == F.lit(year))
        .join(customers, "customer_id")
        .join(kinds, "product_id")
        .select("category_name", "sub_category_title", "sum_of_sale")
    )


def mart_sub_category_sales(
    tables: dict[str, DataFrame],
    segment: str,
    year: int,
    category: str,
    grain: DataFrame | None = None,
) -> DataFrame:
    """Sales by sub-category of one category for one customer segment and order year."""
    chosen = tables["dim_category"].filter(F.col("category_name") == F.lit(category))
    return (
        _sub_category_sales(tables, chosen, segment, year, grain)
        .groupBy("sub_category_title")
        .agg(F.sum("sum_of_sale").cast("decimal(20,2)").alias("total_sales"))
        .orderBy("sub_category_title")
    )


def mart_for_each_category(
    tables: dict[str, DataFrame], segment: str, year: int, grain: DataFrame | None = None
) -> DataFrame:
    """The sub-category marts of all categories in one table."""
    return (
        _sub_category_sales(tables, tables["dim_category"], segment, year, grain)
        .groupBy("category_name", "sub_category_title")
        .agg(F.sum("sum_of_sale").cast("decimal(20,2)").alias("total_sales"))
    )


def random_category(dim_category: DataFrame, seed: int | None = None) -> DataFrame:
    """The name of one category, each as likely as any other."""
    return random_row(dim_category.select("category_name"), seed)


def known_category(dim_category: DataFrame, category: str) -> str:
    """The category itself if the core layer has it."""
    if dim_category.filter(F.col("category_name") == F.lit(category)).isEmpty():
        raise ValueError(f"no category is called {category!r}")
    return category


def mart_for_random_category(
    tables: dict[str, DataFrame],
    segment: str,
    year: int,
    seed: int | None = None,
    grain: DataFrame | None = None,
) -> DataFrame:
    """The sub-category mart of a random category. One name comes to the driver."""
    picked = random_category(tables["dim_category"], seed).collect()
    if not picked or picked[0]["category_name"] is None:
        raise ValueError("there is no category to choose from")
    return mart_sub_category_sales(tables, segment, year, picked[0]["category_name"], grain)
