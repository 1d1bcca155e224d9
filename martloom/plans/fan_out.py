"""Where an incomplete key finds several parents, and what that adds to the fact.

A title or code that stands for several parents repeats every line that uses it. The report says
so from the counts of keys, without running the joins; the totals say what the fact will add up to.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from martloom.config import MartConfig
from martloom.operators.checks import ConstraintError
from martloom.operators.join_size import join_size, key_counts
from martloom.plans.dims import city_path, region_path, state_path, sub_category_path
from martloom.plans.fact import fact_parents, lines_with_keys, summed_lines

Join = tuple[str, DataFrame, DataFrame, list[str]]


def _dimension_joins(core_raw: DataFrame, tables: dict[str, DataFrame], config: MartConfig) -> list[Join]:
    """(name, distinct children, parents, key) of the dimensions that find a parent by its title."""
    strict = config.strict_keys
    regions = region_path(tables["dim_region"], tables["dim_country"])
    states = state_path(tables["dim_state"], regions)
    cities = city_path(tables["dim_city"], states)
    kinds = sub_category_path(tables["dim_sub_category"], tables["dim_category"])

    def join(child: str, own: list[str], parent: str, parents: DataFrame, title: list[str], rest: list[str]) -> Join:
        key = title + (rest if strict else [])
        return f"{child} to {parent}", core_raw.select(*own, *key).distinct(), parents, key

    return [
        join("dim_product", ["product_id", "product_name"], "dim_sub_category", kinds, ["sub_category"], ["category"]),
        join("dim_state", ["state"], "dim_region", regions, ["region"], ["country"]),
        join("dim_city", ["city"], "dim_state", states, ["state"], ["region", "country"]),
        join("dim_postal_code", ["postal_code"], "dim_city", cities, ["city", "state"], ["region", "country"]),
    ]


def fan_out_report(core_raw: DataFrame, tables: dict[str, DataFrame], config: MartConfig) -> DataFrame:
    """One row per join of the core layer that looks a parent up by its natural key: join_name and
    the columns of `join_size`. Joins on whole keys repeat nothing; others may."""
    lines = lines_with_keys(core_raw)
    joins = _dimension_joins(core_raw, tables, config) + [
        (f"fact_sales to {name}", lines, parent, key)
        for name, (parent, key) in fact_parents(tables, config).items()
    ]
    return reduce(
        DataFrame.unionByName,
        [join_size(child, parent, key, F.lit(name).alias("join_name")) for name, child, parent, key in joins],
    )


def fan_out_totals(core_raw: DataFrame, tables: dict[str, DataFrame], config: MartConfig) -> DataFrame:
    """Totals of the lines and of the fact that will be made of them, in the columns of
    `sales_reconciliation`, before there is a fact: each group of lines counts once for every
    combination of its parents."""
    lines = summed_lines(core_raw, config)
    times = F.lit(1).cast("decimal(38,0)")
    for name, (parent, key) in fact_parents(tables, config).items():
        lines = lines.join(key_counts(parent, key, f"_{name}"), key, "left")
        times = times * F.coalesce(F.col(f"_{name}"), F.lit(0)).cast("decimal(10,0)")
    lines = lines.withColumn("_times", times.cast("decimal(18,0)"))
    return lines.agg(
        F.sum("sum_of_sale").cast("decimal(38,2)").alias("line_sales"),
        F.sum("quantity").alias("line_quantity"),
        F.sum(F.when(F.col("_times") > 0, F.col("sum_of_sale").cast("decimal(18,2)") * F.col("_times")))
        .cast("decimal(38,2)")
        .alias("fact_sales"),
        F.sum(F.when(F.col("_times") > 0, F.col("quantity") * F.col("_times"))).cast("long").alias("fact_quantity"),
    )


def require_no_fan_out(core_raw: DataFrame, tables: dict[str, DataFrame], config: MartConfig) -> None:
    """Raise if a join of the core layer repeats or loses rows. At most one row per join comes to
    the driver."""
    bad = (
        fan_out_report(core_raw, tables, config)
        .filter(F.col("joined_rows") != F.col("child_rows"))
        .orderBy("join_name")
        .collect()
    )
    if bad:
        found = "; ".join(f"{r['join_name']}: {r['joined_rows']} rows of {r['child_rows']}" for r in bad)
        raise ConstraintError(f"joins do not find one parent for each row: {found}")
