"""A full refresh: file to raw, raw to core, core to marts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from martloom.operators.checks import require_foreign_keys, require_primary_key
from martloom.plans.core import GRAINS, NEEDS, build_core
from martloom.plans.fan_out import require_no_fan_out
from martloom.plans.marts import (
    known_category,
    mart_for_random_category,
    mart_sales_by_year,
    mart_sub_category_sales,
    sales_grain,
)
from martloom.plans.raw import core_raw, raw_dates, raw_typed
from martloom.schemas import PRIMARY_KEYS
from martloom.sources.order_lines_csv import read_raw_csv
from martloom.sources.staging import Staging, shuffles_freed
from martloom.sources.tables import Warehouse


def load_raw(warehouse: Warehouse, path: str, pattern: str = "*") -> DataFrame:
    """Parse, type and date the file in one pass and write it. Row ids come from the user,
    so their key is checked, on that one column of the written table."""
    with Staging(warehouse.spark) as staging:
        text = read_raw_csv(warehouse.spark, path, pattern, staging)
        dated = raw_dates(raw_typed(text, warehouse.config.key_type))
        return warehouse.stage("order_lines", dated, check_key=True, conformed=True)


def load_core(
    warehouse: Warehouse, raw: DataFrame, verify: bool = False, allow_fan_out: bool = True
) -> dict[str, DataFrame]:
    """Copy one segment to the core layer and build its tables.

    Surrogate keys are unique and foreign keys come from their parents, both by
    construction; `verify` checks every declared key all the same. Unless `allow_fan_out`, the
    fact is not built if a join would repeat or lose lines.
    """
    lines = warehouse.stage(
        "core_raw", core_raw(raw, warehouse.config.segment), conformed=True
    )
    known = None
    if not allow_fan_out:
        known = build_core(lines, warehouse.config, warehouse.save, set(NEEDS["fact_sales"]))
        require_no_fan_out(lines, known, warehouse.config)
    tables = build_core(lines, warehouse.config, warehouse.save, have=known)
    core = {name: df for name, df in tables.items() if name not in GRAINS}
    if verify:
        for table in PRIMARY_KEYS.keys() & core.keys():
            require_primary_key(core[table], table)
        require_foreign_keys(core)
    return {"core_raw": lines, **core}


def publish_mart(warehouse: Warehouse, table: str, rows: DataFrame) -> None:
    """Replace a mart by the result of a core query."""
    warehouse.stage(table, rows)
    warehouse.publish(table)


def refresh(
    warehouse: Warehouse,
    path: str,
    pattern: str = "*",
    category: str | None = None,
    seed: int | None = None,
    verify: bool = False,
    allow_fan_out: bool = True,
    statistics: bool = True,
) -> None:
    """Reload everything from a file. Without a category the second mart takes a random
    one. Nothing is published before the last table is written, so a failed load leaves all
    layers as they were. All tables are then published as one load; one that a dead driver left
    half published is brought to its end first. `statistics` keeps row counts for later readers."""
    config = warehouse.config
    warehouse.discard()
    warehouse.recover()
    with shuffles_freed(warehouse.spark), Staging(warehouse.spark) as staging:
        tables = load_core(warehouse, load_raw(warehouse, path, pattern), verify, allow_fan_out)
        grain = staging.save("sales_grain", sales_grain(tables), by="year")
        warehouse.stage("mart_sales_by_year", mart_sales_by_year(tables, grain))
        if category is None:
            second = mart_for_random_category(tables, config.segment, config.year, seed, grain)
        else:
            known_category(tables["dim_category"], category)
            second = mart_sub_category_sales(
                tables, config.segment, config.year, category, grain
            )
        warehouse.stage("mart_sub_category_sales", second)
    warehouse.publish()
    if statistics:
        warehouse.analyze()
