from __future__ import annotations

import pathlib
import sys
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

ROOT = pathlib.Path(__file__).resolve().parent.parent
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

from martloom.config import MartConfig  # noqa: E402
from martloom.plans.core import build_core  # noqa: E402
from martloom.schemas import columns_of  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(base / "shared"))
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


LINE = {
    "row_id": 1,
    "order_id": "O-1",
    "order_date": date(2015, 1, 5),
    "ship_date": date(2015, 1, 9),
    "ship_mode": "Standard",
    "customer_id": "C-1",
    "customer_name": "Ann",
    "segment": "Corporate",
    "country": "US",
    "city": "Troy",
    "state": "NY",
    "postal_code": 100,
    "region": "East",
    "product_id": "P-1",
    "category": "Furniture",
    "sub_category": "Chairs",
    "product_name": "Chair",
    "sales": Decimal("20.00"),
    "quantity": 2,
    "discount": Decimal("0.00"),
    "profit": Decimal("1.0000"),
}


@pytest.fixture(scope="session")
def make_lines(spark):
    """Typed order lines: each argument overrides some columns of one line."""
    ddl = ", ".join(
        f"{name} {'STRING' if kind.startswith('VARCHAR') else kind}"
        for name, kind in columns_of("order_lines")
    )

    def make(*overrides: dict):
        rows = [{**LINE, "row_id": i + 1, **o} for i, o in enumerate(overrides)]
        names = [name for name, _ in columns_of("order_lines")]
        return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ddl)

    return make


@pytest.fixture(scope="session")
def build(spark):
    """Core tables of some lines, written to a new staging folder."""
    from martloom.functions.conform import conform
    from martloom.plans.core import GRAINS
    from martloom.sources.staging import Staging

    def run(lines, strict=False, only=None, buckets=16):
        staging = Staging(spark)

        def save(name, df):
            return staging.save(name, df if name in GRAINS else conform(df, name))

        raw = staging.save("core_raw", lines)
        config = MartConfig(strict_keys=strict, key_buckets=buckets)
        return build_core(raw, config, save, only)

    return run
