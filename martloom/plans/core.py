"""The core layer in dependency order."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import CancelledError, Future, ThreadPoolExecutor
from threading import Event

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from martloom.config import MartConfig
from martloom.plans import dims
from martloom.plans.fact import fact_sales

GRAINS = ("shipping_grain", "order_grain", "customer_grain", "place_grain", "product_grain")

# What each table reads; the grains and the fact read core_raw, too. Every table stands after those it reads.
NEEDS: dict[str, tuple[str, ...]] = {
    "shipping_grain": (),
    "order_grain": (),
    "customer_grain": (),
    "place_grain": (),
    "product_grain": (),
    "dim_date": ("order_grain", "shipping_grain"),
    "dim_order": ("order_grain", "dim_date"),
    "dim_ship_mode": ("shipping_grain",),
    "dim_shipment": ("shipping_grain", "dim_date", "dim_ship_mode"),
    "dim_segment": ("customer_grain",),
    "dim_customer": ("customer_grain", "dim_segment"),
    "dim_category": ("product_grain",),
    "dim_sub_category": ("product_grain", "dim_category"),
    "dim_product": ("product_grain", "dim_sub_category", "dim_category"),
    "dim_country": ("place_grain",),
    "dim_region": ("place_grain", "dim_country"),
    "dim_state": ("place_grain", "dim_region", "dim_country"),
    "dim_city": ("place_grain", "dim_state", "dim_region", "dim_country"),
    "dim_postal_code": ("place_grain", "dim_city", "dim_state", "dim_region", "dim_country"),
    "fact_sales": (
        "dim_order",
        "dim_shipment",
        "dim_ship_mode",
        "dim_date",
        "dim_customer",
        "dim_segment",
        "dim_postal_code",
        "dim_city",
        "dim_state",
        "dim_region",
        "dim_country",
        "dim_product",
        "dim_sub_category",
        "dim_category",
    ),
}


def _regions(t: dict[str, DataFrame]) -> DataFrame:
    return dims.region_path(t["dim_region"], t["dim_country"])


def _states(t: dict[str, DataFrame]) -> DataFrame:
    return dims.state_path(t["dim_state"], _regions(t))


def _cities(t: dict[str, DataFrame]) -> DataFrame:
    return dims.city_path(t["dim_city"], _states(t))


def _subs(t: dict[str, DataFrame]) -> DataFrame:
    return dims.sub_category_path(t["dim_sub_category"], t["dim_category"])


Builder = Callable[[DataFrame, dict[str, DataFrame], MartConfig], DataFrame]

BUILDERS: dict[str, Builder] = {
    "shipping_grain": lambda raw, t, c: dims.shipping_grain(raw),
    "order_grain": lambda raw, t, c: dims.order_grain(raw),
    "customer_grain": lambda raw, t, c: dims.customer_grain(raw),
    "place_grain": lambda raw, t, c: dims.place_grain(raw),
    "product_grain": lambda raw, t, c: dims.product_grain(raw),
    "dim_date": lambda raw, t, c: dims.dim_date(t["order_grain"], t["shipping_grain"]),
    "dim_order": lambda raw, t, c: dims.dim_order(t["order_grain"], t["dim_date"], c),
    "dim_ship_mode": lambda raw, t, c: dims.dim_ship_mode(t["shipping_grain"], c),
    "dim_shipment": lambda raw, t, c: dims.dim_shipment(
        t["shipping_grain"], t["dim_date"], t["dim_ship_mode"], c
    ),
    "dim_segment": lambda raw, t, c: dims.dim_segment(t["customer_grain"], c),
    "dim_customer": lambda raw, t, c: dims.dim_customer(t["customer_grain"], t["dim_segment"], c),
    "dim_category": lambda raw, t, c: dims.dim_category(t["product_grain"], c),
    "dim_sub_category": lambda raw, t, c: dims.dim_sub_category(
        t["product_grain"], t["dim_category"], c
    ),
    "dim_product": lambda raw, t, c: dims.dim_product(t["product_grain"], _subs(t), c),
    "dim_country": lambda raw, t, c: dims.dim_country(t["place_grain"], c),
    "dim_region": lambda raw, t, c: dims.dim_region(t["place_grain"], t["dim_country"], c),
    "dim_state": lambda raw, t, c: dims.dim_state(t["place_grain"], _regions(t), c),
    "dim_city": lambda raw, t, c: dims.dim_city(t["place_grain"], _states(t), c),
    "dim_postal_code": lambda raw, t, c: dims.dim_postal_code(t["place_grain"], _cities(t), c),
    "fact_sales": lambda raw, t, c: fact_sales(raw, t, c),
}


def _with_ancestors(names: set[str]) -> set[str]:
    found = set(names)
    for name in names:
        found |= _with_ancestors(set(NEEDS[name]))
    return found


def build_core(
    core_raw: DataFrame,
    config: MartConfig,
    save: Callable[[str, DataFrame], DataFrame],
    only: set[str] | None = None,
    have: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Write the core tables, parents first, and return them.

    `save` writes a table and returns it as read back, so that children join keys that can
    no longer change. `only` limits the run to some tables and what they need; tables in
    `have` are taken as they are. A table is started when its parents are written, so tables
    that do not need each other are written side by side: most of them are too small to fill
    a cluster.
    """
    done = dict(have or {})
    wanted = (_with_ancestors(only) if only is not None else set(NEEDS)) - done.keys()
    running: dict[str, Future[DataFrame]] = {}
    failed = Event()
    inherited = inheritable_thread_target(core_raw.sparkSession)

    def write(name: str) -> DataFrame:
        parents = {n: running[n].result() if n in running else done[n] for n in NEEDS[name]}
        if failed.is_set():
            raise CancelledError(f"{name}: another table failed")
        try:
            return save(name, BUILDERS[name](core_raw, parents, config))
        except BaseException:
            failed.set()
            raise

    def results() -> dict[str, DataFrame]:
        """The tables, or the error of the first one that failed of itself."""
        errors = [e for e in (t.exception() for t in running.values()) if e is not None]
        own = [e for e in errors if not isinstance(e, CancelledError)]
        if errors:
            raise (own or errors)[0]
        return {name: table.result() for name, table in running.items()}

    with ThreadPoolExecutor(max_workers=len(NEEDS)) as pool:
        for name in NEEDS:
            if name in wanted:
                # the caller's job group, pool and tags hold in the thread, too
                running[name] = pool.submit(inherited(write), name)
    return {**done, **results()}
