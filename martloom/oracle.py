"""Independent SQL for each registered query, over the star-schema tables.

It shares only the text that makes order lines. Everything after that is written anew: no
surrogate keys (tables are joined on natural keys), no pre-aggregation, and rounding done
on whole cents, since other engines divide decimals as doubles.
"""

from __future__ import annotations

from martloom.queries import CATEGORY, FOREIGN_KEY_NAMES, SEGMENT, YEAR
from martloom.schemas import DATE_COLUMNS, ORDER_LINE_COLUMNS, PRIMARY_KEYS
from martloom.sources.star_schema import PLAIN, VARIANTS

_NAMES = [name for _, name, _ in ORDER_LINE_COLUMNS if name != "row_id"]


def _lines(variant: str) -> str:
    overrides, copies = VARIANTS[variant]
    made = {**PLAIN, **overrides}
    columns = ", ".join(f"{made[name]} AS {name}" for name in _NAMES)
    numbers = ", ".join(f"({n})" for n in range(copies))
    return f"""lines AS (
        SELECT {columns}
        FROM lineitem, orders, customer, nation, region, part, (VALUES {numbers}) AS copy(copy_no)
        WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND c_nationkey = n_nationkey
          AND n_regionkey = r_regionkey AND l_partkey = p_partkey),
    core AS (SELECT * FROM lines WHERE segment = '{SEGMENT}')"""


_PRICE = """price AS (
        SELECT product_id, product_name,
               CAST((2 * sum(cents) + count(*)) // (2 * count(*)) AS BIGINT) AS price_cents
        FROM (SELECT product_id, product_name, (200 * paid + share) // (2 * share) AS cents
              FROM (SELECT product_id, product_name, CAST(sales * 100 AS BIGINT) AS paid,
                           (100 - CAST(discount * 100 AS BIGINT)) * quantity AS share
                    FROM core))
        GROUP BY product_id, product_name)"""


def _core(variant: str, strict: bool) -> str:
    """Every core table by natural keys; titles alone find parents unless strict."""

    def on(left: str, right: str, always: str, strictly: str) -> str:
        keys = always.split() + (strictly.split() if strict else [])
        return " AND ".join(f"{left}.{key} = {right}.{key}" for key in keys)

    return f"""{_lines(variant)},
    regions AS (SELECT DISTINCT region, country FROM core),
    states AS (SELECT DISTINCT core.state, r.region, r.country FROM core JOIN regions r
               ON {on("core", "r", "region", "country")}),
    cities AS (SELECT DISTINCT core.city, s.state, s.region, s.country FROM core JOIN states s
               ON {on("core", "s", "state", "region country")}),
    codes AS (SELECT DISTINCT core.postal_code, c.city, c.state, c.region, c.country
              FROM core JOIN cities c ON {on("core", "c", "city state", "region country")}),
    subs AS (SELECT DISTINCT sub_category, category FROM core),
    {_PRICE},
    products AS (SELECT DISTINCT core.product_id, core.product_name, p.price_cents,
                        s.sub_category, s.category
                 FROM core JOIN price p USING (product_id, product_name)
                 JOIN subs s ON {on("core", "s", "sub_category", "category")}),
    buyers AS (SELECT DISTINCT customer_id, customer_name, segment FROM core),
    receipts AS (SELECT DISTINCT order_id, order_date FROM core),
    facts AS (
        SELECT core.order_id, o.order_date, core.ship_date, core.ship_mode,
               core.customer_id, b.customer_name, b.segment,
               core.postal_code, c.city, c.state, c.region, c.country,
               core.product_id, core.product_name, p.price_cents, p.sub_category, p.category,
               CAST(sum(core.sales) AS DECIMAL(10,2)) AS sum_of_sale,
               CAST(sum(core.quantity) AS INT) AS quantity,
               CAST(sum(core.sales) * 100 AS BIGINT) AS paid,
               CAST(sum(p.price_cents * core.quantity) AS BIGINT) AS full_value,
               CAST(sum(core.profit) AS DECIMAL(10,4)) AS profit
        FROM core
        JOIN receipts o ON {on("core", "o", "order_id", "order_date")}
        JOIN buyers b ON {on("core", "b", "customer_id", "customer_name segment")}
        JOIN codes c ON {on("core", "c", "postal_code", "city state region country")}
        JOIN products p ON {on("core", "p", "product_id product_name", "sub_category category")}
        GROUP BY ALL)"""


def _cents(column: str, kind: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(18,2)) / 100 AS {kind})"


_DISCOUNT = (
    "CAST(sign(full_value - paid) * ((200 * abs(full_value - paid) + full_value)"
    " // (2 * full_value)) AS INT)"
)

_FACT_COLUMNS = f"""order_id AS order_id_from_raw, order_date, ship_date, ship_mode,
        customer_id AS customer_id_from_raw, customer_name, segment_title,
        postal_code, city, state, region, country,
        product_id AS product_id_from_raw, product_name, {_cents("price_cents", "DECIMAL(8,2)")}
        AS price, sub_category, category, sum_of_sale, quantity,
        {_cents(_DISCOUNT, "DECIMAL(2,2)")} AS discount, profit""".replace(
    "segment_title", "segment AS segment_title"
)


def _facts(variant: str, strict: bool = False) -> str:
    return f"WITH {_core(variant, strict)} SELECT {_FACT_COLUMNS} FROM facts"


def _by_year(variant: str, strict: bool = False) -> str:
    return f"""WITH {_core(variant, strict)}
        SELECT CAST(year(order_date) AS INT) AS year, category AS category_name,
               CAST(sum(sum_of_sale) AS DECIMAL(20,2)) AS sum_of_sale
        FROM facts GROUP BY ALL ORDER BY year, category_name"""


def _by_sub_category(variant: str, strict: bool = False) -> str:
    return f"""WITH {_core(variant, strict)}
        SELECT sub_category AS sub_category_title,
               CAST(sum(sum_of_sale) AS DECIMAL(20,2)) AS total_sales
        FROM facts
        WHERE segment = '{SEGMENT}' AND year(order_date) = {YEAR} AND category = '{CATEGORY}'
        GROUP BY ALL ORDER BY sub_category_title"""


def _reconciliation(variant: str, strict: bool) -> str:
    return f"""WITH {_core(variant, strict)}
        SELECT a.*, b.* FROM
          (SELECT CAST(sum(sales) AS DECIMAL(38,2)) AS line_sales,
                  CAST(sum(quantity) AS BIGINT) AS line_quantity FROM core) a,
          (SELECT CAST(sum(sum_of_sale) AS DECIMAL(38,2)) AS fact_sales,
                  CAST(sum(quantity) AS BIGINT) AS fact_quantity FROM facts) b"""


def _as_text(column: str) -> str:
    if column in DATE_COLUMNS:
        return f"strftime({column}, '%-m/%-d/%Y') AS {column}"
    if column == "discount":  # with its leading zero
        return "CAST(CAST(discount AS DECIMAL(4,2)) AS STRING) AS discount"
    return f"CAST({column} AS STRING) AS {column}"


def _text_but(changed: dict[str, str]) -> str:
    return ", ".join(
        f"{changed[name]} AS {name}" if name in changed else _as_text(name) for name in _NAMES
    )


def _select(columns: str, source: str = "core", variant: str = "plain") -> str:
    return f"WITH {_core(variant, False)} SELECT {columns} FROM {source}"


_DIMENSIONS = {
    "dim_order": ("order_id AS order_id_from_raw, order_date", "receipts"),
    "dim_shipment": ("DISTINCT ship_date, ship_mode", "core"),
    "dim_customer": (
        "customer_id AS customer_id_from_raw, customer_name, segment AS segment_title",
        "buyers",
    ),
    "dim_sub_category": ("*", "subs"),
    "dim_product": (
        "product_id AS product_id_from_raw, product_name, "
        f"{_cents('price_cents', 'DECIMAL(8,2)')} AS price, sub_category, category",
        "products",
    ),
    "dim_region": ("*", "regions"),
    "dim_state": ("*", "states"),
    "dim_city": ("*", "cities"),
    "dim_postal_code": ("*", "codes"),
}

_COUNTED = {
    "dim_date": "(SELECT order_date FROM core UNION SELECT ship_date FROM core)",
    "dim_order": "receipts",
    "dim_ship_mode": "(SELECT DISTINCT ship_mode FROM core)",
    "dim_shipment": "(SELECT DISTINCT ship_date, ship_mode FROM core)",
    "dim_segment": "(SELECT DISTINCT segment FROM core)",
    "dim_customer": "buyers",
    "dim_category": "(SELECT DISTINCT category FROM core)",
    "dim_sub_category": "subs",
    "dim_product": "products",
    "dim_country": "(SELECT DISTINCT country FROM core)",
    "dim_region": "regions",
    "dim_state": "states",
    "dim_city": "cities",
    "dim_postal_code": "codes",
    "fact_sales": "facts",
}


def _broken_report() -> str:
    """Each constraint with its violations, found with natural keys."""
    broken = {
        "dim_ship_mode primary key": "count(DISTINCT ship_mode) FROM core",
        "dim_sub_category.category_id in dim_category":
            f"count(DISTINCT category) FROM core WHERE category = '{CATEGORY}'",
        "fact_sales.customer_id in dim_customer":
            "count(DISTINCT customer_id) FROM core WHERE customer_id LIKE '%7'",
    }
    names = [*(f"{t} primary key" for t in PRIMARY_KEYS if t != "order_lines"), *FOREIGN_KEY_NAMES]
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS constraint_name, "
        + (f"(SELECT {broken[name]})" if name in broken else "CAST(0 AS BIGINT)")
        + " AS violations"
        for name in names
    )
    return f"WITH {_core('plain', False)} {rows}"


def _fan_out(variant: str, strict: bool = False) -> str:
    """Every join run in full, and counted."""
    joins = [
        ("dim_product", "product_id product_name", "dim_sub_category", "subs", "sub_category", "category"),
        ("dim_state", "state", "dim_region", "regions", "region", "country"),
        ("dim_city", "city", "dim_state", "states", "state", "region country"),
        ("dim_postal_code", "postal_code", "dim_city", "cities", "city state", "region country"),
        ("fact_sales", "", "dim_shipment", "(SELECT DISTINCT ship_date, ship_mode FROM core)", "ship_date ship_mode", ""),
        ("fact_sales", "", "dim_postal_code", "codes", "postal_code", "city state region country"),
        ("fact_sales", "", "dim_product", "products", "product_id product_name", "sub_category category"),
        ("fact_sales", "", "dim_customer", "buyers", "customer_id", "customer_name segment"),
        ("fact_sales", "", "dim_order", "receipts", "order_id", "order_date"),
    ]
    rows = []
    for child, own, parent, source, title, rest in joins:
        keys = title.split() + (rest.split() if strict else [])
        names = ", ".join(dict.fromkeys(own.split() + keys))
        children = f"(SELECT DISTINCT {names} FROM core)" if own else "core"
        key = ", ".join(keys)
        rows.append(f"""
            SELECT '{child} to {parent}' AS join_name,
                   (SELECT count(*) FROM {children}) AS child_rows,
                   (SELECT count(*) FROM {children} c JOIN {source} p USING ({key})) AS joined_rows,
                   (SELECT count(*) FROM {children} c ANTI JOIN {source} p USING ({key})) AS unmatched_rows,
                   (SELECT count(*) FROM (SELECT {key} FROM {source} SEMI JOIN core USING ({key})
                                          GROUP BY ALL HAVING count(*) > 1)) AS repeated_keys,
                   (SELECT max(n) FROM (SELECT count(*) AS n FROM {source} SEMI JOIN core USING ({key})
                                        GROUP BY {key})) AS most_parents""")
    return f"WITH {_core(variant, strict)} " + " UNION ALL ".join(rows)


def _moment(moment: str, variant: str) -> str:
    return f"""SELECT * FROM (WITH {_core(variant, False)}
        SELECT '{moment}' AS moment,
               (SELECT CAST(sum(quantity) AS BIGINT) FROM lines) AS line_quantity,
               (SELECT CAST(sum(sum_of_sale) AS DECIMAL(38,2)) FROM facts) AS mart_sales)"""


def oracle_sql() -> dict[str, str]:
    typed_text = ", ".join(
        _as_text(name) if name in DATE_COLUMNS else name for name in _NAMES
    )
    return {
        "read_raw_csv": _select(", ".join(map(_as_text, _NAMES)), "lines"),
        "read_raw_csv_breaks": _select(
            _text_but({"product_name": """product_name || chr(10) || '"' || quantity || '",'
                || chr(10) || chr(10) || 'end'"""}),
            "lines",
        ),
        "read_raw_csv_stray_quotes": _select(
            _text_but({
                "city": """'3" ' || city""",
                "state": """state || '"'""",
                "product_name": """product_name || chr(10) || '"x", y'""",
            }),
            "lines",
        ),
        "raw_typed": _select(typed_text, "lines"),
        "raw_dates": _select("*", "lines"),
        "conform": _select("*", "lines"),
        "core_raw": _select("*"),
        "write_table": _select("*"),
        "read_table": _select(
            "segment, category, CAST(sum(sales) AS DECIMAL(20,2)) AS sales, "
            "CAST(sum(quantity) AS BIGINT) AS quantity",
            "lines GROUP BY segment, category",
        ),
        "dim_date": f"""WITH {_core("plain", False)}
            SELECT row_number() OVER (ORDER BY day0) AS date_id, day0 AS date_origin,
                   CAST(day(day0) AS INT) AS day, CAST(month(day0) AS INT) AS month,
                   CAST(year(day0) AS INT) AS year, CAST(quarter(day0) AS INT) AS quarter,
                   CAST(isodow(day0) AS STRING) AS day_of_week, CAST(week(day0) AS INT) AS week
            FROM (SELECT order_date AS day0 FROM core UNION SELECT ship_date FROM core)""",
        "dim_ship_mode": _select("DISTINCT ship_mode AS mode_title"),
        "dim_segment": _select("DISTINCT segment AS segment_title"),
        "dim_category": _select("DISTINCT category AS category_name"),
        "dim_country": _select("DISTINCT country AS country_title"),
        **{name: _select(*how) for name, how in _DIMENSIONS.items()},
        **{
            f"{name}_shared_all": _select(*how, variant="shared_all")
            for name, how in _DIMENSIONS.items()
        },
        "product_price": _select(
            f"product_id, product_name, {_cents('price_cents', 'DECIMAL(13,2)')} AS price", "price"
        ),
        "surrogate_key": _select(
            "count(DISTINCT order_id) AS row_count, count(DISTINCT order_id) AS key_count, "
            "CAST(1 AS BIGINT) AS first_key, count(DISTINCT order_id) AS last_key",
            "lines",
        ),
        "fact_sales": _facts("plain"),
        "fact_sales_shared_code": _facts("shared_code"),
        "fact_sales_shared_all": _facts("shared_all"),
        "fact_sales_repeated": _facts("repeated"),
        "fact_sales_strict": _facts("shared_all", strict=True),
        "fact_sales_build": _select(
            "count(*) AS row_count, CAST(sum(sum_of_sale) AS DECIMAL(20,2)) AS sum_of_sale, "
            "CAST(sum(quantity) AS BIGINT) AS quantity, "
            "CAST(sum(profit) AS DECIMAL(20,4)) AS profit",
            "facts",
        ),
        "mart_sales_by_year": _by_year("plain"),
        "mart_sales_by_year_shared_all": _by_year("shared_all"),
        "mart_sales_by_year_strict": _by_year("shared_all", strict=True),
        "mart_sub_category_sales": _by_sub_category("plain"),
        "mart_sub_category_sales_shared_all": _by_sub_category("shared_all"),
        "mart_sub_category_sales_strict": _by_sub_category("shared_all", strict=True),
        "mart_sales_by_year_grain": _by_year("plain"),
        "mart_sub_category_sales_grain": _by_sub_category("plain"),
        "build_core": f"WITH {_core('plain', False)} "
        + " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"
            for name, source in _COUNTED.items()
        ),
        "publish_mart": _by_year("plain"),
        "refresh_on_arrival": _by_year("plain"),
        "check_primary_key": _select(
            "order_id, product_id, count(*) AS row_count",
            "lines GROUP BY order_id, product_id HAVING count(*) > 1",
        ),
        "check_foreign_key": _select(
            "DISTINCT customer_id",
            "lines WHERE customer_id NOT IN (SELECT customer_id FROM core)",
        ),
        "refresh_interrupted": " UNION ALL ".join(
            [_moment("before", "repeated"), _moment("between", "plain"), _moment("after", "plain")]
        ),
        "fan_out_report": _fan_out("shared_all"),
        "fan_out_report_plain": _fan_out("plain"),
        "fan_out_report_strict": _fan_out("shared_all", strict=True),
        "fan_out_totals": _reconciliation("shared_all", strict=False),
        "fan_out_totals_strict": _reconciliation("shared_all", strict=True),
        "refresh_on_arrival_twice": _by_year("plain"),
        "random_category": "SELECT CAST(1 AS BIGINT) AS rows_picked, true AS known",
        "mart_for_random_category": "SELECT CAST(0 AS BIGINT) AS rows_missing, "
        "CAST(0 AS BIGINT) AS rows_too_many",
        "mart_for_each_category": _select(
            "category AS category_name, sub_category AS sub_category_title, "
            "CAST(sum(sum_of_sale) AS DECIMAL(20,2)) AS total_sales",
            f"facts WHERE segment = '{SEGMENT}' AND year(order_date) = {YEAR} GROUP BY ALL",
        ),
        "constraint_report_broken": _broken_report(),
        "constraint_report": " UNION ALL ".join(
            f"SELECT '{name}' AS constraint_name, CAST(0 AS BIGINT) AS violations"
            for name in [
                *(f"{t} primary key" for t in PRIMARY_KEYS if t != "order_lines"),
                *FOREIGN_KEY_NAMES,
            ]
        ),
        "reconciliation": _reconciliation("shared_all", strict=False),
        "reconciliation_strict": _reconciliation("shared_all", strict=True),
    }
