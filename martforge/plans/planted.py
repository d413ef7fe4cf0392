"""Staging tables with broken rows planted in them, to show what the checks count
and what quarantine keeps.

Rows break by rules on their keys, on the whole staging tables, so that the number of
broken rows grows with the input: categories below a missing parent, customers without
a name, a second row of a customer or order, negative prices and refunds, unknown statuses
and buyers, lines without quantity or with an impossible discount, returns without a refund,
products, lines and returns of parents that do not exist.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.constants import ORDER_STATUSES
from martforge.operators.quality import Check, run_suite
from martforge.operators.quarantine import ROW, Quarantine, quarantine, reject_counts, with_rows
from martforge.plans.warehouse import Warehouse

# --- fixed values: which rows break (remainder 0 of the number in their key) ---------
LOST_BRANDS_LIKE = "%-B11"        # categories whose parent is missing
NAMELESS_EVERY = 31               # customers without a name
SECOND_CUSTOMER_EVERY = 37        # customers with a second row
NEGATIVE_PRICE_EVERY = 41         # products
LOST_STATUS_EVERY = 43            # orders with an unknown status
UNKNOWN_BUYER_EVERY = 47          # orders of a customer that does not exist
SECOND_ORDER_EVERY = 53           # orders with a second row
NO_QUANTITY_EVERY = 59            # lines
DISCOUNT_EVERY = 61               # lines with a discount of 150 percent
NO_REFUND_EVERY = 67              # returns without a refund
NEGATIVE_REFUND_EVERY = 71        # returns
UNKNOWN_PARENT_EVERY = 73         # products, lines and returns of a category, order or line that does not exist
UNKNOWN_PRODUCT_EVERY = 79        # lines

KEYS = {"stg_categories": "category_id", "stg_customers": "customer_id", "stg_products": "product_id",
        "stg_orders": "order_id", "stg_order_items": "order_item_id", "stg_returns": "return_id"}


def _rel(model: str, column: str, to_model: str, to_column: str) -> Check:
    return Check(model, column, "relationships", to_model=to_model, to_column=to_column)


PLANTED_SUITE = [
    _rel("stg_categories", "parent_category_id", "stg_categories", "category_id"),
    Check("stg_customers", "full_name", "not_null"),
    Check("stg_customers", "customer_id", "unique"),
    Check("stg_products", "unit_price", "non_negative"),
    _rel("stg_products", "category_id", "stg_categories", "category_id"),
    Check("stg_orders", "order_id", "unique"),
    Check("stg_orders", "order_status", "accepted_values", values=tuple(ORDER_STATUSES)),
    _rel("stg_orders", "customer_id", "stg_customers", "customer_id"),
    Check("stg_order_items", "quantity", "expression", condition="quantity > 0"),
    Check("stg_order_items", "discount_pct", "expression", condition="discount_pct BETWEEN 0 AND 100"),
    _rel("stg_order_items", "order_id", "stg_orders", "order_id"),
    _rel("stg_order_items", "product_id", "stg_products", "product_id"),
    Check("stg_returns", "refund_amount", "not_null"),
    Check("stg_returns", "refund_amount", "non_negative"),
    _rel("stg_returns", "order_item_id", "stg_order_items", "order_item_id"),
]


def _every(key: str, n: int) -> Column:
    return F.substring_index(key, "-", -1).cast("long") % n == 0


def planted(wh: Warehouse) -> dict[str, DataFrame]:
    def broken(model: str, column: str, when: Column, value: Column) -> DataFrame:
        df = tables.get(model, getattr(wh, model))
        kind = df.schema[column].dataType
        tables[model] = df.withColumn(column, F.when(when, value.cast(kind)).otherwise(F.col(column)))
        return tables[model]

    tables: dict[str, DataFrame] = {}
    broken("stg_categories", "parent_category_id", F.col("category_id").like(LOST_BRANDS_LIKE), F.lit("CAT-MISSING"))
    broken("stg_customers", "full_name", _every("customer_id", NAMELESS_EVERY), F.lit(None))
    broken("stg_products", "unit_price", _every("product_id", NEGATIVE_PRICE_EVERY), -F.col("unit_price"))
    broken("stg_orders", "order_status", _every("order_id", LOST_STATUS_EVERY), F.lit("lost"))
    broken("stg_orders", "customer_id", _every("order_id", UNKNOWN_BUYER_EVERY), F.lit("CUST-UNKNOWN"))
    broken("stg_order_items", "quantity", _every("order_item_id", NO_QUANTITY_EVERY), F.lit(0))
    broken("stg_order_items", "discount_pct", _every("order_item_id", DISCOUNT_EVERY), F.lit(150))
    for model, column in (("stg_products", "category_id"), ("stg_order_items", "order_id"), ("stg_returns", "order_item_id")):
        broken(model, column, _every(KEYS[model], UNKNOWN_PARENT_EVERY), F.lit("UNKNOWN"))
    broken("stg_order_items", "product_id", _every("order_item_id", UNKNOWN_PRODUCT_EVERY), F.lit("UNKNOWN"))
    broken("stg_returns", "refund_amount", _every("return_id", NEGATIVE_REFUND_EVERY), -F.col("refund_amount"))
    broken("stg_returns", "refund_amount", _every("return_id", NO_REFUND_EVERY), F.lit(None))
    for model, column, every, value in (
            ("stg_customers", "city", SECOND_CUSTOMER_EVERY, F.lit("Elsewhere")),
            ("stg_orders", "shipping_cost", SECOND_ORDER_EVERY, F.col("shipping_cost") + 1)):
        df = tables[model]
        again = df.filter(_every(KEYS[model], every)).withColumn(column, value.cast(df.schema[column].dataType))
        tables[model] = df.unionByName(again)
    return tables


def planted_report(wh: Warehouse) -> DataFrame:
    """The checks on the planted tables, one row each."""
    return run_suite(PLANTED_SUITE, planted(wh).__getitem__)


def _quarantined(wh: Warehouse) -> tuple[dict[str, DataFrame], Quarantine]:
    done = getattr(wh, "_quarantined", None)
    if done is None:
        tables = {t: with_rows(df) for t, df in planted(wh).items()}
        done = wh._quarantined = tables, quarantine(tables, PLANTED_SUITE)
    return done


def quarantine_counts(wh: Warehouse) -> DataFrame:
    return reject_counts(*_quarantined(wh))


def quarantine_rejects(wh: Warehouse) -> DataFrame:
    """table_name, row_id (the row's own key), n_rows: what was rejected."""
    tables, result = _quarantined(wh)
    parts = []
    for t, df in tables.items():
        bad = result.rejects.filter(F.col("table_name") == t).select(ROW).distinct()
        parts.append(df.join(bad.hint("merge"), ROW, "left_semi").select(F.lit(t).alias("table_name"), F.col(KEYS[t]).alias("row_id")))
    return reduce(DataFrame.unionByName, parts).groupBy("table_name", "row_id").agg(F.count(F.lit(1)).alias("n_rows"))


def quarantine_star(wh: Warehouse) -> Warehouse:
    """The warehouse over the kept rows alone."""
    clean = Warehouse(wh.spark, wh.landing, wh.spine, wh.as_of, wh.strict)
    clean.__dict__.update(_quarantined(wh)[1].kept)
    return clean


# --- the same in SQL, from the rules ------------------------------------------------------

def _num(key: str, n: int) -> str:
    return f"cast(split_part({key}, '-', 2) AS bigint) % {n} = 0"


def _unknown(key: str, column: str, n: int) -> str:
    return f"CASE WHEN {_num(key, n)} THEN 'UNKNOWN' ELSE {column} END AS {column}"


def _ctes() -> str:
    customer = f"customer_id, CASE WHEN {_num('customer_id', NAMELESS_EVERY)} THEN NULL ELSE full_name END AS full_name"
    order = f"""order_id, CASE WHEN {_num('order_id', LOST_STATUS_EVERY)} THEN 'lost' ELSE order_status END AS order_status,
      CASE WHEN {_num('order_id', UNKNOWN_BUYER_EVERY)} THEN 'CUST-UNKNOWN' ELSE customer_id END AS customer_id"""
    return f"""
p_cat AS (SELECT category_id, CASE WHEN category_id LIKE '{LOST_BRANDS_LIKE}' THEN 'CAT-MISSING' ELSE parent_category_id END
            AS parent_category_id FROM stg_categories),
p_cust AS (SELECT {customer}, false AS again FROM stg_customers
           UNION ALL SELECT {customer}, true FROM stg_customers WHERE {_num('customer_id', SECOND_CUSTOMER_EVERY)}),
p_prod AS (SELECT product_id, {_unknown('product_id', 'category_id', UNKNOWN_PARENT_EVERY)},
             CASE WHEN {_num('product_id', NEGATIVE_PRICE_EVERY)} THEN -unit_price ELSE unit_price END AS unit_price FROM stg_products),
p_ord AS (SELECT {order}, false AS again FROM stg_orders
          UNION ALL SELECT {order}, true FROM stg_orders WHERE {_num('order_id', SECOND_ORDER_EVERY)}),
p_item AS (SELECT order_item_id, {_unknown('order_item_id', 'order_id', UNKNOWN_PARENT_EVERY)},
             {_unknown('order_item_id', 'product_id', UNKNOWN_PRODUCT_EVERY)},
             CASE WHEN {_num('order_item_id', NO_QUANTITY_EVERY)} THEN 0 ELSE quantity END AS quantity,
             CASE WHEN {_num('order_item_id', DISCOUNT_EVERY)} THEN 150 ELSE discount_pct END AS discount_pct FROM stg_order_items),
p_ret AS (SELECT return_id, {_unknown('return_id', 'order_item_id', UNKNOWN_PARENT_EVERY)},
            CASE WHEN {_num('return_id', NO_REFUND_EVERY)} THEN NULL
                 WHEN {_num('return_id', NEGATIVE_REFUND_EVERY)} THEN -refund_amount ELSE refund_amount END AS refund_amount
          FROM stg_returns),
k_cat AS (SELECT category_id FROM p_cat WHERE parent_category_id IS NULL
          UNION ALL SELECT c.category_id FROM p_cat c JOIN k_cat p ON c.parent_category_id = p.category_id),
j_cust AS (SELECT *, NOT again AND full_name IS NOT NULL AS good FROM p_cust),
j_prod AS (SELECT *, unit_price >= 0 AND (category_id IS NULL OR category_id IN (SELECT category_id FROM k_cat)) AS good FROM p_prod),
j_ord AS (SELECT *, NOT again AND order_status <> 'lost'
            AND customer_id IN (SELECT customer_id FROM j_cust WHERE good) AS good FROM p_ord),
j_item AS (SELECT *, quantity > 0 AND discount_pct BETWEEN 0 AND 100 AND order_id IN (SELECT order_id FROM j_ord WHERE good)
             AND product_id IN (SELECT product_id FROM j_prod WHERE good) AS good FROM p_item),
j_ret AS (SELECT *, refund_amount IS NOT NULL AND coalesce(refund_amount, 0) >= 0
            AND order_item_id IN (SELECT order_item_id FROM j_item WHERE good) AS good FROM p_ret),
judged AS (
  SELECT 'stg_categories' AS table_name, category_id AS row_id, category_id IN (SELECT category_id FROM k_cat) AS good FROM p_cat
  UNION ALL SELECT 'stg_customers', customer_id, good FROM j_cust UNION ALL SELECT 'stg_products', product_id, good FROM j_prod
  UNION ALL SELECT 'stg_orders', order_id, good FROM j_ord UNION ALL SELECT 'stg_order_items', order_item_id, good FROM j_item
  UNION ALL SELECT 'stg_returns', return_id, good FROM j_ret)"""


def _missing(child: str, column: str, parent: str, key: str) -> str:
    return f"(SELECT count(*) FROM {child} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL))"


def _report_sql() -> str:
    counts = [
        _missing("p_cat", "parent_category_id", "p_cat", "category_id"),
        "(SELECT count(*) FROM p_cust WHERE full_name IS NULL)",
        "(SELECT count(*) FROM p_cust WHERE again)",
        "(SELECT count(*) FROM p_prod WHERE unit_price < 0)",
        _missing("p_prod", "category_id", "p_cat", "category_id"),
        "(SELECT count(*) FROM p_ord WHERE again)",
        "(SELECT count(DISTINCT order_status) FROM p_ord WHERE order_status = 'lost')",
        _missing("p_ord", "customer_id", "p_cust", "customer_id"),
        "(SELECT count(*) FROM p_item WHERE quantity <= 0)",
        "(SELECT count(*) FROM p_item WHERE discount_pct > 100)",
        _missing("p_item", "order_id", "p_ord", "order_id"),
        _missing("p_item", "product_id", "p_prod", "product_id"),
        "(SELECT count(*) FROM p_ret WHERE refund_amount IS NULL)",
        "(SELECT count(*) FROM p_ret WHERE refund_amount < 0)",
        _missing("p_ret", "order_item_id", "p_item", "order_item_id"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{c.check_name}' AS check_name, '{c.model}' AS model, '{c.column}' AS column_name, '{c.test}' AS test, "
        f"'{c.severity}' AS severity, cast({n} AS bigint) AS failing_rows" for c, n in zip(PLANTED_SUITE, counts))


def oracle_bodies() -> dict[str, str]:
    return {name: f"SELECT * FROM (WITH RECURSIVE {_ctes()} {body}) q" for name, body in {
        "dq_planted": _report_sql(),
        "quarantine_counts": """SELECT table_name, count(*) AS n_input, count(*) FILTER (good) AS n_kept,
            count(*) FILTER (NOT good) AS n_rejected FROM judged GROUP BY table_name""",
        "quarantine_rejects": "SELECT table_name, row_id, count(*) AS n_rows FROM judged WHERE NOT good GROUP BY ALL",
        "quarantine_star": """SELECT table_name, count(*) AS row_count FROM judged
            WHERE good AND table_name IN ('stg_orders', 'stg_order_items', 'stg_returns') GROUP BY table_name""",
    }.items()}
