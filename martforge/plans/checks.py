"""The two check suites and the frames they run on.

``DBT_SUITE``: the 50 declarative tests of the source's model build (20 on
staging models, 30 on marts).  ``CONSTRAINT_SUITE``: the constraints of the
hand-written warehouse DDL (NOT NULL, CHECK, foreign keys, the deferred
self-reference), which Parquet does not enforce and which become checks run
before publishing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from martforge.constants import ORDER_STATUSES, RFM_SEGMENT_NAMES
from martforge.operators.quality import ERROR, WARN, Check, run_suite
from martforge.plans import analytics as A
from martforge.plans.warehouse import Warehouse

_STATUS = tuple(ORDER_STATUSES)
_SEGMENTS = tuple(RFM_SEGMENT_NAMES)


def _nn_unique(model: str, col: str) -> list[Check]:
    return [Check(model, col, "not_null"), Check(model, col, "unique")]


def _rel(model: str, col: str, to_model: str, to_col: str, severity: str = ERROR) -> Check:
    return Check(model, col, "relationships", severity, to_model=to_model, to_column=to_col)


DBT_SUITE: list[Check] = [
    # staging (20)
    *_nn_unique("stg_customers", "customer_id"),
    Check("stg_customers", "email", "unique"),
    *_nn_unique("stg_categories", "category_id"),
    *_nn_unique("stg_products", "product_id"),
    _rel("stg_products", "category_id", "stg_categories", "category_id", WARN),
    Check("stg_products", "unit_price", "non_negative", WARN),
    *_nn_unique("stg_orders", "order_id"),
    _rel("stg_orders", "customer_id", "stg_customers", "customer_id"),
    Check("stg_orders", "order_status", "accepted_values", values=_STATUS),
    *_nn_unique("stg_order_items", "order_item_id"),
    _rel("stg_order_items", "order_id", "stg_orders", "order_id"),
    _rel("stg_order_items", "product_id", "stg_products", "product_id"),
    *_nn_unique("stg_returns", "return_id"),
    _rel("stg_returns", "order_item_id", "stg_order_items", "order_item_id"),
    # marts (30)
    *_nn_unique("dim_customer", "customer_key"),
    *_nn_unique("dim_customer", "customer_id"),
    *_nn_unique("dim_category", "category_key"),
    *_nn_unique("dim_product", "product_key"),
    *_nn_unique("dim_product", "product_id"),
    *_nn_unique("dim_date", "date_key"),
    *_nn_unique("fct_orders", "order_key"),
    _rel("fct_orders", "customer_key", "dim_customer", "customer_key"),
    Check("fct_orders", "order_status", "accepted_values", values=_STATUS),
    *_nn_unique("fct_order_items", "order_item_key"),
    _rel("fct_order_items", "order_key", "fct_orders", "order_key"),
    _rel("fct_order_items", "product_key", "dim_product", "product_key"),
    *_nn_unique("fct_returns", "return_key"),
    _rel("fct_returns", "order_item_key", "fct_order_items", "order_item_key"),
    *_nn_unique("mart_customer_rfm", "customer_key"),
    Check("mart_customer_rfm", "segment", "accepted_values", values=_SEGMENTS),
    *_nn_unique("mart_category_sales_rollup", "category_key"),
    *_nn_unique("mart_monthly_revenue_growth", "order_month"),
]


def _nn(model: str, *cols: str) -> list[Check]:
    return [Check(model, c, "not_null", name=f"ddl_not_null_{model}_{c}") for c in cols]


def _ddl(check: Check) -> Check:
    return Check(check.model, check.column, check.test, check.severity, check.values,
                 check.to_model, check.to_column, check.condition,
                 name=f"ddl_{check.check_name}")


CONSTRAINT_SUITE: list[Check] = [
    *_nn("dim_date", "date_key", "full_date", "year", "quarter", "month", "day", "day_of_week",
         "is_weekend"),
    _ddl(Check("dim_date", "full_date", "unique")),
    *_nn("dim_category", "category_id", "category_name"),
    _ddl(Check("dim_category", "category_id", "unique")),
    _ddl(_rel("dim_category", "parent_category_id", "dim_category", "category_id")),
    *_nn("dim_customer", "customer_id", "full_name"),
    _ddl(Check("dim_customer", "customer_id", "unique")),
    *_nn("dim_product", "product_id", "product_name", "unit_price", "is_active"),
    _ddl(Check("dim_product", "unit_price", "non_negative")),
    _ddl(_rel("dim_product", "category_key", "dim_category", "category_key")),
    *_nn("fct_orders", "order_id", "customer_key", "order_date_key", "order_status",
         "shipping_cost", "total_amount"),
    _ddl(Check("fct_orders", "order_id", "unique")),
    _ddl(Check("fct_orders", "order_status", "accepted_values", values=_STATUS)),
    _ddl(Check("fct_orders", "shipping_cost", "non_negative")),
    _ddl(Check("fct_orders", "total_amount", "non_negative")),
    _ddl(_rel("fct_orders", "order_date_key", "dim_date", "date_key")),
    *_nn("fct_order_items", "order_key", "product_key", "quantity", "unit_price", "discount_pct",
         "line_total"),
    _ddl(Check("fct_order_items", "quantity", "expression", condition="quantity > 0",
               name="check_quantity_positive")),
    _ddl(Check("fct_order_items", "unit_price", "non_negative")),
    _ddl(Check("fct_order_items", "discount_pct", "expression",
               condition="discount_pct BETWEEN 0 AND 100", name="check_discount_range")),
    _ddl(Check("fct_order_items", "line_total", "non_negative")),
    *_nn("fct_returns", "order_item_key", "return_date_key", "refund_amount"),
    _ddl(Check("fct_returns", "refund_amount", "non_negative")),
    _ddl(_rel("fct_returns", "return_date_key", "dim_date", "date_key")),
]

# the 30 tests on marts (the 20 before them test staging models)
MART_SUITE: list[Check] = [c for c in DBT_SUITE if not c.model.startswith("stg_")]

MART_MODELS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "mart_customer_rfm": A.customer_rfm,
    "mart_category_sales_rollup": A.category_rollup_lines,
    "mart_monthly_revenue_growth": A.mom_growth_all,
    "mart_cohort_retention": A.cohort_signup,
}


def model_resolver(wh: Warehouse) -> Callable[[str], DataFrame]:
    cache: dict[str, DataFrame] = {}

    stored = getattr(wh, "stored_marts", {})

    def get(name: str) -> DataFrame:
        if name not in cache:
            if name in stored:
                cache[name] = stored[name]
            elif name in MART_MODELS:
                cache[name] = MART_MODELS[name](wh)
            else:
                cache[name] = getattr(wh, name)
        return cache[name]
    return get


def suite_of(test: str) -> list[Check]:
    return [c for c in DBT_SUITE + CONSTRAINT_SUITE if c.test == test]


def run_checks(wh: Warehouse, checks: list[Check]) -> DataFrame:
    return run_suite(checks, model_resolver(wh))
