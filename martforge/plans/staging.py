"""Staging jobs: one cleaning job per landing table.

Each takes the landing frame (all strings) and returns typed columns.
Nothing here shuffles except the customer de-duplication.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.functions.clean import (
    MONEY,
    PCT_TYPE,
    blank_to_null,
    line_total,
    normalize_email,
    parse_bool_text,
    parse_mixed_date,
    parse_money,
)
from martforge.operators.dedup import distinct_on

CUSTOMER_COLUMNS = ["customer_id", "full_name", "email", "signup_date", "city", "state",
                    "country", "segment"]


def customers_typed(raw: DataFrame, strict: bool = True) -> DataFrame:
    return raw.select(
        "customer_id",
        "full_name",
        normalize_email("email").alias("email"),
        parse_mixed_date("signup_date", strict).alias("signup_date"),
        "city", "state", "country", "segment",
        F.col("signup_date").alias("_signup_text"),
    )


def stg_customers(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Clean e-mail, parse signup date, keep one row per customer_id:
    the earliest parsed signup date (NULL last), then the other columns."""
    typed = customers_typed(raw, strict)
    order = [F.col("signup_date").asc_nulls_last()] + [
        F.col(c).asc_nulls_last() for c in CUSTOMER_COLUMNS if c not in ("customer_id", "signup_date")
    ]
    return distinct_on(typed, ["customer_id"], order).select(*CUSTOMER_COLUMNS)


def stg_customers_text_order(raw: DataFrame, strict: bool = True) -> DataFrame:
    """The hand-written load's variant: the kept row is the first by the
    *raw signup text* (its ORDER BY names the input column), NULL last."""
    typed = customers_typed(raw, strict)
    order = [F.col("_signup_text").asc_nulls_last()] + [
        F.col(c).asc_nulls_last() for c in CUSTOMER_COLUMNS if c != "customer_id"
    ]
    return distinct_on(typed, ["customer_id"], order).select(*CUSTOMER_COLUMNS)


def stg_categories(raw: DataFrame) -> DataFrame:
    return raw.select(
        "category_id",
        "category_name",
        blank_to_null("parent_category_id").alias("parent_category_id"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        "product_id",
        "product_name",
        blank_to_null("category_id").alias("category_id"),
        "brand",
        parse_money("unit_price", MONEY, strip="$").alias("unit_price"),
        parse_bool_text("is_active").alias("is_active"),
    )


def stg_orders(raw: DataFrame, strict: bool = True) -> DataFrame:
    return raw.select(
        "order_id",
        "customer_id",
        parse_mixed_date("order_date", strict).alias("order_date"),
        "order_status",
        "payment_method",
        parse_money("shipping_cost", MONEY).alias("shipping_cost"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    q = F.col("quantity").cast("int")
    p = parse_money("unit_price", MONEY)
    d = parse_money("discount_pct", PCT_TYPE)
    return raw.select(
        "order_item_id",
        "order_id",
        "product_id",
        q.alias("quantity"),
        p.alias("unit_price"),
        d.alias("discount_pct"),
        line_total(q, p, d).alias("line_total"),
    )


def stg_returns(raw: DataFrame) -> DataFrame:
    return raw.select(
        "return_id",
        "order_item_id",
        F.col("return_date").cast("date").alias("return_date"),
        "return_reason",
        parse_money("refund_amount", MONEY).alias("refund_amount"),
    )
