"""Invariants the reference states for its own results (shape checks that
hold for any data), checked on the driver tables."""
from pyspark.sql import functions as F

from conftest import SF_SMALL
from martforge.plans import analytics as A
from martforge.plans.warehouse import warehouse_for


def test_first_order_cohort_month_zero_is_full(spark):
    wh = warehouse_for(spark, SF_SMALL)
    zero = A.cohort_first_order(wh).filter(F.col("month_number") == 0)
    assert zero.count() > 0
    assert zero.filter(F.col("retention_pct") != 100.0).count() == 0


def test_segments_sum_to_customers_with_orders(spark):
    wh = warehouse_for(spark, SF_SMALL)
    total = A.rfm_segment_counts(wh).agg(F.sum("customers")).first()[0]
    with_orders = wh.int_customer_order_facts.join(
        wh.dim_customer.select("customer_id"), "customer_id", "left_semi").count()
    assert total == with_orders == A.customer_rfm(wh).count()


def test_rollup_has_one_row_per_root_and_counts_every_category(spark):
    wh = warehouse_for(spark, SF_SMALL)
    roll = A.category_rollup_lines(wh)
    roots = wh.dim_category.filter(F.col("parent_category_id").isNull()).count()
    assert roll.count() == roots
    # every category sits under exactly one root (no orphans in the tree)
    assert roll.agg(F.sum("subcategory_count")).first()[0] == wh.dim_category.count()
    # lines of categorised products are all counted once
    categorised = wh.fct_order_items.join(
        wh.dim_product.filter(F.col("category_key").isNotNull()), "product_key", "left_semi").count()
    assert roll.agg(F.sum("line_item_count")).first()[0] == categorised


def test_row_count_parity_raw_to_star(spark):
    wh = warehouse_for(spark, SF_SMALL)
    raw_customers = wh.landing["customers"].select("customer_id").distinct().count()
    assert wh.dim_customer.count() == raw_customers
    assert wh.dim_product.count() == wh.landing["products"].count()
    assert wh.fct_order_items.count() == wh.landing["order_items"].count()   # no orphans here
    assert wh.fct_returns.count() == wh.landing["returns"].count()
    # every order total equals the sum of its lines
    sums = wh.fct_order_items.groupBy("order_key").agg(F.sum("line_total").alias("s"))
    bad = wh.fct_orders.join(sums, "order_key", "left").filter(
        F.coalesce(F.col("s"), F.lit(0)) != F.col("total_amount"))
    assert bad.count() == 0
