"""Hand-made landing extracts through the whole pipeline."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from martforge.plans import analytics as A
from martforge.plans import checks as C
from martforge.plans.warehouse import Warehouse
from martforge.sources.landing import landing_schema

SPINE = (dt.date(2024, 1, 1), dt.date(2024, 12, 31))


def _wh(spark, orders, items, returns=(), customers=None, products=None, categories=None):
    customers = customers or [("C1", "Ann", "a@x", "2024-01-10", "c", "S1", "US", "g"),
                              ("C2", "Bob", "b@x", "02/01/2024", "c", "S2", "US", "g")]
    categories = categories or [("K1", "Root", ""), ("K2", "Child", "K1"), ("K3", "Other", "")]
    products = products or [("P1", "p1", "K2", "b", "$10.00", "true"),
                            ("P2", "p2", "", "b", "5.00", "0")]
    frames = {
        "customers": customers, "categories": categories, "products": products,
        "orders": orders, "order_items": items, "returns": list(returns),
    }
    landing = {k: spark.createDataFrame(v, landing_schema(k)) for k, v in frames.items()}
    return Warehouse(spark, landing, spine=SPINE, as_of=dt.date(2024, 12, 31))


def test_mom_gap_and_zero_previous(spark):
    orders = [("O1", "C1", "2024-01-05", "delivered", "paypal", "1.00"),
              ("O2", "C1", "2024-03-05", "delivered", "paypal", "1.00"),
              ("O3", "C2", "2024-04-05", "delivered", "paypal", "1.00"),
              ("O4", "C2", "2024-05-05", "cancelled", "paypal", "1.00")]
    items = [("I1", "O1", "P1", "1", "10.00", "0"), ("I2", "O2", "P1", "2", "10.00", "0"),
             ("I4", "O4", "P2", "1", "5.00", "0")]
    wh = _wh(spark, orders, items)
    got = {r.order_month: (r.revenue, r.prior_month_revenue, r.mom_growth_pct)
           for r in A.mom_growth_all(wh).collect()}
    # March compares with January (no February row); April's total is 0
    # (order without lines), so May's growth has a zero base and is NULL
    assert got[dt.date(2024, 3, 1)] == (Decimal("20.00"), Decimal("10.00"), 100.0)
    assert got[dt.date(2024, 4, 1)] == (Decimal("0.00"), Decimal("20.00"), -100.0)
    assert got[dt.date(2024, 5, 1)] == (Decimal("5.00"), Decimal("0.00"), None)
    net = {r.month for r in A.mom_growth_net(wh).collect()}
    assert dt.date(2024, 5, 1) not in net


def test_order_without_lines_and_returned_rule(spark):
    orders = [("O1", "C1", "2024-01-05", "returned", "paypal", "0.00"),
              ("O2", "C2", "2024-01-06", "returned", "paypal", "0.00")]
    items = [("I1", "O1", "P1", "3", "10.05", "15")]
    returns = [("R1", "I1", "2024-01-20", "defective", "20.00")]
    wh = _wh(spark, orders, items, returns)
    totals = {r.order_id: r.total_amount for r in wh.fct_orders.collect()}
    assert totals == {"O1": Decimal("25.63"), "O2": Decimal("0.00")}
    from martforge.operators.quality import dq_returned_has_return
    bad = dq_returned_has_return(wh.fct_orders, wh.fct_order_items, wh.fct_returns)
    assert [r.order_id for r in bad.collect()] == ["O2"]


def test_rollup_counts_root_and_skips_uncategorised(spark):
    orders = [("O1", "C1", "2024-01-05", "delivered", "paypal", "0.00")]
    items = [("I1", "O1", "P1", "1", "10.00", "0"), ("I2", "O1", "P2", "1", "5.00", "0")]
    wh = _wh(spark, orders, items)
    got = {r.category_name: (r.subcategory_count, r.total_sales, r.line_item_count)
           for r in A.category_rollup_lines(wh).collect()}
    assert got == {"Root": (2, Decimal("10.00"), 1), "Other": (1, Decimal("0.00"), 0)}


def test_ltv_fanout_counts_order_total_per_line(spark):
    orders = [("O1", "C1", "2024-01-05", "delivered", "paypal", "0.00")]
    items = [("I1", "O1", "P1", "1", "10.00", "0"), ("I2", "O1", "P2", "1", "5.00", "0")]
    returns = [("R1", "I1", "2024-01-20", "defective", "4.00"), ("R2", "I1", "2024-01-21", "defective", "1.00")]
    wh = _wh(spark, orders, items, returns)
    fan = {r.customer_key: r.lifetime_value for r in A.customer_ltv_fanout(wh).collect()}
    fair = {r.customer_key: r.lifetime_value for r in A.customer_ltv(wh).collect()}
    # rows: I1 x R1, I1 x R2, I2 -> total 15 counted 3 times, refunds 5
    assert fan == {1: Decimal("40.00")}
    assert fair == {1: Decimal("10.00")}
    summary = {r.customer_key: (r.total_orders, r.lifetime_value, r.last_order_date)
               for r in A.customer_summary(wh).collect()}
    assert summary[2] == (0, Decimal("0.00"), None)


def test_cohorts(spark):
    orders = [("O1", "C1", "2024-01-15", "delivered", "paypal", "0.00"),
              ("O2", "C1", "2024-03-15", "delivered", "paypal", "0.00"),
              ("O3", "C2", "2024-01-20", "delivered", "paypal", "0.00")]
    wh = _wh(spark, orders, [])
    first = {(r.cohort_month, r.month_number): r.retention_pct for r in A.cohort_first_order(wh).collect()}
    assert first == {(dt.date(2024, 1, 1), 0): 100.0, (dt.date(2024, 1, 1), 2): 50.0}
    signup = {(r.cohort_month, r.month_number): (r.cohort_size, r.active_customers)
              for r in A.cohort_signup(wh).collect()}
    # C2 signed up in February: its January order is before the cohort and dropped
    assert signup == {(dt.date(2024, 1, 1), 0): (1, 1), (dt.date(2024, 1, 1), 2): (1, 1)}


def test_dbt_suite_passes_on_clean_frames(spark):
    orders = [("O1", "C1", "2024-01-15", "delivered", "paypal", "0.00")]
    items = [("I1", "O1", "P1", "1", "10.00", "0")]
    wh = _wh(spark, orders, items)
    report = C.run_checks(wh, C.DBT_SUITE)
    assert report.count() == 50
    assert report.filter(F.col("failing_rows") > 0).count() == 0


def test_dbt_suite_catches_broken_frames(spark):
    orders = [("O1", "C9", "2024-01-15", "lost", "paypal", "0.00"),
              ("O1", "C1", "2024-01-16", "placed", "paypal", "0.00")]
    items = [("I1", "O1", "P7", "1", "10.00", "0")]
    wh = _wh(spark, orders, items)
    report = {r.check_name: r.failing_rows for r in C.run_checks(wh, C.DBT_SUITE).collect()}
    assert report["unique_stg_orders_order_id"] == 1
    assert report["relationships_stg_orders_customer_id_stg_customers"] == 1
    assert report["accepted_values_stg_orders_order_status"] == 1
    assert report["relationships_stg_order_items_product_id_stg_products"] == 1


def test_ltv_for_given_keys_and_sql_views(spark):
    from martforge.plans.warehouse import register_views
    orders = [("O1", "C1", "2024-01-05", "delivered", "paypal", "0.00"),
              ("O2", "C2", "2024-01-06", "delivered", "paypal", "0.00")]
    items = [("I1", "O1", "P1", "1", "10.00", "0"), ("I2", "O2", "P2", "1", "5.00", "0")]
    wh = _wh(spark, orders, items)
    keys = spark.createDataFrame([(2,)], "customer_key long")
    got = {r.customer_key: r.lifetime_value for r in A.customer_ltv_fanout(wh, customer_keys=keys).collect()}
    assert got == {2: Decimal("5.00")}
    # the stored function answers 0 for a key without orders
    asked = spark.createDataFrame([(2,), (99,)], "customer_key long")
    got = {r.customer_key: r.lifetime_value for r in A.fn_customer_ltv(wh, customer_keys=asked).collect()}
    assert got == {2: Decimal("5.00"), 99: Decimal("0.00")}
    names = register_views(wh, prefix="t_")
    assert "t_fct_orders" in names
    assert spark.sql("SELECT count(*) FROM t_fct_orders").first()[0] == 2
