"""Business questions on top of the star schema (the marts).

Two builds exist in the source and they disagree in places; both forms are
offered under separate names:

* dbt-style marts: ``mom_growth_all``, ``customer_rfm``, ``cohort_signup``,
  ``category_rollup_lines``;
* hand-written queries: ``mom_growth_net`` (drops cancelled orders),
  ``customer_rfm_named`` / ``sort_rfm_top20``, ``cohort_first_order``,
  ``category_rollup_units``, ``customer_ltv_fanout`` (the stored function).

Every aggregate runs map-side first (partial aggregation), so a customer,
month or state holding a third of all rows costs one partial row per task.
Series over months are bounded by the calendar and may meet in one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.constants import RFM_BUCKETS, RFM_DEFAULT_SEGMENT, RFM_SEGMENTS
from martforge.functions.clean import SUM_MONEY, money_sum, pct
from martforge.functions.dates import date_key, month_distance, month_start
from martforge.operators.hierarchy import walk_from_roots
from martforge.operators.quantiles import Tiles, with_exact_ntiles
from martforge.operators.ranking import with_global_rank
from martforge.plans.warehouse import Warehouse


def _dates(wh: Warehouse, *cols: str) -> DataFrame:
    """The calendar, broadcast: its size is fixed by the spine's two dates."""
    return F.broadcast(wh.dim_date.select(*cols))


def orders_with_dates(wh: Warehouse) -> DataFrame:
    """Orders joined to the calendar (inner: orders without a date key drop)."""
    d = _dates(wh, F.col("date_key").alias("order_date_key"), "full_date")
    return wh.fct_orders.join(d, "order_date_key", "inner")


# --- month over month ---------------------------------------------------------

def _monthly_growth(orders: DataFrame, month_col: str, prev_col: str) -> DataFrame:
    monthly = orders.groupBy(month_start("full_date").alias(month_col)).agg(
        money_sum("total_amount").alias("revenue"))
    # one row per calendar month: the ordered window may run in one task
    w = Window.orderBy(month_col)
    prev = F.lag("revenue").over(w)
    return monthly.select(
        month_col,
        "revenue",
        prev.alias(prev_col),
        pct(F.col("revenue") - prev, prev, 2).alias("mom_growth_pct"),
    )


def mom_growth_all(wh: Warehouse) -> DataFrame:
    """Revenue per month with the previous present month and growth %,
    every status included (dbt mart)."""
    return _monthly_growth(orders_with_dates(wh), "order_month", "prior_month_revenue")


def mom_growth_net(wh: Warehouse) -> DataFrame:
    """Same without cancelled orders (hand-written query); a NULL status
    is dropped too, as ``status <> 'cancelled'`` is not true for it."""
    orders = orders_with_dates(wh).filter(F.col("order_status") != "cancelled")
    return _monthly_growth(orders, "month", "prev_month_revenue").orderBy("month")


def running_total(wh: Warehouse) -> DataFrame:
    """Revenue per month with its running total (promised in the source's
    comment; the window frame is rows from the first month to this one)."""
    monthly = orders_with_dates(wh).groupBy(month_start("full_date").alias("order_month")).agg(
        money_sum("total_amount").alias("revenue"))
    w = Window.orderBy("order_month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly.select("order_month", "revenue",
                          F.sum("revenue").over(w).cast(SUM_MONEY).alias("running_revenue"))


# --- RFM ------------------------------------------------------------------------------

def _segment(total: Column) -> Column:
    expr = None
    for threshold, name in RFM_SEGMENTS:
        cond = total >= threshold
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(RFM_DEFAULT_SEGMENT))


def _score(facts: DataFrame, as_of: dt.date, r: str, f: str, m: str) -> DataFrame:
    """Three global quintiles, their cuts found by selection.  Ties are broken
    by customer_key so the result is repeatable; NULL recency (no dated order)
    sorts first, as in the source database's descending order."""
    recency = F.datediff(F.lit(as_of), F.col("last_order_date"))
    return with_exact_ntiles(
        facts.withColumn("recency_days", recency),
        [Tiles(r, "recency_days", descending=True, nulls_first=True), Tiles(f, "frequency"), Tiles(m, "monetary")],
        "customer_key", RFM_BUCKETS)


def _once(wh: Warehouse, what: tuple, build: Callable[[], DataFrame]) -> DataFrame:
    """Scored tables are built once for a warehouse and shared by their readers."""
    scored = wh.__dict__.setdefault("_scored", {})
    if what not in scored:
        scored[what] = build()
    return scored[what]


def customer_rfm(wh: Warehouse, as_of: dt.date | None = None) -> DataFrame:
    """dbt mart: one row per customer with orders (every status)."""
    as_of = as_of or wh.as_of
    return _once(wh, ("customer_rfm", as_of), lambda: _customer_rfm(wh, as_of))


def _customer_rfm(wh: Warehouse, as_of: dt.date) -> DataFrame:
    facts = wh.int_customer_order_facts.join(
        wh.dim_customer.select("customer_id", "customer_key"), "customer_id", "inner"
    ).select("customer_key", "last_order_date", "frequency", "monetary")
    s = _score(facts, as_of, "r_score", "f_score", "m_score")
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return s.select(
        "customer_key", "last_order_date", "frequency", "monetary",
        "r_score", "f_score", "m_score",
        total.cast("int").alias("rfm_total"),
        _segment(total).alias("segment"),
    )


def rfm_segment_counts(wh: Warehouse, as_of: dt.date | None = None) -> DataFrame:
    return customer_rfm(wh, as_of).groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))


def customer_rfm_named(wh: Warehouse, as_of: dt.date | None = None) -> DataFrame:
    """Hand-written form: customers joined to their *dated* orders, with the
    name and recency in days."""
    as_of = as_of or wh.as_of
    return _once(wh, ("customer_rfm_named", as_of), lambda: _customer_rfm_named(wh, as_of))


def _customer_rfm_named(wh: Warehouse, as_of: dt.date) -> DataFrame:
    facts = (
        orders_with_dates(wh)
        .groupBy("customer_key")
        .agg(F.max("full_date").alias("last_order_date"),
             # order_key is unique in the fact: the count is the distinct count
             F.count("order_key").alias("frequency"),
             money_sum("total_amount").alias("monetary"))
        .join(wh.dim_customer.select("customer_key", "full_name"), "customer_key", "inner")
    )
    s = _score(facts, as_of, "recency_score", "frequency_score", "monetary_score")
    total = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    return s.select(
        "customer_key", "full_name", "recency_days", "frequency", "monetary",
        "recency_score", "frequency_score", "monetary_score",
        total.cast("int").alias("rfm_total"),
        _segment(total).alias("rfm_segment"),
    )


def rfm_build_parity(wh: Warehouse, as_of: dt.date | None = None) -> DataFrame:
    """Customers per segment in both builds side by side (the reference
    compares the two builds' RFM split).  The model build scores every
    order; the hand-written one only dated orders."""
    a = customer_rfm(wh, as_of).groupBy("segment").agg(F.count(F.lit(1)).alias("model_build"))
    b = customer_rfm_named(wh, as_of).groupBy(F.col("rfm_segment").alias("segment")).agg(
        F.count(F.lit(1)).alias("handwritten_build"))
    return a.join(b, "segment", "full").select(
        "segment",
        F.coalesce("model_build", F.lit(0)).cast("long").alias("model_build"),
        F.coalesce("handwritten_build", F.lit(0)).cast("long").alias("handwritten_build"))


def sort_rfm_top20(wh: Warehouse, as_of: dt.date | None = None, n: int = 20) -> DataFrame:
    """The 20 best RFM totals (a top-k: each task keeps its own 20 first)."""
    return customer_rfm_named(wh, as_of).orderBy(
        F.col("rfm_total").desc(), F.col("customer_key").asc()).limit(n)


# --- cohorts ------------------------------------------------------------------------

def cohort_signup(wh: Warehouse) -> DataFrame:
    """dbt mart: cohort = signup month; orders before it are dropped; the
    cohort size counts customers who never ordered."""
    first_month = wh.dim_customer.filter(F.col("signup_date").isNotNull()).select(
        "customer_key", month_start("signup_date").alias("cohort_month"))
    orders_by_month = orders_with_dates(wh).select(
        "customer_key", month_start("full_date").alias("order_month")).distinct()
    activity = (
        first_month.join(orders_by_month, "customer_key", "inner")
        .filter(F.col("order_month") >= F.col("cohort_month"))
        .select("cohort_month", "customer_key",
                month_distance("order_month", "cohort_month").alias("month_number"))
    )
    # one row per signup month: bounded by the calendar
    sizes = first_month.groupBy("cohort_month").agg(
        F.count_distinct("customer_key").alias("cohort_size"))
    active = activity.groupBy("cohort_month", "month_number").agg(
        F.count_distinct("customer_key").alias("active_customers"))
    return active.join(F.broadcast(sizes), "cohort_month", "inner").select(
        "cohort_month", "month_number", "cohort_size", "active_customers",
        pct("active_customers", "cohort_size", 1).alias("retention_pct"))


def cohort_first_order(wh: Warehouse) -> DataFrame:
    """Hand-written query: cohort = month of the first dated order, so
    month 0 is always 100%."""
    # (customer, month) pairs: partial-aggregated before any join
    om = orders_with_dates(wh).select(
        "customer_key", month_start("full_date").alias("order_month")).distinct()
    first = om.groupBy("customer_key").agg(F.min("order_month").alias("cohort_month"))
    activity = (
        om.join(first, "customer_key", "inner")
        .groupBy("cohort_month", "order_month")
        .agg(F.count_distinct("customer_key").alias("active_customers"))
        .select("cohort_month", month_distance("order_month", "cohort_month").alias("month_number"),
                "active_customers")
    )
    sizes = first.groupBy("cohort_month").agg(F.count_distinct("customer_key").alias("cohort_customers"))
    return activity.join(F.broadcast(sizes), "cohort_month", "inner").select(
        "cohort_month", "month_number", "active_customers", "cohort_customers",
        pct("active_customers", "cohort_customers", 1).alias("retention_pct"),
    ).orderBy("cohort_month", "month_number")


# --- category roll-ups ----------------------------------------------------------

def category_tree(wh: Warehouse) -> DataFrame:
    """Every category reachable from a root, with its root's key, id and name.
    Walked once per warehouse; the roll-ups share it."""
    cached = wh.__dict__.get("_category_tree")
    if cached is None:
        nodes = wh.dim_category.select("category_key", "category_id", "category_name",
                                       "parent_category_id")
        cached = walk_from_roots(
            nodes, "category_id", "parent_category_id",
            {"root_category_key": "category_key", "root_category_id": "category_id",
             "root_category_name": "category_name"})
        wh.__dict__["_category_tree"] = cached
    return cached


def _sales_by_category(wh: Warehouse) -> DataFrame:
    """Lines aggregated to one row per category before meeting the tree."""
    items = wh.fct_order_items.select("product_key", "line_total", "quantity")
    prods = wh.dim_product.select("product_key", "category_key")
    return items.join(prods, "product_key", "inner").groupBy("category_key").agg(
        F.sum("line_total").alias("sales"),
        F.count("line_total").alias("lines"),
        F.sum("quantity").alias("units"),
    )


def category_rollup_lines(wh: Warehouse) -> DataFrame:
    """dbt mart: per root, categories under it (itself included), sales and
    the number of lines; products without a category are left out."""
    tree = category_tree(wh)
    sales = _sales_by_category(wh)
    return (
        tree.join(sales, "category_key", "left")
        .groupBy(F.col("root_category_key").alias("category_key"),
                 F.col("root_category_name").alias("category_name"))
        .agg(F.count_distinct("category_key").alias("subcategory_count"),
             F.coalesce(F.sum("sales"), F.lit(0)).cast(SUM_MONEY).alias("total_sales"),
             F.coalesce(F.sum("lines"), F.lit(0)).cast("long").alias("line_item_count"))
    )


def category_rollup_units(wh: Warehouse) -> DataFrame:
    """Hand-written query: per root, categories, sales and units sold."""
    tree = category_tree(wh)
    sales = _sales_by_category(wh)
    return (
        tree.join(sales, "category_key", "left")
        .groupBy(F.col("root_category_id").alias("top_level_category_id"),
                 F.col("root_category_name").alias("top_level_category_name"))
        .agg(F.count_distinct("category_id").alias("subcategory_count"),
             F.coalesce(F.sum("sales"), F.lit(0)).cast(SUM_MONEY).alias("total_sales"),
             F.coalesce(F.sum("units"), F.lit(0)).cast("long").alias("total_units_sold"))
        .orderBy(F.col("total_sales").desc(), F.col("top_level_category_id").asc())
    )


# --- lifetime value ------------------------------------------------------------------

def _returns_per_item(wh: Warehouse) -> DataFrame:
    return wh.fct_returns.groupBy("order_item_key").agg(
        F.count(F.lit(1)).alias("n_returns"), F.sum("refund_amount").alias("refunds"))


def _dated_orders_until(wh: Warehouse, as_of: dt.date) -> DataFrame:
    # date keys grow with the date, so the bound also prunes the fact scan
    return orders_with_dates(wh).filter(
        (F.col("full_date") <= F.lit(as_of)) & (F.col("order_date_key") <= date_key(F.lit(as_of))))


def _fanout_per_order(wh: Warehouse) -> DataFrame:
    """Per order: how many rows the source's orders-lines-returns join makes
    (sum over its lines of max(1, returns)) and its refunds; two partial
    aggregates, the fan-out itself is never built."""
    per_item = wh.fct_order_items.select("order_item_key", "order_key").join(
        _returns_per_item(wh), "order_item_key", "left")
    return per_item.groupBy("order_key").agg(
        F.sum(F.greatest(F.coalesce(F.col("n_returns"), F.lit(0)), F.lit(1))).alias("fan"),
        F.sum("refunds").alias("refunds"))


def _fanout_ltv(total: Column, fan: Column, refunds: Column, keep: Column) -> Column:
    """coalesce(sum(total over fan-out rows), 0) - coalesce(sum(refunds), 0)
    over the rows ``keep`` selects."""
    rows = F.coalesce(fan, F.lit(1)).cast("decimal(20,0)")
    return (F.coalesce(F.sum(F.when(keep, total * rows)), F.lit(0))
            - F.coalesce(F.sum(F.when(keep, refunds)), F.lit(0))).cast(SUM_MONEY)


def customer_ltv_fanout(wh: Warehouse, as_of: dt.date | None = None,
                        customer_keys: DataFrame | None = None) -> DataFrame:
    """The stored function as written: order totals summed over the rows of
    orders LEFT JOIN lines LEFT JOIN returns, so an order's total counts once
    per line (and per return of a line), minus all refunds; dated orders up
    to ``as_of``.  One row per customer with such an order.

    The source calls the function once per customer; here it is one grouped
    job for all customers, or for the ``customer_keys`` given (a frame with a
    ``customer_key`` column, applied as a semi join before aggregating)."""
    as_of = as_of or wh.as_of
    orders = _dated_orders_until(wh, as_of)
    if customer_keys is not None:
        orders = orders.join(customer_keys.select("customer_key"), "customer_key", "left_semi")
    rows = orders.join(_fanout_per_order(wh), "order_key", "left")
    return rows.groupBy("customer_key").agg(
        _fanout_ltv(F.col("total_amount"), F.col("fan"), F.col("refunds"), F.lit(True))
        .alias("lifetime_value"))


def fn_customer_ltv(wh: Warehouse, as_of: dt.date | None = None,
                    customer_keys: DataFrame | None = None) -> DataFrame:
    """The stored function for every customer, or for each distinct key of
    ``customer_keys``: a key without dated orders, known or not, gets 0."""
    keys = (wh.dim_customer if customer_keys is None else customer_keys).select("customer_key").distinct()
    values = customer_ltv_fanout(wh, as_of, customer_keys)
    return keys.join(values, "customer_key", "left").select(
        "customer_key", F.coalesce("lifetime_value", F.lit(0).cast(SUM_MONEY)).alias("lifetime_value"))


def _refunds_per_order(wh: Warehouse) -> DataFrame:
    return wh.fct_order_items.select("order_item_key", "order_key").join(
        _returns_per_item(wh), "order_item_key", "inner").groupBy("order_key").agg(
        F.sum("refunds").alias("refunds"))


def customer_ltv(wh: Warehouse, as_of: dt.date | None = None) -> DataFrame:
    """The stated intent: each dated order counted once, minus the refunds
    of its lines."""
    as_of = as_of or wh.as_of
    rows = _dated_orders_until(wh, as_of).join(_refunds_per_order(wh), "order_key", "left")
    return rows.groupBy("customer_key").agg(
        (F.sum("total_amount") - F.coalesce(F.sum("refunds"), F.lit(0))).cast(SUM_MONEY)
        .alias("lifetime_value"))


def customer_summary(wh: Warehouse, as_of: dt.date | None = None,
                     faithful: bool = True) -> DataFrame:
    """Every customer: orders (all, dated or not), lifetime value, last
    dated order; customers without orders get 0, 0 and NULL.

    One grouping by customer computes all three: the order count and last
    date over every order, the lifetime value over the dated orders up to
    ``as_of`` (``faithful`` = the source's fan-out form)."""
    as_of = as_of or wh.as_of
    d = _dates(wh, F.col("date_key").alias("order_date_key"), "full_date")
    orders = wh.fct_orders.select("order_key", "customer_key", "order_date_key", "total_amount")
    keep = F.col("full_date") <= F.lit(as_of)
    if faithful:
        rows = orders.join(d, "order_date_key", "left").join(_fanout_per_order(wh), "order_key", "left")
        ltv = _fanout_ltv(F.col("total_amount"), F.col("fan"), F.col("refunds"), keep)
    else:
        refunds = _refunds_per_order(wh)
        rows = orders.join(d, "order_date_key", "left").join(refunds, "order_key", "left")
        ltv = (F.coalesce(F.sum(F.when(keep, F.col("total_amount"))), F.lit(0))
               - F.coalesce(F.sum(F.when(keep, F.col("refunds"))), F.lit(0))).cast(SUM_MONEY)
    per_cust = rows.groupBy("customer_key").agg(
        # order_key is the table's unique key and every join here is
        # one-to-one, so a plain count is the distinct count
        F.count("order_key").alias("total_orders"),
        F.max("full_date").alias("last_order_date"),
        ltv.alias("lifetime_value"))
    return (
        wh.dim_customer.select("customer_key")
        .join(per_cust, "customer_key", "left")
        .select("customer_key",
                F.coalesce(F.col("total_orders"), F.lit(0)).cast("int").alias("total_orders"),
                F.coalesce(F.col("lifetime_value"), F.lit(0)).cast(SUM_MONEY).alias("lifetime_value"),
                "last_order_date")
    )


def ltv_row_counts(wh: Warehouse, as_of: dt.date | None = None) -> DataFrame:
    s = customer_summary(wh, as_of)
    return s.agg(
        F.count(F.lit(1)).alias("customers"),
        F.round(F.avg(F.col("lifetime_value").cast("double")), 2).alias("avg_ltv"),
        F.max("lifetime_value").alias("max_ltv"),
    )


# --- refunds and point lookups -------------------------------------------------------

def refunds_by_state_reason(wh: Warehouse, as_of: dt.date | None = None) -> DataFrame:
    """Returns of the trailing 12 months by customer state and reason."""
    as_of = as_of or wh.as_of
    since = F.add_months(F.lit(as_of), -12)
    d = _dates(wh, F.col("date_key").alias("return_date_key"), "full_date")
    recent = (
        wh.fct_returns
        # date keys grow with the date: the same bound on the key prunes the scan
        .filter(F.col("return_date_key") >= date_key(since))
        .join(d, "return_date_key", "inner")
        .filter(F.col("full_date") >= since)
    )
    items = wh.fct_order_items.select("order_item_key", "order_key")
    orders = wh.fct_orders.select("order_key", "customer_key")
    cust = wh.dim_customer.select("customer_key", "state")
    # aggregate to (customer, reason) before meeting the customer table, so
    # that join sees one row per customer and reason instead of every return
    per_customer = (
        recent.join(items, "order_item_key", "inner")
        .join(orders, "order_key", "inner")
        .groupBy("customer_key", "return_reason")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("refund_amount").alias("refunded"))
    )
    return (
        per_customer.join(cust, "customer_key", "inner")
        .groupBy("state", "return_reason")
        .agg(F.sum("n").alias("return_count"),
             F.sum("refunded").cast(SUM_MONEY).alias("total_refunded"))
        .orderBy(F.col("total_refunded").desc(), "state", "return_reason")
    )


def customer_order_history(wh: Warehouse, customer_key: int = 123) -> DataFrame:
    """One customer's orders, newest first (a point lookup on customer_key)."""
    d = _dates(wh, F.col("date_key").alias("order_date_key"), "full_date")
    return (
        wh.fct_orders.filter(F.col("customer_key") == customer_key)
        .join(d, "order_date_key", "inner")
        .select("order_id", "order_status", "total_amount", "full_date")
        .orderBy(F.col("full_date").desc(), F.col("order_id").asc())
    )


# --- dashboards -------------------------------------------------------------------

def bi_revenue_overview(wh: Warehouse, as_of: dt.date | None = None) -> DataFrame:
    """Total revenue, month-over-month growth and refunds by state, as one
    long frame (section, label, amount, pct)."""
    total = orders_with_dates(wh).agg(money_sum("total_amount").alias("amount")).select(
        F.lit("total_revenue").alias("section"), F.lit(None).cast("string").alias("label"),
        "amount", F.lit(None).cast("double").alias("pct"))
    mom = mom_growth_all(wh).select(
        F.lit("mom_growth").alias("section"), F.date_format("order_month", "yyyy-MM").alias("label"),
        F.col("revenue").alias("amount"), F.col("mom_growth_pct").alias("pct"))
    refunds = refunds_by_state_reason(wh, as_of).groupBy("state").agg(
        money_sum("total_refunded").alias("amount")).select(
        F.lit("refunds_by_state").alias("section"), F.col("state").alias("label"), "amount",
        F.lit(None).cast("double").alias("pct"))
    return total.unionByName(mom).unionByName(refunds)


def bi_segments(wh: Warehouse, as_of: dt.date | None = None, top_n: int | None = None,
                state: str | None = None, cohort_month: dt.date | None = None) -> DataFrame:
    """Customers by monetary value within their state, optionally of one state
    and one signup cohort, and only the first ``top_n`` of a state if asked for.
    The rank is the global rank by (state, value) less that of the state's first
    customer, so a state holding a third of all customers is ranked by many
    tasks."""
    rfm = customer_rfm(wh, as_of)
    cust = wh.dim_customer.select("customer_key", "full_name", "state",
                                  month_start("signup_date").alias("cohort_month"))
    df = rfm.join(cust, "customer_key", "inner")
    if state is not None:
        df = df.filter(F.col("state") == state)
    if cohort_month is not None:
        df = df.filter(F.col("cohort_month") == F.lit(cohort_month))
    ranked = with_global_rank(df, ["state", F.col("monetary").desc(), "customer_key"], "_mf_rank")
    first = ranked.groupBy(F.col("state").alias("_mf_state")).agg(F.min("_mf_rank").alias("_mf_first"))
    ranked = ranked.join(first, F.col("state").eqNullSafe(F.col("_mf_state"))).withColumn(
        "rank_in_state", (F.col("_mf_rank") - F.col("_mf_first") + 1).cast("int"))
    if top_n is not None:
        ranked = ranked.filter(F.col("rank_in_state") <= top_n)
    return (
        ranked.select("state", "rank_in_state", "customer_key", "full_name", "cohort_month",
                "monetary", "segment")
    )


def bi_category_performance(wh: Warehouse) -> DataFrame:
    return category_rollup_lines(wh).select("category_name", "total_sales", "line_item_count")
