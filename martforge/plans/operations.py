"""Load operations on the warehouse: status updates with audit, stamping,
idempotent inserts, appends, back-fills, the summary refresh and publish.

The "later extract" of order statuses comes from the driver's own order
status column (F = finished, O = open): an order still placed or shipped
whose source row says finished moves to delivered, a placed order whose
source row says open moves to shipped.  Only orders with news (F or O) are
in that extract.
"""

from __future__ import annotations

import copy
import datetime as dt
import logging
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.clean import SUM_MONEY
from martforge.operators.changes import (
    apply_updates,
    audit_status_changes,
    backfill_column,
    insert_ignore,
    touch_updated_at,
)
from martforge.plans import analytics as A
from martforge.plans import checks as C
from martforge.plans.publish import append_table, atomic_publish, published_row_counts
from martforge.plans.staging import CUSTOMER_COLUMNS, customers_typed
from martforge.plans.warehouse import LAYOUT, Warehouse
from martforge.session import scratch_path
from martforge.sources.driver import read_table
from martforge.sources.landing import source_id
from martforge.streaming.audit_stream import run_audit_once

log = logging.getLogger("martforge")

# --- fixed values: status moves of the later extract ---------------------------
FINISHED, OPEN = "F", "O"
LOAD_TIME = dt.datetime(2002, 1, 1, 0, 0, 0)      # stamp of the initial load
UPDATE_TIME = dt.datetime(2002, 1, 2, 0, 0, 0)    # stamp of the update batch
EARLIER_LOAD_BEFORE = dt.date(1997, 1, 1)          # customers loaded earlier


def _run_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def orders_status_update(wh: Warehouse, spark: SparkSession, sf_dir: str) -> DataFrame:
    src = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"]).filter(
        F.col("o_orderstatus").isin(FINISHED, OPEN))
    src = src.select(
        source_id("ORD", F.col("o_orderkey")).alias("order_id"), "o_orderstatus")
    cur = wh.fct_orders.select("order_id", "order_key", "order_status")
    s = F.col("order_status")
    new = (
        F.when((F.col("o_orderstatus") == FINISHED) & s.isin("placed", "shipped"), F.lit("delivered"))
        .when((F.col("o_orderstatus") == OPEN) & (s == "placed"), F.lit("shipped"))
        .otherwise(s)
    )
    return cur.join(src, "order_id", "inner").select("order_key", new.alias("order_status"))


def audit_status_changes_job(wh: Warehouse, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit rows of the update batch, numbered like the audit table's
    serial key (``audit_id``, in order key order; ``changed_at`` is the
    write time and left out)."""
    from martforge.operators.ranking import with_surrogate_key
    changes = audit_status_changes(wh.fct_orders, orders_status_update(wh, spark, sf_dir),
                                   "order_key", "order_status")
    return with_surrogate_key(changes, ["order_key"], "audit_id")


def touch_updated_at_job(wh: Warehouse, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the update batch is stamped (changed or not)."""
    current = wh.fct_orders.select("order_key", "order_status",
                                   F.lit(LOAD_TIME).alias("updated_at"))
    updated = touch_updated_at(current, orders_status_update(wh, spark, sf_dir), "order_key",
                               stamp=F.lit(UPDATE_TIME))
    return updated.select("order_key", "order_status",
                          (F.col("updated_at") == F.lit(UPDATE_TIME)).alias("touched"))


def insert_ignore_job(wh: Warehouse) -> DataFrame:
    """Customers loaded earlier stay as they are; the new extract (all raw
    rows, duplicates included) inserts only customers not yet present,
    first by raw text order."""
    existing = wh.stg_customers.filter(F.col("signup_date") < F.lit(EARLIER_LOAD_BEFORE))
    incoming = customers_typed(wh.landing["customers"], wh.strict)
    order = [F.col("_signup_text").asc_nulls_last()] + [
        F.col(c).asc_nulls_last() for c in CUSTOMER_COLUMNS if c != "customer_id"]
    return insert_ignore(incoming, existing, ["customer_id"], order).select(*CUSTOMER_COLUMNS)


def append_facts_job(wh: Warehouse, spark: SparkSession) -> DataFrame:
    """The source's plain fact insert run twice: every return is there twice."""
    path = _run_dir(spark, "append_facts")
    batch = wh.fct_returns.drop("return_key")
    append_table(batch, path)
    append_table(batch, path)
    return spark.read.parquet(path)


def backfill_order_totals_job(wh: Warehouse) -> DataFrame:
    """Orders loaded with total 0, then updated from the sum of their lines;
    orders without lines keep 0."""
    loaded = wh.fct_orders.select("order_key", F.lit(0).cast(SUM_MONEY).alias("total_amount"))
    sums = wh.fct_order_items.groupBy("order_key").agg(
        F.sum("line_total").cast(SUM_MONEY).alias("total_amount"))
    return backfill_column(loaded, sums, "order_key", "total_amount")


def refresh_customer_summary(wh: Warehouse, spark: SparkSession, path: str | None = None) -> DataFrame:
    """Rebuild the summary table (full overwrite, with refresh time) and
    return it as read back, without the time column."""
    from pyspark.sql import Observation

    path = path or _run_dir(spark, "customer_summary")
    summary = A.customer_summary(wh).withColumn("refreshed_at", F.current_timestamp())
    written = Observation("customer_summary")
    # the row count is observed while writing (no second pass)
    summary.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    log.info("customer_summary refreshed: %s rows", written.get["rows"])
    return spark.read.parquet(path).drop("refreshed_at")


STAR_TABLES = ["dim_date", "dim_category", "dim_customer", "dim_product", "fct_orders",
               "fct_order_items", "fct_returns"]


def atomic_publish_job(wh: Warehouse, spark: SparkSession) -> DataFrame:
    root = _run_dir(spark, "published")

    def report(written: dict[str, DataFrame]) -> DataFrame:
        # the same models, the star tables read from the written files
        on_files = copy.copy(wh)
        on_files.__dict__.pop("_scored", None)  # scores of the unwritten models
        on_files.__dict__.update(written)
        return C.run_checks(on_files, C.DBT_SUITE)

    atomic_publish(spark, {t: getattr(wh, t) for t in STAR_TABLES}, root, checks=report, layout=LAYOUT)
    return published_row_counts(spark, root, STAR_TABLES)


def audit_status_stream_job(wh: Warehouse, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two extracts arrive one after the other; the stream logs the changes."""
    base = _run_dir(spark, "audit_stream")
    src, sink, ckpt = f"{base}/source", f"{base}/sink", f"{base}/checkpoint"
    first = wh.fct_orders.select("order_key", "order_status", F.lit(0).cast("long").alias("snapshot_seq"))
    second = orders_status_update(wh, spark, sf_dir).select(
        "order_key", "order_status", F.lit(1).cast("long").alias("snapshot_seq"))
    first.write.mode("append").parquet(src)
    run_audit_once(spark, src, sink, ckpt)
    second.write.mode("append").parquet(src)
    run_audit_once(spark, src, sink, ckpt)
    return spark.read.parquet(sink).select("order_key", "old_order_status", "new_order_status")


def join_returns_by_product(wh: Warehouse) -> DataFrame:
    """The hand-written load's return fact: a return finds its line through
    the raw line's order and *product* (not the line id), so an order with
    the same product on two lines matches both.  The source looks the
    product up with a correlated subquery in the join condition; here it is
    one more equi-join."""
    from martforge.functions.clean import MONEY, parse_money
    from martforge.functions.dates import date_key

    r = wh.landing["returns"]
    oi_raw = wh.landing["order_items"].select("order_item_id", "order_id", "product_id")
    orders = wh.fct_orders.select("order_id", "order_key")
    prods = wh.dim_product.select("product_id", "product_key")
    items = wh.fct_order_items.select("order_key", "product_key", "order_item_key")
    return (
        r.join(oi_raw, "order_item_id", "inner")
        .join(orders, "order_id", "inner")
        .join(prods, "product_id", "inner")
        .join(items, ["order_key", "product_key"], "inner")
        .select("order_item_key",
                date_key(F.col("return_date").cast("date")).alias("return_date_key"),
                "return_reason",
                parse_money("refund_amount", MONEY).alias("refund_amount"))
    )


def layout_point_lookup(wh: Warehouse, spark: SparkSession, customer_key: int = 123) -> DataFrame:
    """The point lookup on a table laid out for it: orders range-partitioned
    and sorted by customer_key, so Parquet min/max statistics let the scan
    skip every row group but the customer's (the index of the source)."""
    from martforge.plans.publish import write_table

    path = _run_dir(spark, "fct_orders_by_customer")
    write_table(wh.fct_orders, path, sort_by=["customer_key", "order_key"])
    d = F.broadcast(wh.dim_date.select(F.col("date_key").alias("order_date_key"), "full_date"))
    return (
        spark.read.parquet(path).filter(F.col("customer_key") == customer_key)
        .join(d, "order_date_key", "inner")
        .select("order_id", "order_status", "total_amount", "full_date")
        .orderBy(F.col("full_date").desc(), F.col("order_id").asc())
    )


# --- CSV landing round trip -----------------------------------------------------

def landing_csv_paths(wh: Warehouse, spark: SparkSession) -> dict[str, str]:
    """``load_raw_full_refresh``: write the six landing extracts as header CSV
    (overwrite), once per warehouse."""
    from martforge.sources.landing import ROWS_PER_FILE, write_landing_csv
    paths = getattr(wh, "_csv_paths", None)
    if paths is None:
        paths = write_landing_csv(wh.landing, _run_dir(spark, "landing_csv"), ROWS_PER_FILE)
        wh._csv_paths = paths
    return paths


def csv_landing(wh: Warehouse, spark: SparkSession) -> dict[str, DataFrame]:
    """``scan_raw_csv`` of every landing CSV with its fixed all-string schema."""
    from martforge.sources.landing import scan_raw_csv
    return {t: scan_raw_csv(spark, p, t) for t, p in landing_csv_paths(wh, spark).items()}


def landed(wh: Warehouse, spark: SparkSession) -> dict[str, DataFrame]:
    """The landing tables loaded from the CSV files (full refresh), once per warehouse."""
    from martforge.sources.landing import csv_to_landing
    tables = getattr(wh, "_landed", None)
    if tables is None:
        tables = wh._landed = csv_to_landing(spark, landing_csv_paths(wh, spark), _run_dir(spark, "landing"))
    return tables


def star_from_csv(wh: Warehouse, spark: SparkSession) -> Warehouse:
    """The warehouse over the landing tables that came from the CSV files."""
    built = getattr(wh, "_from_csv", None)
    if built is None:
        built = wh._from_csv = Warehouse(spark, landed(wh, spark), wh.spine, wh.as_of, wh.strict)
    return built


def load_raw_full_refresh_job(wh: Warehouse, spark: SparkSession) -> DataFrame:
    """Row count per landing table after the full-refresh load."""
    out = None
    for t, df in landed(wh, spark).items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(f"{t}_raw").alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def scan_raw_csv_job(wh: Warehouse, spark: SparkSession) -> DataFrame:
    """Customers staged from the CSV files instead of the in-memory extract:
    the cleaning rules give the same table."""
    from martforge.plans.staging import stg_customers
    return stg_customers(csv_landing(wh, spark)["customers"], wh.strict)


# --- small reports ------------------------------------------------------------------

def sample_rows(df: DataFrame, order: list, n: int) -> DataFrame:
    """First ``n`` rows in ``order`` (a top-k: each task keeps its own n)."""
    return df.orderBy(*order).limit(n)


def limit_samples_job(wh: Warehouse) -> DataFrame:
    """The six latest months of the growth mart."""
    return sample_rows(A.mom_growth_all(wh), [F.col("order_month").desc()], 6)


def guard_returned(orders_after: DataFrame, changed_keys: DataFrame, items: DataFrame,
                   returns: DataFrame) -> DataFrame:
    """Rows of an update batch that would leave an order 'returned' without
    a return (the source's update trigger rejects them).  Empty = accept."""
    from martforge.operators.quality import dq_returned_has_return
    bad = dq_returned_has_return(orders_after, items, returns)
    return bad.join(changed_keys.select("order_key").distinct(), "order_key", "left_semi")


def guard_returned_job(wh: Warehouse, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check the status update batch against the returned-order rule."""
    upd = orders_status_update(wh, spark, sf_dir)
    after = apply_updates(wh.fct_orders.select("order_key", "order_status"), upd, "order_key")
    return guard_returned(after, upd, wh.fct_order_items, wh.fct_returns)


# --- update batches as transactions -----------------------------------------------

SECOND_UPDATE_TIME = dt.datetime(2002, 1, 3, 0, 0, 0)
ARRIVED_EVERY = 7                 # second batch: shipped orders of such keys have arrived
MOVED_EVERY = 11                  # customers of such keys have moved
ORDER_LAYOUT = {"fct_orders": LAYOUT["fct_orders"]}


def _time_text(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def update_orders(spark: SparkSession, root: str, batch_id: str, updates: DataFrame, at: dt.datetime) -> str:
    """One status batch on the published orders: guarded, stamped and logged."""
    from martforge.plans.updates import apply_batch, read_table_of
    items, returns = (read_table_of(spark, root, t) for t in ("fct_order_items", "fct_returns"))
    return apply_batch(spark, root, "fct_orders", "order_key", batch_id, updates, at, audited="order_status",
                       guard=lambda after, batch: guard_returned(after, batch, items, returns), layout=ORDER_LAYOUT)


def publish_order_tables(wh: Warehouse, spark: SparkSession, root: str) -> str:
    """The tables that a status batch reads and writes, as first published."""
    from martforge.plans.updates import publish_tables
    return publish_tables(spark, root, {
        "fct_orders": wh.fct_orders.withColumn("updated_at", F.lit(LOAD_TIME)),
        "fct_order_items": wh.fct_order_items, "fct_returns": wh.fct_returns}, ORDER_LAYOUT)


def update_batches(wh: Warehouse, spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two status batches, the first sent twice: the orders and the audit table as
    published in the end.  A batch holds the rows that change."""
    from martforge.plans.updates import AUDIT, read_table_of
    done = getattr(wh, "_updated", None)
    if done is None:
        root = _run_dir(spark, "updates")
        publish_order_tables(wh, spark, root)
        old = wh.fct_orders.select("order_key", F.col("order_status").alias("_mf_old"))
        first = (orders_status_update(wh, spark, sf_dir).join(old, "order_key")
                 .filter(~F.col("order_status").eqNullSafe(F.col("_mf_old"))).drop("_mf_old"))
        for _ in range(2):  # the second time it is logged already
            update_orders(spark, root, "first", first, UPDATE_TIME)
        second = read_table_of(spark, root, "fct_orders").filter(
            (F.col("order_key") % ARRIVED_EVERY == 0) & (F.col("order_status") == "shipped")).select(
            "order_key", F.lit("delivered").alias("order_status"))
        update_orders(spark, root, "second", second, SECOND_UPDATE_TIME)
        done = wh._updated = root
    return (read_table_of(spark, done, "fct_orders").select("order_key", "order_status", _time_text("updated_at")),
            read_table_of(spark, done, AUDIT).withColumn("changed_at", _time_text("changed_at")))


def update_customers_job(wh: Warehouse, spark: SparkSession) -> DataFrame:
    """Customers who moved: every row of the batch is stamped, nothing is logged but the batch."""
    from martforge.plans.updates import apply_batch, publish_tables, read_table_of
    root = _run_dir(spark, "customer_updates")
    publish_tables(spark, root, {"dim_customer": wh.dim_customer.withColumn("updated_at", F.lit(LOAD_TIME))})
    moved = wh.dim_customer.filter(F.col("customer_key") % MOVED_EVERY == 0).select(
        "customer_key", F.concat("city", F.lit(" (new)")).alias("city"))
    apply_batch(spark, root, "dim_customer", "customer_key", "moved", moved, UPDATE_TIME)
    return read_table_of(spark, root, "dim_customer").select("customer_key", "city", _time_text("updated_at"))


def table_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Column statistics by one aggregation: exact distinct count, nulls, and
    least and greatest value as text."""
    parts = []
    for i, c in enumerate(columns):
        parts += [F.count_distinct(c).alias(f"d{i}"),
                  F.coalesce(F.sum(F.col(c).isNull().cast("long")), F.lit(0)).alias(f"n{i}"),
                  F.min(c).cast("string").alias(f"lo{i}"), F.max(c).cast("string").alias(f"hi{i}")]
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"d{i}").alias("distinct_count"),
                              F.col(f"n{i}").alias("num_nulls"), F.col(f"lo{i}").alias("min"),
                              F.col(f"hi{i}").alias("max")) for i, c in enumerate(columns)])
    return df.agg(*parts).select(F.explode(rows).alias("r")).select("r.*")


STATS_COLUMNS = ["customer_key", "order_status", "order_date_key", "total_amount"]


def table_stats_job(wh: Warehouse, spark: SparkSession) -> DataFrame:
    return table_stats(wh.fct_orders, STATS_COLUMNS)
