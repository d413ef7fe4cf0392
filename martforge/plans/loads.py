"""Keyed loads into stored tables: ``INSERT ... ON CONFLICT (key) DO NOTHING``.

A batch brings rows for several tables, in the order in which they refer to each
other, and becomes one published version or none (the versions of ``updates``):

* of rows with one natural key the stored one wins, then the batch's first in
  the order of its other columns, nulls last;
* surrogate keys go on from the greatest one stored, in the order of the natural
  key, without gaps;
* a table's rows may refer to tables as they stand, the batch's own included, so
  an order finds the customer that came with it;
* nothing stored is rewritten: new rows are one more folder of their table, and
  a table without new rows gets none;
* a batch that is logged already changes nothing; the same rows under another
  name add no rows, only the entry.

Stored keys are read between the batch's least and greatest key only; files are
in key order, so Parquet statistics skip the others.  A row with a null in its
key raises ``RejectedBatch``, as the keys' constraints do.  Empty batches and
empty stored tables are allowed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.clean import line_total
from martforge.functions.dates import date_key
from martforge.operators.dedup import distinct_on
from martforge.operators.ranking import with_surrogate_key
from martforge.plans.operations import EARLIER_LOAD_BEFORE, LOAD_TIME, UPDATE_TIME
from martforge.plans.publish import current_version, new_version, write_table
from martforge.plans.updates import LOG, LOG_SCHEMA, RejectedBatch, folders_of, publish_folders, read_table_of
from martforge.plans.warehouse import Warehouse
from martforge.session import scratch_path


@dataclass(frozen=True)
class Load:
    """Rows for one table: ``rows`` gets the tables as they stand, by name.  With a
    serial, columns that follow from a row's others may be ``derived`` once it is numbered."""

    table: str
    key: tuple[str, ...]
    rows: Callable[[dict[str, DataFrame]], DataFrame]
    serial: str | None = None
    derived: Mapping[str, Column] | None = None


def fresh_rows(load: Load, incoming: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Rows to insert, one for each key that is not stored, and one for each key with
    a null, which ``load_batch`` refuses.  The batch's least and greatest key are
    looked up only if there are stored keys to bound."""
    lead = load.key[0]
    rest = [F.col(c).asc_nulls_last() for c in incoming.columns if c not in load.key]
    first = distinct_on(incoming, load.key, rest or list(load.key))
    if stored is None:
        return first
    lo, hi = incoming.agg(F.min(lead), F.max(lead)).first()
    if lo is None:
        return first
    known = stored.filter(F.col(lead).between(F.lit(lo), F.lit(hi))).select(*load.key)
    return first.join(known, list(load.key), "left_anti").select(*incoming.columns)


def _without_key(load: Load) -> Column:
    return F.coalesce(F.count_if(F.concat_ws("", *[F.when(F.col(k).isNull(), "x") for k in load.key]) != ""), F.lit(0))


def _with_serial(fresh: DataFrame, load: Load, stored: DataFrame | None) -> DataFrame:
    last = (stored.agg(F.max(load.serial)).first()[0] or 0) if stored is not None else 0
    ranked = with_surrogate_key(fresh, list(load.key), load.serial, derived=load.derived)
    return ranked.withColumn(load.serial, F.col(load.serial) + F.lit(last))


def load_batch(spark: SparkSession, root: str, batch_id: str, loads: list[Load], loaded_at: dt.datetime) -> str:
    """Load one batch and return the published version."""
    base = current_version(spark, root)
    folders = folders_of(spark, root, base) if base else {}
    if LOG in folders and not read_table_of(spark, root, LOG).filter(F.col("batch_id") == batch_id).isEmpty():
        return base
    version, entries = new_version(), []
    now = {t: spark.read.parquet(*[f"{root}/{f}" for f in f_]) for t, f_ in folders.items()}
    for load in loads:
        stored = now.get(load.table)
        incoming = load.rows(now)
        fresh = fresh_rows(load, incoming, stored)
        if load.serial:
            fresh = _with_serial(fresh, load, stored)
        folder = f"{version}/{load.table}"
        # rows with a serial come in key order from their numbering
        write_table(fresh, f"{root}/{folder}", "errorifexists", None if load.serial else list(load.key))
        added, broken = spark.read.schema(fresh.schema).parquet(f"{root}/{folder}").agg(
            F.count(F.lit(1)), _without_key(load)).first()
        if broken:  # no version names the folder
            broken = incoming.agg(_without_key(load)).first()[0]
            raise RejectedBatch(f"{broken} rows for {load.table} have a null in their key")
        if added or stored is None:
            folders[load.table] = [*folders.get(load.table, []), folder]
            now[load.table] = spark.read.schema(fresh.schema).parquet(*[f"{root}/{f}" for f in folders[load.table]])
        entries.append((batch_id, load.table, added, loaded_at))
    write_table(spark.createDataFrame(entries, LOG_SCHEMA), f"{root}/{version}/{LOG}", "errorifexists")
    folders[LOG] = [*folders.get(LOG, []), f"{version}/{LOG}"]
    return publish_folders(spark, root, base, version, folders)


def star_loads(wh: Warehouse, before: dt.date | None = None) -> list[Load]:
    """The seven star tables as one batch.  With ``before`` it is the earlier
    extract: rows dated before that day, root categories and active products.
    Rows whose parent is not loaded yet are left to a later extract, as the
    inner joins of the load leave them."""
    def cut(df: DataFrame, condition) -> DataFrame:
        return df if before is None else df.filter(condition)

    def dated(df: DataFrame, c: str) -> DataFrame:
        return cut(df, F.col(c) < F.lit(before))

    def orders(now):
        return (dated(wh.int_order_totals, "order_date")
                .join(now["dim_customer"].select("customer_id", "customer_key"), "customer_id")
                .select("order_id", "customer_key", date_key("order_date").alias("order_date_key"), "order_status",
                        "payment_method", "shipping_cost", "total_amount"))

    def lines(now):
        return (wh.stg_order_items.join(now["fct_orders"].select("order_id", "order_key"), "order_id")
                .join(now["dim_product"].select("product_id", "product_key"), "product_id")
                .select("order_item_id", "order_key", "product_key", "quantity", "unit_price", "discount_pct"))

    def returns(now):
        return (dated(wh.stg_returns, "return_date")
                .join(now["fct_order_items"].select("order_item_id", "order_item_key"), "order_item_id")
                .select("return_id", "order_item_key", date_key("return_date").alias("return_date_key"),
                        "return_reason", "refund_amount"))

    products = wh.stg_products.select("product_id", "product_name", "category_id", "brand", "unit_price", "is_active")
    return [
        Load("dim_date", ("date_key",), lambda now: dated(wh.dim_date, "full_date")),
        Load("dim_category", ("category_id",), lambda now: cut(wh.stg_categories, F.col("parent_category_id").isNull()), "category_key"),
        Load("dim_customer", ("customer_id",), lambda now: dated(wh.stg_customers, "signup_date"), "customer_key"),
        Load("dim_product", ("product_id",), lambda now: cut(products, F.col("is_active")), "product_key"),
        Load("fct_orders", ("order_id",), orders, "order_key"),
        Load("fct_order_items", ("order_item_id",), lines, "order_item_key",
             {"line_total": line_total("quantity", "unit_price", "discount_pct")}),
        Load("fct_returns", ("return_id",), returns, "return_key"),
    ]


LOADED = ["dim_date", "dim_category", "dim_customer", "dim_product", "fct_orders", "fct_order_items", "fct_returns"]


def keyed_load(wh: Warehouse, spark: SparkSession, table: str) -> DataFrame:
    """A table after the earlier extract, the whole one and the whole one again
    (sent under its own name, so the log drops it).  Customers of the whole
    extract carry another city, which the stored ones do not take over."""
    root = getattr(wh, "_loaded", None)
    if root is None:
        root = scratch_path(spark, f"keyed-load-{new_version()}")
        load_batch(spark, root, "earlier", star_loads(wh, EARLIER_LOAD_BEFORE), LOAD_TIME)
        whole = [Load(x.table, x.key, lambda now: wh.stg_customers.withColumn("city", F.concat("city", F.lit(" (late)"))), x.serial)
                 if x.table == "dim_customer" else x for x in star_loads(wh)]
        for _ in range(2):
            load_batch(spark, root, "whole", whole, UPDATE_TIME)
        wh._loaded = root
    out = read_table_of(spark, root, table)
    return out.select("batch_id", "table_name", "rows") if table == LOG else out


def oracle_bodies() -> dict[str, str]:
    """Numbers follow (extract, key); an order is in the earlier extract if its
    date and its customer are, a line if its order and its product are."""
    day = f"DATE '{EARLIER_LOAD_BEFORE}'"
    first_key = EARLIER_LOAD_BEFORE.strftime("%Y%m%d")
    when = {
        "dim_category": "SELECT *, CASE WHEN parent_category_id IS NULL THEN 1 ELSE 2 END AS e FROM dim_category",
        "dim_customer": f"SELECT * REPLACE (CASE WHEN signup_date < {day} THEN city ELSE city || ' (late)' END AS city), "
                        f"CASE WHEN signup_date < {day} THEN 1 ELSE 2 END AS e FROM dim_customer",
        "dim_product": "SELECT *, CASE WHEN is_active THEN 1 ELSE 2 END AS e FROM dim_product_handwritten",
        "fct_orders": f"SELECT f.* REPLACE (c.n AS customer_key), CASE WHEN c.e = 1 AND order_date_key < {first_key} THEN 1 ELSE 2 END AS e "
                      "FROM fct_orders f JOIN numbered_dim_customer c ON c.was = f.customer_key",
        "fct_order_items": "SELECT f.* REPLACE (o.n AS order_key, p.n AS product_key), greatest(o.e, p.e) AS e FROM fct_order_items f "
                           "JOIN numbered_fct_orders o ON o.was = f.order_key JOIN numbered_dim_product p ON p.was = f.product_key",
        "fct_returns": f"SELECT f.* REPLACE (i.n AS order_item_key), CASE WHEN i.e = 1 AND return_date_key < {first_key} THEN 1 ELSE 2 END AS e "
                       "FROM fct_returns f JOIN numbered_fct_order_items i ON i.was = f.order_item_key",
    }
    ids = {"dim_category": ("category_key", "category_id"), "dim_customer": ("customer_key", "customer_id"),
           "dim_product": ("product_key", "product_id"), "fct_orders": ("order_key", "order_id"),
           "fct_order_items": ("order_item_key", "order_item_id"), "fct_returns": ("return_key", "return_id")}
    parts = {t: f"numbered_{t} AS (SELECT row_number() OVER (ORDER BY e, {ids[t][1]}) AS n, {ids[t][0]} AS was, * FROM ({q}) q)"
             for t, q in when.items()}
    counts = "SELECT CASE e WHEN 1 THEN 'earlier' ELSE 'whole' END AS batch_id, '{t}' AS table_name, count(*) AS rows FROM {f} GROUP BY ALL"
    dates = f"(SELECT CASE WHEN full_date < {day} THEN 1 ELSE 2 END AS e FROM dim_date)"
    log = " UNION ALL ".join([counts.format(t="dim_date", f=dates)] + [counts.format(t=t, f=f"numbered_{t}") for t in when])
    every = ", ".join(parts.values())
    bodies = {f"keyed_load_{t}": f"SELECT * FROM (WITH {every} SELECT * EXCLUDE (n, was, e) REPLACE (n AS {ids[t][0]}) FROM numbered_{t}) t"
              for t in when}
    bodies["keyed_load_dim_date"] = "SELECT * FROM dim_date"
    bodies["keyed_load_log"] = f"SELECT * FROM (WITH {every} {log}) t"
    return bodies
