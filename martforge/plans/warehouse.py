"""Intermediate models, dimensions and facts (the star schema).

``Warehouse`` wires the models: each model is a method that names its
inputs by reading other models, and ``functools.cached_property`` makes the
build order follow the dependencies (the ``ref()`` graph of the source).
Models with surrogate keys are ranked by the parallel global ranking
operator; their ranked output is checkpointed once and shared by every
reader.

Join strategy: the calendar (size fixed by its two dates) is broadcast by
hint.  Every other join is left to Spark: with AQE on, a side whose
*measured* size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``
is broadcast at run time, anything larger is a sort-merge join, and AQE's
skew handling splits a partition holding a hot key.
"""

from __future__ import annotations

import datetime as dt
import threading
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.constants import DEFAULT_AS_OF
from martforge.functions.clean import SUM_MONEY, line_total
from martforge.operators.ranking import size_shuffles, with_surrogate_key
from martforge.plans import staging
from martforge.session import stored_between
from martforge.sources.calendar import calendar_spine
from martforge.sources.landing import landing_frames


class Warehouse:
    """All models built from one set of landing frames."""

    def __init__(self, spark: SparkSession, landing: dict[str, DataFrame],
                 spine: tuple[dt.date, dt.date] | None = None,
                 as_of: dt.date = DEFAULT_AS_OF, strict: bool = True):
        self.spark = spark
        self.landing = landing
        self.spine = spine
        self.as_of = as_of
        self.strict = strict

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str, **kw) -> "Warehouse":
        return cls(spark, landing_frames(spark, sf_dir), **kw)

    # --- staging -----------------------------------------------------------
    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.landing["customers"], self.strict)

    @cached_property
    def stg_categories(self) -> DataFrame:
        return staging.stg_categories(self.landing["categories"])

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.landing["products"])

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.landing["orders"], self.strict)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.landing["order_items"])

    @cached_property
    def stg_returns(self) -> DataFrame:
        return staging.stg_returns(self.landing["returns"])

    # --- intermediate ------------------------------------------------------
    @cached_property
    def int_order_items_enriched(self) -> DataFrame:
        """Line + its order (inner) + its product's category (left)."""
        oi = self.stg_order_items
        o = self.stg_orders.select("order_id", "customer_id", "order_date", "order_status")
        p = self.stg_products.select("product_id", "category_id")
        return (
            oi.join(o, "order_id", "inner")
            .join(p, "product_id", "left")
            .select("order_item_id", "order_id", "customer_id", "product_id", "category_id",
                    "order_date", "order_status", "quantity", "unit_price", "discount_pct",
                    "line_total")
        )

    @cached_property
    def int_order_totals(self) -> DataFrame:
        """Every staged order with the sum of its lines (0 without lines).

        The source sums the enriched lines (lines joined to their order and
        product).  With order ids and product ids unique - the error-severity
        tests ``unique_stg_orders_order_id`` and
        ``unique_stg_products_product_id`` - those joins only drop lines of
        unknown orders, which the left join below drops as well, so the
        lines are aggregated straight from staging: partial sums map-side,
        one row per order shuffled, no line-level join at all.
        """
        totals = self.stg_order_items.groupBy("order_id").agg(
            F.sum("line_total").cast(SUM_MONEY).alias("total_amount"))
        return self.stg_orders.join(totals, "order_id", "left").select(
            "order_id", "customer_id", "order_date", "order_status", "payment_method",
            "shipping_cost",
            F.coalesce(F.col("total_amount"), F.lit(0).cast(SUM_MONEY)).alias("total_amount"),
        )

    @cached_property
    def int_customer_order_facts(self) -> DataFrame:
        """Last order date, order count and money per customer (all statuses).

        The source counts distinct order ids; with order ids unique in
        staging (``unique_stg_orders_order_id``, see ``int_order_totals``)
        a plain count is the same number without the extra shuffle that a
        distinct count plans."""
        return self.int_order_totals.groupBy("customer_id").agg(
            F.max("order_date").alias("last_order_date"),
            F.count("order_id").alias("frequency"),
            F.sum("total_amount").cast(SUM_MONEY).alias("monetary"),
        )

    # --- dimensions --------------------------------------------------------
    @cached_property
    def dim_date(self) -> DataFrame:
        return calendar_spine(self.spark, *(self.spine or self.observed_years))

    @cached_property
    def observed_years(self) -> tuple[dt.date, dt.date]:
        """Whole years around all order and return dates (the year of the
        analysis date if there are none): no dated row lacks a calendar day."""
        dates = self.stg_orders.select(F.col("order_date").alias("d")).unionByName(
            self.stg_returns.select(F.col("return_date").alias("d")))
        first, last = dates.agg(F.min("d"), F.max("d")).first()
        return (dt.date((first or self.as_of).year, 1, 1), dt.date((last or self.as_of).year, 12, 31))

    @cached_property
    def dim_category(self) -> DataFrame:
        return with_surrogate_key(self.stg_categories, ["category_id"], "category_key")

    @cached_property
    def dim_customer(self) -> DataFrame:
        return with_surrogate_key(self.stg_customers, ["customer_id"], "customer_key")

    @cached_property
    def dim_product(self) -> DataFrame:
        cat = self.dim_category.select("category_id", "category_key", "category_name")
        joined = self.stg_products.join(cat, "category_id", "left").select(
            "product_id", "product_name", "category_key", "category_name", "brand",
            "unit_price", "is_active")
        return with_surrogate_key(joined, ["product_id"], "product_key")

    @cached_property
    def dim_product_handwritten(self) -> DataFrame:
        """The hand-written load's product table: it keeps the category id
        (a foreign key to the category table), not the category key and name."""
        return with_surrogate_key(
            self.stg_products.select("product_id", "product_name", "category_id", "brand",
                                     "unit_price", "is_active"),
            ["product_id"], "product_key")

    # --- facts ---------------------------------------------------------------
    @cached_property
    def fct_orders(self) -> DataFrame:
        cust = self.dim_customer.select("customer_id", "customer_key")
        dates = F.broadcast(self.dim_date.select(F.col("full_date").alias("order_date"), "date_key"))
        joined = (
            self.int_order_totals.join(cust, "customer_id", "inner")
            .join(dates, "order_date", "left")
            .select("order_id", "customer_key", F.col("date_key").alias("order_date_key"),
                    "order_status", "payment_method", "shipping_cost", "total_amount")
        )
        return with_surrogate_key(joined, ["order_id"], "order_key")

    @cached_property
    def fct_order_items(self) -> DataFrame:
        """Lines with their order and product keys.  The source starts from
        the enriched lines; with the staging keys unique (see
        ``int_order_totals``) the staged lines give the same rows with two
        fewer line-sized shuffles.  The lines are stored between the joins and
        the ranking, so that one line-sized shuffle lies on the disks at a time
        and the sampling of ranges repeats no join; the product keys are stored
        too, so that a join of small tables is planned by both true sizes."""
        orders = self.fct_orders.select("order_id", "order_key")
        prods, delete_prods = stored_between(self.dim_product.select("product_id", "product_key"), "keys-of-products")
        placed, delete_placed = stored_between(
            self.stg_order_items.join(orders, "order_id", "inner")
            .select("order_item_id", "order_key", "product_id", "quantity", "unit_price", "discount_pct"), "lines-of-orders")
        joined, delete_joined = stored_between(
            placed.join(prods, "product_id", "inner")
            .select("order_item_id", "order_key", "product_key", "quantity", "unit_price", "discount_pct"), "lines-of-products")
        delete_placed()
        delete_prods()
        ranked = with_surrogate_key(joined, ["order_item_id"], "order_item_key", derived={
            "line_total": line_total("quantity", "unit_price", "discount_pct")})
        delete_joined()
        return ranked

    @cached_property
    def fct_returns(self) -> DataFrame:
        items = self.fct_order_items.select("order_item_id", "order_item_key")
        dates = F.broadcast(self.dim_date.select(F.col("full_date").alias("return_date"), "date_key"))
        joined = (
            self.stg_returns.join(items, "order_item_id", "inner")
            .join(dates, "return_date", "left")
            .select("return_id", "order_item_key", F.col("date_key").alias("return_date_key"),
                    "return_reason", "refund_amount")
        )
        return with_surrogate_key(joined, ["return_id"], "return_key")


# --- one warehouse per (session, folder, settings) ---------------------------

_LOCK = threading.Lock()
_CACHE: dict[tuple, Warehouse] = {}


def warehouse_for(spark: SparkSession, sf_dir: str, **kw) -> Warehouse:
    """Build (once per session) the warehouse over the driver tables in
    ``sf_dir``; later calls share its checkpointed keyed tables."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/"),
           tuple(sorted((k, str(v)) for k, v in kw.items())))
    with _LOCK:
        wh = _CACHE.get(key)
        if wh is None:
            wh = Warehouse.from_driver_tables(spark, sf_dir, **kw)
            _CACHE[key] = wh
        size_shuffles(spark, wh.landing.values())
        return wh


# --- reading a published build ---------------------------------------------------

# models a build writes as tables (the rest are views recomputed by readers)
TABLE_MODELS = ["dim_date", "dim_category", "dim_customer", "dim_product", "fct_orders",
                "fct_order_items", "fct_returns", "int_customer_order_facts"]
# point lookups filter orders by customer: lay that table out by customer; the
# order key behind it splits a customer with very many orders over several files
LAYOUT = {"fct_orders": ["customer_key", "order_key"]}


# staging and intermediate models are views, recomputed by each reader
VIEW_MODELS = ["stg_customers", "stg_categories", "stg_products", "stg_orders",
               "stg_order_items", "stg_returns", "int_order_items_enriched",
               "int_order_totals", "int_customer_order_facts"]


def register_views(wh: Warehouse, prefix: str = "") -> list[str]:
    """Make every model queryable from Spark SQL as a temporary view (lazy:
    a view is planned into each query that reads it)."""
    names = []
    for name in VIEW_MODELS + ["dim_date", "dim_category", "dim_customer", "dim_product",
                               "fct_orders", "fct_order_items", "fct_returns"]:
        getattr(wh, name).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


# the table models in dependency waves: models of one wave read only
# models of earlier waves (and views), so a wave's writes are independent
BUILD_WAVES = [
    ["dim_date", "dim_category", "dim_customer", "int_customer_order_facts"],
    ["dim_product", "fct_orders"],
    ["fct_order_items"],
    ["fct_returns"],
]


def write_warehouse(wh: Warehouse, root: str, models: list[str] | None = None,
                    threads: int = 1) -> None:
    """Materialise the table models under ``root`` (full refresh).

    With ``threads`` > 1 the models of one wave are written as concurrent
    Spark jobs (as the source's model build runs 4 threads), so small
    single-task stages of one model overlap with the work of another."""
    from concurrent.futures import ThreadPoolExecutor

    from martforge.plans.publish import write_table
    wanted = set(models or TABLE_MODELS)

    def write(name: str) -> None:
        write_table(getattr(wh, name), f"{root}/{name}", sort_by=LAYOUT.get(name))

    for wave in BUILD_WAVES:
        names = [n for n in wave if n in wanted]
        if threads <= 1 or len(names) <= 1:
            for n in names:
                write(n)
            continue
        with ThreadPoolExecutor(max_workers=min(threads, len(names))) as pool:
            for f in [pool.submit(write, n) for n in names]:
                f.result()


def _stored(name: str):
    return cached_property(lambda self: self.spark.read.parquet(f"{self.root}/{name}"))


class PublishedWarehouse(Warehouse):
    """The warehouse as downstream jobs see it: table models are scans of
    what a build wrote (filters and column pruning reach the Parquet
    reader); staging models are not available."""

    def __init__(self, spark: SparkSession, root: str,
                 spine: tuple[dt.date, dt.date] | None = None,
                 as_of: dt.date = DEFAULT_AS_OF):
        super().__init__(spark, {}, spine, as_of)
        self.root = root
        self.stored_marts: dict[str, DataFrame] = {}

    def store_mart(self, name: str, df: DataFrame) -> DataFrame:
        """Write a mart as a table (full refresh); checks then read the table."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        self.stored_marts[name] = self.spark.read.parquet(path)
        return self.stored_marts[name]

    dim_date = _stored("dim_date")
    dim_category = _stored("dim_category")
    dim_customer = _stored("dim_customer")
    dim_product = _stored("dim_product")
    fct_orders = _stored("fct_orders")
    fct_order_items = _stored("fct_order_items")
    fct_returns = _stored("fct_returns")
    int_customer_order_facts = _stored("int_customer_order_facts")
