"""Registered queries: name -> (Spark job, oracle SQL).

Every query takes ``(spark, sf_dir)``, builds (once per session) the
warehouse over the driver tables in ``sf_dir`` and returns a DataFrame.
Oracle SQL for the same name is in ``oracle_sql()``; a query without one is
compared on row counts only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.operators import quality as Q
from martforge.plans import analytics as A
from martforge.plans import checks as C
from martforge.plans import operations as OP
from martforge.plans import oracle as O
from martforge.plans import loads, planted, staging
from martforge.plans.updates import LOG
from martforge.plans.warehouse import Warehouse, warehouse_for
from martforge.sources.landing import LANDING_TABLES

Query = Callable[[SparkSession, str], DataFrame]

# models exposed as they are (key = model name)
MODELS = [
    "stg_customers", "stg_categories", "stg_products", "stg_orders", "stg_order_items",
    "stg_returns", "int_order_items_enriched", "int_order_totals", "int_customer_order_facts",
    "dim_date", "dim_category", "dim_customer", "dim_product", "fct_orders", "fct_order_items",
    "fct_returns", "dim_product_handwritten",
]

ANALYTICS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "mom_growth_all": A.mom_growth_all,
    "mom_growth_net": A.mom_growth_net,
    "running_total": A.running_total,
    "customer_rfm": A.customer_rfm,
    "rfm_segment_counts": A.rfm_segment_counts,
    "customer_rfm_named": A.customer_rfm_named,
    "sort_rfm_top20": A.sort_rfm_top20,
    "cohort_signup": A.cohort_signup,
    "cohort_first_order": A.cohort_first_order,
    "category_rollup_lines": A.category_rollup_lines,
    "category_rollup_units": A.category_rollup_units,
    "bi_category_performance": A.bi_category_performance,
    "customer_ltv_fanout": A.customer_ltv_fanout,
    "fn_customer_ltv": A.fn_customer_ltv,
    "customer_ltv": A.customer_ltv,
    "customer_summary": A.customer_summary,
    "ltv_row_counts": A.ltv_row_counts,
    "refunds_by_state_reason": A.refunds_by_state_reason,
    "customer_order_history": A.customer_order_history,
    "bi_revenue_overview": A.bi_revenue_overview,
    "bi_segments": A.bi_segments,
    "rfm_build_parity": A.rfm_build_parity,
}


def _model_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(warehouse_for(spark, sf_dir), name)
    run.__name__ = name
    return run


def _analytic_query(name: str, fn: Callable[[Warehouse], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(warehouse_for(spark, sf_dir))
    run.__name__ = name
    return run


def _landing_query(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return warehouse_for(spark, sf_dir).landing[table]
    return run


def _stg_customers_text_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_customers_text_order(warehouse_for(spark, sf_dir).landing["customers"])


def _raw_rowcount_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse_for(spark, sf_dir)
    out = None
    for name, df in wh.landing.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(f"{name}_raw").alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    q["messy_landing"] = _landing_query("customers")
    for t in LANDING_TABLES:
        q[f"messy_landing_{t}"] = _landing_query(t)
    q["raw_rowcount_report"] = _raw_rowcount_report
    q["stg_customers_text_order"] = _stg_customers_text_order
    for m in MODELS:
        q[m] = _model_query(m)
    q["calendar_spine"] = _model_query("dim_date")
    for name, fn in ANALYTICS.items():
        q[name] = _analytic_query(name, fn)
    for name, fn in _operations().items():
        q[name] = fn
    return q


def _wh(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(warehouse_for(spark, sf_dir), spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def _suite(checks_fn):
    return _wh(lambda wh, spark, sf_dir: C.run_checks(wh, checks_fn()))


def _severity(wh, spark, sf_dir):
    return C.run_checks(wh, C.DBT_SUITE + C.CONSTRAINT_SUITE).filter(F.col("failing_rows") > 0)


def _operations() -> dict[str, Query]:
    return {
        # quality
        "dq_suite": _suite(lambda: C.DBT_SUITE),
        "dq_constraints": _suite(lambda: C.CONSTRAINT_SUITE),
        "dq_not_null": _suite(lambda: C.suite_of("not_null")),
        "dq_unique": _suite(lambda: C.suite_of("unique")),
        "dq_accepted_values": _suite(lambda: C.suite_of("accepted_values")),
        "dq_relationships": _suite(lambda: C.suite_of("relationships")),
        "dq_non_negative": _suite(lambda: C.suite_of("non_negative")),
        "dq_check": _suite(lambda: C.suite_of("expression")),
        "dq_severity": _wh(_severity),
        "dq_deferred_self_fk": _wh(lambda wh, s, d: Q.dq_deferred_self_fk(
            wh.dim_category, "parent_category_id", "category_id")),
        "dq_returned_has_return": _wh(lambda wh, s, d: Q.dq_returned_has_return(
            wh.fct_orders, wh.fct_order_items, wh.fct_returns)),
        # changes and loads
        "join_returns_by_product": _wh(lambda wh, s, d: OP.join_returns_by_product(wh)),
        "audit_status_changes": _wh(OP.audit_status_changes_job),
        "touch_updated_at": _wh(OP.touch_updated_at_job),
        "insert_ignore": _wh(lambda wh, s, d: OP.insert_ignore_job(wh)),
        "append_facts": _wh(lambda wh, s, d: OP.append_facts_job(wh, s)),
        "backfill_order_totals": _wh(lambda wh, s, d: OP.backfill_order_totals_job(wh)),
        "refresh_customer_summary": _wh(lambda wh, s, d: OP.refresh_customer_summary(wh, s)),
        "atomic_publish": _wh(lambda wh, s, d: OP.atomic_publish_job(wh, s)),
        "audit_status_stream": _wh(OP.audit_status_stream_job),
        "layout_point_lookup": _wh(lambda wh, s, d: OP.layout_point_lookup(wh, s)),
        "load_raw_full_refresh": _wh(lambda wh, s, d: OP.load_raw_full_refresh_job(wh, s)),
        "scan_raw_csv": _wh(lambda wh, s, d: OP.scan_raw_csv_job(wh, s)),
        "limit_samples": _wh(lambda wh, s, d: OP.limit_samples_job(wh)),
        "guard_returned": _wh(OP.guard_returned_job),
        "table_stats": _wh(lambda wh, s, d: OP.table_stats_job(wh, s)),
        # CSV files to landing tables to the star
        **{f"csv_stg_{t}": _csv_model(f"stg_{t}") for t in LANDING_TABLES},
        "csv_fct_order_items": _csv_model("fct_order_items"),
        "csv_fct_returns": _csv_model("fct_returns"),
        # broken rows and quarantine
        "dq_planted": _wh(lambda wh, s, d: planted.planted_report(wh)),
        "quarantine_counts": _wh(lambda wh, s, d: planted.quarantine_counts(wh)),
        "quarantine_rejects": _wh(lambda wh, s, d: planted.quarantine_rejects(wh)),
        "quarantine_star": _wh(_quarantine_star),
        # update batches as transactions
        "update_batch_orders": _wh(lambda wh, s, d: OP.update_batches(wh, s, d)[0]),
        "update_batch_audit": _wh(lambda wh, s, d: OP.update_batches(wh, s, d)[1]),
        "update_batch_customers": _wh(lambda wh, s, d: OP.update_customers_job(wh, s)),
        # keyed loads of two extracts into stored tables
        **{f"keyed_load_{t}": _keyed_load(t) for t in loads.LOADED},
        "keyed_load_log": _keyed_load(LOG),
    }


def _keyed_load(table: str) -> Query:
    return _wh(lambda wh, s, d: loads.keyed_load(wh, s, table))


def _csv_model(name: str) -> Query:
    return _wh(lambda wh, s, d: getattr(OP.star_from_csv(wh, s), name))


def _quarantine_star(wh: Warehouse, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the facts built from the kept rows, named by their staging tables."""
    star = planted.quarantine_star(wh)
    facts = {"stg_orders": star.fct_orders, "stg_order_items": star.fct_order_items, "stg_returns": star.fct_returns}
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(t).alias("table_name"), "row_count") for t, df in facts.items()])


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    chain = O.with_chain
    o["messy_landing"] = chain("SELECT * FROM customers_raw")
    o["raw_rowcount_report"] = chain(" UNION ALL ".join(
        f"SELECT '{t}_raw' AS table_name, count(*) AS row_count FROM {t}_raw"
        for t in ["categories", "customers", "products", "orders", "order_items", "returns"]))
    o["stg_customers_text_order"] = chain("SELECT * FROM stg_customers_text_order")
    for m in MODELS:
        o[m] = chain(f"SELECT * FROM {m}")
    o["calendar_spine"] = chain("SELECT * FROM dim_date")
    for name, body in O.analytic_bodies().items():
        o[name] = chain(body)
    for name, body in O.operation_bodies().items():
        o[name] = chain(body)
    suites = {
        "dq_suite": C.DBT_SUITE,
        "dq_constraints": C.CONSTRAINT_SUITE,
        "dq_not_null": C.suite_of("not_null"),
        "dq_unique": C.suite_of("unique"),
        "dq_accepted_values": C.suite_of("accepted_values"),
        "dq_relationships": C.suite_of("relationships"),
        "dq_non_negative": C.suite_of("non_negative"),
        "dq_check": C.suite_of("expression"),
    }
    for name, checks in suites.items():
        o[name] = chain(O.suite_sql(checks))
    o["table_stats"] = chain(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count, "
        f"count(*) - count({c}) AS num_nulls, cast(min({c}) AS varchar) AS min, cast(max({c}) AS varchar) AS max "
        "FROM fct_orders" for c in OP.STATS_COLUMNS))
    for t in LANDING_TABLES:
        o[f"csv_stg_{t}"] = chain(f"SELECT * FROM stg_{t}")
        o[f"messy_landing_{t}"] = chain(f"SELECT * FROM {t}_raw")
    for fact in ("fct_order_items", "fct_returns"):
        o[f"csv_{fact}"] = chain(f"SELECT * FROM {fact}")
    for name, body in {**planted.oracle_bodies(), **loads.oracle_bodies()}.items():
        o[name] = chain(body)
    o["dq_severity"] = chain(
        f"SELECT * FROM ({O.suite_sql(C.DBT_SUITE + C.CONSTRAINT_SUITE)}) r WHERE failing_rows > 0")
    return o
