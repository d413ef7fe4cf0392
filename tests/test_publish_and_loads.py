import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martforge.operators.quality import Check, DataQualityError, run_suite
from martforge.plans import operations as OP
from martforge.plans.publish import (
    atomic_publish, current_version, published_row_counts, read_published, write_table,
)
from test_marts_small import _wh


def test_publish_flips_pointer_only_after_all_tables(spark):
    root = tempfile.mkdtemp(prefix="mf-pub-")
    a = spark.range(3).withColumnRenamed("id", "k")
    b = spark.range(5).withColumnRenamed("id", "k")
    v1 = atomic_publish(spark, {"a": a, "b": b}, root)
    assert current_version(spark, root) == v1
    counts = {r.table_name: r.row_count for r in published_row_counts(spark, root, ["a", "b"]).collect()}
    assert counts == {"a": 3, "b": 5}
    v2 = atomic_publish(spark, {"a": b, "b": a}, root)
    assert v2 != v1 and current_version(spark, root) == v2
    assert read_published(spark, root, "a").count() == 5


def test_publish_aborts_on_failed_check(spark):
    root = tempfile.mkdtemp(prefix="mf-pub-")
    good = spark.range(3).withColumnRenamed("id", "k")
    v1 = atomic_publish(spark, {"a": good}, root)
    dup = spark.createDataFrame([(1,), (1,)], "k long")
    report = run_suite([Check("a", "k", "unique")], lambda name: dup)
    with pytest.raises(DataQualityError):
        atomic_publish(spark, {"a": dup}, root, checks=report)
    # readers still see the previous version, untouched
    assert current_version(spark, root) == v1
    assert read_published(spark, root, "a").count() == 3


def test_publish_stopped_before_the_switch_keeps_the_old_version(spark, monkeypatch):
    import martforge.plans.publish as P
    root = tempfile.mkdtemp(prefix="mf-pub-")
    v1 = atomic_publish(spark, {"a": spark.range(3)}, root)

    def lost(*args):
        raise RuntimeError("driver lost")
    monkeypatch.setattr(P, "_write_pointer", lost)
    with pytest.raises(RuntimeError):
        atomic_publish(spark, {"a": spark.range(9)}, root)
    assert current_version(spark, root) == v1
    assert read_published(spark, root, "a").count() == 3


def test_publish_checks_what_is_written(spark):
    root = tempfile.mkdtemp(prefix="mf-pub-")
    seen = {}

    def report(written):
        seen.update({n: df.inputFiles() for n, df in written.items()})
        return run_suite([Check("a", "id", "unique")], lambda name: written[name])
    version = atomic_publish(spark, {"a": spark.range(3)}, root, checks=report, layout={"a": ["id"]})
    assert current_version(spark, root) == version
    assert all(f"{root}/{version}/a" in f for f in seen["a"])


def test_layout_splits_a_hot_customer(spark):
    """A customer with a third of the orders lies in several files."""
    import glob
    import pyarrow.parquet as pq
    from martforge.plans.warehouse import LAYOUT
    path = os.path.join(tempfile.mkdtemp(prefix="mf-layout-"), "t")
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).cast("long").alias("customer_key"),
        F.col("id").alias("order_key"))
    write_table(df, path, sort_by=LAYOUT["fct_orders"], partitions=8)
    rows = [pq.read_metadata(f).num_rows for f in glob.glob(path + "/*.parquet")]
    assert sum(rows) == 30000 and max(rows) < 30000 / 8 * 1.5


def test_sorted_layout_keeps_point_lookup_rows(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="mf-layout-"), "t")
    df = spark.range(1000).select((F.col("id") % 97).alias("customer_key"), F.col("id").alias("v"))
    write_table(df, path, sort_by=["customer_key"], partitions=4)
    back = spark.read.parquet(path).filter(F.col("customer_key") == 5)
    assert back.count() == len([i for i in range(1000) if i % 97 == 5])
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(customer_key,5)" in plan


def test_returns_join_by_product_fans_out(spark):
    orders = [("O1", "C1", "2024-01-05", "returned", "paypal", "0.00")]
    # the same product on two lines of one order
    items = [("I1", "O1", "P1", "1", "10.00", "0"), ("I2", "O1", "P1", "2", "10.00", "0")]
    returns = [("R1", "I1", "2024-01-20", "defective", "9.00")]
    wh = _wh(spark, orders, items, returns)
    by_product = OP.join_returns_by_product(wh).collect()
    by_item = wh.fct_returns.collect()
    assert len(by_item) == 1
    assert sorted(r.order_item_key for r in by_product) == [1, 2]
    assert {r.refund_amount for r in by_product} == {Decimal("9.00")}


def test_insert_ignore_job_keeps_earlier_rows(spark):
    customers = [("C1", "Ann", "a@x", "1996-05-01", "c", "S", "US", "g"),
                 ("C1", "Ann", "a@x", "05/01/1999", "c", "S", "US", "g"),
                 ("C2", "Bob", "b@x", "1998-01-01", "c", "S", "US", "g")]
    wh = _wh(spark, [], [], customers=customers)
    got = {r.customer_id: r.signup_date for r in OP.insert_ignore_job(wh).collect()}
    assert got == {"C1": dt.date(1996, 5, 1), "C2": dt.date(1998, 1, 1)}


def test_deep_chain_walk(spark):
    from martforge.operators.hierarchy import walk_from_roots
    from martforge.operators import hierarchy
    rows = [("N0", "n0", None)] + [(f"N{i}", f"n{i}", f"N{i - 1}") for i in range(1, 1001)]
    nodes = spark.createDataFrame(rows, "id string, name string, parent string")
    writes, cut = [], hierarchy.cut_lineage
    hierarchy.cut_lineage = lambda df, name: writes.append(name) or cut(df, name)
    try:
        walked = walk_from_roots(nodes, "id", "parent", {"root": "id"})
    finally:
        hierarchy.cut_lineage = cut
    assert {r.id: r.depth for r in walked.collect()} == {f"N{i}": i for i in range(1001)}
    assert len(writes) <= 12  # rounds follow the logarithm of the depth


def test_constraint_suite_aborts_publish_on_driver_tables(spark):
    """The hand-written load refuses orders without a parseable date (NOT NULL
    date key); the same constraint stops publishing here, old data stays."""
    from conftest import SF_SMALL
    from martforge.plans import checks as C
    from martforge.plans.warehouse import warehouse_for
    wh = warehouse_for(spark, SF_SMALL)
    report = C.run_checks(wh, C.CONSTRAINT_SUITE)
    failing = {r.check_name: r.failing_rows for r in report.filter(F.col("failing_rows") > 0).collect()}
    assert set(failing) == {"ddl_not_null_fct_orders_order_date_key"}
    root = tempfile.mkdtemp(prefix="mf-pub-")
    with pytest.raises(DataQualityError):
        atomic_publish(spark, {"fct_orders": wh.fct_orders}, root, checks=report)
    assert current_version(spark, root) is None


def test_publish_job_checks_what_it_wrote(spark, monkeypatch):
    from conftest import SF_SMALL
    from martforge.plans import operations
    from martforge.plans.registry import queries
    from martforge.plans.warehouse import LAYOUT, Warehouse
    read, asked, run, publish = {}, {}, operations.C.run_checks, operations.atomic_publish

    def checks(wh, suite):
        assert isinstance(wh, Warehouse)
        read.update((t, getattr(wh, t).inputFiles()) for t in operations.STAR_TABLES)
        return run(wh, suite)

    def publishing(*a, **k):
        asked.update(k)
        return publish(*a, **k)

    monkeypatch.setattr(operations.C, "run_checks", checks)
    monkeypatch.setattr(operations, "atomic_publish", publishing)
    assert queries()["atomic_publish"](spark, SF_SMALL).count() == len(operations.STAR_TABLES)
    for t, files in read.items():
        assert files and all("/published" in f and f"/{t}/" in f for f in files)
    assert asked["layout"] == LAYOUT
