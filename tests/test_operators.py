import datetime as dt

import pytest
from pyspark.sql import functions as F

from martforge.operators import quality as Q
from martforge.operators.changes import (
    audit_status_changes, backfill_column, insert_ignore, touch_updated_at,
)
from martforge.operators.dedup import distinct_on
from martforge.operators.hierarchy import HierarchyTooDeep, unreachable_nodes, walk_from_roots
from martforge.plans.staging import stg_customers, stg_customers_text_order

RAW_COLS = "customer_id string, full_name string, email string, signup_date string, city string, " \
           "state string, country string, segment string"


def test_distinct_on_two_equal_rows(spark):
    row = ("C1", "Ann", "a@x", "2024-01-01", "c", "s", "k", "g")
    df = stg_customers(spark.createDataFrame([row, row], RAW_COLS))
    assert df.count() == 1


def test_dedup_text_order_vs_parsed_order(spark):
    rows = [("C1", "Ann", "a@x", "03/05/2025", "c", "s", "k", "g"),
            ("C1", "Ann", "a@x", "2024-01-01", "c", "s", "k", "g")]
    raw = spark.createDataFrame(rows, RAW_COLS)
    assert stg_customers(raw).first()["signup_date"] == dt.date(2024, 1, 1)
    assert stg_customers_text_order(raw).first()["signup_date"] == dt.date(2025, 3, 5)


def test_distinct_on_nulls_last(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("b", None, 3)], "k string, d int, x int")
    got = {r.k: r.x for r in distinct_on(df, ["k"], [F.col("d").asc_nulls_last(), "x"]).collect()}
    assert got == {"a": 2, "b": 3}


def _tree(spark, rows):
    return spark.createDataFrame(rows, "id string, name string, parent string")


def test_tree_walk_orphans_and_cycles(spark):
    nodes = _tree(spark, [("A", "a", None), ("B", "b", "A"), ("C", "c", "B"), ("R", "r", None),
                          ("O", "o", "missing"), ("X", "x", "Y"), ("Y", "y", "X")])
    walked = walk_from_roots(nodes, "id", "parent", {"root": "id"})
    got = {r.id: (r.root, r.depth) for r in walked.collect()}
    assert got == {"A": ("A", 0), "B": ("A", 1), "C": ("A", 2), "R": ("R", 0)}
    assert {r.id for r in unreachable_nodes(nodes, walked, "id").collect()} == {"O", "X", "Y"}


def test_tree_walk_cycle_reachable_from_root_stops(spark):
    # duplicated id: X hangs under root A and under Y, and Y hangs under X
    nodes = _tree(spark, [("A", "a", None), ("X", "x", "A"), ("Y", "y", "X"), ("X", "x2", "Y")])
    with pytest.raises(HierarchyTooDeep):
        walk_from_roots(nodes, "id", "parent", {"root": "id"}, max_depth=6)


def test_quality_checks(spark):
    df = spark.createDataFrame(
        [(1, "a", "placed", 5), (2, "a", "bogus", -1), (None, None, None, None), (3, "b", "bogus", 0)],
        "id int, email string, status string, v int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert Q.dq_not_null(df, "id").count() == 1
    assert Q.dq_unique(df, "email").count() == 1           # 'a' twice; NULL ignored
    assert Q.dq_accepted_values(df, "status", ["placed"]).count() == 1   # one distinct bad value
    assert Q.dq_relationships(df, "id", parent, "id").count() == 1       # 3 missing; NULL passes
    assert Q.dq_non_negative(df, "v").count() == 1
    assert Q.dq_check(df, F.col("v") > 0).count() == 2   # -1 and 0 fail; NULL passes


def test_run_suite_and_severity(spark):
    df = spark.createDataFrame([(1, "x"), (1, None)], "id int, s string")
    checks = [Q.Check("t", "id", "unique"), Q.Check("t", "s", "not_null", Q.WARN),
              Q.Check("t", "s", "accepted_values", values=("x",))]
    report = Q.run_suite(checks, lambda name: df)
    got = {r.check_name: (r.failing_rows, r.severity) for r in report.collect()}
    assert got == {"unique_t_id": (1, "error"), "not_null_t_s": (1, "warn"),
                   "accepted_values_t_s": (0, "error")}
    with pytest.raises(Q.DataQualityError):
        Q.raise_on_errors(report)
    warn_only = Q.run_suite(checks[1:], lambda name: df)
    assert [w["check_name"] for w in Q.raise_on_errors(warn_only)] == ["not_null_t_s"]


def test_returned_has_return(spark):
    orders = spark.createDataFrame([(1, "returned"), (2, "returned"), (3, "placed")],
                                   "order_key long, order_status string")
    items = spark.createDataFrame([(10, 1), (20, 2)], "order_item_key long, order_key long")
    returns = spark.createDataFrame([(10,)], "order_item_key long")
    bad = Q.dq_returned_has_return(orders, items, returns)
    assert [r.order_key for r in bad.collect()] == [2]


def test_audit_status_changes(spark):
    old = spark.createDataFrame([(1, None), (2, "placed"), (3, "placed"), (4, "placed")],
                                "k long, status string")
    new = spark.createDataFrame([(1, "placed"), (2, "placed"), (3, "shipped"), (5, "placed")],
                                "k long, status string")
    got = sorted(tuple(r) for r in audit_status_changes(old, new, "k", "status").collect())
    assert got == [(1, None, "placed"), (3, "placed", "shipped")]


def test_insert_ignore_first_writer_wins_and_idempotent(spark):
    existing = spark.createDataFrame([("a", 1)], "k string, v int")
    batch = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2)], "k string, v int")
    once = insert_ignore(batch, existing, ["k"], ["v"])
    twice = insert_ignore(batch, once, ["k"], ["v"])
    assert sorted(tuple(r) for r in once.collect()) == [("a", 1), ("b", 2)]
    assert sorted(tuple(r) for r in twice.collect()) == sorted(tuple(r) for r in once.collect())


def test_touch_and_backfill(spark):
    t0, t1 = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2)
    cur = spark.createDataFrame([(1, "placed", t0), (2, "placed", t0)], "k long, s string, updated_at timestamp")
    upd = spark.createDataFrame([(1, "placed")], "k long, s string")
    always = {r.k: r.updated_at for r in touch_updated_at(cur, upd, "k", stamp=F.lit(t1)).collect()}
    assert always == {1: t1, 2: t0}
    changed = touch_updated_at(cur, upd, "k", stamp=F.lit(t1), only_if_changed=["s"])
    assert {r.k: r.updated_at for r in changed.collect()} == {1: t0, 2: t0}
    facts = spark.createDataFrame([(1, 0), (2, 0)], "k long, total int")
    sums = spark.createDataFrame([(1, 7)], "k long, total int")
    assert sorted(tuple(r) for r in backfill_column(facts, sums, "k", "total").collect()) == [(1, 7), (2, 0)]
