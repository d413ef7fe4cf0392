"""N-tiles by selection, CSV landing, quarantine with cascade and update batches."""
import datetime as dt
import os
import uuid
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from martforge.operators import quantiles
from martforge.operators.quality import WARN, Check
from martforge.operators.quarantine import quarantine, reject_counts, with_rows
from martforge.operators.quantiles import Tiles, with_exact_ntiles
from martforge.plans import operations as OP
from martforge.plans import planted
from martforge.plans import updates as U
from martforge.plans.publish import current_version
from martforge.plans.warehouse import warehouse_for
from martforge.session import scratch_path
from martforge.sources.landing import csv_paths, csv_to_landing, fields_span_lines, landing_frames, scan_raw_csv, write_landing_csv


# --- n-tiles

SCHEMA = "id long, days int, n long, money decimal(28,2), day date"
TILES = [Tiles("a", "days", descending=True, nulls_first=True), Tiles("b", "n"), Tiles("c", "money", descending=True),
         Tiles("d", "day", nulls_first=True)]


def check_tiles(spark, rows, buckets):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.id: (r.a, r.b, r.c, r.d) for r in with_exact_ntiles(df, TILES, "id", buckets).collect()}

    def rank(value, key=lambda v: v, nulls=1):
        order = sorted(rows, key=lambda r: ((r[value] is None) == bool(nulls), key(r[value]) if r[value] is not None else 0, r[0]))
        size, more = divmod(len(rows), buckets)
        sizes = [size + (j < more) for j in range(buckets)]
        tiles = [j + 1 for j, s in enumerate(sizes) for _ in range(s)]
        return {r[0]: t for r, t in zip(order, tiles)}

    want = [rank(1, lambda v: -v, 0), rank(2), rank(3, lambda v: -v), rank(4, lambda v: v.toordinal(), 0)]
    assert got == {r[0]: tuple(w[r[0]] for w in want) for r in rows}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(
    st.none() | st.integers(-5, 5), st.none() | st.integers(-2 ** 60, 2 ** 60), st.none() | st.sampled_from([Decimal("-1.25"), Decimal("99999999999999999999.99")]),
    st.none() | st.dates(dt.date(1960, 1, 1), dt.date(2030, 1, 1))), max_size=40), st.integers(1, 7), st.integers(2, 50))
def test_tiles_equal_ntile(spark, rows, buckets, ranges):
    quantiles.RANGES, before = ranges, quantiles.RANGES
    try:
        check_tiles(spark, [(i * 7 - 3, *r) for i, r in enumerate(rows)], buckets)
    finally:
        quantiles.RANGES = before


def test_tiles_of_a_hot_value_and_the_plan(spark):
    check_tiles(spark, [(i, 1, 5 if i % 3 else i, Decimal("1.00"), None) for i in range(500)], 5)
    check_tiles(spark, [], 5)
    check_tiles(spark, [(1, None, None, None, None)], 5)
    df = spark.range(100).select("id", (F.col("id") % 9).alias("n"))
    out = with_exact_ntiles(df, [Tiles("t", "n")], "id", 5)
    plan = out._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan
    ref = df.withColumn("t", F.ntile(5).over(Window.orderBy("n", "id")))
    assert sorted(out.collect()) == sorted(ref.collect())
    with pytest.raises(TypeError):
        with_exact_ntiles(spark.createDataFrame([(1, 0.5)], "id long, x double"), [Tiles("t", "x")], "id", 5)


# --- CSV

def test_csv_files_split_unless_a_field_spans_lines(spark):
    base = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    rows = [(f"CAT-{i}", f'a "quoted", name {i}', "") for i in range(20_000)]
    plain = spark.createDataFrame(rows, "category_id string, category_name string, parent_category_id string")
    spans = plain.limit(50).withColumn("category_name", F.concat("category_name", F.lit("\n\nsecond \"line\" \n")))
    one = write_landing_csv({"categories": plain.coalesce(1)}, f"{base}/one")["categories"]
    two = write_landing_csv({"categories": spans.coalesce(1)}, f"{base}/two")["categories"]
    assert not fields_span_lines(spark, one) and fields_span_lines(spark, two)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        got = scan_raw_csv(spark, one, "categories")
        assert got.rdd.getNumPartitions() > 4  # one file
        assert sorted(r[:2] for r in got.collect()) == sorted(r[:2] for r in rows)
        assert sorted(r[:2] for r in scan_raw_csv(spark, two, "categories").collect()) == sorted(r[:2] for r in spans.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_with_another_header_fails(spark):
    base = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    spark.createDataFrame([("a", "b", "c")], "category_id string, title string, parent_category_id string").write.option(
        "header", "true").csv(base)
    with pytest.raises(Exception):  # noqa: B017 - Spark's own error
        scan_raw_csv(spark, base, "categories").collect()


def test_landing_from_csv_folder(spark):
    base = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    frames = landing_frames(spark, SF_SMALL)
    write_landing_csv(frames, f"{base}/csv")
    landed = csv_to_landing(spark, csv_paths(f"{base}/csv"), f"{base}/landing")
    assert set(landed) == set(frames)
    for t, df in frames.items():
        assert landed[t].count() == df.count() and landed[t].columns == df.columns


# --- quarantine

def test_cascade_until_nothing_changes(spark):
    tree = spark.createDataFrame([("a", None), ("b", "a"), ("c", "lost"), ("d", "c"), ("e", "d"), ("f", "b"), ("f", "a")], "id string, up string")
    leaf = spark.createDataFrame([(1, "e", 5), (2, "b", -1), (3, None, 1), (4, "f", 1), (None, "b", 2)], "id int, node string, v int")
    checks = [Check("tree", "up", "relationships", to_model="tree", to_column="id"), Check("tree", "id", "unique"),
              Check("leaf", "node", "relationships", to_model="tree", to_column="id"), Check("leaf", "v", "non_negative"),
              Check("leaf", "id", "not_null"), Check("leaf", "node", "accepted_values", WARN, values=("none",))]
    tables = {"tree": with_rows(tree), "leaf": with_rows(leaf)}
    got = quarantine(tables, checks)
    assert sorted(r.id for r in got.kept["tree"].collect()) == ["a", "b", "f"]
    assert sorted(r.id for r in got.kept["leaf"].collect()) == [3, 4]
    assert got.kept["leaf"].columns == leaf.columns and got.rounds == 4
    counts = {r.table_name: (r.n_input, r.n_kept, r.n_rejected) for r in reject_counts(tables, got).collect()}
    assert counts == {"tree": (7, 3, 4), "leaf": (5, 2, 3)}
    assert {r.reason for r in got.rejects.collect()} == {c.check_name for c in checks if c.severity != WARN}


def test_unique_keeps_the_first_of_equal_rows(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, None), (None, "x"), (None, "x")], "id int, v string")
    kept = quarantine({"t": df}, [Check("t", "id", "unique")]).kept["t"]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, "a"), (2, None), (None, "x"), (None, "x")], key=str)


def test_planted_rows_break_every_check(spark):
    wh = warehouse_for(spark, SF_SMALL)
    report = planted.planted_report(wh).collect()
    assert len(report) == len(planted.PLANTED_SUITE) and all(r.failing_rows > 0 for r in report)
    assert {r.test for r in report} == {"not_null", "unique", "accepted_values", "relationships", "non_negative", "expression"}
    for r in planted.quarantine_counts(wh).collect():
        assert r.n_input == r.n_kept + r.n_rejected and r.n_rejected > 0
    kept = planted.quarantine_star(wh)
    clean = planted.run_suite(planted.PLANTED_SUITE, lambda m: getattr(kept, m)).collect()
    assert all(r.failing_rows == 0 for r in clean)


# --- update batches

def test_update_batch_is_one_transaction(spark):
    wh = warehouse_for(spark, SF_SMALL)
    root = scratch_path(spark, f"updates-{uuid.uuid4().hex}")
    OP.publish_order_tables(wh, spark, root)
    first = current_version(spark, root)
    orders = U.read_table_of(spark, root, "fct_orders")
    bare = orders.join(wh.fct_order_items.select("order_key").distinct(), "order_key", "left_anti")
    no_return = orders.join(wh.fct_order_items.join(wh.fct_returns, "order_item_key").select("order_key"), "order_key", "left_anti")
    bad = no_return.orderBy("order_key").limit(3).select("order_key", F.lit("returned").alias("order_status"))
    assert bare is not None and bad.count() == 3
    with pytest.raises(U.RejectedBatch, match="on 3 rows, the first being"):
        OP.update_orders(spark, root, "bad", bad, OP.UPDATE_TIME)
    assert current_version(spark, root) == first and U.read_table_of(spark, root, U.LOG).count() == 0
    good = orders.filter("order_key in (1, 2, 5)").select("order_key", F.lit("cancelled").alias("order_status"))
    with pytest.raises(U.RejectedBatch, match="more than once"):
        OP.update_orders(spark, root, "twice", good.unionByName(good), OP.UPDATE_TIME)
    changed = orders.filter("order_key in (1, 2, 5) and order_status <> 'cancelled'").count()
    second = OP.update_orders(spark, root, "good", good, OP.UPDATE_TIME)
    assert current_version(spark, root) == second != first
    assert OP.update_orders(spark, root, "good", good, OP.SECOND_UPDATE_TIME) == second  # a replay
    after = U.read_table_of(spark, root, "fct_orders")
    assert after.count() == orders.count()
    assert {r.order_key for r in after.filter(F.col("updated_at") == F.lit(OP.UPDATE_TIME)).collect()} == {1, 2, 5}
    more = orders.filter("order_key in (8, 9)").select("order_key", F.lit("placed").alias("order_status"))
    changed += orders.filter("order_key in (8, 9) and order_status <> 'placed'").count()
    OP.update_orders(spark, root, "more", more, OP.SECOND_UPDATE_TIME)
    audit = U.read_table_of(spark, root, U.AUDIT).orderBy("audit_id").collect()
    assert [r.audit_id for r in audit] == list(range(1, changed + 1))
    assert [r.batch_id for r in audit] == sorted(r.batch_id for r in audit)
    assert {r.batch_id: r.rows for r in U.read_table_of(spark, root, U.LOG).collect()} == {"good": 3, "more": 2}


def test_a_writer_that_comes_late_fails(spark, monkeypatch):
    root = scratch_path(spark, f"updates-{uuid.uuid4().hex}")
    df = spark.createDataFrame([(1, "a", OP.LOAD_TIME)], "id long, v string, updated_at timestamp")
    base = U.publish_tables(spark, root, {"t": df})
    U.apply_batch(spark, root, "t", "id", "one", df.select("id", F.lit("b").alias("v")), OP.UPDATE_TIME)
    with pytest.raises(U.ConcurrentUpdate):
        U._publish(spark, root, base, {"t": df}, {})
    assert [r.v for r in U.read_table_of(spark, root, "t").collect()] == ["b"]
    assert os.path.basename(base) == base


def test_no_keys_of_the_quarantine_are_broadcast(spark, monkeypatch):
    from martforge.operators import quarantine as module
    plans, cut = [], module.cut_lineage

    def watched(df, name="lineage"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df, name)

    monkeypatch.setattr(module, "cut_lineage", watched)
    nodes = [(i, i - 1 if i else None, i % 5) for i in range(6)] + [(1, 0, 3), (6, 99, 0), (7, 6, 1), (8, 7, 2), (8, 5, 2)]
    tables = {"node": spark.createDataFrame(nodes, "id long, parent long, n int"),
              "leaf": spark.createDataFrame([(i, i) for i in range(10)], "id long, node long")}
    result = quarantine(tables, [Check("node", "parent", "relationships", to_model="node", to_column="id"),
                                 Check("leaf", "id", "unique"), Check("leaf", "id", "non_negative"),
                                 Check("leaf", "node", "relationships", to_model="node", to_column="id")])
    rejected = sorted((r.table_name, r["round"]) for r in result.rejects.collect())
    # node 8 has a second row below 5, so its key and its leaf stay
    assert rejected == [("leaf", 1), ("leaf", 2), ("leaf", 3), ("node", 1), ("node", 2), ("node", 3)]
    assert sorted(r.id for r in result.kept["leaf"].collect()) == [0, 1, 2, 3, 4, 5, 8]
    assert result.rounds == 3
    plans += [df._jdf.queryExecution().executedPlan().toString() for df in result.kept.values()]
    assert len(plans) > 6 and not any("BroadcastHashJoin" in p for p in plans)
