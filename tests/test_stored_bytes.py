"""What the star's jobs shuffle and store: codec, derived columns, no pass over a first batch."""
import datetime as dt
import glob
import os
import time

from pyspark.sql import functions as F

from martforge.functions.clean import line_total
from martforge.operators import ranking
from martforge.operators.ranking import size_shuffles, with_surrogate_key
from martforge.plans import loads, publish, warehouse
from martforge.plans import operations as OP
from martforge.plans.warehouse import Warehouse
from martforge.session import DROP_SHUFFLES, cut_lineage, dropping_shuffles, stored_between
from martforge.sources.landing import ROWS_PER_FILE, landing_schema, scan_raw_csv, write_landing_csv


def test_stored_tables_are_zstd(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "id % 7 as x")
    publish.write_table(df, str(tmp_path / "t"))
    publish.append_table(df, str(tmp_path / "t"))
    assert len(glob.glob(f"{tmp_path}/t/*.zstd.parquet")) == len(glob.glob(f"{tmp_path}/t/*.parquet")) > 0
    stored = cut_lineage(df)
    assert stored.count() == 100 and all(f.endswith(".zstd.parquet") for f in stored.inputFiles())


def test_derived_columns_are_not_shuffled(spark):
    df = spark.createDataFrame([("b", 2), ("a", 5), ("c", None)], "id string, x int")
    got = with_surrogate_key(df, ["id"], "k", 3, derived={"twice": F.col("x") * 2})
    assert got.columns == ["k", "id", "x", "twice"]
    assert sorted(map(tuple, got.collect())) == [(1, "a", 5, 10), (2, "b", 2, 4), (3, "c", None, None)]


def test_line_total_is_exact(spark):
    df = spark.sql("""SELECT * FROM VALUES (3, 0.05BD, 10.00BD, '0.14'), (1, 0.05BD, 50.00BD, '0.03'),
        (2147483647, 1.00BD, 0.00BD, '2147483647.00'), (1, 99999999.99BD, 33.33BD, '66669999.99'), (null, 1.00BD, 0.00BD, null)
        AS t(q, p, d, want)""")
    df = df.select("want", line_total("q", F.col("p").cast("decimal(10,2)"), F.col("d").cast("decimal(5,2)")).alias("got"))
    assert [str(r.got) if r.got is not None else None for r in df.collect()] == [r.want for r in df.collect()]
    assert "/" not in df._jdf.queryExecution().analyzed().toString()  # hundredths are multiplied, not divided


def test_scans_are_cut_finer(spark):
    before = {k: spark.conf.get(k, None) for k in (ranking.SCAN_BYTES, ranking.INITIAL_PARTITIONS)}
    try:
        spark.conf.unset(ranking.SCAN_BYTES)
        size_shuffles(spark, [spark.range(3)])
        assert spark.conf.get(ranking.SCAN_BYTES) == ranking.BYTES_PER_SCAN
        spark.conf.set(ranking.SCAN_BYTES, "64m")  # a session's own value stays
        size_shuffles(spark, [spark.range(3)])
        assert spark.conf.get(ranking.SCAN_BYTES) == "64m"
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_joins_of_small_shares_hash_a_side_and_hot_keys_are_sorted(spark):
    keys = (ranking.SCAN_BYTES, ranking.INITIAL_PARTITIONS, ranking.TASK_BYTES, ranking.HASHED_BYTES,
            "spark.sql.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}

    def joined(hot: bool):
        a = spark.range(3000).selectExpr(f"{'id % 1 + 1' if hot else 'id'} AS k", "sha2(cast(id AS string), 256) AS a").repartition(3)
        b = spark.range(3000).selectExpr("id % 50 AS k" if hot else "id AS k", "sha2(cast(-id AS string), 256) AS b").repartition(3)
        out = a.join(b, "k")
        rows = out.groupBy().agg(F.count(F.lit(1)), F.count_distinct("k")).first()
        out.collect()
        return tuple(rows), out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]

    try:
        for k in keys:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        size_shuffles(spark, [spark.range(3)])
        rows, plan = joined(False)
        assert rows == (3000, 3000) and "ShuffledHashJoin" in plan and "Sort [" not in plan
        spark.conf.set(ranking.TASK_BYTES, "4k")
        spark.conf.set(ranking.HASHED_BYTES, "4k")
        size_shuffles(spark, [spark.range(3)])
        assert spark.conf.get(ranking.HASHED_BYTES) == "4k"  # a session's own value stays
        rows, plan = joined(True)
        assert rows == (3000 * 60, 1) and "SortMergeJoin" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_first_batch_is_not_read_beforehand(spark, tmp_path):
    rows = spark.createDataFrame([("a", 3), ("b", 2), ("a", 1)], "id string, x int")
    load = loads.Load("t", ("id",), lambda now: rows, "k", {"y": F.col("x") + 1})
    sc = spark.sparkContext
    sc.setJobGroup("first-batch", "")
    loads.fresh_rows(load, rows, None)
    jobs = list(sc.statusTracker().getJobIdsForGroup("first-batch"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs
    loads.load_batch(spark, str(tmp_path), "one", [load], dt.datetime(2002, 1, 1))
    assert sorted(map(tuple, loads.read_table_of(spark, str(tmp_path), "t").collect())) == [(1, "a", 1, 2), (2, "b", 2, 3)]


def shuffle_files(spark) -> set:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_shuffle_files_go_when_a_stored_write_ends(spark):
    df = spark.range(1000).selectExpr("id", "sha2(cast(id AS string), 256) AS x").repartitionByRange(4, "x")
    before = shuffle_files(spark)
    stored = cut_lineage(df.groupBy("x").agg(F.max("id").alias("id")))
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:  # they are deleted behind the write
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert stored.count() == df.count() == df.distinct().count() == 1000
    now = spark.conf.get(DROP_SHUFFLES)
    with dropping_shuffles(spark), dropping_shuffles(spark):
        assert spark.conf.get(DROP_SHUFFLES) == "true"
    assert spark.conf.get(DROP_SHUFFLES) == now


def test_landing_files_of_the_load_are_small(spark, tmp_path):
    rows = [(f"CAT-{i}", f'a "quoted"\nname {i}' if i == 70 else f"n {i}", None if i % 9 else "CAT-1") for i in range(250)]
    df = spark.createDataFrame(rows, landing_schema("categories")).coalesce(1)
    path = write_landing_csv({"categories": df}, str(tmp_path), 100)["categories"]
    files = glob.glob(f"{path}/*.csv*")
    assert len(files) == 3 and all(f.endswith(".csv.gz") for f in files)
    assert sorted(map(tuple, scan_raw_csv(spark, path, "categories").collect())) == sorted(rows)
    got = OP.landing_csv_paths(Warehouse(spark, {"categories": df}), spark)["categories"]
    files = [f for f in os.listdir(got.removeprefix("file:")) if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files) and ROWS_PER_FILE <= 500_000


def test_lines_between_joins_and_ranking_are_deleted(spark, monkeypatch):
    landing = {t: spark.createDataFrame(rows, landing_schema(t)) for t, rows in {
        "categories": [("K1", "Root", "")], "customers": [("C1", "Ann", "a@x", "2024-01-10", "c", "S1", "US", "g")],
        "products": [("P1", "p1", "K1", "b", "$10.00", "true")], "orders": [("O1", "C1", "2024-01-05", "placed", "paypal", "1.00")] * 2,
        "order_items": [("I2", "O1", "P1", "2", "10.00", "0"), ("I1", "O1", "P1", "1", "10.00", "50"), ("I3", "O1", "P9", "1", "1.00", "0"),
                        ("I4", None, "P1", "1", "1.00", "0")], "returns": []}.items()}
    kept = []

    def between(df, name):
        out, delete = stored_between(df, name)
        kept.append(os.path.dirname(out.inputFiles()[0].removeprefix("file://")))
        assert os.path.isdir(kept[-1])
        return out, delete

    monkeypatch.setattr(warehouse, "stored_between", between)
    got = Warehouse(spark, landing, spine=(dt.date(2024, 1, 1), dt.date(2024, 12, 31))).fct_order_items
    assert sorted((r.order_item_key, r.order_item_id, str(r.line_total)) for r in got.collect()) == [
        (1, "I1", "5.00"), (2, "I1", "5.00"), (3, "I2", "20.00"), (4, "I2", "20.00")]  # the order comes twice
    assert len(kept) == 3 and not any(map(os.path.exists, kept))
