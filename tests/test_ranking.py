import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from martforge.operators.ranking import ntile_of, with_global_ntile, with_global_rank


def test_global_rank_matches_row_number(spark):
    random.seed(7)
    rows = [(random.randint(0, 5), i, random.random()) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, id int, v double").repartition(7)
    got = with_global_rank(df, [F.col("k").desc(), "id"], "rk", "n", num_partitions=5)
    ref = df.withColumn("rk2", F.row_number().over(Window.orderBy(F.col("k").desc(), "id")))
    joined = got.join(ref, ["k", "id"]).filter(F.col("rk") != F.col("rk2"))
    assert joined.count() == 0
    assert got.select(F.max("n")).first()[0] == 500


def test_hot_leading_key_is_split(spark):
    # a third of the rows share one leading key; ranks stay exact
    rows = [(0 if i % 3 == 0 else i, i) for i in range(900)]
    df = spark.createDataFrame(rows, "k int, id int")
    got = with_global_rank(df, ["k", "id"], "rk", num_partitions=6)
    ranks = sorted(r[0] for r in got.select("rk").collect())
    assert ranks == list(range(1, 901))


def test_ntile_formula_matches_builtin(spark):
    for n in [0, 1, 3, 5, 7, 13, 50]:
        df = spark.range(n).select(F.col("id").cast("int").alias("id"))
        a = with_global_ntile(df, ["id"], 5, "t", num_partitions=3)
        b = df.withColumn("t2", F.ntile(5).over(Window.orderBy("id")))
        assert a.join(b, "id").filter(F.col("t") != F.col("t2")).count() == 0
        assert a.count() == n


def test_ntile_bucket_sizes(spark):
    def sizes(n):
        df = spark.range(n).select(F.col("id").cast("int").alias("id"))
        t = with_global_ntile(df, ["id"], 5, "t", num_partitions=2)
        return [r[1] for r in t.groupBy("t").count().orderBy("t").collect()]
    assert sizes(3) == [1, 1, 1]
    assert sizes(7) == [2, 2, 1, 1, 1]


def test_ntile_of_expression(spark):
    df = spark.createDataFrame([(i, 7) for i in range(1, 8)], "r long, n long")
    assert [x[0] for x in df.select(ntile_of("r", "n", 5)).collect()] == [1, 1, 2, 2, 3, 4, 5]


from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(-5, 5))),
                min_size=0, max_size=60),
       st.integers(1, 6), st.integers(1, 7))
def test_rank_and_ntile_property(spark, rows, parts, buckets):
    """Any data, any partition count: rank equals row_number and the n-tile
    equals NTILE over the same total order (NULLs first, unique tie-break)."""
    data = [(k, v, i) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, v int, id int")
    order = [F.col("k").desc(), F.col("v").asc_nulls_first(), F.col("id")]
    got = with_global_rank(df, order, "rk", num_partitions=parts)
    got = got.withColumn("nt", ntile_of("rk", F.lit(len(data)), buckets))
    w = Window.orderBy(*order)
    ref = df.select("id", F.row_number().over(w).alias("rk2"), F.ntile(buckets).over(w).alias("nt2"))
    bad = got.join(ref, "id").filter((F.col("rk") != F.col("rk2")) | (F.col("nt") != F.col("nt2")))
    assert bad.count() == 0
    assert got.count() == len(data)


def test_rank_with_aqe_sized_partitions(spark):
    """No partition count: AQE coalesces neighbouring ranges; order holds."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    try:
        df = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("k"), "id")
        got = with_global_rank(df, ["k", "id"], "rk")
        ref = df.withColumn("rk2", F.row_number().over(Window.orderBy("k", "id")))
        assert got.join(ref, ["k", "id"]).filter(F.col("rk") != F.col("rk2")).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_rank_over_many_partitions(spark):
    """Offsets of several partitions and the total are right."""
    import martforge.operators.ranking as R
    df = spark.range(500).select((F.col("id") * 37 % 101).alias("k"), "id")
    got = R.with_global_rank(df, ["k", "id"], "rk", "n", num_partitions=7)
    ref = df.withColumn("rk2", F.row_number().over(Window.orderBy("k", "id")))
    assert got.join(ref, ["k", "id"]).filter(F.col("rk") != F.col("rk2")).count() == 0
    assert {r.n for r in got.select("n").distinct().collect()} == {500}


def test_range_partitions_follow_the_input_bytes(spark, monkeypatch, tmp_path):
    import martforge.operators.ranking as R
    path = str(tmp_path / "t")
    spark.range(20000).write.parquet(path)
    df = spark.read.parquet(path)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert R.range_partitions(df) == least
    monkeypatch.setattr(R, "BYTES_PER_RANGE", 1000)
    assert R.range_partitions(df) > 20 and R.range_partitions(df.join(df, "id")) > R.range_partitions(df)
    # rows without a known size don't count
    assert R.range_partitions(spark.createDataFrame([(1,)], "id long")) == least


def test_columns_that_only_order_the_rows_are_not_written(spark, monkeypatch):
    import martforge.operators.ranking as R
    written = []
    monkeypatch.setattr(R, "cut_lineage", lambda df: written.append(df.columns) or df)
    df = spark.createDataFrame([(1, None, "c"), (1, 5, "a"), (1, 2, "b"), (None, 9, "d"), (1, 2, "e")], "k long, tie long, v string")
    got = R.with_global_rank(df, ["k", "tie", "v"], "rk", keep=["v"])
    assert written == [["v", "_mf_tag"]]
    assert {tuple(r) for r in got.collect()} == {("d", 1), ("c", 2), ("b", 3), ("e", 4), ("a", 5)}


def test_shuffles_start_with_partitions_for_the_greatest_table(spark, monkeypatch, tmp_path):
    import martforge.operators.ranking as R
    path = str(tmp_path / "t")
    spark.range(20000).write.parquet(path)
    small, large = spark.createDataFrame([(1,)], "id long"), spark.read.parquet(path)
    least = spark.conf.get("spark.sql.shuffle.partitions")
    was = spark.conf.get(R.INITIAL_PARTITIONS, None)
    try:
        spark.conf.unset(R.INITIAL_PARTITIONS)
        R.size_shuffles(spark, [small])
        assert spark.conf.get(R.INITIAL_PARTITIONS) == least
        monkeypatch.setattr(R, "BYTES_PER_RANGE", 1000)
        R.size_shuffles(spark, [small, large])
        assert int(spark.conf.get(R.INITIAL_PARTITIONS)) == R.range_partitions(large) > 20
        spark.conf.set(R.INITIAL_PARTITIONS, "5")  # the session's own value
        R.size_shuffles(spark, [small, large])
        assert spark.conf.get(R.INITIAL_PARTITIONS) == "5"
    finally:
        spark.conf.unset(R.INITIAL_PARTITIONS)
        if was is not None:
            spark.conf.set(R.INITIAL_PARTITIONS, was)


def test_range_partition_of_stored_rows_fits_a_task():
    import martforge.operators.ranking as R
    assert R.BYTES_PER_RANGE <= 16 << 20  # 256 MB of stored line items spilled when sorted
