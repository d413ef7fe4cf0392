"""Values beyond the sizes of the test tables: long keys, late dates, wide sums, one scan a model."""
import datetime as dt

from pyspark.sql import functions as F

from martforge.functions.clean import money_sum, pct
from martforge.operators.quality import Check, dq_returned_has_return, run_suite
from martforge.plans.operations import table_stats
from martforge.plans.warehouse import Warehouse
from martforge.sources.landing import source_id


def test_long_keys_stay_whole(spark):
    df = spark.createDataFrame([(7,), (10_000_000_001,), (10_000_000_002,), (1_234_567_890_123,)], "k long")
    got = [r[0] for r in df.select(source_id("CUST", F.col("k"))).collect()]
    assert got == ["CUST-0000000007", "CUST-10000000001", "CUST-10000000002", "CUST-1234567890123"]
    assert df.select(source_id("ORD", F.col("k"))).distinct().count() == 4


def test_sums_beyond_eighteen_digits(spark):
    df = spark.sql("SELECT cast('99999999999999.99' AS decimal(28,2)) AS x FROM range(1000)")
    total = df.agg(money_sum("x").alias("t")).first()[0]
    assert str(total) == "99999999999999990.00"
    assert df.agg(money_sum("x").alias("t")).select(pct("t", "t", 2)).first()[0] == 100.0


def test_calendar_covers_the_dates(spark):
    landing = {
        "orders": spark.createDataFrame([("ORD-1", "CUST-1", "2031-05-06", "placed", "card", "1.00"),
                                         ("ORD-2", "CUST-1", "unknown", "placed", "card", "1.00")],
                                        "order_id string, customer_id string, order_date string, "
                                        "order_status string, payment_method string, shipping_cost string"),
        "returns": spark.createDataFrame([("RET-1", "OI-1", "2033-01-02", "other", "1.00")],
                                         "return_id string, order_item_id string, return_date string, "
                                         "return_reason string, refund_amount string")}
    wh = Warehouse(spark, landing)
    assert wh.observed_years == (dt.date(2031, 1, 1), dt.date(2033, 12, 31))
    assert wh.dim_date.count() == 365 * 3 + 1


def test_row_checks_scan_a_model_once(spark, tmp_path):
    spark.range(10).selectExpr("id as a", "id - 5 as b", "nullif(id, 3) as c").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    checks = [Check("t", "a", "not_null", name="n_a"), Check("t", "c", "not_null", name="n_c"),
              Check("t", "b", "non_negative", name="pos_b")]
    report = run_suite(checks, lambda name: table)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert {r.check_name: r.failing_rows for r in report.collect()} == {"n_a": 0, "n_c": 1, "pos_b": 5}


def test_returned_rule_with_a_hot_order(spark):
    orders = spark.createDataFrame([(1, "returned"), (2, "returned")], "order_key long, order_status string")
    items = spark.range(500).selectExpr("id as order_item_key", "cast(1 as long) as order_key")
    returns = spark.range(500).selectExpr("id as order_item_key")
    assert [r.order_key for r in dq_returned_has_return(orders, items, returns).collect()] == [2]


def test_table_stats(spark):
    df = spark.createDataFrame([(1, "b"), (1, None), (3, "a")], "x int, y string")
    assert sorted(map(tuple, table_stats(df, ["x", "y"]).collect())) == [("x", 2, 0, "1", "3"), ("y", 2, 1, "a", "b")]
