import datetime as dt
from decimal import Decimal

import pytest

from martforge.functions import (
    date_key, day_of_week_sun0, line_total, month_distance, month_start, normalize_email,
    parse_bool_text, parse_mixed_date, parse_money, pct,
)


def _one(spark, values, expr, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr.alias("y")).collect()]


def test_email(spark):
    assert _one(spark, ["  ANN@X.COM ", "", "   ", None], normalize_email("x")) == [
        "ann@x.com", None, None, None]


def test_mixed_dates(spark):
    got = _one(spark, ["2024-03-05", "03/05/2024", "3/5/2024", "junk", "", None, "2024-03-05\n"],
               parse_mixed_date("x"))
    d = dt.date(2024, 3, 5)
    assert got == [d, d, None, None, None, None, None]


def test_impossible_date_strict_fails_quarantine_nulls(spark):
    with pytest.raises(Exception):
        _one(spark, ["2024-02-30"], parse_mixed_date("x", strict=True))
    assert _one(spark, ["2024-02-30", "02/30/2024"], parse_mixed_date("x", strict=False)) == [None, None]


def test_money(spark):
    got = _one(spark, ["$19.99", "19.99"], parse_money("x", strip="$"))
    assert got == [Decimal("19.99"), Decimal("19.99")]
    with pytest.raises(Exception):
        _one(spark, ["1,299.00"], parse_money("x", strip="$"))


def test_bool_spellings(spark):
    assert _one(spark, ["true", "TRUE", "1", "false", "yes", None], parse_bool_text("x")) == [
        True, True, True, False, False, None]


def test_line_total_half_up(spark):
    df = spark.createDataFrame([(3, Decimal("10.05"), Decimal("15"))],
                               "q int, p decimal(10,2), d decimal(5,2)")
    assert df.select(line_total("q", "p", "d")).first()[0] == Decimal("25.63")


def test_dates_helpers(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 5), dt.date(2023, 11, 30))], "a date, b date")
    r = df.select(date_key("a"), month_start("a"), month_distance("a", "b"),
                  day_of_week_sun0("a")).first()
    assert tuple(r) == (20240305, dt.date(2024, 3, 1), 4, 2)  # 2024-03-05 is a Tuesday


def test_pct_guards_zero(spark):
    df = spark.createDataFrame([(Decimal("5"), Decimal("0")), (Decimal("1"), Decimal("8"))],
                               "a decimal(18,2), b decimal(18,2)")
    assert [r[0] for r in df.select(pct("a", "b", 1)).collect()] == [None, 12.5]
