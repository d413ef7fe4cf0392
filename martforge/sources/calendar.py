"""Calendar spine (``dim_date``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.dates import date_key, day_of_week_sun0


def calendar_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day in ``[start, end]`` with key, year, quarter, month,
    day, weekday (0 = Sunday) and a weekend flag.

    The size is fixed by the two dates (about 365 rows a year), so joins may
    broadcast it whatever the size of the facts.
    """
    days = spark.range(1).select(
        F.explode(
            F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
        ).alias("full_date")
    )
    d = F.col("full_date")
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).cast("int").alias("year"),
        F.quarter(d).cast("int").alias("quarter"),
        F.month(d).cast("int").alias("month"),
        F.dayofmonth(d).cast("int").alias("day"),
        day_of_week_sun0(d).alias("day_of_week"),
        day_of_week_sun0(d).isin(0, 6).alias("is_weekend"),
    )
