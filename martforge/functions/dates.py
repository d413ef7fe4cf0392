"""Date expressions: surrogate date keys, month buckets, weekday."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c) -> Column:
    """Date to a ``YYYYMMDD`` integer key; NULL date gives NULL key."""
    d = _c(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_start(c) -> Column:
    """First day of the month, as a date (``date_trunc('month', d)::date``)."""
    return F.trunc(_c(c), "MM")


def month_distance(later, earlier) -> Column:
    """Whole calendar months between two dates: ``(y2-y1)*12 + (m2-m1)``."""
    a, b = _c(later), _c(earlier)
    return ((F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))).cast("int")


def day_of_week_sun0(c) -> Column:
    """Weekday with 0 = Sunday .. 6 = Saturday (Spark's ``dayofweek`` is 1-based)."""
    return (F.dayofweek(_c(c)) - 1).cast("int")
