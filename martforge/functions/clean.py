"""Cleaning and money expressions used by the staging jobs.

Every function returns a ``Column`` built from JVM-side functions, so the
expressions stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martforge.constants import (
    BOOLEAN_TRUE_SPELLINGS,
    ISO_DATE_PATTERN,
    US_DATE_FORMAT,
    US_DATE_PATTERN,
)

MONEY = "decimal(10,2)"
LINE_MONEY = "decimal(12,2)"
SUM_MONEY = "decimal(28,2)"
PCT_TYPE = "decimal(5,2)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """``NULLIF(x, '')``."""
    return F.nullif(_c(c), F.lit(""))


def normalize_email(c) -> Column:
    """Trim spaces, lower-case, and turn an empty result into NULL."""
    return F.nullif(F.lower(F.trim(_c(c))), F.lit(""))


def parse_mixed_date(c, strict: bool = True) -> Column:
    """ISO ``yyyy-MM-dd`` or US ``MM/dd/yyyy`` text to a date; other text NULL.

    The pattern guards each branch, so junk never reaches a cast.  A text of
    the right shape with an impossible day (``2024-02-30``) fails the job in
    strict mode, like the source database; ``strict=False`` turns it into
    NULL instead (quarantine mode).
    """
    c = _c(c)
    if strict:
        iso = c.cast("date")
        us = F.to_date(c, US_DATE_FORMAT)
    else:
        iso = F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).cast("date")
        us = F.try_to_timestamp(c, F.lit(US_DATE_FORMAT)).cast("date")
    return F.when(c.rlike(ISO_DATE_PATTERN), iso).when(c.rlike(US_DATE_PATTERN), us)


def parse_money(c, dtype: str = MONEY, strip: str | None = None) -> Column:
    """Text to an exact decimal; optionally strip one literal character
    (``'$'``).  Any other junk (``'1,299.00'``) fails the job under ANSI."""
    c = _c(c)
    if strip:
        c = F.replace(c, F.lit(strip), F.lit(""))
    return c.cast(dtype)


def parse_bool_text(c) -> Column:
    """``lower(x) IN ('true', '1')``: NULL stays NULL, other text is false."""
    return F.lower(_c(c)).isin(*BOOLEAN_TRUE_SPELLINGS)


def line_total(quantity, unit_price, discount_pct) -> Column:
    """``round(q * p * (1 - d / 100), 2)`` in exact decimals (HALF_UP).  Hundredths
    are multiplied by 0.01, which is as exact as a division and costs less."""
    q = _c(quantity).cast("decimal(10,0)")
    gross = q * _c(unit_price)
    factor = (F.lit(100).cast("decimal(3,0)") - _c(discount_pct)) * F.lit("0.01").cast("decimal(2,2)")
    return F.round(gross * factor, 2).cast(LINE_MONEY)


def money_sum(c) -> Column:
    """Sum of money as ``decimal(28,2)``: totals of 100 TB of lines stay far below it."""
    return F.sum(_c(c)).cast(SUM_MONEY)


def pct(numer, denom, scale: int) -> Column:
    """``round(100 * numer / nullif(denom, 0), scale)`` as double.

    The ratio is formed on exact decimals and rounded HALF_UP before the
    final cast, so the value equals the source database's numeric result.
    """
    n = _c(numer).cast(SUM_MONEY)
    d = F.nullif(_c(denom).cast(SUM_MONEY), F.lit(0).cast(SUM_MONEY))
    return F.round(F.lit(100).cast("decimal(3,0)") * n / d, scale).cast("double")
