"""Change capture and idempotent loads, as set operations on snapshots.

The source keeps these in row triggers and conflict clauses; on Spark they
are joins between the current table and an incoming batch:

* ``audit_status_changes``  old/new snapshot join, keep rows whose status is
  distinct (NULL-safe), as the audit trigger logs them (updates only);
* ``touch_updated_at``      stamp rows of an update batch with the time;
* ``insert_ignore``         ``INSERT ... ON CONFLICT (key) DO NOTHING``;
* ``backfill_column``       ``UPDATE f SET c = s.c FROM s WHERE key``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.operators.dedup import distinct_on


def audit_status_changes(old: DataFrame, new: DataFrame, key: str, col: str,
                         changed_at: Column | None = None) -> DataFrame:
    """One row (key, old value, new value[, changed_at]) per key present in
    both snapshots whose value changed; NULL -> value counts as a change.
    Inserted and deleted keys are not logged."""
    o = old.select(key, F.col(col).alias(f"old_{col}"))
    n = new.select(key, F.col(col).alias(f"new_{col}"))
    out = o.join(n, key, "inner").filter(~F.col(f"old_{col}").eqNullSafe(F.col(f"new_{col}")))
    if changed_at is not None:
        out = out.withColumn("changed_at", changed_at)
    return out


def apply_updates(current: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """``UPDATE current SET <cols> = updates.<cols> WHERE key matches``: rows
    in the batch take its values, the others keep theirs."""
    value_cols = [c for c in updates.columns if c != key]
    u = updates.select(key, *[F.col(c).alias(f"_mf_new_{c}") for c in value_cols],
                       F.lit(True).alias("_mf_hit"))
    hit = F.coalesce(F.col("_mf_hit"), F.lit(False))
    return current.join(u, key, "left").select(
        *[F.when(hit, F.col(f"_mf_new_{c}")).otherwise(F.col(c)).alias(c) if c in value_cols
          else F.col(c) for c in current.columns])


def touch_updated_at(current: DataFrame, updates: DataFrame, key: str,
                     ts_col: str = "updated_at", stamp: Column | None = None,
                     only_if_changed: Sequence[str] | None = None) -> DataFrame:
    """Apply an update batch: updated rows take the batch's values and a new
    ``ts_col`` stamp, the others keep theirs.

    With ``only_if_changed`` a row is stamped only when one of those columns
    changed; without it every updated row is stamped, changed or not (as the
    source's order trigger does).
    """
    stamp = stamp if stamp is not None else F.current_timestamp()
    value_cols = [c for c in updates.columns if c != key]
    u = updates.select(key, *[F.col(c).alias(f"_mf_new_{c}") for c in value_cols],
                       F.lit(True).alias("_mf_hit"))
    j = current.join(u, key, "left")
    hit = F.coalesce(F.col("_mf_hit"), F.lit(False))
    if only_if_changed:
        changed = None
        for c in only_if_changed:
            d = ~F.col(c).eqNullSafe(F.col(f"_mf_new_{c}"))
            changed = d if changed is None else (changed | d)
        touched = hit & changed
    else:
        touched = hit
    cols = []
    for c in current.columns:
        if c in value_cols:
            cols.append(F.when(hit, F.col(f"_mf_new_{c}")).otherwise(F.col(c)).alias(c))
        elif c == ts_col:
            cols.append(F.when(touched, stamp).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def insert_ignore(incoming: DataFrame, existing: DataFrame, key: Sequence[str],
                  order: Sequence) -> DataFrame:
    """``INSERT INTO existing SELECT ... FROM incoming ON CONFLICT DO NOTHING``.

    The first writer wins: existing rows are kept, and of several incoming
    rows with one key only the first in ``order`` is inserted.  Loading the
    same batch twice leaves the table unchanged.
    """
    first = distinct_on(incoming, list(key), order)
    fresh = first.join(existing.select(*key), list(key), "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def backfill_column(facts: DataFrame, values: DataFrame, key: str, col: str) -> DataFrame:
    """``UPDATE facts SET col = values.col FROM values WHERE key matches``;
    rows without a match keep their value."""
    v = values.select(key, F.col(col).alias("_mf_value"))
    return facts.join(v, key, "left").select(
        *[F.coalesce(F.col("_mf_value"), F.col(c)).alias(c) if c == col else F.col(c)
          for c in facts.columns])
