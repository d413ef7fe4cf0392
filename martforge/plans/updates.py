"""Update batches as transactions on published tables.

The source updates rows under triggers: a guard refuses the statement, the time
of the update is stamped, and status changes are logged, all in one transaction.
Here a batch (key and new values) becomes one new published version or none:

1. a batch that is logged already changes nothing (a replay after a crash);
2. the guard looks at the table as it would be; one offender raises
   ``RejectedBatch`` with their number and first keys, and readers keep the version they have;
3. the updated table, the batch's audit rows and its entry in the batch log are
   written into a fresh version folder;
4. one rename of the pointer makes all of it visible.

A version is a list of folders for each table (``tables.json`` in its folder), so that tables
the batch doesn't touch, and the audit rows of earlier batches, stay where they are.
Audit numbers go on from the greatest one stored and follow the key within a batch.
Two writers at once: the later one finds that the pointer has moved and raises.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.operators.changes import audit_status_changes, touch_updated_at
from martforge.operators.ranking import with_global_rank
from martforge.plans.publish import current_version, new_version, publish_version, read_text, write_table, write_text

TABLES = "tables.json"
AUDIT, LOG = "status_audit", "batch_log"
LOG_SCHEMA = "batch_id string, table_name string, rows long, applied_at timestamp"
KEYS_NAMED = 5  # offending keys in an error message


class RejectedBatch(RuntimeError):
    """The batch breaks a rule; nothing of it was published."""


class ConcurrentUpdate(RuntimeError):
    """Another writer published since this batch was read."""


def folders_of(spark: SparkSession, root: str, version: str) -> dict[str, list[str]]:
    return json.loads(read_text(spark, f"{root}/{version}/{TABLES}"))


def read_table_of(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the published version."""
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing published under {root}")
    return spark.read.parquet(*[f"{root}/{f}" for f in folders_of(spark, root, version)[name]])


def _publish(spark: SparkSession, root: str, base: str | None, replaced: dict[str, DataFrame],
             added: dict[str, DataFrame], layout: dict[str, list[str]] | None = None) -> str:
    version = new_version()
    folders = folders_of(spark, root, base) if base else {}
    for name, df in {**replaced, **added}.items():
        write_table(df, f"{root}/{version}/{name}", "errorifexists", (layout or {}).get(name))
        folders[name] = [*(folders.get(name, []) if name in added else []), f"{version}/{name}"]
    return publish_folders(spark, root, base, version, folders)


def publish_folders(spark: SparkSession, root: str, base: str | None, version: str, folders: dict[str, list[str]]) -> str:
    """Names a version by the folders of each table, unless the pointer has left ``base``."""
    write_text(spark, f"{root}/{version}/{TABLES}", json.dumps(folders))
    if current_version(spark, root) != base:
        raise ConcurrentUpdate(f"{root} has moved on from {base}")
    publish_version(spark, root, version)
    return version


def publish_tables(spark: SparkSession, root: str, tables: dict[str, DataFrame],
                   layout: dict[str, list[str]] | None = None) -> str:
    """The first version of a set of tables, with an empty batch log."""
    log = spark.createDataFrame([], LOG_SCHEMA)
    return _publish(spark, root, current_version(spark, root), {**tables, LOG: log}, {}, layout)


def apply_batch(spark: SparkSession, root: str, table: str, key: str, batch_id: str, updates: DataFrame,
                applied_at: dt.datetime, audited: str | None = None,
                guard: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
                layout: dict[str, list[str]] | None = None) -> str:
    """Apply one batch of updates and return the published version.

    ``updates`` holds ``key`` and the columns to set; every row of the batch is
    stamped in ``updated_at``.  Changes of the column ``audited`` are logged.
    ``guard(after, updates)`` returns offenders with their ``key``."""
    base = current_version(spark, root)
    log = read_table_of(spark, root, LOG)
    if not log.filter(F.col("batch_id") == batch_id).isEmpty():
        return base
    before = read_table_of(spark, root, table)
    twice = updates.groupBy(key).count().filter("count > 1")
    _refuse(twice, key, f"batch {batch_id} names {{n}} keys of {table} more than once")
    after = touch_updated_at(before, updates, key, stamp=F.lit(applied_at))
    if guard is not None:
        _refuse(guard(after, updates), key, f"batch {batch_id} breaks the rule of {table} on {{n}} rows")
    rows = updates.join(before.select(key), key, "left_semi").agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(batch_id).alias("batch_id"), F.lit(table).alias("table_name"), "rows", F.lit(applied_at).alias("applied_at"))
    added = {LOG: rows}
    if audited is not None:
        added[AUDIT] = _audit_rows(spark, root, base, before, updates, key, audited, batch_id, applied_at)
    return _publish(spark, root, base, {table: after}, added, layout)


def _refuse(offenders: DataFrame, key: str, message: str) -> None:
    n = offenders.count()
    if n:
        named = ", ".join(str(r[0]) for r in offenders.select(key).orderBy(key).limit(KEYS_NAMED).collect())
        raise RejectedBatch(f"{message.format(n=n)}, the first being {named}")


def _audit_rows(spark: SparkSession, root: str, base: str, before: DataFrame, updates: DataFrame, key: str,
                audited: str, batch_id: str, applied_at: dt.datetime) -> DataFrame:
    last = 0
    if AUDIT in folders_of(spark, root, base):
        last = read_table_of(spark, root, AUDIT).agg(F.max("audit_id")).first()[0] or 0
    changes = audit_status_changes(before, updates, key, audited)
    ranked = with_global_rank(changes, [key], "audit_id")
    return ranked.select((F.col("audit_id") + last).alias("audit_id"), F.lit(batch_id).alias("batch_id"), key,
                         f"old_{audited}", f"new_{audited}", F.lit(applied_at).alias("changed_at"))
