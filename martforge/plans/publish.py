"""Writing tables: full refresh, append, and an all-or-nothing publish.

The source builds its whole warehouse inside one transaction: a failing
check rolls everything back and readers never see half a load.  Plain
Parquet folders have no transactions, so ``atomic_publish``:

1. writes every table, in its layout, into a fresh, never-reused version folder;
2. runs the checks on the written files and aborts if one fails;
3. only then names the version in the ``_CURRENT`` pointer, with one rename
   that replaces the old pointer (``FileContext.rename`` with OVERWRITE, a
   single step on HDFS and local file systems).

Readers resolve the pointer (``read_published``); an aborted or half-written
version is never named by it.  Old versions stay until a retention job
removes them.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.operators.quality import raise_on_errors
from martforge.operators.ranking import range_partitions
from martforge.session import STORED_CODEC

POINTER = "_CURRENT"


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                sort_by: list[str] | None = None, partitions: int | None = None) -> None:
    """Write one table.  ``sort_by`` range-partitions and sorts the rows on
    those columns so Parquet row-group statistics prune point lookups."""
    if sort_by:
        n = partitions or range_partitions(df)
        df = df.repartitionByRange(n, *sort_by).sortWithinPartitions(*sort_by)
    df.write.mode(mode).option("compression", STORED_CODEC).parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    """Plain append: loading the same batch twice doubles it (the source's
    fact loads behave so).  Use ``insert_ignore`` for idempotent loads."""
    df.write.mode("append").option("compression", STORED_CODEC).parquet(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _write_pointer(spark: SparkSession, root: str, version: str) -> None:
    fs, path, jvm = _fs(spark, root)
    tmp = jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}.{uuid.uuid4().hex}")
    final = jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}")
    out = fs.create(tmp, True)
    out.write(bytearray(version.encode("utf-8")))
    out.close()
    option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(option, 1)
    overwrite[0] = option.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(tmp), fs.makeQualified(final), overwrite)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file beside the tables (never one with rows)."""
    fs, p, _ = _fs(spark, path)
    out = fs.create(p, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())


def current_version(spark: SparkSession, root: str) -> str | None:
    fs, _, jvm = _fs(spark, root)
    final = jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}")
    if not fs.exists(final):
        return None
    stream = fs.open(final)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def new_version() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("v%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]


def publish_version(spark: SparkSession, root: str, version: str, checks: DataFrame | None = None) -> list:
    """Check a version that is written already, then name it; returns the
    warnings.  A failing check raises, and readers keep the version they have."""
    warnings = raise_on_errors(checks) if checks is not None else []
    _write_pointer(spark, root, version)
    return warnings


def atomic_publish(spark: SparkSession, tables: dict[str, DataFrame], root: str,
                   checks: DataFrame | Callable[[dict[str, DataFrame]], DataFrame] | None = None,
                   layout: dict[str, list[str]] | None = None) -> str:
    """Write all tables to a new version, check them, then flip the pointer.

    ``checks`` is a report, or a function from the written tables to one.
    ``layout`` names the sort columns of tables that have a layout."""
    version = new_version()
    for name, df in tables.items():
        write_table(df, f"{root}/{version}/{name}", "errorifexists", (layout or {}).get(name))
    if callable(checks):
        checks = checks({name: spark.read.parquet(f"{root}/{version}/{name}") for name in tables})
    publish_version(spark, root, version, checks)
    return version


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing published under {root}")
    return spark.read.parquet(f"{root}/{version}/{name}")


def published_row_counts(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    out = None
    for name in names:
        one = read_published(spark, root, name).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out
