"""Reading the driver's parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Scan one driver table.  Selecting ``columns`` here only names the
    projection; Catalyst prunes the parquet read to the columns used later."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
