"""``SELECT DISTINCT ON (key) ... ORDER BY key, <order>`` as a Spark job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def distinct_on(df: DataFrame, key: Sequence[str], order: Sequence) -> DataFrame:
    """Keep the first row per ``key`` in ``order``.

    ``order`` should end in a total tie-break (all remaining columns) so the
    kept row does not depend on input order.  ``row_number() = 1`` is planned
    with a group limit on both sides of the shuffle: every map task keeps at
    most one row per key before shuffling, so a key that holds a third of the
    rows still sends only one row per map task to the reducer.
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    w = Window.partitionBy(*key).orderBy(*order_cols)
    return (
        df.withColumn("_mf_rn", F.row_number().over(w))
        .filter(F.col("_mf_rn") == 1)
        .drop("_mf_rn")
    )
