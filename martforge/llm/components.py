"""Connected components of a link table, each named by its smallest member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.session import cut_lineage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of ``links``.

    Every round each node takes the smallest label around it and then the label
    of that label (pointer jumping), so a chain of n links needs about log n
    rounds and a star one.  Each round is written to the shared folder: lineage
    stays short, and nothing but one count comes to the driver."""
    both = links.select(F.col(a).alias("x"), F.col(b).alias("y"))
    edges = cut_lineage(both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y")))
                        .filter("x <> y").distinct(), "edges")
    labels = cut_lineage(edges.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("m"))
                         .select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = (edges.join(labels.select(F.col("node").alias("y"), "label"), "y")
                .groupBy(F.col("x").alias("node")).agg(F.min("label").alias("near")))
        new = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("label").alias("further"))
        new = cut_lineage(new.join(jump, "mid", "left").select(
            "node", "old", F.coalesce(F.least("mid", "further"), F.col("mid")).alias("label")), "labels")
        changed = new.filter("label <> old").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")
