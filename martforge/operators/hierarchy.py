"""Walking a parent-child (adjacency list) hierarchy from its roots.

The source writes ``WITH RECURSIVE tree AS (roots UNION ALL children joined
to tree)``, one level a step.  Here every node holds a pointer to an ancestor and its distance,
at first its parent, and each round joins it with the pointer of that ancestor, so
that distances double: a tree of depth d takes about log2(d) rounds.  A walk is
done when it meets a root's own row, and takes over the root's columns there.  A round
writes only the walks that were still going, once, to the shared checkpoint folder.

Nodes whose chain never reaches a root (a missing parent, or a cycle) are
not reached - as in the source.  Walks of orphans end where the parent is missing;
when a round ends no walk at all, those left go round in cycles and are
given up.  With repeated ids a cycle can be reachable from a root; some walk is then
longer than there are rows, which raises.  ``unreachable_nodes`` reports what is not reached.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.session import cut_lineage


class HierarchyTooDeep(RuntimeError):
    pass


def walk_from_roots(nodes: DataFrame, id_col: str, parent_col: str,
                    root_carry: dict[str, str], max_depth: int | None = None) -> DataFrame:
    """Return every node reachable from a root with the root's columns.

    ``root_carry`` maps output names to node columns copied from the root
    (e.g. ``{"root_category_key": "category_key"}``); a ``depth`` column
    counts levels below the root (0 for the root itself).
    """
    cols, carried = nodes.columns, list(root_carry)
    is_root = F.col(parent_col).isNull()
    step = cut_lineage(nodes.select(
        *cols, F.when(is_root, F.col(id_col)).otherwise(F.col(parent_col)).alias("_mf_at"),
        F.when(is_root, 0).otherwise(1).cast("long").alias("_mf_far"), is_root.alias("_mf_done"),
        *[F.when(is_root, F.col(src)).alias(dst) for dst, src in root_carry.items()]), "tree")
    finished: list[DataFrame] = []
    rows = None
    while True:
        done, left, far = step.agg(F.count_if("_mf_done"), F.count_if(~F.col("_mf_done")),
                                   F.max(F.when(F.col("_mf_done"), F.col("_mf_far")))).first()
        rows = done + left if rows is None else rows
        if done and (far >= rows or max_depth is not None and far > max_depth):
            raise HierarchyTooDeep(f"a node {far} levels below its root: a cycle is reachable from a root"
                                   if far >= rows else f"hierarchy deeper than {max_depth} levels")
        finished.append(step.filter("_mf_done"))
        if not done or not left:  # where no walk ends, none of those left ever will
            break
        todo = step.filter(~F.col("_mf_done"))
        known = reduce(DataFrame.unionByName, finished, todo).select(
            F.col(id_col).alias("_mf_id"), *[F.col(c).alias(f"_mf_next{c}") for c in ("_mf_at", "_mf_far", "_mf_done", *carried)])
        # a parent that is not there ends the walk of an orphan
        step = cut_lineage(todo.join(known, F.col("_mf_at") == F.col("_mf_id")).select(
            *cols, F.col("_mf_next_mf_at").alias("_mf_at"), (F.col("_mf_far") + F.col("_mf_next_mf_far")).alias("_mf_far"),
            F.col("_mf_next_mf_done").alias("_mf_done"), *[F.col(f"_mf_next{c}").alias(c) for c in carried]), "tree")
    return reduce(DataFrame.unionByName, finished).select(*cols, *carried, F.col("_mf_far").cast("int").alias("depth"))


def unreachable_nodes(nodes: DataFrame, walked: DataFrame, id_col: str) -> DataFrame:
    """Nodes that no walk from a root reaches (orphans and cycles)."""
    return nodes.join(walked.select(id_col).distinct(), id_col, "left_anti")
