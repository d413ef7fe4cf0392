"""Near-duplicate vectors by a forest of random projection trees with spill.

The forest is fitted on a bounded sample: each tree splits along a random
direction at the sample's median, and again on both sides, until a leaf is
expected to hold ``LEAF`` vectors.  Every vector is then sent down every tree;
within a margin of the split it goes down both sides.  The margin follows from
the threshold: two unit vectors at the threshold cosine c differ along a random
direction by about sqrt((2 - 2c) / dimensions), and only a pair on both outer
sides of the margin is parted.  With the values below a pair at the threshold
misses all trees with a chance under 1e-5 for leaves of a million vectors.

Equal vectors of a label are one class before that.  Vectors of one leaf and
label are compared in blocks, as matrix products in double precision.  A pair
that meets in several leaves counts in the first of them only, which each block
decides from the two vectors' leaf lists, so that no pair leaves its task: a
vector leaves with its number of links and one edge to its block's component.

Vectors that are null, zero, or hold a null or a number that is not finite, and
vectors without label, link with nothing; vectors of different length never
meet.  Rows that repeat a vec_id are vectors of their own that share a
component.  Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from dataclasses import dataclass
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm import common
from martforge.llm.components import components
from martforge.session import cut_lineage

TREES = 8
LEAF = 4096  # vectors of all labels that a leaf may expect
SAMPLE = 20_000  # vectors that the fit reads
LEAST = 32  # sampled vectors in a node that is split further
SPILL = 0.75  # margin in units of the expected difference at the threshold
BLOCK = 1024  # vectors of a leaf and label compared in one matrix product with as many others


@dataclass
class Tree:
    """Nodes in a list: (direction, cut, left, right) or None for a leaf."""
    nodes: list

    def leaves(self, unit: np.ndarray, margin: float) -> list[tuple[int, np.ndarray]]:
        """(leaf, rows) for every leaf that rows reach."""
        out, todo = [], [(0, np.arange(len(unit)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if self.nodes[node] is None:
                out.append((node, rows))
                continue
            direction, cut, left, right = self.nodes[node]
            at = unit[rows] @ direction - cut
            todo += [(left, rows[at <= margin]), (right, rows[at >= -margin])]
        return out


def grow(sample: np.ndarray, expected: float, rng: np.random.Generator) -> Tree:
    """``expected``: vectors that one sampled vector stands for."""
    nodes: list = []

    def split(rows: np.ndarray) -> int:
        me = len(nodes)
        nodes.append(None)
        if len(rows) >= LEAST and len(rows) * expected > LEAF:
            direction = rng.normal(size=sample.shape[1])
            direction /= np.linalg.norm(direction)
            at = sample[rows] @ direction
            cut = float(np.median(at))
            if (at < cut).any():
                left, right = split(rows[at < cut]), split(rows[at >= cut])
                nodes[me] = (direction, cut, left, right)
        return me

    split(np.arange(len(sample)))
    return Tree(nodes)


def margin(threshold: float, dimensions: int) -> float:
    return SPILL * float(np.sqrt((2 - 2 * threshold) / dimensions))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, width)


def _first_meeting(keys_a: np.ndarray, keys_b: np.ndarray, here: int) -> np.ndarray:
    """Whether rows of two leaf-list arrays share no leaf before ``here``."""
    fresh = np.ones(len(keys_a), bool)
    for j in range(keys_a.shape[1]):
        k = keys_a[:, j]
        fresh &= ~((k < here) & (k >= 0) & (keys_b == k[:, None]).any(1))
    return fresh


def _padded(lists: list[list[int]], fill: int) -> np.ndarray:
    out = np.full((len(lists), max(map(len, lists))), fill, np.int64)
    for i, x in enumerate(lists):
        out[i, :len(x)] = x
    return out


def compare(ids: np.ndarray, unit: np.ndarray, weight: np.ndarray, keys: list[list[int]], first: np.ndarray,
            second: np.ndarray, here: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (weighted by copies) per vector found first in this leaf, and the
    smallest member of each vector's component; rows of ``first`` meet those of
    ``second``, the same rows for a block with itself."""
    same = len(first) == len(second) and (first == second).all()
    near = unit[first] @ unit[second].T >= threshold
    a, b = np.nonzero(near)
    a, b = first[a], second[b]
    if same:
        keep = a < b
        a, b = a[keep], b[keep]
    links = np.zeros(len(ids), np.int64)
    ka, kb = _padded(keys, -1), _padded(keys, -2)
    for i in range(0, len(a), 100_000):
        x, y = a[i:i + 100_000], b[i:i + 100_000]
        fresh = _first_meeting(ka[x], kb[y], here)
        np.add.at(links, x[fresh], weight[y[fresh]])
        np.add.at(links, y[fresh], weight[x[fresh]])
    root = ids.copy()
    while len(a):  # smallest label around, until nothing changes
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        if (root == before).all():
            break
    return links, root


CLASS = "vec_id long, label long, width int, unit binary"


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """Valid vectors, scaled to length one in double precision."""
    def run(batch: pa.RecordBatch) -> dict:
        ids, labels, widths, units = [], [], [], []
        for i, v, y in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if v is None or y is None or i is None or not v or any(c is None for c in v):
                continue
            x = np.array(v, float)
            if not np.isfinite(x).all() or not x.any():
                continue
            with np.errstate(over="ignore", under="ignore"):
                size = np.linalg.norm(x)
                if not 1e-150 < size < 1e150:  # squares over- or underflow
                    x = x / np.abs(x).max()
                    size = np.linalg.norm(x)
            ids.append(i), labels.append(y), widths.append(len(x)), units.append((x / size).astype("<f8").tobytes())
        return {"vec_id": ids, "label": labels, "width": widths, "unit": units}

    return common.map_batches(vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"),
                                             F.col("label").cast("long")), run, CLASS)


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, seed: int = 8) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    valid = cut_lineage(unit_vectors(vectors), "units")
    classes = cut_lineage(valid.groupBy("label", "width", "unit").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
        .withColumn("class", F.xxhash64("label", "width", "unit")), "classes")
    fits = {}
    for width, total in ((r[0], r[1]) for r in classes.groupBy("width").count().collect()):
        rows = (classes.filter(F.col("width") == width).orderBy(F.xxhash64("class", F.lit(seed)), "class")
                .limit(SAMPLE).select("unit").collect())
        sample = np.frombuffer(b"".join(r[0] for r in rows), "<f8").reshape(-1, width)
        rng = np.random.default_rng(seed)
        fits[width] = [grow(sample, total / len(sample), rng) for _ in range(TREES)]
    shared = spark.sparkContext.broadcast(fits)

    def assign(batch: pa.RecordBatch) -> dict:
        widths = np.array(batch.column(1).to_pylist(), np.int64)
        keys: list[list[int]] = [[] for _ in range(batch.num_rows)]
        for width in np.unique(widths):
            rows = np.flatnonzero(widths == width)
            unit = _matrix(batch.column(2).take(pa.array(rows)), width)
            for t, tree in enumerate(shared.value[width]):
                for leaf, mine in tree.leaves(unit, margin(threshold, width)):
                    for i in rows[mine].tolist():
                        keys[i].append(t << 40 | leaf)
        return {"rep": batch.column(0), "width": batch.column(1), "unit": batch.column(2), "label": batch.column(3),
                "copies": batch.column(4), "leaves": [sorted(k) for k in keys]}

    placed = cut_lineage(common.map_batches(
        classes.select("rep", "width", "unit", "label", "copies"), assign,
        "rep long, width int, unit binary, label long, copies long, leaves array<long>"), "placed")
    at = placed.select("rep", "label", "width", F.explode("leaves").alias("leaf"))
    group = ["label", "width", "leaf"]
    sizes = at.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # a large leaf is cut into parts, and every pair of parts is a block
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = (placed.withColumn("leaf", F.explode("leaves")).join(sizes, group)
            .withColumn("parts", parts)
            .withColumn("part", F.pmod(F.xxhash64("rep", "unit"), F.col("parts")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("lo", F.least("part", "other")).withColumn("hi", F.greatest("part", "other"))
            .select(*group, "lo", "hi", "part", "rep", "copies", "unit", "leaves"))

    def block(table: pa.Table) -> pa.Table:
        here, width = table.column("leaf")[0].as_py(), table.column("width")[0].as_py()
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        part = table.column("part").to_numpy()
        ids, weight = table.column("rep").to_numpy(), table.column("copies").to_numpy()
        links, root = compare(ids, _matrix(table.column("unit"), width), weight, table.column("leaves").to_pylist(),
                              np.flatnonzero(part == lo), np.flatnonzero(part == hi), here, threshold)
        keep = (links > 0) | (root != ids)
        return pa.table({"rep": ids[keep], "links": links[keep], "root": root[keep]})

    found = cut_lineage(rows.groupBy(*group, "lo", "hi").applyInArrow(block, "rep long, links long, root long"), "found")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    label = components(found.filter("rep <> root"), "rep", "root")
    members = (valid.join(classes.select("label", "width", "unit", "rep", "copies"), ["label", "width", "unit"])
               .select("vec_id", "rep", "copies"))
    named = (members.join(links, "rep", "left").join(label.withColumnRenamed("node", "rep"), "rep", "left")
             .select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    return _all_rows(vectors, named)


def _all_rows(vectors: DataFrame, named: DataFrame) -> DataFrame:
    """Named vectors, and the others as components of their own."""
    linked = named.select("vec_id", "n_links", "component_id", F.lit(True).alias("valid"))
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"),
                           F.col("label"))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
              & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))))
    # exactly the rows that unit_vectors leaves out
    rest = every.filter(~F.coalesce(usable & F.exists("v", lambda x: x != 0), F.lit(False)))
    rest = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.drop("valid").unionByName(rest)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
