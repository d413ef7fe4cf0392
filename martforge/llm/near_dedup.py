"""Near-duplicate documents by HyperMinHash.

A document's set holds its distinct five-word shingles.  Each shingle hash
falls into a bucket by its first bits; a bucket keeps its smallest hash in
compressed form, the count of leading zeros plus a few mantissa bits.  A bucket
without a shingle borrows the register of another one along a fixed random
order, so that registers of two documents agree with the probability of their
Jaccard similarity also for short texts.  Registers are banded: documents that
share all registers of a band become candidates.

Documents of equal sets are one class before banding.  In a band bucket every
class is paired with the bucket's smallest class, not with all others.  The
register agreement, corrected for chance collisions, estimates the similarity;
pairs within the error of the threshold are verified on the full sets.  Then
the members of buckets whose classes still lie in several components meet in
blocks inside tasks: trees of pairs that the estimate allows name regions, and
the members of a region are compared on their full sets, but for pairs that
links connect already.  Only trees and links leave a task, so rows follow the
members of a bucket, not its pairs, and no link between two classes of a bucket
is lost unless they are connected by others.  Components are named by their
smallest document.

The chance that two documents at the threshold share no band is under 1e-6.

A null or empty text, or one without words, has the empty set and no link; with
fewer than five words the whole sequence is one shingle.  Rows that repeat a key
are one document of that key each, in one component if their sets are equal or
alike; rows without key stay single.  Other columns travel along untouched.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.llm import common
from martforge.llm.components import components
from martforge.session import cut_lineage

SHINGLE = 5
BANDS, ROWS = 40, 4
REGISTERS = BANDS * ROWS
MANTISSA = 10  # bits; six more hold the leading zeros
THRESHOLD = 75  # percent
ERRORS = 4.0  # standard errors that the estimate may fall short of the threshold
SLACK = ERRORS * (0.01 * THRESHOLD * (1 - 0.01 * THRESHOLD) / REGISTERS) ** 0.5
WORDS_KEPT = 400_000
BUCKET_ROWS = 2_048  # about the members in a block of an open bucket
BLOCK = 1 << 18  # about the shingles in a block of a region
LEAST_WEIGHT = 64  # shingles that a member counts at least, for at most 4,096 in a block

_rng = np.random.default_rng(20)
# where an empty bucket looks for a register, in this order
BORROW = np.stack([_rng.permutation(REGISTERS) for _ in range(REGISTERS)])


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    known = common.worker_state("word hashes", dict)
    if len(known) > WORDS_KEPT:
        known.clear()
    for w in set(words).difference(known):
        known[w] = xxhash.xxh64_intdigest(w)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE, len(h))
    with np.errstate(over="ignore"):
        out = np.full(len(h) - width + 1, len(h) if width < SHINGLE else 0, np.uint64)
        for i in range(width):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - width + 1 + i])
    return np.unique(out)


def registers(hashes: np.ndarray) -> np.ndarray:
    """Compressed minimum per bucket (uint16), empty buckets filled by borrowing.

    Sorted hashes lie bucket by bucket, so a bucket's smallest is its first."""
    n = np.uint64(REGISTERS)
    high = hashes >> np.uint64(32)
    bucket = ((high * n) >> np.uint64(32)).astype(np.int64)
    # the part of the hash below the bucket, again as 64 bits
    rest = _mix(hashes)
    order = np.lexsort((rest, bucket))
    bucket, rest = bucket[order], rest[order]
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    low = rest[first]
    # leading zeros, then the bits after the leading one
    zeros = np.minimum(63 - np.floor(np.log2(np.maximum(low >> np.uint64(11), 1).astype(np.float64))).astype(np.int64) - 11, 53)
    lead = np.uint64(63) - zeros.astype(np.uint64)
    bits = np.where(lead >= MANTISSA, low >> (lead - np.minimum(lead, np.uint64(MANTISSA))), low)
    value = (zeros << MANTISSA) | (bits.astype(np.int64) & ((1 << MANTISSA) - 1))
    out = np.zeros(REGISTERS, np.int64)
    full = np.zeros(REGISTERS, bool)
    out[bucket[first]], full[bucket[first]] = value, True
    if not full.all():
        empty = np.flatnonzero(~full)
        order = BORROW[empty]
        found = order[np.arange(len(empty)), full[order].argmax(1)]
        # a borrowed register differs from bucket to bucket only by its value
        out[empty] = out[found]
    return out.astype("<u2")


SKETCH = "doc_id long, text_md5 string, n_shingles long, digest binary, bands array<long>"


def sketches(docs: DataFrame) -> DataFrame:
    """Set size, digest of the whole set and the registers, four to a long."""
    def run(batch: pa.RecordBatch) -> dict:
        n, digest, bands = [], [], []
        for text in common.texts_of(batch):
            s = shingles(text)
            n.append(len(s))
            digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            bands.append(registers(s).view("<i8").tolist() if len(s) else None)
        return {"doc_id": batch.column(0), "text_md5": batch.column(2), "n_shingles": n, "digest": digest, "bands": bands}

    return common.map_batches(common.id_and_text(docs).withColumn("text_md5", _md5("text")), run, SKETCH)


def _md5(text: str) -> Column:
    """Tells the texts of one key apart."""
    return F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))


def estimate(bands_a: str, bands_b: str, n_a: str, n_b: str) -> Column:
    """Share of equal registers without the share expected by chance: for n and
    m distinct shingles chance makes about 0.17 * 4r / (1 + r)^2 registers in
    2^mantissa equal, r = n / m (the approximation of HyperMinHash)."""
    lanes = " + ".join(f"if((z & {0xFFFF << (16 * i) if i < 3 else -(1 << 48)}L) = 0, 1, 0)" for i in range(4))
    equal = F.expr(f"aggregate(zip_with({bands_a}, {bands_b}, (x, y) -> x ^ y), 0, (acc, z) -> acc + {lanes})")
    r = F.col(n_a) / F.col(n_b)
    chance = F.lit(0.169919487159739 / 2 ** MANTISSA) * 4 * r / ((1 + r) * (1 + r))
    return (equal / REGISTERS - chance) / (1 - chance)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    t = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    s = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    both = pairs.join(t, "b").join(s, "a").select("a", "b", "text_a", "text_b")

    def run(batch: pa.RecordBatch) -> dict:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        keep, last, mine = [], None, None
        for i, (x, y) in enumerate(zip(common.texts_of(batch, "text_a"), common.texts_of(batch, "text_b"))):
            if x != last:  # pairs of one document come in a row
                last, mine = x, shingles(x)
            other = shingles(y)
            shared = len(np.intersect1d(mine, other, assume_unique=True))
            if 100 * shared >= THRESHOLD * (len(mine) + len(other) - shared):
                keep.append(i)
        return {"a": [a[i] for i in keep], "b": [b[i] for i in keep]}

    return common.map_batches(both, run, "a long, b long")


def _alike(a: str, b: str) -> Column:
    """Sizes and registers do not rule the threshold out."""
    sizes = F.least(f"n_{a}", f"n_{b}") * 100 >= F.greatest(f"n_{a}", f"n_{b}") * THRESHOLD
    return sizes & (estimate(f"bands_{a}", f"bands_{b}", f"n_{a}", f"n_{b}") >= 0.01 * THRESHOLD - SLACK)


def _sketch_as(reps: DataFrame, name: str) -> DataFrame:
    return reps.select(F.col("doc_id").alias(name), F.col("n_shingles").alias(f"n_{name}"),
                       F.col("bands").alias(f"bands_{name}"))


def _candidates(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs whose estimate does not rule the threshold out."""
    return (pairs.join(_sketch_as(reps, "b"), "b").join(_sketch_as(reps, "a"), "a")
            .filter(_alike("a", "b")).select("a", "b"))


def _meetings(rows: DataFrame, group: str, weight: Column, block: int, columns: list[str]) -> DataFrame:
    """Each group's rows dealt into blocks of about ``block`` weight by their
    key, and one row for every two blocks and for each block with itself: x, y
    and the ``members`` of both, ``low`` telling those of block x."""
    sizes = rows.groupBy(group).agg(F.ceil(F.sum(weight) / block).cast("int").alias("blocks"))
    x, y = F.least("mine", "other"), F.greatest("mine", "other")
    return (rows.join(sizes, group)
            .withColumn("mine", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .groupBy(group, x.alias("x"), y.alias("y"))
            .agg(F.collect_list(F.struct((F.col("mine") == x).alias("low"), *columns)).alias("members"))
            .filter(F.size("members") > 1).select("x", "y", "members"))


def _groups(batch: pa.RecordBatch):
    """(same block, members as a struct array) of each row of ``_meetings``."""
    x, y, members = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
    for i in range(batch.num_rows):
        yield x[i] == y[i], members[i].values


def _numbers(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False)


def _partners(i: int, same_block: bool, low: np.ndarray, tree: np.ndarray) -> np.ndarray:
    """Whom member i meets: the later ones of its block or all of the other
    block, but for those that hang together with it already."""
    meets = tree != tree[i]
    if same_block:
        meets[:i + 1] = False
    else:
        meets &= ~low
    return np.flatnonzero(meets)


def _alike_to(i: int, others: np.ndarray, n: np.ndarray, regs: np.ndarray) -> np.ndarray:
    """Those of ``others`` that sizes and registers do not rule out, as ``_alike``."""
    few, many = np.minimum(n[others], n[i]), np.maximum(n[others], n[i])
    others = others[few * 100 >= many * THRESHOLD]
    if not len(others):
        return others
    r = n[i] / n[others]
    chance = 0.169919487159739 / 2 ** MANTISSA * 4 * r / ((1 + r) * (1 + r))
    equal = np.count_nonzero(regs[others] == regs[i], axis=1) / REGISTERS
    return others[(equal - chance) / (1 - chance) >= 0.01 * THRESHOLD - SLACK]


def _alike_trees(rows: DataFrame) -> DataFrame:
    """(a, b): every document that is alike, by the estimate, to one of another
    component in one of its buckets, with the smallest document of its tree of
    such pairs.  Pairs stay in the task; rows follow the members."""
    def run(batch: pa.RecordBatch) -> dict:
        a, b = [], []
        for same_block, members in _groups(batch):
            low, ids, component, n = (_numbers(members.field(c)) for c in ("low", "doc_id", "component", "n_shingles"))
            regs = _numbers(members.field("bands").flatten()).view("<u2").reshape(len(ids), REGISTERS)
            tree = np.arange(len(ids))
            for i in range(len(ids)):
                if same_block or low[i]:
                    others = _partners(i, same_block, low, tree)
                    found = _alike_to(i, others[component[others] != component[i]], n, regs)
                    if len(found):
                        tree[np.isin(tree, tree[found])] = tree[i]
            for root in np.flatnonzero(np.bincount(tree, minlength=len(ids)) > 1):
                mine = ids[tree == root]
                a += [int(mine.min())] * len(mine)
                b += mine.tolist()
        return {"a": a, "b": b}

    met = _meetings(rows, "key", F.lit(1), BUCKET_ROWS, ["doc_id", "component", "n_shingles", "bands"])
    return common.map_batches(met, run, "a long, b long").distinct()


def _region_links(members: DataFrame) -> DataFrame:
    """Links (a, b) between components, on full sets: every two members of a
    region whose estimate allows a link and that no links found so far connect.
    Two trees that meet give one link."""
    def run(batch: pa.RecordBatch) -> dict:
        a, b = [], []
        for same_block, rows in _groups(batch):
            low, ids, component = (_numbers(rows.field(c)) for c in ("low", "doc_id", "component"))
            sets = [shingles(t or "") for t in rows.field("text").to_pylist()]
            full = np.array([len(s) > 0 for s in sets])
            low, ids, component = low[full], ids[full], component[full]
            sets = [s for s in sets if len(s)]
            if len(sets) < 2:
                continue
            n = np.array([len(s) for s in sets])
            regs = np.stack([registers(s) for s in sets])
            number = np.split(np.unique(np.concatenate(sets), return_inverse=True)[1], np.cumsum(n)[:-1])
            mark = np.zeros(int(n.sum()), np.int64)
            tree = np.unique(component, return_inverse=True)[1]
            for i in range(len(ids)):
                if not (same_block or low[i]):
                    continue
                others = _alike_to(i, _partners(i, same_block, low, tree), n, regs)
                if not len(others):
                    continue
                mark[number[i]] = 1
                ends = np.cumsum(n[others])
                shared = np.add.reduceat(mark[np.concatenate([number[j] for j in others])], ends - n[others])
                mark[number[i]] = 0
                linked = others[100 * shared >= THRESHOLD * (n[others] + n[i] - shared)]
                if len(linked):
                    joined, first = np.unique(tree[linked], return_index=True)
                    a += [int(ids[i])] * len(first)
                    b += ids[linked[first]].tolist()
                    tree[np.isin(tree, joined)] = tree[i]
        return {"a": a, "b": b}

    weight = F.greatest("n_shingles", F.lit(LEAST_WEIGHT))
    return common.map_batches(_meetings(members, "region", weight, BLOCK, ["doc_id", "component", "text"]), run, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return _near_duplicates(docs).drop("text_md5")


def _near_duplicates(docs: DataFrame) -> DataFrame:
    texts = common.id_and_text(docs)
    sketch = cut_lineage(sketches(texts), "sketch")
    with_set = sketch.filter(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    classes = cut_lineage(with_set.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n_shingles"),
        F.count(F.lit(1)).alias("copies")), "classes")
    # the bands of one document of each class; a key that repeats with other
    # texts still names one class here
    reps = cut_lineage(with_set.select("doc_id", "digest", "bands").join(
        classes.select("doc_id", "digest", "n_shingles"), ["doc_id", "digest"])
        .dropDuplicates(["doc_id", "digest"]).select("doc_id", "n_shingles", "bands"), "reps")
    banded = reps.select("doc_id", F.posexplode("bands").alias("band", "value")).select(
        "doc_id", "band", F.xxhash64("band", "value").alias("key"))
    buckets = (banded.groupBy("key").agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("n"))
               .filter("n > 1"))
    first = banded.join(buckets.select("key", "a"), "key").filter("doc_id <> a").select(
        "a", F.col("doc_id").alias("b"))
    tried = cut_lineage(first.distinct(), "tried")
    links = cut_lineage(verified(_candidates(tried, reps), texts), "links")

    label = components(links)
    known = reps.select("doc_id").join(label, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", F.coalesce("component", "doc_id").alias("component"))
    # buckets of three or more classes in several components
    wide = (banded.join(buckets.filter("n > 2").select("key", F.col("a").alias("center")), "key")
            .join(known, "doc_id"))
    wide = cut_lineage(wide.select("key", "center", "doc_id", "component"), "wide")
    open_ = wide.groupBy("key").agg(F.min("component").alias("main"), F.max("component").alias("most")).filter(
        "main <> most").select("key")
    left = (wide.join(open_, "key").filter("doc_id <> center").select("key", "doc_id", "component")
            .join(reps.select("doc_id", "n_shingles", "bands"), "doc_id"))
    near = cut_lineage(_alike_trees(left), "near")
    region = components(near).withColumnsRenamed({"node": "doc_id", "component": "region"})
    members = (region.join(known.distinct(), "doc_id").join(texts, "doc_id")
               .join(reps.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles")), "doc_id"))
    more = cut_lineage(_region_links(members), "links")
    links = links.unionByName(more)
    # equal keys of different texts: the key itself is the link
    label = components(links)

    member = with_set.select("doc_id", "digest").join(
        classes.select("digest", F.col("doc_id").alias("node")), "digest").join(label, "node", "left").select(
        "doc_id", "digest", F.coalesce("component", "node").alias("component_id"))
    named = member.dropDuplicates(["doc_id", "digest"])
    out = sketch.join(named, ["doc_id", "digest"], "left")
    return out.select("doc_id", "text_md5", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame) -> DataFrame:
    """Whole rows of one document of each component.  Key and text decide
    together, so a kept key does not save another text under that key.  Of rows
    with equal key and text the one with the smallest hash of all its columns
    stays; rows without a key all stay."""
    key, md5, order = common.OWN + "id", common.OWN + "md5", common.OWN + "order"
    kept = (_near_duplicates(docs).filter("kept and doc_id is not null")
            .select(F.col("doc_id").alias(key), F.col("text_md5").alias(md5 + "_kept")).distinct())
    plain = [c for c in docs.columns if not isinstance(docs.schema[c].dataType, (T.MapType, T.VariantType))]
    rows = docs.filter(F.col("doc_id").isNotNull()).withColumn(md5, _md5("text")).join(
        kept, (F.col("doc_id").cast("long") == F.col(key)) & (F.col(md5) == F.col(md5 + "_kept")), "left_semi")
    first = F.row_number().over(Window.partitionBy("doc_id", md5).orderBy(F.xxhash64(*plain)))
    return (rows.withColumn(order, first).filter(F.col(order) == 1).select(*docs.columns)
            .unionByName(docs.filter(F.col("doc_id").isNull())))
