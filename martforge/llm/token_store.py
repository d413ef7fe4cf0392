"""Binary token-id shards with a minimal perfect hash index.

``write`` sorts the documents by key (range partitions, ties by the text's
hash), encodes them and writes shards of two files into a shared folder:

* ``<shard>.ids``: the raw ids of its documents one after the other, without
  header, each id as 16 bits if the vocabulary allows it, else 32;
* ``<shard>.mph``: a minimal perfect hash of the distinct keys (displacement
  per bucket, then one slot per key with a 32-bit fingerprint and the first row
  and number of rows of that key) and the row offsets.

File names carry a fresh id per task attempt.  Only shards listed in the
manifest, a table that Spark commits after all tasks ended, belong to the
store; files of lost or repeated attempts are never read.  ``lookup`` is
constant time: two hashes, one fingerprint, one offset pair.

``read`` takes every document back from the files by keyed access.

A null text is the empty text (the end id only).  A null key sorts first and is
kept under a slot of its own.  Rows that share a key are kept all, in one run of
rows.  Other columns are ignored.  An empty table gives an empty store.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martforge.llm import common
from martforge.llm.word_tokens import encoder

MAGIC = 0x4D504831
SHARD_BYTES = 64 << 20  # a shard is closed when its ids reach this size
PER_BUCKET = 3  # mean keys per bucket of the perfect hash
EMPTY_KEY = -(1 << 63)  # stands for a null key next to a null flag


STEP, ADD = 0x9E3779B97F4A7C15, 0x632BE59BD9B4E019
MUL1, MUL2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
BITS = 0xFFFFFFFFFFFFFFFF
SLOT_SEED = 16  # displacement d hashes with seed SLOT_SEED + d


def _mix(x: np.ndarray, seed) -> np.ndarray:
    """64-bit finaliser of keys (uint64), one function per seed (number or array)."""
    with np.errstate(over="ignore"):
        x = x + np.asarray(seed, np.uint64) * np.uint64(STEP) + np.uint64(ADD)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(MUL1)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(MUL2)
        return x ^ (x >> np.uint64(31))


def _mix_one(x: int, seed: int) -> int:
    x = (x + seed * STEP + ADD) & BITS
    x = ((x ^ (x >> 30)) * MUL1) & BITS
    x = ((x ^ (x >> 27)) * MUL2) & BITS
    return x ^ (x >> 31)


def _fold(keys: np.ndarray, nulls: np.ndarray) -> np.ndarray:
    k = keys.astype(np.int64).view(np.uint64).copy()
    k[nulls] ^= np.uint64(0xA5A5A5A5A5A5A5A5)
    return k


class PerfectHash:
    """Hash and displace: keys fall into buckets; buckets, largest first, get
    the least displacement that sends their keys to free slots.  A bucket of
    one key names its slot directly (as -1 - slot)."""

    def __init__(self, displacements: np.ndarray, n: int):
        self.displacements, self.n = displacements, n

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        n = len(keys)
        buckets = max(1, -(-n // PER_BUCKET))
        disp = np.zeros(buckets, np.int64)
        if not n:
            return cls(disp, 0)
        bucket = (_mix(keys, 0) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        sizes = np.diff(starts)
        free = np.ones(n, bool)
        for k in np.argsort(-sizes, kind="stable"):
            mine = order[starts[k]:starts[k + 1]]
            if len(mine) <= 1:
                break
            values, d = keys[mine].tolist(), 0
            while True:
                slots = {_mix_one(v, SLOT_SEED + d) % n for v in values}
                if len(slots) == len(values) and all(free[s] for s in slots):
                    break
                d += 1
            disp[k] = d
            free[list(slots)] = False
        left = iter(np.flatnonzero(free).tolist())
        for k in np.flatnonzero(sizes == 1):
            disp[k] = -1 - next(left)
        return cls(disp, n)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        d = self.displacements[(_mix(keys, 0) % np.uint64(len(self.displacements))).astype(np.int64)]
        hashed = _mix(keys, SLOT_SEED + np.maximum(d, 0)) % np.uint64(self.n)
        return np.where(d < 0, -1 - d, hashed.astype(np.int64))


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 3) >> np.uint64(32)).astype("<u4")


class ShardIndex:
    """The index file of a shard: built from its row keys in order, or read back."""

    @staticmethod
    def pack(keys: np.ndarray, nulls: np.ndarray, offsets: np.ndarray, width: int) -> bytes:
        folded = _fold(keys, nulls)
        first = np.flatnonzero(np.r_[True, folded[1:] != folded[:-1]]) if len(folded) else np.zeros(0, np.int64)
        distinct = folded[first]
        mph = PerfectHash.build(distinct)
        slot = mph.slots(distinct) if len(distinct) else np.zeros(0, np.int64)
        fp, row, runs = (np.zeros(len(distinct), t) for t in ("<u4", "<u4", "<u4"))
        fp[slot] = _fingerprints(distinct)
        row[slot] = first
        runs[slot] = np.diff(np.r_[first, len(folded)])
        head = np.array([MAGIC, width, len(distinct), len(mph.displacements), len(folded)], "<u8")
        return b"".join(x.tobytes() for x in (
            head, mph.displacements.astype("<i8"), fp, row, runs, offsets.astype("<u8")))

    def __init__(self, data: bytes):
        magic, self.width, n, buckets, rows = np.frombuffer(data, "<u8", 5).tolist()
        if magic != MAGIC:
            raise ValueError("not an index file")
        at = 40
        self.mph = PerfectHash(np.frombuffer(data, "<i8", buckets, at), n)
        at += 8 * buckets
        self.fp, self.row, self.runs = (np.frombuffer(data, "<u4", n, at + 4 * n * i) for i in range(3))
        self.offsets = np.frombuffer(data, "<u8", rows + 1, at + 12 * n).astype(np.int64)

    def lookup(self, keys: np.ndarray, nulls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and number of rows of each key; no rows where the
        fingerprint differs."""
        if not self.mph.n:
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        folded = _fold(keys, nulls)
        slot = self.mph.slots(folded)
        hit = self.fp[slot] == _fingerprints(folded)
        return self.row[slot].astype(np.int64), np.where(hit, self.runs[slot], 0).astype(np.int64)


def _filesystem(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path)


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, shard_bytes: int = SHARD_BYTES) -> None:
    """Write the store into ``folder`` (a path or URI that all executors share)."""
    spark = docs.sparkSession
    common.bound_batches(spark)
    shared = spark.sparkContext.broadcast(common.file_bytes(tokenizer))
    schema = ("part int, shard int, name string, width int, n_rows long, n_tokens long, "
              "first_key long, last_key long, keys binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        enc = encoder(shared.value)
        width = 2 if enc.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
        part, end, shard = TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes(), 0
        parts, keys, nulls, lengths, held = [], [], [], [], 0
        store, root = _filesystem(folder)

        def close() -> pa.RecordBatch:
            nonlocal parts, keys, nulls, lengths, held, shard
            name = f"{part:06d}-{shard:04d}-{uuid.uuid4().hex}"
            k, nul = np.array(keys, np.int64), np.array(nulls, bool)
            offsets = np.r_[0, np.cumsum(np.array(lengths, np.int64))]
            with store.open_output_stream(f"{root}/{name}.ids") as f:
                for p in parts:
                    f.write(p)
            with store.open_output_stream(f"{root}/{name}.mph") as f:
                f.write(ShardIndex.pack(k, nul, offsets, width))
            keys_col = np.where(nul, EMPTY_KEY, k).astype("<i8").tobytes() + nul.tobytes()
            row = pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()), "name": [name],
                "width": pa.array([width], pa.int32()), "n_rows": [len(k)], "n_tokens": [int(offsets[-1])],
                "first_key": pa.array([None if nul[0] else int(k[0])], pa.int64()),
                "last_key": pa.array([None if nul[-1] else int(k[-1])], pa.int64()),
                "keys": pa.array([keys_col], pa.binary())})
            parts, keys, nulls, lengths, held = [], [], [], [], 0
            shard += 1
            return row

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for key, raw in zip(ids, enc.encode(common.texts_of(batch))):
                codes = np.frombuffer(raw + end, "<u4")
                parts.append(codes.astype("<u2").tobytes() if width == 2 else codes.tobytes())
                keys.append(key if key is not None else 0)
                nulls.append(key is None)
                lengths.append(len(codes))
                held += len(parts[-1])
                if held >= shard_bytes:
                    yield close()
        if keys:
            yield close()

    tie = F.xxhash64("text")
    ordered = (common.id_and_text(docs).withColumn("tie", tie)
               .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
               .select("doc_id", "text"))
    store, root = _filesystem(folder)
    store.create_dir(root, recursive=True)
    ordered.mapInArrow(run, schema).write.mode("errorifexists").parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit) of every
    document of the store; each is looked up by its key in the shard's index.
    The running total of ``start`` is over the manifest only, one small row a shard."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    order = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    base = manifest.select("name", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("base"))
    shards = manifest.select("name", "keys").join(base, "name")
    schema = "doc_id long, start long, n_tokens long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _filesystem(folder)
        for batch in batches:
            for name, packed, start in zip(*(batch.column(n).to_pylist() for n in ("name", "keys", "base"))):
                n = len(packed) // 9
                keys, nulls = np.frombuffer(packed, "<i8", n), np.frombuffer(packed, bool, n, 8 * n)
                with store.open_input_file(f"{root}/{name}.mph") as f:
                    index = ShardIndex(f.read())
                new = np.r_[True, (keys[1:] != keys[:-1]) | (nulls[1:] != nulls[:-1])]
                keys, nulls = np.where(nulls, 0, keys)[new], nulls[new]
                row, runs = index.lookup(keys, nulls)
                rows = np.repeat(row - np.r_[0, np.cumsum(runs)[:-1]], runs) + np.arange(runs.sum())
                doc = np.repeat(keys, runs)
                null = np.repeat(nulls, runs)
                with store.open_input_file(f"{root}/{name}.ids") as f:
                    for i in range(0, len(rows), 1000):
                        part = rows[i:i + 1000]
                        lo, hi = index.offsets[part], index.offsets[part + 1]
                        data = f.read_at(int(hi[-1] - lo[0]) * index.width, int(lo[0]) * index.width)
                        codes = np.frombuffer(data, f"<u{index.width}").astype("<u4")
                        yield pa.RecordBatch.from_arrays([
                            pa.array(doc[i:i + 1000], pa.int64(), mask=null[i:i + 1000]),
                            pa.array(lo + start), pa.array(hi - lo),
                            pa.array([codes[a - lo[0]:b - lo[0]].tobytes() for a, b in zip(lo, hi)], pa.binary())],
                            ["doc_id", "start", "n_tokens", "ids"])

    # a row is small, its shard is not: as many tasks as shards, which adaptive execution must not merge
    n = max(1, manifest.count())
    return shards.repartition(n).mapInArrow(run, schema)


def get(spark: SparkSession, folder: str, keys: list[int]) -> dict[int, list[np.ndarray]]:
    """Ids of a few documents by key: only the shards whose key range holds a
    key are opened, and of each only the index and the rows asked for."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    inside = F.lit(False)
    for k in keys:
        inside = inside | (F.lit(k).between(F.coalesce("first_key", F.lit(EMPTY_KEY)), F.col("last_key")))
    store, root = _filesystem(folder)
    out: dict[int, list[np.ndarray]] = {k: [] for k in keys}
    wanted = np.array(keys, np.int64)
    for r in manifest.filter(inside).select("part", "shard", "name").orderBy("part", "shard").collect():
        with store.open_input_file(f"{root}/{r['name']}.mph") as f:
            index = ShardIndex(f.read())
        row, runs = index.lookup(wanted, np.zeros(len(wanted), bool))
        with store.open_input_file(f"{root}/{r['name']}.ids") as f:
            for k, a, n in zip(keys, row.tolist(), runs.tolist()):
                for i in range(a, a + n):
                    lo, hi = index.offsets[i], index.offsets[i + 1]
                    data = f.read_at(int(hi - lo) * index.width, int(lo) * index.width)
                    out[k].append(np.frombuffer(data, f"<u{index.width}").astype(np.int64))
    return out


def digests(stored: DataFrame) -> DataFrame:
    return stored.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
