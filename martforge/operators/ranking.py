"""Global row numbers and n-tiles without one task holding all rows.

``row_number() OVER (ORDER BY k)`` with no PARTITION BY makes Spark plan an
``Exchange SinglePartition``: every row of the table meets in one task.  That
is fine for a few hundred rows and fatal for a fact table.  The operators here
compute the same numbers in parallel:

1. range-partition the rows on the sort keys and sort inside each partition
   (one shuffle, split points sampled by Spark, so a hot leading key is still
   split across partitions when later keys differ; AQE sizes the partitions
   unless a count is given);
2. tag each row with ``monotonically_increasing_id`` = (partition << 33) +
   position, and cut lineage (a Parquet table in the shared checkpoint
   folder) so that the tags, and the sampled range bounds behind them, never
   change on a retry or for a second reader;
3. count rows per partition (a partial aggregate; one row per partition
   reaches the driver - a size bound set by the partition count, not by the
   data) and turn the counts into running offsets;
4. rank = offset of the row's partition + its position + 1, with the offsets
   joined as a broadcast table of one row per partition.

n-tiles follow from the rank and the total row count by arithmetic, with the
same bucket sizes as SQL ``NTILE``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.session import cut_lineage

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1
# input bytes that one range partition stands for: half a million stored line
# items and more, which a task sorts in memory
BYTES_PER_RANGE = 8 << 20
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_OWN_INITIAL: dict[str, str] = {}  # the value set here, by session
# file bytes that one scan task reads: a scan of stored line items that feeds a shuffle
# holds ten times its bytes in memory before it must spill (Spark's own value is 128 MB)
SCAN_BYTES = "spark.sql.files.maxPartitionBytes"
SPARK_SCAN_BYTES, BYTES_PER_SCAN = "134217728b", "32m"
# shuffled bytes a task reads (Spark's own value is 64 MB), and those that a join may hold as a
# hash table instead of sorting both sides; partitions beyond them, as of a hot key, are sorted
TASK_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
HASHED_BYTES = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
SPARK_TASK_BYTES, SPARK_HASHED_BYTES, BYTES_PER_JOIN = "67108864b", "0b", "32m"


def _as_columns(order: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def range_partitions(df: DataFrame) -> int:
    """Range partitions for a full sort of ``df``: one per 8 MB of the tables
    under it, and no fewer than the session's shuffle partitions."""
    spark = df.sparkSession
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    # local rows carry the default for an unknown size, the largest long
    read = sum(n for n in sizes if n < (1 << 63) - 1)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-read // BYTES_PER_RANGE))


def size_shuffles(spark: SparkSession, frames: Iterable[DataFrame]) -> None:
    """Lets joins and groupings start with as many partitions as the full sort of the
    greatest frame, so that a task's share doesn't grow with the tables; adaptive
    execution merges those that turn out small.  Scans are cut finer for the same
    reason.  Joins of such shares hash the smaller side: ids begin alike, so
    sorting them compares whole texts.  A session's own values stay."""
    now = spark.conf.get(INITIAL_PARTITIONS, None)
    session = f"{spark.sparkContext.applicationId}/{id(spark)}"
    if now is None or now == _OWN_INITIAL.get(session):
        _OWN_INITIAL[session] = str(max(range_partitions(df) for df in frames))
        spark.conf.set(INITIAL_PARTITIONS, _OWN_INITIAL[session])
    if spark.conf.get(SCAN_BYTES) == SPARK_SCAN_BYTES:
        spark.conf.set(SCAN_BYTES, BYTES_PER_SCAN)
    if (spark.conf.get(TASK_BYTES), spark.conf.get(HASHED_BYTES)) == (SPARK_TASK_BYTES, SPARK_HASHED_BYTES):
        spark.conf.set(TASK_BYTES, BYTES_PER_JOIN)
        spark.conf.set(HASHED_BYTES, BYTES_PER_JOIN)


def with_global_rank(df: DataFrame, order: Sequence, rank_col: str,
                     total_col: str | None = None,
                     num_partitions: int | None = None,
                     keep: Sequence[str] | None = None,
                     derived: Mapping[str, Column] | None = None) -> DataFrame:
    """Add ``rank_col`` = 1-based position of the row in ``order``.

    ``order`` must be a total order (add a unique tie-break key) so that the
    numbers are repeatable; it accepts column names or sort expressions such
    as ``F.col("x").desc_nulls_first()``.  With ``total_col`` the number of
    rows is added too (needed for n-tiles).  With ``keep`` only these columns
    are written and returned; the others just order the rows.  ``derived``
    columns follow from a row's others and are added behind the shuffle.
    """
    cols = _as_columns(order)
    ranged = df.repartitionByRange(int(num_partitions or range_partitions(df)), *cols)
    tagged = (
        ranged
        .sortWithinPartitions(*cols)
        .withColumn("_mf_tag", F.monotonically_increasing_id())
    )
    if keep is not None:
        tagged = tagged.select(*keep, "_mf_tag")
    if derived:
        tagged = tagged.withColumns(dict(derived))
    tagged = cut_lineage(tagged)

    part = F.shiftright(F.col("_mf_tag"), _POS_BITS)
    counts = dict(
        tagged.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("c")).collect())
    n_parts = (max(counts) + 1) if counts else 0
    offsets, running = [], 0
    for p in range(n_parts):
        offsets.append(running)
        running += counts.get(p, 0)
    position = F.col("_mf_tag").bitwiseAND(F.lit(_POS_MASK))
    # one row per range partition: its bound is the partition count
    table = tagged.sparkSession.createDataFrame(
        list(enumerate(offsets)) or [(0, 0)], "_mf_part long, _mf_offset long")
    out = (tagged.join(F.broadcast(table), part == F.col("_mf_part"), "inner")
           .withColumn(rank_col, (F.col("_mf_offset") + position + 1).cast("long"))
           .drop("_mf_part", "_mf_offset"))
    if total_col:
        out = out.withColumn(total_col, F.lit(running).cast("long"))
    return out.drop("_mf_tag")


def ntile_of(rank, total, buckets: int) -> Column:
    """SQL ``NTILE(buckets)`` from a 1-based rank and the row count.

    With q = total div buckets and r = total mod buckets the first r buckets
    hold q + 1 rows and the rest q rows.
    """
    rank = F.col(rank) if isinstance(rank, str) else rank
    total = F.col(total) if isinstance(total, str) else total
    i = rank - 1
    q = F.floor(total / buckets).cast("long")
    r = total - q * buckets
    big = r * (q + 1)
    return (
        F.when(i < big, F.floor(i / (q + 1)) + 1)
        .otherwise(r + F.floor((i - big) / F.greatest(q, F.lit(1))) + 1)
        .cast("int")
    )


def with_global_ntile(df: DataFrame, order: Sequence, buckets: int, out_col: str,
                      num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = ``NTILE(buckets) OVER (ORDER BY order)`` computed in parallel."""
    ranked = with_global_rank(df, order, "_mf_rank", "_mf_rows", num_partitions)
    return ranked.withColumn(out_col, ntile_of("_mf_rank", "_mf_rows", buckets)).drop(
        "_mf_rank", "_mf_rows"
    )


def with_surrogate_key(df: DataFrame, natural_key: Sequence, key_col: str,
                       num_partitions: int | None = None,
                       derived: Mapping[str, Column] | None = None) -> DataFrame:
    """Dense surrogate key ``row_number() OVER (ORDER BY natural_key)``,
    placed as the first column (binary string order, as the source);
    ``derived`` columns come last."""
    ranked = with_global_rank(df, natural_key, key_col, None, num_partitions, derived=derived)
    return ranked.select(key_col, *[c for c in df.columns], *(derived or {}))
