"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# prefix of columns added while whole rows travel with a decision; input
# columns of any other name cannot clash with them
OWN = "__mf_"


# an Arrow batch of rows ends at these bytes, so that long texts do not add up
BATCH_BYTES = 8 << 20
_BATCH_KEY, _SPARK_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20


def bound_batches(spark: SparkSession) -> None:
    """Sets the session's bytes per Arrow batch to ``BATCH_BYTES`` unless the
    session has a value of its own; one row longer than that is a batch alone."""
    now = spark.conf.get(_BATCH_KEY, str(_SPARK_BYTES)).lower().rstrip("b")
    if now == str(_SPARK_BYTES):
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crc_mod(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo n; a null key counts as remainder 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % n, F.lit(0))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the key and the text, under fixed names, whatever else the table holds."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The text column as Python strings, null as the empty text."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """One output row set per Arrow batch: ``fn`` returns the columns by name."""
    fields = T._parse_datatype_string(schema)
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(fields)
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield pa.RecordBatch.from_arrays(
                    [out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type)
                     for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def add_columns(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """All columns of ``df`` plus those ``fn`` computes from each batch
    (names start with ``OWN``)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    new = T._parse_datatype_string(schema)
    full = T.StructType(list(df.schema.fields) + list(new.fields))
    arrow = to_arrow_schema(new)
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                arrays = list(batch.columns)
                names = list(batch.schema.names)
                for f in arrow:
                    v = out[f.name]
                    arrays.append(v if isinstance(v, pa.Array) else pa.array(v, f.type))
                    names.append(f.name)
                yield pa.RecordBatch.from_arrays(arrays, names)

    return df.mapInArrow(run, full)


_state: dict = {}


def worker_state(key, build: Callable):
    """What an operator remembers in this worker process, built once.  Asking
    with another key drops what was kept, so that operators that run one after
    the other in a reused worker do not add up."""
    if key not in _state:
        _state.clear()
        pa.default_memory_pool().release_unused()
        _state[key] = build()
    return _state[key]


def file_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()
