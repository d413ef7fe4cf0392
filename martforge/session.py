"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on.  ANSI mode makes bad casts fail the job (as the
# source database does); UTC keeps date arithmetic independent of the host.
SESSION_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # keyed streaming state (the order-status audit) kept in RocksDB: state
    # larger than memory, compact checkpoints
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app: str = "martforge",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k in ("spark.sql.ansi.enabled", "spark.sql.session.timeZone"):
        spark.conf.set(k, conf[k])
    return spark


# private folders of local sessions without spark.checkpoint.dir (tests)
_LOCAL_DIRS: dict[str, str] = {}


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        value = spark.conf.get(key, None)
    except Exception:  # noqa: BLE001 - unknown keys raise on some versions
        value = None
    return value or None


def _is_local(spark: SparkSession) -> bool:
    master = _conf(spark, "spark.master") or ""
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage.

    Taken from ``spark.checkpoint.dir`` (the cluster names it).  Only a local
    session without that setting (tests) gets a private temporary folder; a
    cluster without it is an error, since a machine-local folder would not
    survive the loss of an executor.
    """
    configured = _conf(spark, "spark.checkpoint.dir")
    if configured is None:
        try:  # classic sessions: the context may have been given a folder directly
            configured = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - no context in a remote session
            configured = None
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        app = _conf(spark, "spark.app.id") or "app"
        configured = _LOCAL_DIRS.setdefault(app, tempfile.mkdtemp(prefix="martforge-ckpt-"))
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate
    tables, one sub-folder per application."""
    app = _conf(spark, "spark.app.id") or "app"
    return f"{checkpoint_dir(spark).rstrip('/')}/martforge-{app}/{name}"


# shuffle files of a write go when it ends (Spark keeps them until the driver collects its garbage)
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_DROPPING: dict[str, list] = {}  # by session: writes under way, and the session's own value
_DROPPING_LOCK = threading.Lock()


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes begun within drop their shuffle files at their end.  A write plans its
    frame anew, so nothing else reads these files; other actions keep theirs."""
    session = f"{spark.sparkContext.applicationId}/{id(spark)}"
    with _DROPPING_LOCK:
        state = _DROPPING.setdefault(session, [0, None])
        if not state[0]:
            state[1] = spark.conf.get(DROP_SHUFFLES, "false")
            spark.conf.set(DROP_SHUFFLES, "true")
        state[0] += 1
    try:
        yield
    finally:
        with _DROPPING_LOCK:
            state[0] -= 1
            if not state[0]:
                spark.conf.set(DROP_SHUFFLES, state[1])


# codec of stored tables: a third smaller than Parquet's default here, and as splittable
STORED_CODEC = "zstd"


def _write_scratch(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, f"{name}/{uuid.uuid4().hex}")
    with dropping_shuffles(df.sparkSession):
        df.write.mode("errorifexists").option("compression", STORED_CODEC).parquet(path)
    return path


def cut_lineage(df: DataFrame, name: str = "lineage") -> DataFrame:
    """Write the frame as a Parquet table in the shared checkpoint folder and
    continue from a scan of it.

    A lost executor then recomputes nothing upstream, non-deterministic
    steps (ids, sampled range bounds) stay fixed for every later reader, and
    - unlike an RDD checkpoint of Java-serialised rows - later readers get a
    columnar scan with column pruning and filter pushdown.
    """
    spark = df.sparkSession
    return spark.read.parquet(_write_scratch(df, name))


def stored_between(df: DataFrame, name: str) -> tuple[DataFrame, Callable[[], None]]:
    """As ``cut_lineage``, for a table between two steps: the scan, and what deletes
    the table once nothing reads it any more."""
    spark, path = df.sparkSession, _write_scratch(df, name)

    def delete() -> None:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    return spark.read.parquet(path), delete
