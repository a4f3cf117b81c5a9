"""Session settings and lineage cuts.

The library never creates its own session inside an operator; these helpers
are for scripts, tests and the bench.  On a cluster the session comes from
the launcher and only the checkpoint folder is read from it.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings the operators are designed for.  AQE re-plans joins at run time:
# a side is broadcast only when its measured size is below the threshold,
# otherwise the join stays a shuffle join and skewed partitions are split.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "gridplace") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("GRIDPLACE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32m")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a session in one JVM without that setting (tests) gets a folder of
    its own, once per session; on a cluster it is an error, because a
    machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
        path = _OWN_FOLDERS.get(sc.applicationId)
        if path is None:
            path = _OWN_FOLDERS[sc.applicationId] = tempfile.mkdtemp(prefix="gridplace-ckpt-")
    sc.setCheckpointDir(path)
    return path


_OWN_FOLDERS: dict[str, str] = {}


def tables_folder(spark: SparkSession) -> str:
    """The session's own folder below the shared one; ``drop_tables`` deletes it."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/gridplace-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own below the session's folder, deleted with it."""
    folder = tables_folder(spark)
    if folder not in _LIVE:
        _LIVE.add(folder)
        atexit.register(_drop_at_exit, spark, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table under ``spark.checkpoint.dir`` and
    read it back.

    Unlike an eager ``checkpoint()``, which runs the plan once to count and
    again to write, the plan runs once; the table survives executor loss,
    cuts the lineage, and gives the planner real sizes for its join choices.
    The shuffles behind it are deleted once it is written, not when the
    driver next collects its garbage.  The tables of a session share one
    folder, which ``drop_tables`` deletes; without that call it goes when the
    driver's Python ends.
    """
    with _shuffles_end(df.sparkSession):
        return _write(df, name, folder)


def materialize_all(folder: str | None = None, **tables: DataFrame) -> list[DataFrame]:
    """``materialize`` several tables at once, in the order given: the jobs of
    small tables then share the cluster instead of waiting for each other."""
    for df in tables.values():
        new_folder(df.sparkSession, "any")  # the session's folder is registered before threads use it
    spark = next(iter(tables.values())).sparkSession
    with _shuffles_end(spark), ThreadPoolExecutor(len(tables)) as pool:
        return [t.result() for t in [pool.submit(inheritable_thread_target(spark)(_write), df, name, folder) for name, df in tables.items()]]


def _write(df: DataFrame, name: str, folder: str | None) -> DataFrame:
    spark = df.sparkSession
    path = f"{folder}/{name}" if folder else new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


@contextmanager
def passing_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for tables (``materialize(..., folder=...)``) that is deleted
    at the end: nothing that is used later may read them."""
    folder = new_folder(spark, "passing")
    try:
        yield folder
    finally:
        _delete(spark, folder)


#: Spark 4.1: the shuffle files of a query go when it ends.
SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ending: dict[str, tuple[int, str | None]] = {}
_ending_lock = Lock()


@contextmanager
def _shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Within, ``SHUFFLES_END`` is on; the first in and the last out of a
    session set and restore it.  A written table is never computed again, so
    its shuffles have no reader."""
    key = str(spark._jsparkSession.sessionUUID())
    with _ending_lock:
        n, before = _ending.get(key, (0, None))
        if n == 0:
            before = spark.conf.get(SHUFFLES_END, None)
            spark.conf.set(SHUFFLES_END, "true")
        _ending[key] = n + 1, before
    try:
        yield
    finally:
        with _ending_lock:
            n, before = _ending.pop(key)
            if n > 1:
                _ending[key] = n - 1, before
            elif before is None:
                spark.conf.unset(SHUFFLES_END)
            else:
                spark.conf.set(SHUFFLES_END, before)


_LIVE: set[str] = set()


def _delete(spark: SparkSession, folder: str) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(conf).delete(path, True)


def drop_tables(spark: SparkSession) -> None:
    """Delete all tables that ``materialize`` wrote in this session; the
    DataFrames that read them end with it."""
    folder = tables_folder(spark)
    _delete(spark, folder)
    _LIVE.discard(folder)


def _drop_at_exit(spark: SparkSession, folder: str) -> None:
    try:
        if folder in _LIVE and spark.sparkContext._jsc is not None:
            _delete(spark, folder)
    except Exception:  # the JVM may be gone already; nothing is left to do
        pass
