"""Sinks (survey 2.1, S7 and S8).

Snapshots are partitioned by their stamp and written with dynamic partition
overwrite, so re-running one day replaces only that day.  A failed task is
retried by Spark's commit protocol; no driver-side file handling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TASKS_PER_CORE = 8
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def write_snapshot(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("datetime",), fmt: str = "parquet"
) -> None:
    """Snapshot sink, one folder per stamp."""
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by).format(fmt).save(path)
    )


def write_suggestions(
    df: DataFrame, path: str, keys: Sequence[str] = ("dataset", "source_replica"), fmt: str = "parquet"
) -> None:
    """One output folder per (dataset, source replica), one file in it.

    Rows are dealt by the first key: a dataset is bounded by its sources and
    their candidates, many datasets share a task, and a hot source spreads by
    its datasets.  So one task writes a dataset's folder, which the commit
    moves as a whole.  The work is that of the files, not of their bytes, so
    the number of tasks is given and not coalesced.  A new path is written
    directly (on a local or mounted file system by ``folders.write_folders``,
    elsewhere by Spark's writer); only where there are folders already does
    the commit replace one after the other.  The ':' of dataset identifiers is
    escaped in folder names and read back intact.
    """
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    write = df.repartition(tasks, keys[0]).write.partitionBy(*keys).format(fmt)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = _folders()
    if fs.exists(at):
        write.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)
    elif folders and fmt == "parquet" and fs.getUri().getScheme() == "file" and folders.writable(df, keys):
        folders.write_folders(df, fs.makeQualified(at).toUri().getPath(), keys, tasks)
    else:
        write.mode("error").save(path)


def read_suggestions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``write_suggestions`` wrote.  Spark lists the folders of a path
    with up to 10,000 tasks; listing one takes less than starting a task, so
    the tasks are as many as keep the cores busy."""
    most = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, min(int(most), TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
    try:
        opened = spark.read.schema(schema).parquet(path)
    finally:
        spark.conf.set(LISTING_TASKS, most)
    return opened.select(*[F.col(f"`{c}`") for c in schema.names])


def _folders():
    try:
        from gridplace.sources import folders
    except ImportError:  # no Arrow: Spark's writer does it all
        return None
    return folders


def write_report(df: DataFrame, path: str, order_by: Sequence[str | Column], fmt: str = "parquet") -> None:
    """O1: a report in its final order: a range-partitioned sort, so the files
    in name order hold the rows in order without one task seeing them all."""
    df.orderBy(*order_by).write.mode("overwrite").format(fmt).save(path)
