"""The folders of a sink of small partitions, written by tasks with Arrow."""

import datetime as dt
import glob
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridplace.sources import folders
from gridplace.sources.sinks import read_suggestions, write_suggestions


@pytest.fixture()
def out():
    return os.path.join(tempfile.mkdtemp(prefix="gridplace-test-"), "out")


def rows(df) -> list[str]:
    return sorted(str(tuple(r)) for r in df.collect())


def started() -> int:
    with open("/proc/stat") as f:
        return next(int(line.split()[1]) for line in f if line.startswith("processes"))


@pytest.mark.skipif(not os.path.exists("/proc/stat"), reason="counts started processes")
def test_a_folder_starts_no_process(spark, out):
    df = spark.range(600).select(F.concat(F.lit("mc:"), F.col("id") % 150).alias("dataset"), F.concat(F.lit("R"), F.col("id") % 4).alias("source_replica"), "id")
    pairs = df.select("dataset", "source_replica").distinct().count()
    before = started()
    write_suggestions(df, out)
    assert started() - before < 2 * pairs
    assert len(glob.glob(f"{out}/dataset=*/source_replica=*/part-*.parquet")) == pairs
    assert rows(read_suggestions(spark, out, df.schema)) == rows(df.select(*df.columns))


def test_the_folders_are_those_of_spark(spark, out):
    """NULL, empty and escaped key values, repeated rows, NULL values, types
    and the order of columns."""
    keys = [None, "", "mc:mc.1", 'a"b#c%d\'e*f', "g/h=i?j\\k{l[m]n^o", "x y", "\t\x7f", "..", "%3A", "7"]
    values = [(1, 1.5, True, "s", Decimal("1.25"), dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3), bytearray(b"b")), (None,) * 8]
    data = [(*v[:2], k, *v[2:], s) for k in keys for s in ("R1", None, "") for v in (values[0], values[0], values[1])]
    df = spark.createDataFrame(data, "`n b` int, f double, dataset string, b boolean, s string, d decimal(10,2), day date, at timestamp, y binary, source_replica string").repartition(3)
    write_suggestions(df, out)
    df.repartition("dataset").write.partitionBy("dataset", "source_replica").parquet(f"{out}2")
    found = lambda p: sorted({os.path.dirname(f)[len(p) :] for f in glob.glob(f"{p}/*/*/part-*")})
    assert found(out) == found(f"{out}2") and len(found(out)) == 18
    assert len(glob.glob(f"{out}/*/*/part-*")) == 18 and os.path.exists(f"{out}/_SUCCESS") and not os.path.exists(f"{out}/_temporary")
    a, b = spark.read.parquet(out), spark.read.parquet(f"{out}2")
    assert a.schema == b.schema and rows(a) == rows(b) and a.count() == len(data)
    assert read_suggestions(spark, out, df.schema).columns == df.columns


def test_a_pair_that_spans_batches_is_one_file(spark, out):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(100).select((F.col("id") % 2).alias("dataset"), (F.col("id") % 3).alias("source_replica"), "id")
        write_suggestions(df, out)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(glob.glob(f"{out}/*/*/part-*")) == 6
    assert rows(read_suggestions(spark, out, df.schema)) == rows(df)


def test_a_failed_write_leaves_no_folder(spark, out):
    df = spark.range(40).select(F.col("id").cast("string").alias("dataset"), F.lit("R").alias("source_replica"), F.when(F.col("id") == 39, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("n"))
    with pytest.raises(Exception, match="no"):
        write_suggestions(df, out)
    assert not os.path.exists(out)


def test_other_types_and_formats_are_left_to_spark(spark, out):
    df = spark.createDataFrame([("a:1", "R1", [1, 2])], "dataset string, source_replica string, n array<int>")
    assert not folders.writable(df, ("dataset", "source_replica"))
    write_suggestions(df, out)
    assert rows(spark.read.parquet(out).select(*df.columns)) == rows(df)
    flat = df.select("dataset", "source_replica", F.col("n")[0].alias("n"))
    write_suggestions(flat, f"{out}2", fmt="json")
    assert glob.glob(f"{out}2/*/*/part-*.json")


def test_the_listing_setting_is_kept(spark, out):
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    df = spark.createDataFrame([("a:1", "R1", 1)], "dataset string, source_replica string, n int")
    write_suggestions(df, out)
    read_suggestions(spark, out, df.schema)
    assert spark.conf.get(key) == before
