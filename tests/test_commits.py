"""Snapshots with a commit record: readers see whole runs only."""

import datetime as dt
import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridplace.sources.commits import commits, drop_uncommitted, read_committed, write_committed

FAILURE = (PySparkException, Py4JJavaError)


def snap(spark, rows):
    return spark.createDataFrame(rows, "queue string, n int, datetime string")


def seen(spark, path):
    return sorted(tuple(r) for r in read_committed(spark, path).select("queue", "n", "datetime").collect())


def test_a_run_replaces_its_stamps(spark, tmp_path):
    path = str(tmp_path / "t")
    write_committed(snap(spark, [("q1", 1, "09-28-2021"), ("q2", 2, "09-29-2021")]), path)
    write_committed(snap(spark, [("q3", 3, "09-29-2021"), ("q4", 4, "09-30-2021")]), path)
    assert seen(spark, path) == [("q1", 1, "09-28-2021"), ("q3", 3, "09-29-2021"), ("q4", 4, "09-30-2021")]
    assert [sorted(r["stamps"]) for r in commits(spark, path)] == [[["09-28-2021"], ["09-29-2021"]], [["09-29-2021"], ["09-30-2021"]]]


def test_a_failed_second_write_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    write_committed(snap(spark, [("q1", 1, "a"), ("q2", 2, "b")]), path)
    before = seen(spark, path)
    # the first stamp's rows are written before the second stamp's fail
    bad = snap(spark, [("new", 5, "a"), ("bad", 6, "b")]).coalesce(1).withColumn(
        "n", F.when(F.col("datetime") == "b", F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("n")))
    with pytest.raises(FAILURE):
        write_committed(bad, path)
    assert seen(spark, path) == before
    assert len(os.listdir(f"{path}/runs")) == 2 and len(commits(spark, path)) == 1


def test_files_without_a_record_are_ignored_and_can_be_dropped(spark, tmp_path):
    path = str(tmp_path / "t")
    write_committed(snap(spark, [("q1", 1, "a")]), path)
    # a run that ended between its files and its record
    snap(spark, [("ghost", 9, "a"), ("ghost", 9, "c")]).write.partitionBy("datetime").parquet(f"{path}/runs/halfway")
    assert seen(spark, path) == [("q1", 1, "a")]
    write_committed(snap(spark, [("q2", 2, "a")]), path)
    gone = drop_uncommitted(spark, path)
    assert "halfway" in gone and len(gone) == 2  # and the run whose only stamp was replaced
    assert seen(spark, path) == [("q2", 2, "a")]


def test_a_reader_that_began_before_a_commit_still_reads_its_run(spark, tmp_path):
    path = str(tmp_path / "t")
    write_committed(snap(spark, [("q1", 1, "a")]), path)
    df = read_committed(spark, path)
    write_committed(snap(spark, [("q2", 2, "a")]), path)
    assert [r.queue for r in df.collect()] == ["q1"]
    assert seen(spark, path) == [("q2", 2, "a")]


def test_stamps_of_any_type_and_empty_runs(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1), "mc:x.1"), (2, None, "mc:y"), (3, dt.date(2024, 1, 2), None)], "n int, day date, dataset string")
    write_committed(df, path, ("day", "dataset"))
    assert read_committed(spark, path).schema.simpleString() == df.schema.simpleString()
    assert sorted(map(str, read_committed(spark, path).collect())) == sorted(map(str, df.collect()))
    write_committed(df.limit(0), path, ("day", "dataset"))
    assert read_committed(spark, path).count() == 3
    write_committed(df.limit(0), path, ("day", "dataset"), stamps=[{"day": dt.date(2024, 1, 1), "dataset": "mc:x.1"}, {"day": None, "dataset": "mc:y"}])
    assert [r.n for r in read_committed(spark, path).collect()] == [3]


def test_filters_on_the_stamp_prune_files(spark, tmp_path):
    path = str(tmp_path / "t")
    write_committed(snap(spark, [("q", i, f"s{i}") for i in range(6)]), path)
    write_committed(snap(spark, [("q", 10, "s1")]), path)
    one = read_committed(spark, path).filter("datetime = 's1'")
    assert [r.n for r in one.collect()] == [10]
    assert {f.split("datetime=")[1].split("/")[0] for f in one.inputFiles()} == {"s1"} and len(one.inputFiles()) == 1


def test_a_run_that_is_the_whole_table(spark, tmp_path):
    """Suggestions: one partition per pair, a run replaces all."""
    path = str(tmp_path / "t")
    pairs = lambda n, k: spark.range(n).select(F.concat(F.lit("mc:"), F.col("id")).alias("dataset"), F.lit("R1").alias("source_replica"), F.lit(k).alias("rse_weight"))
    keys = ("dataset", "source_replica")
    write_committed(pairs(5, 1), path, keys, replace="all")
    write_committed(pairs(3, 2), path, keys, replace="all")
    assert sorted((r.dataset, r.rse_weight) for r in read_committed(spark, path).collect()) == [("mc:0", 2), ("mc:1", 2), ("mc:2", 2)]
    write_committed(pairs(1, 3), path, keys)  # one pair again
    assert sorted((r.dataset, r.rse_weight) for r in read_committed(spark, path).collect()) == [("mc:0", 3), ("mc:1", 2), ("mc:2", 2)]
    assert len(drop_uncommitted(spark, path)) == 1
    assert read_committed(spark, path).count() == 3
    with pytest.raises(ValueError):
        write_committed(pairs(1, 1), path, keys, replace="some")


def test_no_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_committed(spark, str(tmp_path / "none"))
