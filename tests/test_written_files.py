"""What the sinks leave in the file system."""

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from gridplace.plans import registry
from gridplace.sources import readers
from gridplace.sources.sinks import write_suggestions

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="gridplace-test-")


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_records_land_packed_in_bounded_files(spark, monkeypatch):
    paths = []
    monkeypatch.setattr(registry, "RECORDS_PER_FILE", 100)
    monkeypatch.setattr(registry, "read_records", lambda s, path, schema: (paths.append(path), readers.read_records(s, path, schema))[1])
    got = registry.q_records_read_back(spark, SF)
    files = glob.glob(paths[0].removeprefix("file:") + "/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)
    rows = got.groupBy(F.input_file_name().alias("f")).count().collect()
    assert max(r["count"] for r in rows) <= 100 and len(rows) == len(files)
    want = registry.TestTables(spark, SF).replica_records
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_dataset_folder_comes_from_one_task(spark, scratch):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.createDataFrame([(f"mc:mc.{d}", f"R{s}", q) for d in range(6) for s in range(12) for q in range(3)], "dataset string, source_replica string, queue int")
    path = os.path.join(scratch, "out")
    try:
        write_suggestions(df.repartition(5), path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for folder in glob.glob(f"{path}/dataset=*"):
        files = glob.glob(f"{folder}/*/part-*")
        assert len(files) == 12  # one file for each source
        assert len({os.path.basename(f).split("-")[1] for f in files}) == 1
    assert len(glob.glob(f"{path}/dataset=*")) == 6 and spark.read.parquet(path).count() == df.count()


def test_suggestions_written_again_replace_their_own(spark, scratch):
    path = os.path.join(scratch, "out")
    schema = "dataset string, source_replica string, queue int"
    write_suggestions(spark.createDataFrame([("a:1", "R1", 1), ("a:1", "R2", 2), ("a:2", "R1", 3)], schema), path)
    write_suggestions(spark.createDataFrame([("a:1", "R1", 4), ("a:3", None, 5)], schema), path)
    rows = spark.read.parquet(path).select("dataset", "source_replica", "queue").collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, [("a:1", "R1", 4), ("a:1", "R2", 2), ("a:2", "R1", 3), ("a:3", None, 5)]))
    empty = os.path.join(scratch, "empty")
    write_suggestions(spark.createDataFrame([], schema), empty)
    assert spark.read.schema(schema).parquet(empty).count() == 0
