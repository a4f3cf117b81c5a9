import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from gridplace.operators import candidates as CA
from gridplace.operators import scoring as SC
from gridplace.operators import topology as T
from gridplace.sources.readers import read_dataset_list, read_records
from gridplace.sources.sinks import write_snapshot, write_suggestions
from test_scoring import spark_inputs


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="gridplace-test-")


def test_dataset_list_and_records(spark, scratch):
    p = os.path.join(scratch, "datasets.txt")
    with open(p, "w") as f:
        f.write("mc16_13TeV:mc16_13TeV.364250.x\n\ndata18_13TeV.00349014.y\n")
    rows = sorted((r.scope, r.name) for r in read_dataset_list(spark, p).collect())
    assert rows == [("data18_13TeV", "data18_13TeV.00349014.y"), ("mc16_13TeV", "mc16_13TeV.364250.x")]
    rp = os.path.join(scratch, "records.json")
    with open(rp, "w") as f:
        f.write(json.dumps({"rule_id": "r1", "rse_expression": "A_DATADISK", "extra": 1}) + "\n")
    r = read_records(spark, rp, "rule_id string, rse_expression string").collect()
    assert [(x.rule_id, x.rse_expression) for x in r] == [("r1", "A_DATADISK")]


def test_snapshot_sink_replaces_only_its_day(spark, scratch):
    out = os.path.join(scratch, "snap")
    a = spark.createDataFrame([("q1", 1, "09-28-2021"), ("q2", 2, "09-29-2021")], "queue string, n int, datetime string")
    write_snapshot(a, out)
    write_snapshot(spark.createDataFrame([("q3", 3, "09-29-2021")], "queue string, n int, datetime string"), out)
    got = sorted((r.queue, r.datetime) for r in spark.read.parquet(out).collect())
    assert got == [("q1", "09-28-2021"), ("q3", "09-29-2021")]


def test_suggestion_sink_keeps_colons(spark, scratch):
    out = os.path.join(scratch, "sugg")
    df = spark.createDataFrame([("mc:mc.1", "R1_DATADISK", 0.5)], "dataset string, source_replica string, rse_weight double")
    write_suggestions(df, out)
    r = spark.read.parquet(out).collect()[0]
    assert r.dataset == "mc:mc.1" and r.source_replica == "R1_DATADISK"


def test_replica_locations_filtered_by_dataset_list(spark):
    attrs = spark.createDataFrame([(1, "site", "S1"), (1, "cloud", "US")], "rse_id long, key string, value string")
    rses = spark.createDataFrame([(1, "R1_DATADISK")], "rse_id long, rse string")
    reps = spark.createDataFrame(
        [("mc", "a", 1, "DATASET", 5, "AVAILABLE", None, None, None, 1, 1, 5),
         ("mc", "b", 1, "DATASET", 5, "AVAILABLE", None, None, None, 1, 1, 5)],
        "scope string, name string, rse_id long, did_type string, bytes long, state string, accessed_at timestamp_ntz, "
        "updated_at timestamp_ntz, created_at timestamp_ntz, available_replicas_cnt long, length long, available_bytes long")
    ds = spark.createDataFrame([("mc", "b")], "scope string, name string")
    assert [r.name for r in T.replica_locations(reps, attrs, rses, ds).collect()] == ["b"]


def test_weight_dataset_filter_and_band(spark):
    cand, dist, reps = spark_inputs(spark)
    only_a = SC.rse_weight(cand, dist, reps, datasets=spark.createDataFrame([("mc", "a")], "scope string, name string"))
    assert {r.dataset for r in only_a.collect()} == {"mc:a"}
    banded = CA.closeness(cand, dist, CA.official_sources(reps), band=(0, 3)).collect()
    assert banded and all(0 < r.distance_from_source < 3 for r in banded)
    full = CA.closeness(cand, dist, CA.official_sources(reps)).collect()
    dmax = dist.agg(F.max("agis_distance")).collect()[0][0]
    assert all(r.closeness == dmax - r.distance_from_source for r in full)


def test_transfer_limit_modes(spark):
    q = spark.createDataFrame([("q", "S", "R_DATADISK", "C", 1, 1.0, 1.0, 1, 100, "d")],
                              "queue string, site string, rse string, cloud string, tier_level int, corepower double, "
                              "corecount double, nodes int, transferringlimit int, datetime string")
    m = spark.createDataFrame([("q", 60, 0, 150, 1.0, 1, 0, 1.0)],
                              "queue string, running long, queued long, transferring long, queue_occupancy double, "
                              "finished long, failed long, queue_efficiency double")
    s = spark.createDataFrame([("R_DATADISK",)], "rse string")
    for c in ["Avg tombstone", "Difference", "Free(storage)", "Min space", "Persistent", "Primary diff", "Quota(other)",
              "Temporary", "Total(storage)", "Unlocked", "Used(dark)", "Used(other)", "Used(rucio)"]:
        s = s.withColumn(c, F.lit(1.0))
    # transferring 150 >= limit 100: the code drops it; the comment keeps it (150 <= max(100, 120) is false -> dropped)
    assert CA.merged_candidates(q, m, s).count() == 0
    m2 = m.withColumn("running", F.lit(80).cast("long"))
    assert CA.merged_candidates(q, m2, s).count() == 0
    assert CA.merged_candidates(q, m2, s, limit_mode="comment").count() == 1
