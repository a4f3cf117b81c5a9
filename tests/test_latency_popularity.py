import datetime as dt

from gridplace.operators import latency as L
from gridplace.operators import popularity as POP

AS_OF = "2024-01-31"
LOG = "pandaid long, jobstatus string, modificationtime timestamp_ntz, prodsourcelabel string"
ACT = "pandaid long, jeditaskid long, computingsite string, modificationtime timestamp_ntz, prodsourcelabel string"


def t(h, m=0, s=0, us=0):
    return dt.datetime(2024, 1, 30, h, m, s, us)


def test_lag_crosses_queues_and_uses_first_time(spark):
    log = spark.createDataFrame([
        (1, "activated", t(10, 0, 0, 900000), "user"),
        (1, "activated", t(10, 30), "user"),          # later duplicate: min is kept
        (2, "running", t(10, 1, 0, 100000), "user"),   # other queue, same task
        (3, "running", t(11), "managed"),              # wrong label
        (4, "running", t(12), "user"),                 # first entry of its task -> NULL lag
    ], LOG)
    act = spark.createDataFrame([
        (1, 7, "QA", t(23), "user"), (2, 7, "QB", t(23), "user"), (3, 7, "QB", t(23), "user"),
        (4, 8, "QA", t(23), "user"), (5, 9, "QC", t(22), "user"),
    ], ACT)
    res = {r.queue: r for r in L.queueing_time(log, act, AS_OF, 1).collect()}
    # QB: running at 10:01:00.1 after task 7's activation at 10:00:00.9 -> 60 whole seconds
    assert res["QB"].queue_time_avg == 60 and res["QB"].queue_time_max == 60
    assert res["QA"].queue_time_avg is None and res["QA"].n_tasks == 2
    assert "QC" not in res  # no running entry
    total = 5
    assert res["QB"].weighted_avg_queue_time == round(60 * 2 / total, 3)


def test_median_even_count(spark):
    log = spark.createDataFrame(
        [(i, "activated", t(1, i), "user") for i in range(4)]
        + [(10 + i, "running", t(1, i, 10 + 10 * i), "user") for i in range(4)], LOG)
    act = spark.createDataFrame(
        [(i, i, "QX", t(2), "user") for i in range(4)] + [(10 + i, i, "QX", t(2), "user") for i in range(4)], ACT)
    r = L.queueing_time(log, act, AS_OF, 1).collect()[0]
    assert (r.queue_time_min, r.queue_time_max) == (10, 40)
    assert r.queue_time_median == 25.0  # (20+30)/2 = 25


def test_popularity_filters_and_threshold(spark):
    tasks = spark.createDataFrame(
        [(i, f"u{i % 3}", "anal", dt.datetime(1998, 6, 1), dt.datetime(1998, 6, 2)) for i in range(12)]
        + [(100, "u9", "prod", dt.datetime(1998, 6, 1), dt.datetime(1998, 6, 2)),
           (101, "u9", "anal", dt.datetime(1998, 6, 1), None)],
        "jeditaskid long, username string, tasktype string, modificationtime timestamp_ntz, endtime timestamp_ntz")
    ds = spark.createDataFrame(
        [(i, "mc.x.DAOD_A", "input", None) for i in range(12)]
        + [(i, "valid.x.DAOD_A", "input", None) for i in range(12)]
        + [(i, "data.y.DAOD_B", "input", None) for i in range(9)]
        + [(100, "data.y.DAOD_B", "input", None), (101, "data.y.DAOD_B", "input", None),
           (0, "data.y.DAOD_B", "output", None), (1, "data.y.DAOD_B", "input", 5)],
        "jeditaskid long, datasetname string, type string, masterid int")
    res = {r.datasetname: r for r in POP.dataset_popularity(tasks, ds, "1998-07-01", 365, 10).collect()}
    assert set(res) == {"mc.x.DAOD_A"} and res["mc.x.DAOD_A"].n_tasks == 12 and res["mc.x.DAOD_A"].n_users == 3
    low = {r.datasetname: r.n_tasks for r in POP.dataset_popularity(tasks, ds, "1998-07-01", 365, 1).collect()}
    assert low["data.y.DAOD_B"] == 9
