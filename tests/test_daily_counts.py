"""Partial counts per day against the direct reports, and stored sketches
against the exact distinct counts."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from gridplace.operators import daily_counts as D
from gridplace.operators import jobs as J
from gridplace.operators import popularity as POP
from gridplace.operators import popularity_sketches as PS
from gridplace.operators import queues as Q
from gridplace.operators import shares as S

JOBS = "pandaid long, computingsite string, jobstatus string, modificationtime timestamp_ntz, prodsourcelabel string, day date"


def jobs(spark, seed, n=600):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randrange(12 * 86400))
        if rnd.random() < 0.1:
            at = dt.datetime(at.year, at.month, at.day)  # on a day's edge
        at = None if rnd.random() < 0.02 else at
        rows.append((None if rnd.random() < 0.1 else i, rnd.choice(["Q1", "Q2", "Q3_TEST", "Q4", None]), rnd.choice([*J.SHARE_STATUSES, "closed", "cancelled", "other", None]),
                     at, rnd.choice(["user", "managed", None]), at.date() if at else None))
    return spark.createDataFrame(rows, JOBS)


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


WINDOWS = [("2024-01-10", 7), ("2024-01-10", 1), ("2024-01-10 09:30:00", 6.4), ("2024-01-10 09:30:00", 1), ("2024-01-10 09:30:00", 0.25), ("2024-01-10 09:30:00", 0.5), ("2024-01-10", 0.5), ("2024-01-10 00:00:01", None), ("2024-01-20", 3)]


@pytest.mark.parametrize("as_of, n_days", WINDOWS)
def test_windows_equal_the_direct_report(spark, as_of, n_days):
    tables = [jobs(spark, 1), jobs(spark, 2)]
    daily = D.daily_status_counts(tables)
    for options in ({}, {"label": "user", "statuses": J.SHARE_STATUSES}, {"exclude_test": True, "count_col": None, "statuses": J.EFFICIENCY_STATUSES}):
        same(D.job_status_counts_from_daily(daily, tables, as_of, n_days, **options), J.job_status_counts(tables, as_of, n_days, **options))


def test_reports_take_merged_counts(spark):
    tables = [jobs(spark, 3)]
    daily = D.daily_status_counts(tables)
    merged = lambda **o: D.job_status_counts_from_daily(daily, tables, "2024-01-09 17:00:00", 5.5, **o)
    same(Q.queue_occupancy(merged()), Q.queue_occupancy_report(tables, "2024-01-09 17:00:00", 5.5))
    same(Q.efficiency_of(merged(statuses=J.EFFICIENCY_STATUSES, exclude_test=True, count_col=None)), Q.queue_efficiency(tables, "2024-01-09 17:00:00", 5.5))
    same(S.job_shares(merged(statuses=J.SHARE_STATUSES, label="user")), S.job_shares_report(tables, "2024-01-09 17:00:00", 5.5))


def test_days_are_counted_once_and_again(spark, tmp_path):
    first, path = jobs(spark, 4), str(tmp_path / "daily")
    D.refresh_daily_counts(first, path, "2024-01-01", "2024-01-12")
    late = first.unionByName(jobs(spark, 5, 50))
    D.refresh_daily_counts(late, path, "2024-01-05", "2024-01-06")
    got = D.read_daily_counts(spark, path).select(*D.COUNT_COLUMNS)
    inside = F.col("modificationtime").cast("date").between("2024-01-05", "2024-01-06")
    want = D.daily_status_counts(first.filter(~inside)).unionByName(D.daily_status_counts(late.filter(inside)))
    same(got, want)
    D.refresh_daily_counts(first.limit(0), path, "2024-01-07", "2024-01-07")  # a day that lost all its jobs
    assert D.read_daily_counts(spark, path).filter("day = date '2024-01-07'").count() == 0
    assert D.read_daily_counts(spark, path).filter("day = date '2024-01-08'").count() > 0


def test_a_window_opens_its_days_and_the_edges_of_jobs(spark, tmp_path):
    jobs(spark, 6).filter("day IS NOT NULL").write.partitionBy("day").parquet(str(tmp_path / "jobs"))
    table = spark.read.parquet(str(tmp_path / "jobs"))
    D.refresh_daily_counts(table, str(tmp_path / "daily"), "2024-01-01", "2024-01-12", partition_col="day")
    daily = D.read_daily_counts(spark, str(tmp_path / "daily"))
    out = D.job_status_counts_from_daily(daily, table, "2024-01-10 09:30:00", 6.25, partition_col="day")
    plan = out._jdf.queryExecution().executedPlan().toString()
    bounds = sorted(re.findall(r"PartitionFilters: \[isnotnull\(day#\d+\), \(day#\d+ (<=?) ([-\d]+)\), \(day#\d+ >= ([-\d]+)\)", plan) + [
        (b, c, a) for a, b, c in re.findall(r"PartitionFilters: \[isnotnull\(day#\d+\), \(day#\d+ >= ([-\d]+)\), \(day#\d+ (<=?) ([-\d]+)\)", plan)])
    # whole days from 5 to 9 of the counts; of the jobs 04 03:30 to 05 and 10 to 09:30
    assert bounds == [("<", "2024-01-10", "2024-01-05"), ("<=", "2024-01-05", "2024-01-04"), ("<=", "2024-01-10", "2024-01-10")], plan
    same(out, J.job_status_counts(table, "2024-01-10 09:30:00", 6.25))


def pruned(df):
    return "PartitionFilters: [isnotnull(day" in df._jdf.queryExecution().executedPlan().toString()


def test_every_report_prunes_a_partitioned_table(spark, tmp_path):
    jobs(spark, 7).filter("day IS NOT NULL").write.partitionBy("day").parquet(str(tmp_path / "jobs"))
    table = spark.read.parquet(str(tmp_path / "jobs"))
    days = lambda *d: len(table.filter(F.col("day").isin(*[dt.date(2024, 1, x) for x in d])).inputFiles())
    for report in (Q.queue_occupancy_report, Q.queue_efficiency, S.job_shares_report):
        narrow, whole = report(table, "2024-01-10", 2, partition_col="day"), report(table, "2024-01-10", 2)
        assert pruned(narrow) and not pruned(whole)
        same(narrow, whole)
    assert len(Q.queue_occupancy_report(table, "2024-01-10", 2, partition_col="day").inputFiles()) == days(8, 9, 10)
    narrow = Q.queue_efficiency_report(table, "2024-01-05", partition_col="day")
    assert pruned(narrow) and len(narrow.inputFiles()) == days(1, 2, 3, 4, 5)
    same(narrow, Q.queue_efficiency_report(table, "2024-01-05"))


# --- stored sketches ------------------------------------------------------------


def popular(spark, n=40_000, seed=1):
    rows = spark.range(n).select(
        F.col("id").alias("jeditaskid"), F.concat(F.lit("u"), F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(3000))).alias("username"), F.lit("anal").alias("tasktype"),
        (F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(hours=(F.col("id") % 240).cast("int"))).alias("modificationtime"),
        F.when(F.col("id") % 11 > 0, F.lit(dt.datetime(2024, 2, 1))).alias("endtime"),
    )
    used = spark.range(n).select(
        F.col("id").alias("jeditaskid"), F.when(F.col("id") % 3 == 0, "mc.hot.DAOD").when(F.col("id") % 3 == 1, F.concat(F.lit("data."), F.col("id") % 50, F.lit(".DAOD"))).otherwise("other").alias("datasetname"),
        F.when(F.col("id") % 7 > 0, "input").otherwise("output").alias("type"), F.lit(None).cast("long").alias("masterid"),
    )
    return rows, used.unionByName(used.limit(500))


def test_seven_days_of_sketches_are_within_the_stated_error(spark):
    tasks, used = popular(spark)
    exact = {r.datasetname: r for r in POP.dataset_popularity(tasks, used, "2024-01-09", 7).collect()}
    sketches = PS.popularity_sketches(tasks, used)
    got = {r.datasetname: r for r in PS.popularity_from_sketches(sketches, "2024-01-09", 7).collect()}
    assert set(got) == set(exact) and len(exact) == 51
    for name, e in exact.items():
        for c in ("n_tasks", "n_users"):
            assert abs(got[name][c] - e[c]) <= max(1, 4 * PS.standard_error() * e[c])
    assert exact["mc.hot.DAOD"].n_tasks > 6000
    # small sets are counted exactly, and days are not summed: a user of seven days is one
    assert all(got[n] == exact[n] for n in exact if n != "mc.hot.DAOD")


def test_stored_sketches_merge_with_new_days(spark, tmp_path):
    tasks, used = popular(spark, 4000)
    early = PS.popularity_sketches(tasks, used, "2024-01-05", 4)
    late = PS.popularity_sketches(tasks, used, "2024-01-09", 4)
    for k, part in enumerate((early, late)):
        part.write.parquet(str(tmp_path / f"part{k}"))
    stored = spark.read.parquet(str(tmp_path / "part0"), str(tmp_path / "part1"))
    same(PS.popularity_from_sketches(stored, "2024-01-09", 8, 1).orderBy("datasetname"), POP.dataset_popularity(tasks, used, "2024-01-09", 8, 1).orderBy("datasetname"))


def test_sketches_know_whole_days_only(spark):
    with pytest.raises(ValueError):
        PS.popularity_from_sketches(spark.createDataFrame([], "day date, datasetname string, tasks binary, users binary"), "2024-01-09 12:00:00")
