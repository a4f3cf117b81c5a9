"""Mergeable per-day status counts (survey 2.4, A1-A4 over trailing windows).

The job reports count jobs per queue and status over a trailing window and
are run again and again: every run of a 30-day window would read 30 days of
jobs of which 29 were counted before.  Here each day is counted once into a
small table of partial counts,

    day, queue, jobstatus, prodsourcelabel, n_rows, n_ids

whose rows add up.  A window of n days then sums the partial counts of its
whole days and reads jobs only for the parts of a day at its two ends.  The
result is the same as ``job_status_counts`` over all jobs, for whole days and
for fractions of a day.

The table holds one row per (queue, status, label) and day, so it grows with
the queues and the days, never with the jobs.  It is partitioned by day: a
window opens the days it needs, and counting a day again (late jobs) replaces
that day only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridplace.functions import days_before, not_test_queue, snapshot_week, ts_literal
from gridplace.operators.jobs import OCCUPANCY_STATUSES
from gridplace.sources.commits import read_committed, write_committed

COUNT_COLUMNS = ("day", "queue", "jobstatus", "prodsourcelabel", "n_rows", "n_ids")


def as_datetime(value) -> dt.datetime:
    """A point in time given as text, date or datetime."""
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return dt.datetime.fromisoformat(value)


def as_tables(tables: DataFrame | Sequence[DataFrame]) -> list[DataFrame]:
    return [tables] if isinstance(tables, DataFrame) else list(tables)


def between(start: Column | None, end: Column, partition_col: str | None) -> Column:
    """``start <= modificationtime < end``, and the same on the partition's day."""
    t = F.col("modificationtime")
    cond = t < end if start is None else (t >= start) & (t < end)
    if partition_col is not None:
        day = F.col(partition_col)
        cond = cond & (day <= end.cast("date"))
        if start is not None:
            cond = cond & (day >= start.cast("date"))
    return cond


def daily_status_counts(
    tables: DataFrame | Sequence[DataFrame],
    first_day: dt.date | str | None = None,
    last_day: dt.date | str | None = None,
    partition_col: str | None = None,
) -> DataFrame:
    """Partial counts of the whole days ``first_day`` to ``last_day`` (both
    included; None: no bound) over the UNION ALL of job tables.

    ``n_rows`` counts jobs and ``n_ids`` those with an id.  Jobs without a
    modification time are in no window and in no count.
    """
    cond = F.col("modificationtime").isNotNull()
    if last_day is not None:
        start = None if first_day is None else ts_literal(as_datetime(first_day))
        cond = between(start, ts_literal(as_datetime(last_day) + dt.timedelta(days=1)), partition_col)
    elif first_day is not None:
        cond = F.col("modificationtime") >= ts_literal(as_datetime(first_day))
        if partition_col is not None:
            cond = cond & (F.col(partition_col) >= ts_literal(as_datetime(first_day)).cast("date"))
    parts = [
        t.filter(cond).select(
            F.col("modificationtime").cast("date").alias("day"), F.col("computingsite").alias("queue"), "jobstatus", "prodsourcelabel", "pandaid"
        )
        for t in as_tables(tables)
    ]
    jobs = parts[0]
    for p in parts[1:]:
        jobs = jobs.unionByName(p)
    return jobs.groupBy("day", "queue", "jobstatus", "prodsourcelabel").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("pandaid").alias("n_ids")
    ).select(*COUNT_COLUMNS)


def refresh_daily_counts(
    tables: DataFrame | Sequence[DataFrame], path: str, first_day, last_day, partition_col: str | None = None
) -> str:
    """Count the days ``first_day`` to ``last_day`` (again) into the table at
    ``path``; other days stay.  Readers see all of the new days or none."""
    counts = daily_status_counts(tables, first_day, last_day, partition_col)
    days = (as_datetime(last_day) - as_datetime(first_day)).days + 1
    stamps = [{"day": (as_datetime(first_day) + dt.timedelta(days=k)).date()} for k in range(days)]
    return write_committed(counts.repartition("day"), path, ("day",), stamps=stamps)  # one file a day


def read_daily_counts(spark: SparkSession, path: str) -> DataFrame:
    return read_committed(spark, path)


def merged_counts(
    daily: DataFrame,
    tables: DataFrame | Sequence[DataFrame],
    as_of,
    n_days: int | float | None,
    partition_col: str | None = None,
) -> DataFrame:
    """queue, jobstatus, prodsourcelabel, n_rows, n_ids over the window
    ``[as_of - n_days, as_of)``, in parts that add up: whole days from
    ``daily``, what is left at either end from the jobs."""
    end = as_datetime(as_of)
    end_whole = dt.datetime(end.year, end.month, end.day)
    keep = list(COUNT_COLUMNS[1:])
    edges: list[Column] = []
    whole = F.col("day") < F.lit(end_whole.date())
    if n_days is not None:
        # the bound as the direct report takes it, so both agree on every fraction
        start_at = end - dt.timedelta(seconds=round(n_days * 86400, 6))
        start_whole = dt.datetime(start_at.year, start_at.month, start_at.day)
        if start_whole < start_at:
            start_whole += dt.timedelta(days=1)
        if start_whole > end_whole:  # the window lies within a day
            return _edge_counts(tables, between(days_before(as_of, n_days), ts_literal(as_of), partition_col)).select(*keep)
        whole = whole & (F.col("day") >= F.lit(start_whole.date()))
        if start_at < start_whole:
            edges.append(between(days_before(as_of, n_days), ts_literal(start_whole), partition_col))
    if end_whole < end:
        edges.append(between(ts_literal(end_whole), ts_literal(as_of), partition_col))
    out = daily.filter(whole).select(*keep)
    for edge in edges:
        out = out.unionByName(_edge_counts(tables, edge).select(*keep))
    return out


def _edge_counts(tables: DataFrame | Sequence[DataFrame], cond: Column) -> DataFrame:
    return daily_status_counts([t.filter(cond) for t in as_tables(tables)])


def job_status_counts_from_daily(
    daily: DataFrame,
    tables: DataFrame | Sequence[DataFrame],
    as_of,
    n_days: int | float | None = 1,
    statuses: Sequence[str] = OCCUPANCY_STATUSES,
    label: str | None = None,
    exclude_test: bool = False,
    count_col: str | None = "pandaid",
    partition_col: str | None = None,
) -> DataFrame:
    """``job_status_counts`` of the window, from partial counts.

    Same columns and rows: ``queue_occupancy``, ``efficiency_of`` and
    ``job_shares`` take either.  ``daily`` must hold every whole day of the
    window.
    """
    counts = merged_counts(daily, tables, as_of, n_days, partition_col)
    if label is not None:
        counts = counts.filter(F.col("prodsourcelabel") == label)
    if exclude_test:
        counts = counts.filter(not_test_queue("queue"))
    n = F.col("n_ids" if count_col else "n_rows")
    wide = counts.groupBy("queue").agg(*[F.sum(F.when(F.col("jobstatus") == s, n)).alias(s) for s in statuses])
    return wide.select(snapshot_week(as_of).alias("datetime"), "queue", *statuses)
