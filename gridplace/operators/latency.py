"""Queueing time per queue (survey 2.8: queueing_time).

For every task, the first 'activated' and first 'running' time per queue
are taken from the status log; the queueing time of a 'running' entry is
the gap to the task's previous entry (any queue, any status), in whole
seconds.  Per queue: average, median (both rounded), max, min, and the
average/median weighted by the queue's share of active user jobs.

Plan: the log is reduced to one row per (job, status) BEFORE the join with
the active jobs, so a job with a huge log is one row; the join output is
reduced again to (queue, task, status).  The window then sees at most two
rows per (task, queue) - its partition is bounded by the number of queues
a task runs in, never by the log size.  The median is exact and keeps one
counter per distinct whole-second value (at most the window length).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridplace.functions import safe_div, sql_round, trailing_window, whole_seconds_between

# Statuses of the report.
QUEUEING_STATUSES = ("activated", "running")


def task_status_times(
    log: DataFrame, active: DataFrame, as_of, n_days=1, label: str | None = "user",
    statuses: Sequence[str] = QUEUEING_STATUSES, partition_col: str | None = None,
) -> DataFrame:
    """Queue, jeditaskid, jobstatus, first modificationtime in the window."""
    cond = trailing_window("modificationtime", as_of, n_days, partition_col) & F.col("jobstatus").isin(*statuses)
    if label is not None:
        cond = cond & (F.col("prodsourcelabel") == label)
    first = log.filter(cond).groupBy("pandaid", "jobstatus").agg(F.min("modificationtime").alias("_t"))
    a = active.select("pandaid", "jeditaskid", F.col("computingsite").alias("queue"))
    return first.join(a, "pandaid").groupBy("queue", "jeditaskid", "jobstatus").agg(
        F.min("_t").alias("modificationtime")
    )


def queueing_lags(times: DataFrame) -> DataFrame:
    """Queue, jobstatus, lag (seconds since the task's previous entry).

    The partition is the task only, so the previous entry may come from
    another queue; status and queue break ties so reruns are identical.
    """
    w = Window.partitionBy("jeditaskid").orderBy("modificationtime", "jobstatus", "queue")
    prev = F.lag("modificationtime", 1).over(w)
    return times.select("queue", "jobstatus", whole_seconds_between(prev, "modificationtime").alias("lag"))


def queueing_time(
    log: DataFrame, active: DataFrame, as_of, n_days=1, label: str | None = "user", approx_median: bool = False,
    partition_col: str | None = None,
) -> DataFrame:
    """queue, queue_time_avg, queue_time_max, queue_time_min,
    queue_time_median, n_tasks, weighted_avg_queue_time,
    weighted_median_queue_time."""
    lags = queueing_lags(task_status_times(log, active, as_of, n_days, label, partition_col=partition_col))
    med = F.percentile_approx("lag", 0.5, 10000) if approx_median else F.median("lag")
    a = lags.filter(F.col("jobstatus") == "running").groupBy("queue").agg(
        sql_round(F.avg("lag"), 0).alias("queue_time_avg"),
        F.max("lag").alias("queue_time_max"),
        F.min("lag").alias("queue_time_min"),
        sql_round(med, 0).alias("queue_time_median"),
    )
    cond = trailing_window("modificationtime", as_of, n_days)
    if label is not None:
        cond = cond & (F.col("prodsourcelabel") == label)
    b = active.filter(cond).groupBy(F.col("computingsite").alias("queue")).agg(
        F.count("pandaid").alias("n_tasks")
    )
    total = b.agg(F.sum("n_tasks")).scalar()
    return a.join(b, "queue").select(
        "queue", "queue_time_avg", "queue_time_max", "queue_time_min", "queue_time_median", "n_tasks",
        sql_round(safe_div(F.col("queue_time_avg") * F.col("n_tasks"), total), 3).alias("weighted_avg_queue_time"),
        sql_round(safe_div(F.col("queue_time_median") * F.col("n_tasks"), total), 3).alias(
            "weighted_median_queue_time"
        ),
    )
