"""Job counts per queue and status (survey 2.2 P1-P3, 2.4 A1-A4, 2.6 O2).

``job_status_counts`` is the shared first stage of the occupancy, efficiency
and share reports: UNION ALL of job tables, trailing time window, optional
workload label, then one row per queue with one column per status.

Plan: every table is filtered and projected to three columns at the scan;
the union feeds ONE hash aggregate keyed by queue (partial aggregation on
the map side, so a queue holding a third of all jobs still arrives as one
small row per map task).  The status pivot is a set of conditional sums in
that same aggregate - ``.pivot()`` would add a second shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridplace.functions import not_test_queue, nvl, snapshot_week, trailing_window

# Status lists of the reference reports.
OCCUPANCY_STATUSES = ("running", "defined", "assigned", "activated", "starting", "transferring")
SHARE_STATUSES = OCCUPANCY_STATUSES + ("failed", "finished")
EFFICIENCY_STATUSES = ("closed", "cancelled", "failed", "finished")


def select_jobs(
    tables: DataFrame | Sequence[DataFrame],
    as_of,
    n_days: int | float | None,
    label: str | None = None,
    exclude_test: bool = False,
    partition_col: str | None = None,
) -> DataFrame:
    """O2 + P1 + P2 + P3: UNION ALL of job tables reduced to (queue, status, pandaid).

    ``partition_col``: the date column that the tables are partitioned by."""
    if isinstance(tables, DataFrame):
        tables = [tables]
    parts = []
    for t in tables:
        cond = trailing_window("modificationtime", as_of, n_days, partition_col)
        if label is not None:
            cond = cond & (F.col("prodsourcelabel") == label)
        if exclude_test:
            cond = cond & not_test_queue("computingsite")
        parts.append(t.filter(cond).select(F.col("computingsite").alias("queue"), "jobstatus", "pandaid"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def status_pivot(jobs: DataFrame, statuses: Sequence[str], count_col: str | None = "pandaid") -> DataFrame:
    """A1/A2 + A4: per queue, the number of jobs in each listed status.

    ``count_col='pandaid'`` counts non-NULL ids (``count(pandaid)``), ``None``
    counts rows (``count(*)``).  A status with no job in the queue is NULL,
    as in PIVOT; a queue whose jobs all have unlisted statuses still gets a
    row (all NULL).
    """
    one = F.col(count_col).isNotNull().cast("long") if count_col else F.lit(1).cast("long")
    aggs = [F.sum(F.when(F.col("jobstatus") == s, one)).alias(s) for s in statuses]
    return jobs.groupBy("queue").agg(*aggs)


def job_status_counts(
    tables: DataFrame | Sequence[DataFrame],
    as_of,
    n_days: int | float | None = 1,
    statuses: Sequence[str] = OCCUPANCY_STATUSES,
    label: str | None = None,
    exclude_test: bool = False,
    count_col: str | None = "pandaid",
    partition_col: str | None = None,
) -> DataFrame:
    """datetime, queue, <one column per status> (NULL where the queue has none).

    ``datetime`` is the Sunday-based week of ``as_of - 1 day``
    (``TRUNC(sysdate - 1, 'DAY')``); it is constant per run, so it is added
    after the aggregate instead of being a grouping key.
    """
    jobs = select_jobs(tables, as_of, n_days, label=label, exclude_test=exclude_test, partition_col=partition_col)
    counts = status_pivot(jobs, statuses, count_col=count_col)
    return counts.select(snapshot_week(as_of).alias("datetime"), "queue", *statuses)


def fill_counts(counts: DataFrame, statuses: Sequence[str]) -> DataFrame:
    """NVL(status, 0) for every status column."""
    return counts.select(*[nvl(s, 0).alias(s) if s in statuses else F.col(s) for s in counts.columns])
