"""Job shares per queue (survey 2.8: job_shares, queue_shares).

The grand totals are scalar subqueries (``DataFrame.scalar()``), not a
cross join and not an unpartitioned window: Spark runs the one-row
aggregate once (the three totals are merged into one subquery), inlines
the values, and the per-queue rows never leave their partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridplace.functions import safe_div, snapshot_label, sql_round
from gridplace.operators.jobs import SHARE_STATUSES, fill_counts, job_status_counts


def share_counts(counts: DataFrame) -> DataFrame:
    """queue, running, queued, completed from per-status counts (NVL'd)."""
    a = fill_counts(counts, SHARE_STATUSES)
    queued = F.col("defined") + F.col("assigned") + F.col("activated") + F.col("starting")
    completed = F.col("failed") + F.col("finished")
    return a.select("queue", "running", queued.alias("queued"), completed.alias("completed"))


def job_shares(counts: DataFrame, scale: int = 6) -> DataFrame:
    """queue, running_share, queued_share, completed_share, total_share.

    Each share is the queue's jobs over the sum over all queues, rounded to
    ``scale`` digits; a zero total gives NULL (the source database raises).
    """
    a = share_counts(counts)
    tr = a.agg(F.sum("running")).scalar()
    tq = a.agg(F.sum("queued")).scalar()
    tc = a.agg(F.sum("completed")).scalar()
    own = F.col("running") + F.col("queued") + F.col("completed")
    return a.select(
        "queue",
        sql_round(safe_div("running", tr), scale).alias("running_share"),
        sql_round(safe_div("queued", tq), scale).alias("queued_share"),
        sql_round(safe_div("completed", tc), scale).alias("completed_share"),
        sql_round(safe_div(own, tr + tc + tq), scale).alias("total_share"),
    )


def job_shares_report(
    tables, as_of, n_days=1, label: str | None = "user", partition_col: str | None = None
) -> DataFrame:
    """Shares straight from the four job tables (UNION ALL).

    ``partition_col``: the date column that the tables are partitioned by;
    only the days of the window are opened."""
    return job_shares(job_status_counts(tables, as_of, n_days, SHARE_STATUSES, label=label, partition_col=partition_col))


def queue_shares(shares: DataFrame, queues: DataFrame, as_of) -> DataFrame:
    """Shares joined with the eligible (queue, rse) list; one ``queue``
    column is kept, stamped with the run day."""
    return shares.join(queues.select("queue", "site", "rse", "cloud", "tier_level"), "queue").select(
        "queue", "running_share", "queued_share", "completed_share", "total_share",
        "site", "rse", "cloud", "tier_level", snapshot_label(as_of).alias("datetime"),
    )
