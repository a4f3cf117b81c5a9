"""Dataset popularity (survey 2.8: dataset_popularity).

Both distinct counts are exact (Catalyst's Expand rewrite: the first
aggregation is keyed by (dataset, value), so a dataset used by a third of
all tasks is spread over many tasks).  ``approx=True`` switches to
HyperLogLog sketches, which merge map-side and never shuffle the values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridplace.functions import trailing_window

# Dataset name patterns of the report.
DAOD_PATTERNS = ("mc%DAOD%", "data%DAOD%")


def finished_tasks(tasks: DataFrame, as_of, days: int | None, tasktype: str, partition_col: str | None = None) -> DataFrame:
    """Finished tasks of ``tasktype`` of the last ``days`` (``as_of=None``: of all time)."""
    cond = (F.col("tasktype") == tasktype) & F.col("endtime").isNotNull()
    if as_of is not None:
        cond = cond & trailing_window("modificationtime", as_of, days, partition_col)
    return tasks.filter(cond)


def primary_inputs(task_datasets: DataFrame, patterns: Sequence[str] = DAOD_PATTERNS) -> DataFrame:
    """jeditaskid, datasetname of the primary inputs whose name has a pattern."""
    like = None
    for p in patterns:
        c = F.col("datasetname").like(p)
        like = c if like is None else (like | c)
    return task_datasets.filter(
        like & (F.col("type") == "input") & F.col("masterid").isNull()
    ).select("jeditaskid", "datasetname")


def dataset_popularity(
    tasks: DataFrame,
    task_datasets: DataFrame,
    as_of,
    days: int = 7,
    min_tasks: int = 10,
    tasktype: str = "anal",
    patterns: Sequence[str] = DAOD_PATTERNS,
    approx: bool = False,
    partition_col: str | None = None,
) -> DataFrame:
    """datasetname, n_tasks, n_users: distinct tasks and users that read the
    dataset as primary input in the last ``days`` (finished tasks of
    ``tasktype``), keeping datasets with ``n_tasks >= min_tasks``."""
    t = finished_tasks(tasks, as_of, days, tasktype, partition_col).select("jeditaskid", "username")
    d = primary_inputs(task_datasets, patterns)
    j = d.join(t, "jeditaskid")
    if approx:
        aggs = [
            F.approx_count_distinct("jeditaskid").alias("n_tasks"),
            F.approx_count_distinct("username").alias("n_users"),
        ]
    else:
        aggs = [F.countDistinct("jeditaskid").alias("n_tasks"), F.countDistinct("username").alias("n_users")]
    return j.groupBy("datasetname").agg(*aggs).filter(F.col("n_tasks") >= min_tasks)
