"""Stored distinct-count sketches of dataset popularity (survey 2.4, A7).

Distinct counts do not add up: the tasks of a week are not the sum of its
days' tasks, so the exact report reads all tasks of its window each time.
HyperLogLog sketches do merge.  One pair of sketches per (dataset, day) is
stored, and the report of any run of whole days is the union of its days'
sketches, without reading a task again.

The estimate's relative standard error is ``standard_error(lg_k)``, 0.8 % at
the default of 2^14 registers, and up to about a thousand distinct values a
sketch still holds the values' hashes themselves and counts them.  A sketch
takes at most 2^lg_k bytes, so the table grows with datasets and days only.
``operators.popularity`` remains the exact path.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridplace.operators.daily_counts import as_datetime
from gridplace.operators.popularity import DAOD_PATTERNS, finished_tasks, primary_inputs

LG_K = 14


def standard_error(lg_k: int = LG_K) -> float:
    """Relative standard error of the estimate of merged sketches."""
    return 1.04 / math.sqrt(1 << lg_k)


def popularity_sketches(
    tasks: DataFrame,
    task_datasets: DataFrame,
    as_of=None,
    days: int | None = None,
    tasktype: str = "anal",
    patterns: Sequence[str] = DAOD_PATTERNS,
    lg_k: int = LG_K,
    partition_col: str | None = None,
) -> DataFrame:
    """day, datasetname, tasks, users (sketches) of the finished tasks that
    read the dataset as primary input on that day.

    ``as_of`` and ``days``: only the days before ``as_of``; by default all.
    The sketches are built by partial aggregation, so a dataset that a third
    of all tasks read sends one sketch per map task."""
    t = finished_tasks(tasks, as_of, days, tasktype, partition_col).select("jeditaskid", "username", F.col("modificationtime").cast("date").alias("day"))
    joined = primary_inputs(task_datasets, patterns).join(t, "jeditaskid")
    return joined.groupBy("day", "datasetname").agg(
        F.hll_sketch_agg("jeditaskid", lg_k).alias("tasks"), F.hll_sketch_agg("username", lg_k).alias("users")
    )


def popularity_from_sketches(sketches: DataFrame, as_of, days: int = 7, min_tasks: int = 10) -> DataFrame:
    """datasetname, n_tasks, n_users over the ``days`` whole days before
    ``as_of``, which must be the start of a day."""
    end = as_datetime(as_of)
    if (end.hour, end.minute, end.second, end.microsecond) != (0, 0, 0, 0):
        raise ValueError("sketches are stored by day: as_of must be the start of a day")
    first = end.date() - dt.timedelta(days=days)
    window = sketches.filter((F.col("day") >= F.lit(first)) & (F.col("day") < F.lit(end.date())))
    counts = window.groupBy("datasetname").agg(
        F.hll_sketch_estimate(F.hll_union_agg("tasks")).alias("n_tasks"), F.hll_sketch_estimate(F.hll_union_agg("users")).alias("n_users")
    )
    return counts.filter(F.col("n_tasks") >= min_tasks)
