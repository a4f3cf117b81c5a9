"""Small helpers shared by the text operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridplace.session import materialize

__all__ = ["materialize", "table", "text_or_empty", "row_key", "text_slices", "map_arrow", "fresh", "keep_rows"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit(""))


def row_key(text_col: str) -> Column:
    """Second half of a row's identity: documents that share an id (or have
    none) but not their text stay apart; rows equal in both are one document
    seen several times and get the same result."""
    return F.xxhash64(text_or_empty(text_col))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use yet."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str, key: Column) -> DataFrame:
    """The rows of ``docs`` whose id and key are in ``kept`` (id, key), one of
    each, all columns unchanged.

    The NULL-safe id is spelled out as columns, so that the join and the
    removal of repeated rows agree on one partitioning and texts are shuffled
    once.
    """
    names = [fresh(docs, n) for n in ("_id", "_no_id", "_key")]
    parts = lambda i, k: (F.coalesce(i.cast("string"), F.lit("")), i.isNull(), k)
    left = docs.withColumns(dict(zip(names, parts(F.col(id_col), key))))
    theirs = [fresh(left, f"_kept{n}") for n in names]
    right = kept.select(*[c.alias(n) for n, c in zip(theirs, parts(F.col("id"), F.col("key")))])
    same = [F.col(n) == F.col(t) for n, t in zip(names, theirs)]
    return left.join(right, same, "left_semi").dropDuplicates(names).drop(*names)


def text_slices(column: pa.Array, max_bytes: int) -> Iterator[tuple[int, list[str]]]:
    """First row and texts (NULL: empty) of slices of a text column of at most
    ``max_bytes`` each; a longer text is a slice of its own.  Only one slice
    at a time becomes Python strings, so a batch of long texts stays small."""
    total = np.concatenate(([0], np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)))
    start = 0
    while start < len(column):
        end = max(start + 1, int(np.searchsorted(total, total[start] + max_bytes, "right")) - 1)
        yield start, [t or "" for t in column.slice(start, end - start).to_pylist()]
        start = end


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` whose Python workers can import this package: its folder
    joins their path where they see the same files (local mode, shared
    folders); elsewhere the package is shipped with the job as usual."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = df.sparkSession.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return df.mapInArrow(run, schema)
