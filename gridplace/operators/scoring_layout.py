"""Endpoint weights from a stored layout of the pairs (survey 2.8, J16/A10).

``scoring.rse_weight`` deals all (dataset, official source) pairs by source
each time it runs.  The pairs and their dynamic copies do not depend on the
level, the thresholds, the distance band or the list of datasets, so here
they are laid out once: one row per pair with all it needs of its dataset,
bucketed by (source, salt).  A run then brings the candidate rows to the
buckets; the pairs are read where they lie, without an exchange, and the same
layout serves both levels and every list.

The salt splits a source with more than ``pairs_per_bucket`` pairs, so a
source of a third of all pairs is spread over buckets; a run repeats that
source's candidate rows once per salt.

The scoring itself is ``scoring.score_pairs``, the same as without a layout.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridplace.operators.replicas import of_datasets
from gridplace.operators.scoring import apply_thresholds, candidate_rows, pair_rows, score_pairs, source_statistics, with_salts
from gridplace.session import materialize, new_folder

PAIRS_PER_BUCKET = 500_000


@dataclass(frozen=True)
class ScoringLayout:
    """The catalogue names of a layout's two tables, and its buckets."""

    pairs: str
    salts: str
    path: str
    buckets: int


def write_scoring_layout(
    replicas: DataFrame, path: str | None = None, buckets: int | None = None, pairs_per_bucket: int = PAIRS_PER_BUCKET
) -> ScoringLayout:
    """Lay the pairs of ``dataset_replicas`` (scope, name, rse, official, TB,
    available_TB) out under ``path`` (by default in the session's folder)."""
    spark = replicas.sparkSession
    rep = replicas.select("scope", "name", F.concat_ws(":", "scope", "name").alias("dataset"), "rse", "official", "TB", "available_TB")
    full = materialize(pair_rows(rep), "pairs")
    load = full.groupBy("source_replica").agg(F.count(F.lit(1)).alias("n"))
    salts = materialize(load.select("source_replica", F.ceil(F.col("n") / pairs_per_bucket).cast("int").alias("salts")), "source_salts")
    if buckets is None:
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-full.count() // pairs_per_bucket))
    path = path or new_folder(spark, "scoring_layout")
    names = _names()
    (
        with_salts(full, salts).repartition(buckets, "source_replica", "_salt")  # a task writes its bucket, as one file
        .write.bucketBy(buckets, "source_replica", "_salt").option("path", f"{path}/pairs").format("parquet").saveAsTable(names[0])
    )
    salts.write.option("path", f"{path}/salts").format("parquet").saveAsTable(names[1])
    return ScoringLayout(*names, path, buckets)


def _names() -> tuple[str, str]:
    tag = uuid.uuid4().hex
    return f"scoring_pairs_{tag}", f"scoring_salts_{tag}"


def open_scoring_layout(spark: SparkSession, path: str, buckets: int) -> ScoringLayout:
    """A layout that another session wrote, with its number of buckets."""
    names = _names()
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{path}/pairs").schema)
    spark.sql(f"CREATE TABLE {names[0]} ({schema}) USING parquet CLUSTERED BY (source_replica, _salt) INTO {buckets} BUCKETS LOCATION '{path}/pairs'")
    spark.catalog.createTable(names[1], path=f"{path}/salts", source="parquet")
    return ScoringLayout(*names, path, buckets)


def rse_weight_from_layout(
    layout: ScoringLayout,
    candidates: DataFrame,
    distances: DataFrame,
    level: str = "queue",
    thresholds: dict | None = None,
    band: tuple[float, float] | None = None,
    datasets: DataFrame | None = None,
) -> DataFrame:
    """``scoring.rse_weight`` with the pairs of a layout; same rows.

    The candidate rows of a run are written once.  Per source they are summed
    and sent to the source's buckets; the pairs are not exchanged."""
    if level not in ("queue", "rse"):
        raise ValueError(f"unknown level {level!r}")
    spark = candidates.sparkSession
    salts, pairs = spark.table(layout.salts), spark.table(layout.pairs)
    if datasets is not None:
        pairs = of_datasets(pairs, datasets)
        salts = salts.join(pairs.select("source_replica").distinct(), "source_replica", "left_semi")
    cand = apply_thresholds(candidates, thresholds)
    sources = salts.select(F.col("source_replica").alias("rse"), F.lit(True).alias("official"))
    cd = materialize(candidate_rows(cand, distances, sources, level, band), "candidate_rows")
    return score_pairs(pairs, salts, cd, source_statistics(cd), level)
