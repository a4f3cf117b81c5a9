"""Weights from a stored layout: same rows, and no exchange of pairs."""

import pytest
from pyspark.sql import functions as F

from gridplace.operators import scoring as SC
from gridplace.operators.scoring_layout import open_scoring_layout, rse_weight_from_layout, write_scoring_layout
from gridplace.operators.topology import endpoint_distances
from gridplace.plans import params as P
from gridplace.plans import registry as R
from gridplace.session import materialize, materialize_all
from gridplace.sources.testdata import TestTables
from conftest import SF_SMALL
from test_scoring import CASES, spark_inputs


@pytest.fixture(scope="module")
def inputs(spark):
    tt = TestTables(spark, SF_SMALL)
    return materialize_all(
        candidates=R._candidates(tt), distances=endpoint_distances(tt.distances, tt.rses),
        replicas=R._replicas(tt).select("scope", "name", "rse", "official", "TB", "available_TB"),
    )


@pytest.fixture(scope="module")
def layout(spark, inputs):
    return write_scoring_layout(inputs[2], buckets=6, pairs_per_bucket=7)


def same(a, b):
    assert a.columns == b.columns
    rows = lambda df: sorted(map(str, df.collect()))
    found = rows(a)
    assert found == rows(b) and found


@pytest.mark.parametrize("level", ["queue", "rse"])
def test_same_rows(inputs, layout, level):
    cand, dist, reps = inputs
    same(rse_weight_from_layout(layout, cand, dist, level), SC.rse_weight(cand, dist, reps, level))


def test_same_rows_with_thresholds_band_and_list(spark, inputs, layout):
    cand, dist, reps = inputs
    wanted = materialize(R._wanted(TestTables(spark, SF_SMALL)), "wanted")
    for level in ("queue", "rse"):
        options = {"level": level, "thresholds": P.SELECTED_THRESHOLDS, "band": P.SELECTED_BAND, "datasets": wanted}
        same(rse_weight_from_layout(layout, cand, dist, **options), SC.rse_weight(cand, dist, reps, **options))


def test_a_hot_source_is_split(spark, inputs, layout):
    by_source = spark.table(layout.pairs).groupBy("source_replica").agg(F.count(F.lit(1)).alias("n"), F.max("_salt").alias("top"))
    assert all(r.top <= -(-r.n // 7) - 1 for r in by_source.collect())
    assert by_source.filter("top > 0").count() > 0


def exchanged(plan: str, table: str) -> bool:
    """Whether an exchange stands above a scan of ``table``."""
    path: list[tuple[int, str]] = []
    for line in plan.splitlines():
        name = line.lstrip(" :+-*()0123456789")
        depth = len(line) - len(name)
        path = [(d, n) for d, n in path if d < depth] + [(depth, name)]
        if name.startswith("FileScan") and table in line and any(n.startswith("Exchange") for _, n in path):
            return True
    return False


def test_a_second_run_does_not_exchange_pairs(spark, inputs, layout):
    cand, dist, _ = inputs
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for level in ("queue", "rse"):
            plan = rse_weight_from_layout(layout, cand, dist, level)._jdf.queryExecution().executedPlan().toString()
            assert layout.pairs in plan and "SortMergeJoin" in plan
            assert not exchanged(plan, layout.pairs), plan
        spark.conf.set("spark.sql.sources.bucketing.enabled", "false")  # what the check would see without the layout
        plan = rse_weight_from_layout(layout, cand, dist, "rse")._jdf.queryExecution().executedPlan().toString()
        assert exchanged(plan, layout.pairs)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.sources.bucketing.enabled")


def test_a_layout_can_be_opened_again(spark, inputs, layout):
    cand, dist, reps = inputs
    again = open_scoring_layout(spark, layout.path, layout.buckets)
    same(rse_weight_from_layout(again, cand, dist, "rse"), SC.rse_weight(cand, dist, reps, "rse"))


@pytest.mark.parametrize("level", ["queue", "rse"])
@pytest.mark.parametrize("case", list(CASES))
def test_repeated_rules_and_unknown_keys(spark, case, level):
    cand, dist, reps = spark_inputs(spark, *CASES[case])
    own = write_scoring_layout(reps, buckets=2, pairs_per_bucket=2)
    same(rse_weight_from_layout(own, cand, dist, level), SC.rse_weight(cand, dist, reps, level))


def test_unknown_level(inputs, layout):
    with pytest.raises(ValueError):
        rse_weight_from_layout(layout, inputs[0], inputs[1], "site")
