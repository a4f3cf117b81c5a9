"""What the scoring leaves on disk while it runs."""

import os

import pytest
from pyspark.sql import functions as F

from gridplace import session
from gridplace.operators import replicas as R
from gridplace.operators import scoring as SC
from gridplace.plans import params as P
from gridplace.plans import registry
from gridplace.sources.testdata import TestTables
from conftest import SF_SMALL

needs_tables = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def settled(spark, before: set[str]) -> set[str]:
    """New shuffle files, once Spark has had time to delete them."""
    import time

    for _ in range(100):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def dealt(spark, n: int):
    return spark.range(n).repartition(3).groupBy((F.col("id") % 7).alias("k")).count()


def test_the_shuffles_of_a_written_table_end_with_it(spark):
    setting = spark.conf.get(session.SHUFFLES_END, None)
    before = shuffle_files(spark)
    one = session.materialize(dealt(spark, 1000), "one")
    two, three = session.materialize_all(two=dealt(spark, 700), three=dealt(spark, 70))
    assert not settled(spark, before)
    assert [t.agg(F.sum("count")).first()[0] for t in (one, two, three)] == [1000, 700, 70]
    assert spark.conf.get(session.SHUFFLES_END, None) == setting
    with pytest.raises(Exception, match="no table"):
        session.materialize(spark.range(3).select(F.raise_error(F.lit("no table")).alias("x").cast("int")), "failed")
    assert spark.conf.get(session.SHUFFLES_END, None) == setting


def test_tables_of_a_passing_folder_are_deleted(spark):
    with session.passing_folder(spark) as folder:
        t = session.materialize(spark.range(5), "five", folder)
        assert t.count() == 5 and os.path.isdir(f"{folder}/five".removeprefix("file:"))
    assert not os.path.exists(folder.removeprefix("file:"))


@needs_tables
@pytest.mark.parametrize("query", ["rse_weight", "rse_weight_selected"])
def test_the_inputs_of_the_scoring_are_gone_when_it_expands(spark, query):
    before = set(os.listdir(session.tables_folder(spark).removeprefix("file:"))) if os.path.isdir(session.tables_folder(spark).removeprefix("file:")) else set()
    got = registry.QUERIES[query](spark, SF_SMALL)
    made = set(os.listdir(session.tables_folder(spark).removeprefix("file:"))) - before
    assert sorted(m.rsplit("-", 1)[0] for m in made) == ["candidate_rows", "pairs", "source_load"]
    assert got.count() > 0


@needs_tables
@pytest.mark.parametrize("listed", [False, True])
@pytest.mark.parametrize("requested", [False, True])
def test_scoring_replicas_are_the_dataset_replicas(spark, listed, requested):
    tt = TestTables(spark, SF_SMALL)
    history = tt.rule_history
    if requested:
        history = history.withColumn("requested_scope", F.col("scope")).withColumn("requested_name", F.col("name")).withColumn("name", F.lit("container"))
    datasets = tt.replica_records.select("scope", "name").distinct().orderBy("name").limit(9) if listed else None
    twice = history.unionByName(history.limit(5))  # a rule that comes twice
    args = (tt.replica_records, twice, tt.rule_details, tt.attrs, tt.rses)
    want = R.dataset_replicas(*args, P.SNAPSHOT_AS_OF, datasets=datasets).select("scope", "name", "rse", "official", "TB", "available_TB")
    got = R.scoring_replicas(*args, datasets, lambda rules: session.materialize(rules, "rules_kept"))
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 0


def test_flags_come_from_the_history_where_it_has_the_expiry(spark):
    history = spark.createDataFrame([("r1", None), ("r2", "x")], "rule_id string, expires_at string")
    details = spark.createDataFrame([("r1", "y", 1), ("r2", None, 2)], "id string, expires_at string, copies int")
    got = {r.rule_id: (r.expires_at, r.official, r.copies, r.has_rule) for r in R.rules_with_details(history, details).collect()}
    assert got == {"r1": (None, True, 1, True), "r2": ("x", False, 2, True)}


def test_no_date_is_shuffled_for_a_flag(spark):
    history = spark.range(9).select(F.col("id").cast("string").alias("rule_id"), F.lit("n").alias("name"))
    details = spark.range(9).select(F.col("id").cast("string").alias("id"), F.current_timestamp().cast("timestamp").alias("at"), F.lit("a").alias("activity"))
    details = details.select("id", F.when(F.col("id") > "3", F.col("at")).alias("expires_at"), "activity")
    plan = R.rules_with_details(history.hint("merge"), details).select("name", "official")._jdf.queryExecution().executedPlan().toString()
    dealt_rows = [line for line in plan.splitlines() if "Exchange" in line]
    assert dealt_rows and "expires_at" not in "".join(line for line in plan.splitlines() if "Sort [" in line)
    shown = R.rules_with_details(history, details).select("name", "official")._jdf.queryExecution().optimizedPlan().toString()
    join = shown.split("Join Inner", 1)[1]
    assert "AS official" in join


def test_replicas_are_not_collected_before_they_are_dealt(spark):
    rep = spark.createDataFrame([("x", "R1", True, 1.0, 1.0)], "dataset string, rse string, official boolean, TB double, available_TB double")
    plan = SC.pair_rows(rep)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" in plan and "Aggregate" not in plan.split("Exchange hashpartitioning", 1)[1]
