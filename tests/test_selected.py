"""A dataset list restricts the records where they are read."""

import pytest
from pyspark.sql import functions as F

from gridplace.operators import replicas as R
from gridplace.plans import params as P
from gridplace.sources.testdata import TestTables
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def records(spark, tmp_path_factory):
    tt, folder = TestTables(spark, SF_SMALL), tmp_path_factory.mktemp("records")
    out = []
    for name, df in (("replicas", tt.replica_records), ("history", tt.rule_history), ("details", tt.rule_details), ("attrs", tt.attrs), ("rses", tt.rses)):
        df.write.parquet(str(folder / name))
        out.append(spark.read.parquet(str(folder / name)))
    return out


@pytest.fixture(scope="module")
def wanted(spark, records):
    return spark.createDataFrame([tuple(r) for r in records[0].select("scope", "name").distinct().orderBy("name").limit(5).collect()] + [("mc", "unknown")], "scope string, name string")


def below(plan: str, what: str) -> list[list[str]]:
    """The lines below each line of a plan that names ``what``."""
    lines = plan.splitlines()
    depth = lambda s: len(s) - len(s.lstrip(" :+-"))
    found = []
    for i, line in enumerate(lines):
        if what in line:
            part = []
            for other in lines[i + 1 :]:
                if depth(other) <= depth(line):
                    break
                part.append(other)
            found.append(part)
    return found


def test_the_list_meets_the_records_first(records, wanted):
    plan = R.dataset_replicas(*records, P.SNAPSHOT_AS_OF, datasets=wanted)._jdf.queryExecution().optimizedPlan().toString()
    semi = below(plan, "Join LeftSemi")
    assert len(semi) == 2  # replicas and rule history
    for part in semi:
        assert not any("Join" in line or "Aggregate [rse_id" in line for line in part), plan
        assert sum("Relation" in line for line in part) == 1


def test_the_list_changes_nothing_else(records, wanted):
    listed = R.dataset_replicas(*records, P.SNAPSHOT_AS_OF, datasets=wanted)
    every = R.dataset_replicas(*records, P.SNAPSHOT_AS_OF).join(wanted, ["scope", "name"], "left_semi").select(*listed.columns)
    assert sorted(map(str, listed.collect())) == sorted(map(str, every.collect()))
    assert listed.select(F.countDistinct("name")).first()[0] == 5


def test_rules_on_a_container_follow_the_dataset_asked_for(records, wanted):
    replicas, history, details, attrs, rses = records
    asked = history.withColumn("requested_scope", F.col("scope")).withColumn("requested_name", F.col("name")).withColumn("name", F.concat(F.lit("container."), F.col("name")))
    a = R.dataset_replicas(replicas, asked, details, attrs, rses, P.SNAPSHOT_AS_OF, datasets=wanted)
    b = R.dataset_replicas(replicas, history, details, attrs, rses, P.SNAPSHOT_AS_OF, datasets=wanted)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
