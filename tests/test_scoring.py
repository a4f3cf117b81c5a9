"""rse_weight against its definition in exact fractions (on a small fixture),
and against a golden suggestion file (level 'rse' with thresholds)."""

import os
from fractions import Fraction

import pandas as pd
import pytest
from pyspark.sql import types as T

from gridplace.operators import candidates as CA
from gridplace.operators import scoring as SC
from gridplace.sources.readers import read_snapshot

from conftest import FIXTURES

METRICS = list(SC.WEIGHT_METRICS)


def value(x) -> Fraction | None:
    return None if x is None or x != x else Fraction(str(x))


def thousandths(x: Fraction) -> Fraction:
    return Fraction(round(x * 1000), 1000)  # Fraction rounds half to even


def scored(rows: list[dict]) -> list[dict]:
    """The definition on one (dataset, source): every metric is centred on the
    mean of its known values, divided by their range and rounded; unknown
    values and metrics without a range give 0; the weight is the sum."""
    for row in rows:
        row["weight"] = Fraction(0)
    for metric in METRICS:
        known = [v for v in (row[metric] for row in rows) if v is not None]
        if known and max(known) > min(known):
            mean, span = sum(known) / len(known), max(known) - min(known)
            for row in rows:
                if row[metric] is not None:
                    row["weight"] += thousandths((row[metric] - mean) / span)
    return rows


def by_definition(cand: pd.DataFrame, dist: pd.DataFrame, reps: pd.DataFrame, level: str) -> dict[tuple, list[float]]:
    """(dataset, source, rse, queue or site) -> sorted weights."""
    far = int(dist["agis_distance"].max())
    out: dict[tuple, list[float]] = {}
    records = reps.to_dict("records")
    for name in {r["name"] for r in records}:
        copies = [(r["rse"], value(r["available_TB"]) or Fraction(0)) for r in records if r["name"] == name and not r["official"]]
        for source in {r["rse"] for r in records if r["name"] == name and r["official"]}:
            away = {d["dest"]: d["agis_distance"] for d in dist.to_dict("records") if d["source"] == source}
            rows, seen = [], set()
            for c in cand.to_dict("records"):
                if c["rse"] not in away:
                    continue
                seen.add(c["rse"])
                base = {m: value(c[m]) for m in METRICS if m in c} | {"closeness": Fraction(far - away[c["rse"]])}
                keys = {k: (None if c[k] != c[k] else c[k]) for k in ("queue", *SC.ROLLUP_KEYS)}
                for size in [v for e, v in copies if e == c["rse"]] or [Fraction(0)]:
                    rows.append(keys | base | {"available_TB": size})
            rows += [dict.fromkeys([*METRICS, "queue", *SC.ROLLUP_KEYS]) | {"rse": e, "available_TB": v} for e, v in copies if e not in seen]
            if level == "rse":
                groups: dict[tuple, dict] = {}
                for row in rows:
                    k = tuple(row[x] for x in SC.ROLLUP_KEYS)
                    if None in k:
                        continue
                    g = groups.setdefault(k, dict(row))
                    for m in METRICS:
                        g[m] = max((v for v in (g[m], row[m]) if v is not None), default=None)
                rows = list(groups.values())
            for row in scored(rows):
                k = ("mc:" + name, source, row["rse"], row["queue"] if level == "queue" else row["site"])
                out.setdefault(k, []).append(float(row["weight"]))
    return {k: sorted(v) for k, v in out.items()}


CAND = pd.DataFrame([
    # queue, rse, site, cloud, tier, datetime, eff, occ, Difference, Unlocked, transferring_availability
    ("q1", "R1", "S1", "C1", 1, "d", 0.9, 2.0, 20.0, 100.0, 10),
    ("q2", "R1", "S1", "C1", 1, "d", 0.8, 3.5, 20.0, 100.0, 30),
    ("q3", "R2", "S2", "C1", 2, "d", 0.95, 1.0, 5.0, None, 5),
    ("q4", "R3", "S3", "C2", 2, "d", 0.5, 7.0, 50.0, 40.0, 1),
    ("q5", "R4", "S4", "C2", 1, "d", 0.7, 7.0, 50.0, 40.0, 1),
], columns=["queue", "rse", "site", "cloud", "tier_level", "datetime", "queue_efficiency", "queue_occupancy",
            "Difference", "Unlocked", "transferring_availability"])
DIST = pd.DataFrame([(s, d, abs(i - j) + (1 if s != d else 0)) for i, s in enumerate(["R0", "R1", "R2", "R3", "R4", "R5"])
                     for j, d in enumerate(["R0", "R1", "R2", "R3", "R4", "R5"]) if not (s == "R5" and d == "R2")],
                    columns=["source", "dest", "agis_distance"])
REPS = pd.DataFrame([
    ("mc", "a", "R0", True, 1.5, 1.5), ("mc", "a", "R1", False, 1.5, 0.7), ("mc", "a", "R5", False, 1.5, None),
    ("mc", "b", "R2", True, 2.0, 2.0), ("mc", "b", "R5", True, 2.5, 2.5), ("mc", "b", "R3", False, 2.0, 1.1),
    ("mc", "c", "R4", True, 0.3, 0.3),
], columns=["scope", "name", "rse", "official", "TB", "available_TB"])


def more_rules(reps: pd.DataFrame, *rows) -> pd.DataFrame:
    """Replica rows repeat once per rule on the endpoint."""
    return pd.concat([reps, pd.DataFrame([("mc", *r) for r in rows], columns=reps.columns)], ignore_index=True)


CASES = {
    "single rules": (CAND, REPS),
    "two expiring rules on an endpoint": (CAND, more_rules(REPS, ("a", "R1", False, 1.5, 0.7), ("b", "R3", False, 2.0, 1.1), ("b", "R3", False, 2.0, 1.1))),
    "two permanent rules on an endpoint": (CAND, more_rules(REPS, ("a", "R0", True, 1.5, 1.5), ("b", "R5", True, 2.5, 2.5))),
    "permanent and expiring rules on an endpoint": (CAND, more_rules(REPS, ("b", "R2", False, 2.0, 2.0), ("c", "R4", False, 0.3, 0.2), ("c", "R4", False, 0.3, 0.2))),
    "a copy without a candidate, repeated": (CAND, more_rules(REPS, ("a", "R5", False, 1.5, 0.4))),
    "unknown cloud": (CAND.assign(cloud=["C1", None, "C1", None, "C2"]), REPS),
}


def spark_inputs(spark, cand=CAND, reps=REPS):
    cand = spark.createDataFrame(cand.astype(object).where(cand.notna(), None),
                                 "queue string, rse string, site string, cloud string, tier_level int, datetime string, "
                                 "queue_efficiency double, queue_occupancy double, Difference double, Unlocked double, "
                                 "transferring_availability long")
    dist = spark.createDataFrame(DIST, "source string, dest string, agis_distance int")
    reps = spark.createDataFrame(reps.astype(object).where(reps.notna(), None),
                                 "scope string, name string, rse string, official boolean, TB double, available_TB double")
    return cand, dist, reps


def weights(df, level) -> dict[tuple, list[float]]:
    out: dict[tuple, list[float]] = {}
    for r in df.collect():
        out.setdefault((r.dataset, r.source_replica, r.rse, r.queue if level == "queue" else r.site), []).append(r.rse_weight)
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("level", ["queue", "rse"])
@pytest.mark.parametrize("case", list(CASES))
def test_weights_follow_the_definition(spark, case, level):
    cand, reps = CASES[case]
    expected = by_definition(cand, DIST, reps, level)
    got = weights(SC.rse_weight(*spark_inputs(spark, cand, reps), level=level), level)
    assert got.keys() == expected.keys()
    for k in expected:
        assert got[k] == pytest.approx(expected[k], abs=1e-9), k


@pytest.mark.parametrize("level", ["queue", "rse"])
def test_salting_changes_nothing(spark, level):
    inputs = spark_inputs(spark)
    whole = sorted(map(str, SC.rse_weight(*inputs, level=level).collect()))
    assert whole == sorted(map(str, SC.rse_weight(*inputs, level=level, rows_per_task=2).collect()))


def test_no_hint_and_no_output_sized_join(spark):
    """Candidate rows meet the pairs once; nothing is joined after that."""
    plan = SC.rse_weight(*spark_inputs(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "hint" not in plan.lower()
    after = plan.split("Generate explode", 1)[0]
    assert "Join" not in after


def test_scoring_together_equals_scoring_alone(spark):
    cand, dist, reps = spark_inputs(spark)
    together = {(r.dataset, r.source_replica, r.rse, r.queue): r.rse_weight
                for r in SC.rse_weight(cand, dist, reps).collect()}
    for name in ["a", "b", "c"]:
        alone = SC.rse_weight(cand, dist, reps.filter(reps.name == name)).collect()
        for r in alone:
            assert together[(r.dataset, r.source_replica, r.rse, r.queue)] == r.rse_weight


def test_mean_range_normalise(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", 2.0), ("g", 3.0), ("h", 5.0), ("h", 5.0), ("h", None)], "k string, x double")
    rows = sorted((r.k, r.x) for r in SC.mean_range_normalise(df, ["k"], ["x"]).collect())
    assert rows == [("g", -0.5), ("g", 0.0), ("g", 0.5), ("h", 0.0), ("h", 0.0), ("h", 0.0)]
    glob = sorted(r.x for r in SC.mean_range_normalise(df.filter(df.k == "g"), [], ["x"]).collect())
    assert glob == [-0.5, 0.0, 0.5]


# --- golden: the committed suggestion file ------------------------------------

FILTERED = T.StructType([T.StructField(n, t) for n, t in [
    ("queue", T.StringType()), ("site", T.StringType()), ("rse", T.StringType()), ("cloud", T.StringType()),
    ("tier_level", T.IntegerType()), ("corepower", T.DoubleType()), ("corecount", T.DoubleType()),
    ("nodes", T.IntegerType()), ("transferringlimit", T.IntegerType()), ("datetime", T.StringType())]])
METRICS_SNAP = T.StructType([T.StructField(n, t) for n, t in [
    ("datetime", T.StringType()), ("queue", T.StringType()), ("running", T.LongType()), ("queued", T.LongType()),
    ("transferring", T.LongType()), ("queue_occupancy", T.DoubleType()), ("finished", T.DoubleType()),
    ("failed", T.DoubleType()), ("queue_efficiency", T.DoubleType())]])
STORAGE_SNAP = T.StructType(
    [T.StructField("rse", T.StringType())]
    + [T.StructField(n, T.StringType() if n == "Storage Timestamp" else T.DoubleType()) for n in [
        "Avg tombstone", "Difference", "Free(storage)", "Min space", "Persistent", "Primary diff", "Quota(other)",
        "Storage Timestamp", "Temporary", "Total(storage)", "Unlocked", "Used(dark)", "Used(other)", "Used(rucio)"]]
    + [T.StructField("datetime", T.StringType())])
SOURCE = "TOKYO-LCG2_DATADISK"


def test_golden_suggestion(spark):
    queues = read_snapshot(spark, os.path.join(FIXTURES, "filtered.csv"), FILTERED)
    metrics = read_snapshot(spark, os.path.join(FIXTURES, "queues_metrics.csv"), METRICS_SNAP)
    storage = read_snapshot(spark, os.path.join(FIXTURES, "storage_info.csv"), STORAGE_SNAP)
    cand = CA.merged_candidates(queues, metrics, storage)
    assert cand.count() == 109
    golden = pd.read_csv(os.path.join(FIXTURES, "suggestion_golden.csv"), index_col=0)
    # distances rebuilt from the golden columns, plus one pair at the maximum 11
    pairs = {(SOURCE, r, int(d)) for r, d in zip(golden["rse"], golden["distance_from_source"])}
    pairs.add((SOURCE, "NOWHERE_DATADISK", 11))
    dist = spark.createDataFrame(sorted(pairs), "source string, dest string, agis_distance int")
    reps = spark.createDataFrame([
        ("mc16_13TeV", "ds", SOURCE, True, 1.29, 1.29),
        ("mc16_13TeV", "ds", "RAL-LCG2-ECHO_DATADISK", False, 0.83, 0.83),
        ("mc16_13TeV", "ds", "RO-07-NIPNE_DATADISK", False, 1.29, 1.29),
    ], "scope string, name string, rse string, official boolean, TB double, available_TB double")
    got = SC.rse_weight(cand, dist, reps, level="rse", thresholds=SC.DEFAULT_THRESHOLDS).toPandas()
    assert len(got) == len(golden) == 22
    g = {(r.rse, r.site): r for r in got.itertuples()}
    for r in golden.itertuples():
        mine = g[(r.rse, r.site)]
        assert mine.rse_weight == pytest.approx(r.rse_weight, abs=1e-9), (r.rse, r.site)
        for c in ["queue_efficiency", "queue_occupancy", "Difference", "Unlocked", "closeness",
                  "transferring_availability", "available_TB", "dataset_size_TB"]:
            assert getattr(mine, c) == pytest.approx(getattr(r, c)), (r.rse, c)


def test_golden_efficiency_and_zero_occupancy(spark):
    """The efficiency formula reproduces every row of the committed queue
    metrics snapshot (counts not NVL'd: no failures -> 0)."""
    from pyspark.sql import functions as F

    from gridplace.operators.queues import efficiency_expr

    m = read_snapshot(spark, os.path.join(FIXTURES, "queues_metrics.csv"), METRICS_SNAP)
    got = m.select("queue", "queue_efficiency", efficiency_expr("finished", "failed").alias("mine")).collect()
    assert len(got) == 112
    assert all(r.mine == pytest.approx(r.queue_efficiency, abs=1e-12) for r in got)
    # queues with nothing queued and occupancy 0 can only come from activated = 0 (NULL-propagating GREATEST)
    zero = m.filter((F.col("queued") == 0) & (F.col("queue_occupancy") == 0)).count()
    assert zero == 3
