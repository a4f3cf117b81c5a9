"""Registered queries against their oracles, and the pipeline's stages
against what their operators decide."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from gridplace.llm.common import materialize, table
from gridplace.llm.decontaminate import decontaminate
from gridplace.llm.queries import ORACLES, QUERIES
from gridplace.llm.quality import quality

from .rows import by_id
from .test_dedup import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_all_are_registered():
    names = set(entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert by_id(df.select(*columns).collect()) == by_id(cur.fetchall())


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "stage")
        kept.append({r.doc_id: r.asDict() for r in docs.collect()})
    source = {r.doc_id: r.asDict() for r in table(spark, SF, "documents").collect()}
    good, exact, near, clean, coded = kept
    assert set(good) == {r.doc_id for r in quality(table(spark, SF, "documents"), table(spark, SF, "labels")).collect() if r.predicted}
    last = {}
    for i, r in good.items():
        last[r["text"]] = max(i, last.get(r["text"], i))
    assert set(exact) == set(last.values())
    fps = {i: plain_fingerprint(r["text"]) for i, r in exact.items()}
    label = plain_components(list(fps.values()), 3)
    first = {}
    for i, f in fps.items():
        first[label[f]] = min(i, first.get(label[f], i))
    assert set(near) == set(first.values())
    left = spark.createDataFrame(list(near.values()), table(spark, SF, "documents").schema)
    assert set(clean) == {r.doc_id for r in decontaminate(left, table(spark, SF, "benchmark")).collect() if not r.contaminated}
    assert set(coded) == set(clean) and len(clean) < len(source)
    for stage in (good, exact, near, clean):
        assert all(source[i] == r for i, r in stage.items())
    assert by_id((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect()) == by_id((i, r["ids_sha256"]) for i, r in coded.items())


def test_pipeline_without_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "stage")
    assert docs.collect() == []
