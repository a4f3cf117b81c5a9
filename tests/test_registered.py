"""Every registered report against its DuckDB oracle on the sf0.001 tables,
and the driver's entry point."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from gridplace.plans import registry  # noqa: E402
from check_oracles import TABLES, rows  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


KEYS = sorted(registry.queries())


def test_every_report_has_an_oracle():
    assert set(KEYS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF_SMALL)
    sc, sr = rows(df.columns, df.collect())
    cur = duck.execute(entry.oracle_sql()[key])
    dc, dr = rows([d[0] for d in cur.description], cur.fetchall())
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert "rse_weight" in df.columns
    assert df.count() > 0
