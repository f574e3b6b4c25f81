"""Every registered query against its DuckDB oracle on sf0.001 (row count + order-insensitive values)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from meterlake.plans.catalog import QUERIES
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, digest

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle():
    assert set(KEYS) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["job_id", "name", "total_cost", "tables", "consumers", "cost_per_consumer"]
    assert df.count() > 0
