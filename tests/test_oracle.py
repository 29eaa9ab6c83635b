"""Every catalogue query against its DuckDB oracle on the smallest test tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as se  # noqa: E402
from oracle_check import digest  # noqa: E402
from tessera.plans.catalog import ORACLE, QUERIES, load_all  # noqa: E402
from tessera.testviews import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
load_all()  # the optional training-data queries are tested in tests/llm


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["week", "avg_amount", "avg_distance", "fare_amount", "trip_distance", "zip"]
    assert df.count() >= 0
