"""Queries that SQL can express, against DuckDB on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

from oracle_check import digest  # noqa: E402
from tessera.llm.queries import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE[name])
    cols, want = [d[0] for d in cur.description], cur.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(cols) and len(got) == len(want)
    assert digest(df.columns, got)[0] == digest(cols, want)[0]


def test_all_operators_and_pipeline_are_registered():
    import __spark_entry__ as se
    names = se.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {q.split("_")[0] for q in names} and "pipeline" in names
