"""Registered queries against their DuckDB statements, and the contract of
every registered name."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import rows_of  # noqa: E402
from tabulon.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_matches_oracle(spark, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[key](spark, SF)
    cur = con.execute(queries.ORACLE[key])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, cur.fetchall())


def test_all_and_the_pipeline_are_registered():
    names = E.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(queries.ORACLE) <= set(E.oracle_sql())
