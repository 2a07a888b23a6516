"""Registered queries against their DuckDB oracle at sf0.001.

A fast subset runs by default; TABULON_FULL_ORACLE=1 runs every key that has
an oracle."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
FAST = ["sessionize", "consecutive_gap", "stats_by_group", "point_in_polygon", "scan_trips_csv",
        "cooccurrence", "chi_squared_edges", "connected_components", "triangle_count", "tfidf",
        "topk_per_group", "scan_ratings", "canonicalize_alias", "sample_negatives", "ranking_auc",
        "asof_fill", "rolling_return", "confusion_matrix", "cluster_assign", "one_hot"]
KEYS = sorted(E.oracle_sql()) if os.environ.get("TABULON_FULL_ORACLE") else FAST


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[key])
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    assert sorted(c.lower() for c in df.columns) == sorted(c.lower() for c in d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_of(df.columns, s_rows) == rows_of(d_cols, d_rows)


def test_every_key_is_callable():
    qs, ors = E.queries(), E.oracle_sql()
    assert set(ors) <= set(qs)
    assert len(qs) >= 130


def _run(code):
    import subprocess
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    r = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300)
    assert r.returncode == 0, r.stderr[-2000:]


def test_oracle_sql_needs_no_spark_session():
    _run("import __spark_entry__ as E; assert len(E.oracle_sql()) > 100; assert len(E.queries()) > 100")


def test_import_needs_no_spark_jars():
    """queries() and oracle_sql() build where Spark's jar folder can't be listed."""
    _run("import glob, zipfile\n"
         "glob.glob = lambda *a, **k: []\n"
         "def refuse(*a, **k): raise OSError('no jars')\n"
         "zipfile.ZipFile = refuse\n"
         "import __spark_entry__ as E; assert len(E.queries()) > 100; assert len(E.oracle_sql()) > 100")


def test_import_without_training_data_folders():
    """The optional subpackage and its pipeline may be absent."""
    _run("import sys\n"
         "sys.modules['corpus_pipeline'] = None\n"
         "import __spark_entry__ as E; assert len(E.queries()) > 100; assert 'pipeline' not in E.queries()")
