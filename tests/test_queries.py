"""Every registered query with SQL against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def rows(frame):
    def cell(x):
        if x is None or x != x:
            return "NULL"
        return f"{x:.6f}" if isinstance(x, float) and not math.isinf(x) else str(x)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(cell, r)) for r in frame.astype(object).itertuples(index=False))


def as_float_where_needed(a, b):
    for c in a.columns.intersection(b.columns):
        if a[c].dtype.kind in "iuf" and b[c].dtype.kind in "iuf" and a[c].dtype.kind != b[c].dtype.kind:
            a[c], b[c] = a[c].astype(float), b[c].astype(float)
    return a, b


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    ours = entry.queries()[name](spark, FOLDER).toPandas()
    theirs = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    ours, theirs = as_float_where_needed(ours, theirs)
    assert rows(ours) == rows(theirs)


@pytest.mark.parametrize("name", ["importance_tree", "model_logreg", "model_roundtrip_score", "run_manifest"])
def test_model_queries_give_rows(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
