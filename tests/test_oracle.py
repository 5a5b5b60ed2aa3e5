"""Every query with SQL against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__

QUERIES, SQL = __spark_entry__.queries(), __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def db(small):
    con = duckdb.connect()
    for p in glob.glob(f"{small}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def canon(rows, names):
    def cell(x):
        return "~" if x is None or x != x else f"{float(x):.6f}" if isinstance(x, (int, float)) else str(x)

    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small, db, name):
    df = QUERIES[name](spark, small)
    want = db.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(want.fetchall(), names)


def test_entry(spark):
    assert __spark_entry__.entry(spark).limit(1).count() == 1


def test_no_cartesian_products(spark, small):
    for name in ("candidates_topk", "channel_retrieval", "consensus_support", "threshold_scan", "number_features"):
        plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan, name
