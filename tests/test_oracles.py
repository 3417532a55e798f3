"""Every registered query with a SQL twin gives the same rows in DuckDB."""

import decimal
import math

import duckdb
import numpy as np
import pytest

from shelfspark import registry
from shelfspark.plans import catalog  # noqa: F401

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return con


def plain(x):
    if isinstance(x, float | np.floating):
        return None if math.isnan(x) else round(float(x), 6)
    if isinstance(x, bool | np.bool_):
        return bool(x)
    if isinstance(x, decimal.Decimal):
        return float(x)
    return int(x) if isinstance(x, np.integer) else x


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql_twin(spark, duck, name):
    df = registry.QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(registry.ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    columns = sorted(names)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    theirs = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=str)
    assert ours == theirs


def test_estimates_are_near(spark):
    exact = {r.l_returnflag: r.n for r in spark.read.parquet(f"{SF_DIR}/lineitem.parquet").selectExpr("l_returnflag", "l_partkey").groupBy("l_returnflag").agg({"l_partkey": "count"}).selectExpr("l_returnflag", "`count(l_partkey)` n").collect()}
    for r in registry.QUERIES["approx_distinct"](spark, SF_DIR).collect():
        assert 0 < r.est <= exact[r.l_returnflag] * 1.1 and abs(r.hll - r.est) <= 0.2 * r.est
