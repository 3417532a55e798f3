"""The contract queries that SQL can express give the same rows in DuckDB."""

import duckdb
import pytest

from shelfspark.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    cursor = con.execute(queries.ORACLES[name])
    names = [c[0] for c in cursor.description]
    df = queries.QUERIES[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(names)
    assert sorted(str(tuple(r[n] for n in names)) for r in df.collect()) == sorted(map(str, cursor.fetchall()))
