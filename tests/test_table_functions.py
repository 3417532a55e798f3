"""The table function and the aggregate, from SQL, with empty partitions and wrong arguments."""

import hashlib

import pytest

from shelfspark.functions import table_functions

SCHEMA = "k string, o int, size int, before string"


@pytest.fixture
def rows(spark):
    table_functions.register(spark)
    df = spark.createDataFrame([("a", 2, 5, "x"), ("a", 1, 7, "y"), ("a", 3, 1, "z"), ("b", 1, 100, None), ("b", 2, 1, None), ("c", 1, None, None), ("c", 2, 3, None), (None, 1, 4, None)], SCHEMA)
    df.createOrReplaceTempView("sized")
    df.limit(0).createOrReplaceTempView("none")
    return df


def test_rows_until_the_budget(spark, rows):
    got = spark.sql("SELECT k, o, size, before FROM take_within(TABLE(sized) PARTITION BY (k) ORDER BY (o), 'size', 10) ORDER BY k, o").collect()
    assert [tuple(r) for r in got] == [(None, 1, 4, 0), ("a", 1, 7, 0), ("a", 2, 5, 7), ("b", 1, 100, 0), ("c", 1, None, 0), ("c", 2, 3, 0)]
    assert spark.sql("SELECT * FROM take_within(TABLE(sized) PARTITION BY (k) ORDER BY (o), 'size', -1)").collect() == []


def test_no_rows_give_none(spark, rows):
    got = spark.sql("SELECT * FROM take_within(TABLE(none) PARTITION BY (k) ORDER BY (o), 'size', 10)")
    assert got.collect() == [] and got.columns == ["k", "o", "size", "before"] and dict(got.dtypes)["before"] == "bigint"
    assert spark.sql("SELECT k, set_hash(before) FROM none GROUP BY k").collect() == []


def test_wrong_arguments_are_told_before_anything_runs(spark, rows):
    for call in ("take_within(TABLE(sized) PARTITION BY (k), 'nothing', 10)", "take_within(TABLE(sized) PARTITION BY (k), 'k', 10)", "take_within('t', 'size', 10)"):
        with pytest.raises(Exception, match="first argument is|second argument names|whole numbers"):
            spark.sql(f"SELECT * FROM {call}")


def test_hash_of_a_set(spark, rows):
    got = {r.k: r.h for r in spark.sql("SELECT k, set_hash(before) AS h FROM (SELECT * FROM sized UNION ALL SELECT * FROM sized) GROUP BY k").collect()}
    assert got["a"] == hashlib.sha256(b"1\0x1\0y1\0z").hexdigest() and got["b"] == got[None] == hashlib.sha256(b"").hexdigest()


def test_many_keys_share_a_partition_over_arrow_batches(spark, rows):
    sized = spark.table("sized").unionByName(spark.createDataFrame([(k, o, s, None) for k in ("d", "e") for o, s in enumerate([2, None, 9, -8, 7, 1, 2**31 - 1, 5])], SCHEMA))
    sized.createOrReplaceTempView("sized")
    spark.udtf.register("within", table_functions.take_within_runs(sized.schema, ["k"], "size", 10))
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    row_by_row = spark.sql("SELECT * FROM take_within(TABLE(sized) PARTITION BY (k) ORDER BY (o), 'size', 10)")
    try:
        for most in ("1", "3", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
            for by in ("pmod(xxhash64(k), 2)", "1", "k"):
                got = spark.sql(f"SELECT * FROM within(TABLE(sized) PARTITION BY ({by}) ORDER BY (k, o))")
                assert got.columns == row_by_row.columns == ["k", "o", "size", "before"]
                assert sorted(map(repr, got.collect())) == sorted(map(repr, row_by_row.collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    assert spark.sql("SELECT * FROM within(TABLE(none) PARTITION BY (1) ORDER BY (k, o))").collect() == []
    with pytest.raises(ValueError, match="whole numbers"):
        table_functions.take_within_runs(sized.schema, ["k"], "k", 10)


def test_sums_beyond_a_batch_of_long_numbers_stay_exact(spark):
    big = spark.createDataFrame([(1, o, 2**62) for o in range(2)] + [(2, o, s) for o, s in enumerate([-(2**62), 2**62, 5])], "k int, o int, size long")
    big.createOrReplaceTempView("big")
    spark.udtf.register("within_big", table_functions.take_within_runs(big.schema, ["k"], "size", 2**62))
    got = spark.sql("SELECT k, o, before FROM within_big(TABLE(big) PARTITION BY (1) ORDER BY (k, o)) ORDER BY k, o").collect()
    assert [tuple(r) for r in got] == [(1, 0, 0), (1, 1, 2**62), (2, 0, 0), (2, 1, -(2**62)), (2, 2, 0)]
