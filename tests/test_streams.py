"""Streams that keep their place, and caches that expire."""

import datetime as dt

from pyspark.sql import functions as F

from shelfspark.streaming import stateful


def put(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_merged_tables_go_on_where_they_ended(spark, tmp_path):
    source, table, schema = f"{tmp_path}/in", f"{tmp_path}/t", "k long, v string, at long"
    assert stateful.merged(spark, table, "k", "at") is None
    for n, rows in enumerate([[(1, "a", 1), (2, "b", 1)], [(1, "c", 3), (1, "late", 2)], [(2, "old", 0), (3, "d", 5)]]):
        put(spark, source, rows, schema)
        stateful.merge_stream(spark.readStream.schema(schema).parquet(source), table, "k", "at", f"m{n}", compact_every=2).awaitTermination()
    assert {r.k: r.v for r in stateful.merged(spark, table, "k", "at").collect()} == {1: "c", 2: "b", 3: "d"}
    assert stateful._folders(spark, table, "base=") == [1] and stateful._folders(spark, table, "delta=") == [2]
    stateful.compact(spark, table, "k", "at")
    assert stateful._folders(spark, table, "delta=") == [] and stateful.merged(spark, table, "k", "at").count() == 3


def test_cached_values_end(spark, tmp_path):
    day = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    schema = "key string, value string, at long, ts timestamp"
    row = lambda key, value, seconds: (key, value, int(day.timestamp()) + seconds, day + dt.timedelta(seconds=seconds))
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"

    def keep(batch, n):
        batch.withColumn("n", F.lit(n)).write.mode("append").parquet(out)

    for rows in ([row("a", "1", 0), row("b", "2", 0)], [row("a", "3", 50)], [row("c", "4", 9000)], [row("c", "5", 9001)]):
        put(spark, source, rows, schema)
        stream = stateful.cache_stream(spark.readStream.schema(schema).parquet(source), ttl=100, late="1 second")
        stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    got = [(r.key, r.value, r.expired) for r in spark.read.parquet(out).collect()]
    assert ("a", "3", False) in got and ("a", "3", True) in got and ("b", "2", True) in got
    assert ("c", "5", False) in got and not any(k == "c" and e for k, _, e in got)


def test_changed_rows(spark):
    now = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k int, h string")
    stored = spark.createDataFrame([(1, "x"), (2, "z"), (3, None)], "k int, h string")
    assert [r.k for r in stateful.changed(now, stored, "k", "h").collect()] == [2]
