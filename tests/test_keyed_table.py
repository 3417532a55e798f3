"""Bucketed tables: which files a write touches, what readers and failed writers see."""

import pytest
from pyspark.sql import functions as F

from shelfspark.operators.keyed_table import Conflict, KeyedTable

SCHEMA = "id string, name string, size long"


@pytest.fixture
def table(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"))
    t.create(spark.createDataFrame([(f"k{k}", f"n{k}", k) for k in range(200)], SCHEMA), "id", 16)
    return t


def files(t, generation=None):
    return {b: sorted(t.spark.read.parquet(f"{t.path}/{f}").inputFiles()) for b, f in t.manifest(generation).folders.items()}


def rows(df):
    return {r.id: (r.name, r.size) for r in df.collect()}


def test_an_upsert_touches_its_buckets_only(spark, table):
    before, was = files(table), rows(table.read())
    updates = spark.createDataFrame([("k7", "seven", None), ("k8", "", 88), ("new", "fresh", 1)], SCHEMA)
    m = table.upsert(updates)
    touched = table._touched(updates, m)
    after = files(table)
    assert 1 <= len(touched) <= 3 and m.generation == 1
    assert all((after[b] == before[b]) is (b not in touched) for b in after)
    assert rows(table.read()) == was | {"k7": ("seven", 7), "k8": ("n8", 88), "new": ("fresh", 1)}
    assert rows(table.read(0)) == was
    assert rows(table.upsert(updates, clears=("name",)) and table.lookup(updates)) == {"k7": ("seven", 7), "k8": ("", 88), "new": ("fresh", 1)}


def test_a_lookup_reads_the_files_of_its_buckets(spark, table):
    keys = spark.createDataFrame([("k3",), ("k3",), ("none",)], "id string")
    got = table.lookup(keys)
    assert rows(got) == {"k3": ("n3", 3)}
    read = {f for b in table._touched(keys, table.manifest()) for f in files(table).get(b, [])}
    assert set(got.inputFiles()) <= read | set(keys.inputFiles())


def test_deletes_and_prunes(spark, table):
    before = files(table)
    table.delete(spark.createDataFrame([("k1",), ("k2",), ("none",)], "id string"))
    assert "k1" not in rows(table.read()) and len(rows(table.read())) == 198
    assert sum(files(table)[b] != before[b] for b in before) <= 2
    same = table.delete(spark.createDataFrame([("none",)], "id string"))
    assert same.generation == 1 and table.generations() == [0, 1]
    table.prune(F.col("size") < 190)
    assert sorted(rows(table.read())) == [f"k{k}" for k in range(190, 200)]
    table.prune(F.col("size") >= 0)
    assert table.read().collect() == [] and table.manifest().folders == {}
    table.upsert(spark.createDataFrame([("k1", "back", 5)], SCHEMA))
    assert rows(table.read()) == {"k1": ("back", 5)}


def test_a_failed_writer_leaves_the_last_generation(spark, table):
    was = rows(table.read())

    @F.udf("string")
    def breaks(x):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        table.upsert(spark.createDataFrame([("k7", "x", 1)], SCHEMA).withColumn("name", breaks("name")))
    assert table.generations() == [0] and rows(table.read()) == was
    with pytest.raises(ValueError, match="of its own"):
        table.upsert(spark.createDataFrame([("k7", "x", 1), ("k7", "y", 1)], SCHEMA))
    with pytest.raises(ValueError, match="of its own"):
        table.upsert(spark.createDataFrame([(None, "x", 1)], SCHEMA))
    assert table.upsert(spark.createDataFrame([], SCHEMA)).generation == 0


def test_the_second_of_two_writers_begins_again(spark, table):
    base = table.manifest()
    table.upsert(spark.createDataFrame([("k1", "first", 1)], SCHEMA), base=base)
    second = spark.createDataFrame([("k1", None, 11), ("k2", "second", 2)], SCHEMA)
    with pytest.raises(Conflict):
        table.upsert(second, base=base)
    bases = [base, None]
    assert table.retry(lambda t: t.upsert(second, base=bases.pop(0))).generation == 2
    got = rows(table.read())
    assert got["k1"] == ("first", 11) and got["k2"] == ("second", 2)


def test_vacuum_keeps_what_the_last_manifests_name(spark, table):
    for k in range(3):
        table.upsert(spark.createDataFrame([(f"k{k}", "x", k)], SCHEMA))
    want = rows(table.read())
    assert table.vacuum(keep=2) == ["manifests/generation-000000000000", "manifests/generation-000000000001"]
    gone = table.vacuum(keep=1, older_than_seconds=0)
    assert "manifests/generation-000000000002" in gone and any(g.startswith("data/") for g in gone) is False
    assert rows(table.read()) == want and table.generations() == [3]
    table.upsert(spark.createDataFrame([(f"k{k}", "y", k) for k in range(200)], SCHEMA))
    assert sum(g.startswith("data/") for g in table.vacuum(keep=1, older_than_seconds=0)) == 4
    assert len(rows(table.read())) == 200


def test_no_table(spark, tmp_path):
    with pytest.raises(ValueError, match="no generation"):
        KeyedTable(spark, str(tmp_path / "none")).read()
