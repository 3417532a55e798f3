"""The SQLite source and sink: what is pushed, what is read, what a failed write leaves."""

import os
import sqlite3

import pytest
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.sources import sqlite

ROWS = [(k, f"name {k % 7}" if k % 5 else None, k / 4, bytes([k % 256]) * (k % 3)) for k in range(-20, 300)]


@pytest.fixture
def db(tmp_path):
    path = str(tmp_path / "t.db")
    with sqlite3.connect(path) as con:
        con.execute("CREATE TABLE app (id INTEGER, title TEXT, size REAL, icon BLOB)")
        con.executemany("INSERT INTO app VALUES (?, ?, ?, ?)", ROWS)
        con.execute('CREATE TABLE pair (a TEXT, b INTEGER, "odd ""name""" TEXT, PRIMARY KEY (a, b)) WITHOUT ROWID')
        con.executemany("INSERT INTO pair VALUES (?, ?, ?)", [(f"k{i // 9}", i % 9, f"v{i}") for i in range(100)])
        con.execute("CREATE TABLE bare (a INTEGER)")
        # Reading row 99 of this fails in the database.
        con.execute("CREATE VIEW trap AS SELECT id, CASE WHEN id = 99 THEN abs(-9223372036854775807 - 1) ELSE id END AS n FROM app WHERE id >= 0")
    return path


def conditions():
    return [
        F.col("id") == 17, F.col("id") > 290, F.col("id") <= -18, F.col("title").contains("e 3"), F.col("title").startswith("name 6"), F.col("title").endswith("4"),
        F.col("title").isNull(), F.col("title").isNotNull() & (F.col("size") < 1.0), F.col("id").isin(1, 5, 400), ~F.col("id").isin(*range(250)), F.col("title") != "name 1",
        ~F.col("title").contains("name"), (F.col("id") > 10) & (F.col("id") < 15), (F.col("id") == 3) | (F.col("id") == 4), F.col("title").eqNullSafe(None), F.col("size").eqNullSafe(2.5), F.length("title") > 6, F.col("title").contains("%"),
    ]


def test_filters_give_the_rows_of_spark(spark, db):
    whole = spark.createDataFrame(ROWS, "id long, title string, size double, icon binary")
    assert sqlite.read_table(spark, db, "app").dtypes == whole.dtypes
    for c in conditions():
        got = sqlite.read_table(spark, db, "app", once=True).filter(c)
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.filter(c).collect())), c


def test_stated_conditions_hold_for_every_scan(spark, db):
    whole = spark.createDataFrame(ROWS, "id long, title string, size double, icon binary")
    for where, c in [([("id", ">", 5), ("title", "contains", "e 3")], "id > 5 AND title LIKE '%e 3%'"), ([("title", "null")], "title IS NULL"), ([("id", "in", [1, 2, 900])], "id IN (1, 2)"), ([("title", "starts", "name 6"), ("title", "ends", "6"), ("size", "<=", 3.0)], "title = 'name 6' AND size <= 3")]:
        got = sqlite.read_table(spark, db, "app", where=where)
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.filter(c).collect()))
        assert got.filter("id % 2 = 0").count() + got.filter("id % 2 <> 0").count() == got.count()
    with pytest.raises(Exception, match="not all of"):
        sqlite.read_table(spark, db, "app", where=[("no", "=", 1)]).collect()


def test_pushed_sql_and_unread_rows(spark, db):
    reader = sqlite.PushingReader(T.StructType([T.StructField("title", T.StringType())]), {"path": db, "table": "app", "numPartitions": "2", "where": '[["size", ">", 0.5]]'})
    left = list(reader.pushFilters([ds.GreaterThan(("id",), 5), ds.StringContains(("title",), "x"), ds.EqualTo(("s", "f"), 1), ds.Not(ds.EqualTo(("title",), "y"))]))
    assert left == [ds.EqualTo(("s", "f"), 1)]
    first = reader.partitions()[0]
    text, values = reader.statement(first)
    assert text == 'SELECT "title" FROM "app" WHERE "size" > ? AND "id" > ? AND instr("title", ?) > 0 AND NOT ("title" = ?) AND rowid <= ?' and values == [0.5, 5, "x", "y", first.high[0]]
    read = lambda **more: sqlite.read_table(spark, db, "trap", **more)
    assert read(once=True).filter("id < 99").count() == 99 and read(where=[("id", "in", [7, 8])]).agg(F.sum("n")).first()[0] == 15
    with pytest.raises(Exception, match="overflow"):
        read().filter("id < 99").agg(F.sum("n")).collect()


def test_only_named_columns_are_read(spark, db):
    got = sqlite.read_table(spark, db, "trap", ["id"])
    assert got.columns == ["id"] and got.count() == 300 and got.agg(F.max("id")).first()[0] == 299


def test_tables_without_rowid_go_by_key_ranges(spark, db):
    for parts in (1, 3, 7, 200):
        got = sqlite.read_table(spark, db, "pair", partitions=parts)
        assert sorted(r.a + str(r.b) for r in got.collect()) == sorted(f"k{i // 9}{i % 9}" for i in range(100)) and got.columns[2] == 'odd "name"'
    reader = sqlite.SqliteReader(T.StructType([]), {"path": db, "table": "pair", "numPartitions": "4"})
    keys = sorted((f"k{i // 9}", i % 9) for i in range(100))
    assert [p.high for p in reader.partitions()] == [keys[24], keys[49], keys[74], None]
    assert sqlite.read_table(spark, db, "bare").count() == 0


def rows_of(path, table):
    with sqlite3.connect(path) as con:
        return sorted(con.execute(f"SELECT * FROM {table}").fetchall(), key=str)


def put(df, path, mode="append", **options):
    df.write.format("sqlite").mode(mode).options(path=path, table="out", **options).save()


def test_writes_are_whole_and_upsert_by_key(spark, tmp_path):
    sqlite.register(spark)
    path = str(tmp_path / "w.db")
    df = spark.createDataFrame([(k, f"t{k}", b"x") for k in range(40)], "id long, title string, icon binary").repartition(5)
    put(df, path, key="id")
    assert len(rows_of(path, "out")) == 40
    put(spark.createDataFrame([(3, "", None), (4, "new", b"y"), (100, "more", None)], "id long, title string, icon binary"), path, key="id", keepOnEmpty="true")
    got = {r[0]: r[1:] for r in rows_of(path, "out")}
    assert len(got) == 41 and got[3] == ("t3", b"x") and got[4] == ("new", b"y") and got[100] == ("more", None)
    put(spark.createDataFrame([(3, "", None)], "id long, title string, icon binary"), path, key="id")
    assert {r[0]: r[1] for r in rows_of(path, "out")}[3] == ""
    put(spark.createDataFrame([(1, "only", None)], "id long, title string, icon binary"), path, mode="overwrite", key="id")
    assert rows_of(path, "out") == [(1, "only", None)]
    assert sqlite.read_table(spark, path, "out").count() == 1 and os.listdir(tmp_path) == ["w.db"]


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    sqlite.register(spark)
    path = str(tmp_path / "w.db")
    put(spark.range(5).select(F.col("id"), F.lit("old").alias("t")), path, key="id")

    @F.udf("string")
    def breaks(k):
        if k == 7:
            raise RuntimeError("lost")
        return "new"

    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="lost|Aborted|FAILED|abort"):
            put(spark.range(20).repartition(4).select(F.col("id"), breaks("id").alias("t")), path, mode=mode, key="id")
        assert rows_of(path, "out") == [(k, "old") for k in range(5)]
    with pytest.raises(Exception, match="no column"):
        put(spark.range(2).select(F.array("id").alias("a")), path)
    # Tasks that outlive the abort may leave files; nobody reads them, and a later write clears what is a day old.
    (tmp_path / "w.db.gone.task.part").write_text("")
    for left in os.listdir(tmp_path):
        os.utime(tmp_path / left, (0, 0))
    put(spark.range(5, 7).select(F.col("id"), F.lit("new").alias("t")), path, key="id")
    assert os.listdir(tmp_path) == ["w.db"] and len(rows_of(path, "out")) == 7
