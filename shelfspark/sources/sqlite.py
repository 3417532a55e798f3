"""SQLite files as a Spark source and sink.

Reading: stated conditions are judged by the database, a given schema prunes
columns, and a table is read by ranges of its rowid or, where it has none, of its
primary key; a view is read by one task. With ``pushdown`` Spark's own filters are
pushed as well. That is for a DataFrame that one scan reads: Spark 4.1 keeps what
was pushed for the loaded table, so a second scan of it would be filtered too. Writing: every task writes a file of its own beside the target, and the
commit moves their rows over in one transaction, so readers see all of a write
or nothing; a failed job leaves the target as it was. The files must lie where
all executors see them.
"""

from __future__ import annotations

import contextlib
import glob
import json
import math
import os
import sqlite3
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.types import StructType

#: Spark's types by the declared type of a column, and the other way round.
KINDS = {"INTEGER": "bigint", "INT": "bigint", "REAL": "double", "BLOB": "binary"}
STALE_SECONDS = 24 * 3600
DECLARED = {"tinyint": "INTEGER", "smallint": "INTEGER", "int": "INTEGER", "bigint": "INTEGER", "boolean": "INTEGER", "float": "REAL", "double": "REAL", "string": "TEXT", "binary": "BLOB"}


def name(identifier: str) -> str:
    return '"' + identifier.replace('"', '""') + '"'


def _open(path: str, write: bool = False) -> sqlite3.Connection:
    return sqlite3.connect(path, timeout=60) if write else sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def _columns(db: sqlite3.Connection, table: str) -> list[tuple[str, str, int]]:
    """(name, declared type, place in the primary key or 0)."""
    return [(c[1], c[2].upper(), c[5]) for c in db.execute(f"PRAGMA table_info({name(table)})")]


def _has_rowid(db: sqlite3.Connection, table: str) -> bool:
    if db.execute("SELECT 1 FROM sqlite_master WHERE type = 'table' AND name = ?", (table,)).fetchone() is None:
        return False
    try:
        db.execute(f"SELECT rowid FROM {name(table)} LIMIT 0")
    except sqlite3.OperationalError:
        return False
    return True


def condition(f: ds.Filter, columns: set[str]) -> tuple[str, list] | None:
    """A pushed filter as SQL and its values; none if the database can't judge it as Spark does."""
    if isinstance(f, ds.Not):
        inner = condition(f.child, columns)
        return inner and (f"NOT ({inner[0]})", inner[1])
    if len(f.attribute) != 1 or f.attribute[0] not in columns:
        return None
    c = name(f.attribute[0])
    if isinstance(f, ds.IsNull):
        return f"{c} IS NULL", []
    if isinstance(f, ds.IsNotNull):
        return f"{c} IS NOT NULL", []
    plain = lambda v: isinstance(v, int | str | bytes) or (isinstance(v, float) and math.isfinite(v))
    if isinstance(f, ds.In):
        return (f"{c} IN ({', '.join('?' * len(f.value))})", list(f.value)) if f.value and all(map(plain, f.value)) else None
    if not plain(f.value):
        return None
    signs = {ds.EqualTo: "=", ds.EqualNullSafe: "IS", ds.GreaterThan: ">", ds.GreaterThanOrEqual: ">=", ds.LessThan: "<", ds.LessThanOrEqual: "<="}
    if sign := signs.get(type(f)):
        return f"{c} {sign} ?", [f.value]
    if isinstance(f, ds.StringContains):
        return f"instr({c}, ?) > 0", [f.value]
    if isinstance(f, ds.StringStartsWith):
        return f"substr({c}, 1, length(?)) = ?", [f.value, f.value]
    if isinstance(f, ds.StringEndsWith):
        return f"(length({c}) >= length(?) AND substr({c}, length({c}) - length(?) + 1) = ?)", [f.value] * 3
    return None


#: Names of conditions that a reader is given, with what they are.
OPERATIONS = {"=": ds.EqualTo, ">": ds.GreaterThan, ">=": ds.GreaterThanOrEqual, "<": ds.LessThan, "<=": ds.LessThanOrEqual, "in": lambda c, v: ds.In(c, tuple(v)), "contains": ds.StringContains, "starts": ds.StringStartsWith, "ends": ds.StringEndsWith, "null": ds.IsNull, "not null": ds.IsNotNull}


@dataclass
class KeyRange(ds.InputPartition):
    """Rows whose keys lie after ``low`` and up to ``high``; null: no bound."""

    low: tuple | None
    high: tuple | None


class SqliteReader(ds.DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.path, self.table = schema, options["path"], options["table"]
        self.parts = int(options.get("numPartitions", "4"))
        with contextlib.closing(_open(self.path)) as db:
            self.columns = {c for c, _, _ in _columns(db, self.table)}
            primary = [c for c, _, at in sorted(_columns(db, self.table), key=lambda c: c[2]) if at]
            self.key = ["rowid"] if _has_rowid(db, self.table) else primary
        stated = [OPERATIONS[op]((column,), *more) for column, op, *more in json.loads(options.get("where", "[]"))]
        self.where: list[tuple[str, list]] = [c for f in stated if (c := condition(f, self.columns))]
        if len(self.where) < len(stated):
            raise ValueError(f"not all of {options['where']} are conditions on columns of {self.table}")

    def partitions(self) -> list[KeyRange]:
        """Ranges of equally many rows for a primary key, of equally many numbers for rowids, whose ends are known at once."""
        with contextlib.closing(_open(self.path)) as db:
            if not self.key:
                return [KeyRange(None, None)]
            if self.key == ["rowid"]:
                low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {name(self.table)}").fetchone()
                if low is None:
                    return [KeyRange(None, None)]
                step = (high - low) // self.parts + 1
                ends = [(low + step * k - 1,) for k in range(1, self.parts) if low + step * k - 1 < high]
            else:
                n = db.execute(f"SELECT count(*) FROM {name(self.table)}").fetchone()[0]
                cols = ", ".join(map(name, self.key))
                ends = [db.execute(f"SELECT {cols} FROM {name(self.table)} ORDER BY {cols} LIMIT 1 OFFSET ?", (n * k // self.parts - 1,)).fetchone() for k in range(1, self.parts) if n * k // self.parts > n * (k - 1) // self.parts]
        return [KeyRange(low, high) for low, high in zip([None, *ends], [*ends, None], strict=True)]

    def statement(self, part: KeyRange) -> tuple[str, list]:
        key = "rowid" if self.key == ["rowid"] else f"({', '.join(map(name, self.key))})"
        marks = "?" if self.key == ["rowid"] else f"({', '.join('?' * len(self.key))})"
        where, values = [w for w, _ in self.where], [v for _, vs in self.where for v in vs]
        for bound, sign in ((part.low, ">"), (part.high, "<=")):
            if bound is not None:
                where.append(f"{key} {sign} {marks}")
                values += bound
        cols = ", ".join(name(f.name) for f in self.schema.fields) or "1"
        return f"SELECT {cols} FROM {name(self.table)}" + (f" WHERE {' AND '.join(where)}" if where else ""), values

    def read(self, partition: KeyRange) -> Iterator[tuple]:
        with contextlib.closing(_open(self.path)) as db:
            yield from db.execute(*self.statement(partition))


class PushingReader(SqliteReader):
    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:  # noqa: N802
        for f in filters:
            if found := condition(f, self.columns):
                self.where.append(found)
            else:
                yield f


class SqliteWriter(ds.DataSourceWriter):
    """Files of tasks are named by the write, so an aborted one removes its own and no other's."""

    def __init__(self, schema: StructType, options: dict, overwrite: bool):
        self.names = [f.name for f in schema.fields]
        self.kinds = [f.dataType.simpleString() for f in schema.fields]
        if odd := [k for k in self.kinds if k not in DECLARED]:
            raise ValueError(f"SQLite has no column for {odd[0]}")
        self.path, self.table, self.overwrite = options["path"], options["table"], overwrite
        self.key = [k for k in options.get("key", "").split(",") if k]
        self.keeps = options.get("keepOnEmpty", "false") == "true"
        self.write_id = uuid.uuid4().hex

    def _create(self, db: sqlite3.Connection, key: list[str]) -> None:
        cols = [f"{name(n)} {DECLARED[k]}" for n, k in zip(self.names, self.kinds, strict=True)]
        cols += [f"PRIMARY KEY ({', '.join(map(name, key))})"] if key else []
        db.execute(f"CREATE TABLE IF NOT EXISTS {name(self.table)} ({', '.join(cols)})")

    def _insert(self, upsert: bool) -> str:
        cols, marks = ", ".join(map(name, self.names)), ", ".join("?" * len(self.names))
        text = f"INSERT INTO {name(self.table)} ({cols}) VALUES ({marks})"
        rest = [n for n in self.names if n not in self.key]
        if not (upsert and self.key):
            return text
        fresh = lambda n: f"CASE WHEN excluded.{name(n)} IS NULL OR length(excluded.{name(n)}) = 0 THEN {name(n)} ELSE excluded.{name(n)} END" if self.keeps else f"excluded.{name(n)}"
        does = f"UPDATE SET {', '.join(f'{name(n)} = {fresh(n)}' for n in rest)}" if rest else "NOTHING"
        return f"{text} ON CONFLICT ({', '.join(map(name, self.key))}) DO {does}"

    def write(self, iterator: Iterator) -> ds.WriterCommitMessage:
        part = f"{self.path}.{self.write_id}.{uuid.uuid4().hex}.part"
        try:
            with contextlib.closing(_open(part, write=True)) as db, db:
                self._create(db, [])
                db.executemany(self._insert(False), (tuple(r) for r in iterator))
        except BaseException:
            _remove(part)
            raise
        return _Written(part)

    def commit(self, messages: list) -> None:
        with contextlib.closing(_open(self.path, write=True)) as db:
            with db:  # one transaction: all parts or none
                db.execute("BEGIN IMMEDIATE")
                self._create(db, self.key)
                if self.overwrite:
                    db.execute(f"DELETE FROM {name(self.table)}")
                for m in sorted((m for m in messages if m is not None), key=lambda m: m.part):
                    with contextlib.closing(_open(m.part)) as rows:
                        db.executemany(self._insert(True), rows.execute(f"SELECT {', '.join(map(name, self.names))} FROM {name(self.table)}"))
        self.abort(messages)

    def abort(self, messages: list) -> None:
        """Removes the files of this write, and those that tasks of a lost driver left a day ago or earlier."""
        for part in glob.glob(f"{glob.escape(self.path)}.*.part*"):
            with contextlib.suppress(FileNotFoundError):
                if self.write_id in part or time.time() - os.stat(part).st_mtime > STALE_SECONDS:
                    _remove(part)


def _remove(part: str) -> None:
    for path in (part, f"{part}-journal"):
        with contextlib.suppress(FileNotFoundError):
            os.remove(path)


@dataclass
class _Written(ds.WriterCommitMessage):
    part: str


class SqliteSource(ds.DataSource):
    """``format("sqlite")``: options path, table; for reading numPartitions, where and pushdown; for writing key and keepOnEmpty.

    ``where`` is a JSON list of [column, operation, value], all of which hold;
    the operations are those of ``OPERATIONS``.

    A write with ``key`` (names, comma between) updates rows of equal keys; with
    ``keepOnEmpty`` a null or empty value leaves what is stored. A schema given
    to the reader names the columns that are read.
    """

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        with contextlib.closing(_open(self.options["path"])) as db:
            found = _columns(db, self.options["table"])
        return ", ".join("`" + c.replace("`", "``") + f"` {KINDS.get(kind, 'string')}" for c, kind, _ in found)

    def reader(self, schema: StructType) -> ds.DataSourceReader:
        return (PushingReader if self.options.get("pushdown") == "true" else SqliteReader)(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> ds.DataSourceWriter:
        return SqliteWriter(schema, self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session."""
    spark.dataSource.register(SqliteSource)


def read_table(spark: SparkSession, path: str, table: str, columns: list[str] | None = None, where: list[tuple] = (), partitions: int = 4, once: bool = False) -> DataFrame:
    """A table, or some of its columns, which alone are then read, and of its rows those that ``where`` holds for.

    ``once``: one scan reads the DataFrame, so Spark may push its filters too.
    """
    register(spark)
    reader = spark.read.format("sqlite").options(path=path, table=table, numPartitions=partitions, where=json.dumps(list(where)))
    if once:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
        reader = reader.option("pushdown", "true")
    if columns is None:
        return reader.load()
    with contextlib.closing(_open(path)) as db:
        kinds = {c: KINDS.get(kind, "string") for c, kind, _ in _columns(db, table)}
    return reader.schema(", ".join(f"`{c}` {kinds[c]}" for c in columns)).load()
