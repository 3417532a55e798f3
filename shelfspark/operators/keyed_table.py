"""A keyed table in hash buckets, one manifest per generation.

Rows lie in the bucket that a hash of their key names. An upsert or a delete
rewrites the buckets its keys fall into and no others, into new files; the
manifest of the next generation points to those and to the old files of the rest.
A generation is there once its manifest has been renamed into place, so readers
see one generation whole, a failed writer leaves the last one as it was, and of
two writers on one base the second is told to begin again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfspark.operators import tables


class Conflict(RuntimeError):
    """Another writer has made the next generation first."""


@dataclass(frozen=True)
class Manifest:
    generation: int
    key: str
    buckets: int
    schema: StructType
    #: Folder of each bucket that has rows, below the table's own.
    folders: dict[int, str]


class KeyedTable:
    """The table in a folder; any folder that Spark's Hadoop file systems can list and rename in."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # -- files -------------------------------------------------------------------

    def _fs(self, path: str):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop

    def _names(self, folder: str) -> list[tuple[str, int]]:
        """(name, time of change in ms) of what lies in a folder of the table."""
        fs, at = self._fs(f"{self.path}/{folder}")
        return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(at)] if fs.exists(at) else []

    def generations(self) -> list[int]:
        return sorted(int(n.removeprefix("generation-")) for n, _ in self._names("manifests") if n.startswith("generation-"))

    def manifest(self, generation: int | None = None) -> Manifest:
        """The manifest of a generation, the newest by default; one row per bucket."""
        known = self.generations()
        if not known or (generation is not None and generation not in known):
            raise ValueError(f"{self.path} has no generation {'' if generation is None else generation}")
        at = known[-1] if generation is None else generation
        lines = [json.loads(r.value) for r in self.spark.read.text(f"{self.path}/manifests/generation-{at:012d}").collect()]
        head = next(x for x in lines if "key" in x)
        return Manifest(at, head["key"], head["buckets"], StructType.fromJson(head["schema"]), {x["bucket"]: x["folder"] for x in lines if "bucket" in x})

    def _commit(self, m: Manifest) -> Manifest:
        """Writes a manifest beside the others and renames it into place, which fails if that generation is there."""
        lines = [{"key": m.key, "buckets": m.buckets, "schema": json.loads(m.schema.json())}, *[{"bucket": b, "folder": f} for b, f in sorted(m.folders.items())]]
        draft, place = f"{self.path}/drafts/{uuid.uuid4().hex}", f"{self.path}/manifests/generation-{m.generation:012d}"
        self.spark.createDataFrame([(json.dumps(x),) for x in lines], "value string").coalesce(1).write.text(draft)
        fs, to = self._fs(place)
        fs.mkdirs(to.getParent())
        if fs.exists(to) or not fs.rename(self._fs(draft)[1], to):
            fs.delete(self._fs(draft)[1], True)
            raise Conflict(f"generation {m.generation} of {self.path} has been written by another")
        return m

    # -- rows --------------------------------------------------------------------

    @staticmethod
    def bucket(key: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")

    def _put(self, rows: DataFrame, key: str, buckets: int) -> dict[int, str]:
        """Writes rows by bucket, one task each; the folders of the buckets that got any."""
        folder = f"data/{uuid.uuid4().hex}"
        dealt = rows.withColumn("__bucket", self.bucket(F.col(key), buckets))
        dealt.repartition(buckets, "__bucket").write.partitionBy("__bucket").parquet(f"{self.path}/{folder}")
        return {int(n.removeprefix("__bucket=")): f"{folder}/{n}" for n, _ in self._names(folder) if n.startswith("__bucket=")}

    def create(self, rows: DataFrame, key: str, buckets: int) -> Manifest:
        """Generation 0. Choose ``buckets`` so that one is a task's work; it stays as it is."""
        self._check(rows, key)
        return self._commit(Manifest(0, key, buckets, rows.schema, self._put(rows, key, buckets)))

    @staticmethod
    def _check(rows: DataFrame, key: str) -> None:
        if rows.filter(F.col(key).isNull()).limit(1).count() or rows.groupBy(key).count().filter("count > 1").limit(1).count():
            raise ValueError(f"every row needs a {key} of its own")

    def read(self, generation: int | None = None, only: set[int] | None = None) -> DataFrame:
        """All rows of a generation, or those of some buckets."""
        return self._read(self.manifest(generation), only)

    def _read(self, m: Manifest, only: set[int] | None = None) -> DataFrame:
        folders = [f"{self.path}/{f}" for b, f in sorted(m.folders.items()) if only is None or b in only]
        return self.spark.read.schema(m.schema).parquet(*folders) if folders else self.spark.createDataFrame([], m.schema)

    def _touched(self, keys: DataFrame, m: Manifest) -> set[int]:
        """Buckets of some keys: as many numbers as there are buckets at most."""
        return {r.b for r in keys.select(self.bucket(F.col(m.key), m.buckets).alias("b")).distinct().collect()}

    def lookup(self, keys: DataFrame, generation: int | None = None) -> DataFrame:
        """The rows of some keys; only files of their buckets are read."""
        m = self.manifest(generation)
        return self._read(m, self._touched(keys, m)).join(keys.select(m.key).distinct(), m.key, "left_semi")

    def _rewrite(self, m: Manifest, touched: set[int], rows: DataFrame) -> Manifest:
        folders = {b: f for b, f in m.folders.items() if b not in touched}
        return self._commit(Manifest(m.generation + 1, m.key, m.buckets, m.schema, folders | self._put(rows, m.key, m.buckets)))

    def upsert(self, updates: DataFrame, clears: tuple[str, ...] = (), base: Manifest | None = None) -> Manifest:
        """The next generation, with ``updates`` by key as ``tables.merge`` takes them. Without rows nothing is written."""
        m = base or self.manifest()
        self._check(updates, m.key)
        touched = self._touched(updates, m)
        return self._rewrite(m, touched, tables.merge(self._read(m, touched), updates, m.key, clears)) if touched else m

    def delete(self, keys: DataFrame, base: Manifest | None = None) -> Manifest:
        """The next generation without some keys; keys that aren't there touch nothing."""
        m = base or self.manifest()
        there = self.lookup(keys, m.generation).select(m.key)
        touched = self._touched(there, m)
        return self._rewrite(m, touched, tables.delete(self._read(m, touched), keys, m.key)) if touched else m

    def prune(self, old: Column, base: Manifest | None = None) -> Manifest:
        """The next generation without the rows for which ``old`` holds; buckets without such rows stay as they are."""
        m = base or self.manifest()
        touched = self._touched(self._read(m).filter(old), m)
        return self._rewrite(m, touched, self._read(m, touched).filter(~F.coalesce(old, F.lit(False)))) if touched else m

    def retry(self, write, times: int = 5) -> Manifest:
        """``write(table)`` again from the newest generation where another writer came first."""
        for left in range(times - 1, -1, -1):
            try:
                return write(self)
            except Conflict:
                if not left:
                    raise
        raise AssertionError

    def vacuum(self, keep: int = 2, older_than_seconds: float = 24 * 3600) -> list[str]:
        """Removes manifests but the last ``keep`` and files that none of those names, if they are old enough that no writer is at them."""
        known = self.generations()
        held = {f.split("/")[1] for g in known[-keep:] for f in self.manifest(g).folders.values()}
        now = int(self.spark.sparkContext._jvm.java.lang.System.currentTimeMillis())
        gone = [f"manifests/generation-{g:012d}" for g in known[:-keep]]
        for folder in ("data", "drafts"):
            gone += [f"{folder}/{n}" for n, at in self._names(folder) if n not in held and now - at >= older_than_seconds * 1000]
        for g in gone:
            fs, at = self._fs(f"{self.path}/{g}")
            fs.delete(at, True)
        return gone
