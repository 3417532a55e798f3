"""Stateful streams: refusal backoff, newest wins, event-time windows, incremental merges."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shelfspark.operators import tables
from shelfspark.plans.lineage import scratch_path


def _count_refusals(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    tries, last = state.get if state.exists else (0, 0)
    for rows in batches:
        tries += len(rows)
        last = max(last, int(rows["at"].max()))
    state.update((tries, last))
    wait = tables.MOST_SECONDS if tries > 5 else min(tables.MOST_SECONDS, tables.FIRST_SECONDS << (tries - 1))
    yield pd.DataFrame({"user_id": [key[0]], "tries": [tries], "until": [last + wait]})


def backoff_stream(events: DataFrame) -> DataFrame:
    """A stream of (user_id, at in seconds) refusals -> an update (user_id, tries, until) per key and batch."""
    return events.groupBy("user_id").applyInPandasWithState(_count_refusals, "user_id long, tries long, until long", "tries long, last long", "update", GroupStateTimeout.NoTimeout)


def newest_wins(events: DataFrame, key: str, at: str) -> DataFrame:
    """The newest row of each key as a stream of updates, however late rows come: one row of state per key, none dropped."""
    rest = [c for c in events.columns if c != key]
    best = events.groupBy(key).agg(F.max_by(F.struct(*rest), at).alias("b"))
    return best.select(key, *[F.col(f"b.{c}") for c in rest])


def pauses(failures: DataFrame) -> DataFrame:
    """A stream of (provider, at, pause) in seconds -> updates (provider, until): the pause of the newest failure."""
    return failures.groupBy("provider").agg(F.max_by(F.col("at") + F.col("pause"), "at").alias("until"))


def _keep_until(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState, ttl: int) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        value, at = state.get
        state.remove()
        yield pd.DataFrame({"key": [key[0]], "value": [value], "at": [at], "expired": [True]})
        return
    value, at = state.get if state.exists else (None, -1)
    for rows in batches:
        best = rows.loc[rows["at"].idxmax()]
        if int(best["at"]) >= at:
            value, at = str(best["value"]), int(best["at"])
    state.update((value, at))
    state.setTimeoutTimestamp(max((at + ttl) * 1000, state.getCurrentWatermarkMs() + 1))
    yield pd.DataFrame({"key": [key[0]], "value": [value], "at": [at], "expired": [False]})


def cache_stream(entries: DataFrame, ttl: int, late: str = "1 hour") -> DataFrame:
    """A stream of (key, value, at in seconds, ts) -> updates (key, value, at, expired): the newest value of a key, and its end ``ttl`` seconds of event time later."""

    def keep(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        return _keep_until(key, batches, state, ttl)

    return entries.withWatermark("ts", late).groupBy("key").applyInPandasWithState(keep, "key string, value string, at long, expired boolean", "value string, at long", "update", GroupStateTimeout.EventTimeTimeout)


def deduplicated(events: DataFrame, keys: list[str], at: str, late: str = "1 hour") -> DataFrame:
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def windowed_counts(events: DataFrame, at: str, by: str, length: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    w = F.window(at, length, slide) if slide else F.window(at, length)
    return events.withWatermark(at, late).groupBy(w.alias("w"), by).agg(F.count(F.lit(1)).alias("n"))


def _folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the complete folders ``prefix<number>`` below a path, in order."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix) and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS")))


def _remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def merged(spark: SparkSession, table_path: str, key: str, at: str) -> DataFrame | None:
    """The table that ``merge_stream`` keeps: its newest base and the batches after it, the newest row of each key; None before the first batch."""
    bases = _folders(spark, table_path, "base=")
    base = bases[-1] if bases else -1
    parts = [(f"{table_path}/base={base}", -1)] if bases else []
    parts += [(f"{table_path}/delta={k}", k) for k in _folders(spark, table_path, "delta=") if k > base]
    if not parts:
        return None
    rows = None
    for path, k in parts:
        one = spark.read.parquet(path).withColumn("__batch", F.lit(k))
        rows = one if rows is None else rows.unionByName(one)
    rest = [c for c in rows.columns if c not in (key, "__batch")]
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(at, "__batch")).alias("b"))
    return newest.select(key, *[F.col(f"b.{c}") for c in rest])


def compact(spark: SparkSession, table_path: str, key: str, at: str) -> None:
    """Write base and batches as a new base, then remove what went into it; a failure in between leaves rows twice, never fewer."""
    deltas, bases = _folders(spark, table_path, "delta="), _folders(spark, table_path, "base=")
    if not deltas or (bases and deltas[-1] <= bases[-1]):
        return
    merged(spark, table_path, key, at).write.mode("overwrite").parquet(f"{table_path}/base={deltas[-1]}")
    for k in deltas:
        _remove(spark, f"{table_path}/delta={k}")
    for k in bases:
        _remove(spark, f"{table_path}/base={k}")


def merge_stream(updates: DataFrame, table_path: str, key: str, at: str, query_name: str, checkpoint: str | None = None, compact_every: int = 20) -> StreamingQuery:
    """Start merging a stream into a keyed table: each batch adds its newest rows, every ``compact_every`` batches become one base.

    Only the batch's own rows are written. A batch that comes again writes the
    same folder again, so nothing is counted twice; the checkpoint lies beside
    the table unless ``checkpoint`` names another place, so a restart goes on
    where the last one ended. ``merged`` reads the table.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rest = [c for c in batch.columns if c != key]
        newest = batch.groupBy(key).agg(F.max_by(F.struct(*rest), at).alias("b")).select(key, *[F.col(f"b.{c}") for c in rest])
        newest.write.mode("overwrite").parquet(f"{table_path}/delta={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            compact(spark, table_path, key, at)

    return updates.writeStream.foreachBatch(each).queryName(query_name).option("checkpointLocation", checkpoint or f"{table_path}/_checkpoint").trigger(availableNow=True).start()


def changed(batch: DataFrame, stored: DataFrame, key: str, content: str) -> DataFrame:
    """Rows of a batch whose content hash isn't the stored one: what is to be made anew."""
    have = stored.select(F.col(key).alias("__k"), F.col(content).alias("__h"))
    return batch.join(have, (F.col(key) == F.col("__k")) & F.col(content).eqNullSafe(F.col("__h")), "left_anti")


def run_to_end(stream: DataFrame, mode: str, name: str) -> DataFrame:
    """All rows that a finite stream gives, from an availableNow run written to the shared folder."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("__batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/rows/b={batch_id}")

    q = stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{path}/rows").drop("b")
