"""Streams run to their end over the tables; their results equal the batch ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.plans.lineage import scratch_path
from shelfspark.plans.state_queries import BACKOFF_SQL
from shelfspark.registry import query, table
from shelfspark.streaming import stateful, timed


def _stream(spark, sf_dir):
    """The events table as a stream: a stream source lists a folder or a pattern, and the table may be one file."""
    return spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parquet*")


@query("stream_backoff_equals_batch", BACKOFF_SQL)
def stream_backoff_equals_batch(spark, sf_dir):
    e = _stream(spark, sf_dir).filter("event_type = 'error'").select("user_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("at"))
    rows = stateful.run_to_end(stateful.backoff_stream(e), "update", "backoff")
    return rows.groupBy("user_id").agg(F.max_by("tries", "__batch").alias("tries"), F.max_by("until", "__batch").alias("until"))


@query("stream_tumbling_counts", "SELECT CAST(floor(epoch(ts) / 86400) * 86400 AS BIGINT) AS start_s, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2")
def stream_tumbling_counts(spark, sf_dir):
    e = _stream(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    rows = stateful.run_to_end(stateful.windowed_counts(e, "ts", "event_type", "1 day", late="400 days"), "update", "tumbling")
    return rows.groupBy(F.unix_timestamp("w.start").alias("start_s"), "event_type").agg(F.max_by("n", "__batch").alias("n"))


@query("stream_newest_wins", "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id")
def stream_newest_wins(spark, sf_dir):
    e = _stream(spark, sf_dir).select("user_id", F.struct("ts", "event_id").alias("at"), "event_id")
    rows = stateful.run_to_end(stateful.newest_wins(e, "user_id", "at"), "update", "newest")
    return rows.groupBy("user_id").agg(F.max_by("event_id", "__batch").alias("event_id"))


@query("stream_pauses", "SELECT event_type AS provider, arg_max(event_id + 60, event_id) AS until FROM events GROUP BY 1")
def stream_pauses(spark, sf_dir):
    e = _stream(spark, sf_dir).select(F.col("event_type").alias("provider"), F.col("event_id").alias("at"), F.lit(60).alias("pause"))
    rows = stateful.run_to_end(stateful.pauses(e), "update", "pauses")
    return rows.groupBy("provider").agg(F.max_by("until", "__batch").alias("until"))


@query("stream_merged_table", "SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id")
def stream_merged_table(spark, sf_dir):
    """The events as a stream, merged twice into one table: the second start finds its checkpoint and nothing new."""
    path = scratch_path(spark, "merged")
    for _ in range(2):
        e = _stream(spark, sf_dir).select("user_id", "event_type", "event_id")
        stateful.merge_stream(e, path, "user_id", "event_id", "merge", compact_every=1).awaitTermination()
    return stateful.merged(spark, path, "user_id", "event_id").select("user_id", "event_type", "event_id")


@query("changed_rows", "SELECT user_id FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1) WHERE n % 2 = 1 OR user_id % 3 = 0")
def changed_rows(spark, sf_dir):
    now = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("h"))
    stored = now.filter("user_id % 3 <> 0").select("user_id", F.when(F.col("h") % 2 == 1, F.col("h") + 1).otherwise(F.col("h")).alias("h"))
    return stateful.changed(now, stored, "user_id", "h").select("user_id")


_SECONDS = "CAST(floor(epoch(ts)) AS BIGINT)"


@query("stream_sessions", f"""WITH e AS (SELECT user_id, {_SECONDS} AS s FROM events), g AS (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY user_id ORDER BY s) < 86400 THEN 0 ELSE 1 END AS first FROM e),
n AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(s) AS start, max(s) + 86400 AS stop, CAST(count(*) AS BIGINT) AS n FROM n GROUP BY user_id, k HAVING max(s) + 86400 <= (SELECT max(s) - 7200 FROM e)""")
def stream_sessions(spark, sf_dir):
    """Sessions of a day's gap that the watermark has passed; those still open at the end of the stream don't come."""
    e = _stream(spark, sf_dir).select("user_id", F.date_trunc("second", F.col("ts").cast("timestamp")).alias("ts"))
    rows = stateful.run_to_end(timed.sessions(e, "user_id", "ts", "1 day", "2 hours"), "append", "sessions")
    return rows.select("user_id", F.unix_timestamp("start").alias("start"), F.unix_timestamp("stop").alias("stop"), "n")


@query("stream_answered", f"""WITH e AS (SELECT event_id, user_id, event_type, {_SECONDS} AS s FROM events)
SELECT q.event_id AS question, a.event_id AS answer FROM e q JOIN e a ON q.user_id = a.user_id AND a.s BETWEEN q.s AND q.s + 21600 WHERE q.event_type = 'error' AND a.event_type = 'purchase'""")
def stream_answered(spark, sf_dir):
    """Errors of a user and the purchases within six hours after each, two streams with watermarks."""
    second = F.date_trunc("second", F.col("ts").cast("timestamp"))
    q = _stream(spark, sf_dir).filter("event_type = 'error'").select(F.col("user_id").alias("id"), second.alias("asked"), F.col("event_id").alias("question"))
    a = _stream(spark, sf_dir).filter("event_type = 'purchase'").select(F.col("user_id").alias("id"), second.alias("said"), F.col("event_id").alias("answer"))
    return stateful.run_to_end(timed.answered(q, a, "6 hours", "400 days"), "append", "answered").select("question", "answer")
