"""Timed state and watermarks: rows really come late, queries really restart."""

import datetime as dt
import random
import time

from pyspark.sql import functions as F

from shelfspark.streaming import timed

DAY = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
BASE = int(DAY.timestamp())


def at(seconds):
    return DAY + dt.timedelta(seconds=seconds)


class Feed:
    """A folder that a stream reads one file at a time; each ``run`` is a query that starts from the checkpoint and ends."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema, self.n = spark, path, schema, 0

    def put(self, rows):
        self.n += 1
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(f"{self.path}/in/{self.n:04d}")

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(f"{self.path}/in/*")


def run(stream, path, mode="update"):
    def keep(batch, n):
        batch.write.mode("append").parquet(f"{path}/out")

    stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()


def out(spark, path):
    return spark.read.parquet(f"{path}/out").collect()


def test_pauses_end_and_outlive_a_restart(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), "key string, at long, pause long, ts timestamp")
    row = lambda key, s, pause: (key, BASE + s, pause, at(s))
    ends = lambda: {(r.key, r.until - BASE) for r in out(spark, tmp_path) if not r.paused}
    for rows in ([row("a", 0, 60), row("b", 5, 600)], [row("a", 30, 60)], [row("c", 95, 10)]):
        feed.put(rows)
        run(timed.timed_pauses(feed.stream(), late="1 second"), tmp_path)  # each run is a restart
    # The first end of a's pause was moved; 90 is past the watermark of 94 by now.
    assert ends() == {("a", 90)}
    feed.put([row("d", 700, 1)])
    run(timed.timed_pauses(feed.stream(), late="1 second"), tmp_path)
    assert ends() == {("a", 90), ("b", 605), ("c", 105)}
    feed.put([row("e", 100, 20), row("b", 690, 100)])
    run(timed.timed_pauses(feed.stream(), late="1 second"), tmp_path)
    started = {(r.key, r.until - BASE) for r in out(spark, tmp_path) if r.paused}
    assert started == {("a", 60), ("b", 605), ("a", 90), ("c", 105), ("d", 701)}  # e and b's last came too late to be seen


def test_caches_keep_their_budget_across_restarts(spark, tmp_path):
    rnd = random.Random(3)
    feed = Feed(spark, str(tmp_path), "cache string, entry string, bytes long, used long")
    held = {"x": {}, "y": {}}
    gone = []
    for batch in range(6):
        rows = [(rnd.choice("xy"), f"e{rnd.randint(0, 9)}", rnd.randint(1, 40), batch * 100 + k) for k in range(rnd.randint(1, 12))]
        feed.put(rows)
        for cache, entry, size, used in rows:
            mine = held[cache]
            mine[entry] = (size, used)
            while sum(b for b, _ in mine.values()) > 100 and len(mine) > 1:
                oldest = min((e for e in mine if e != entry), key=lambda e: mine[e][1])
                del mine[oldest]
                gone.append((cache, oldest))
        run(timed.bounded_cache(feed.stream(), 100), tmp_path)
    got = out(spark, tmp_path)
    assert sorted((r.cache, r.entry) for r in got if r.evicted) == sorted(gone)
    last = {c: (len(h), sum(b for b, _ in h.values())) for c, h in held.items()}
    assert {(r.cache, r.entries, r.bytes) for r in got if not r.evicted} >= {(c, *v) for c, v in last.items()}


def test_entries_live_so_long(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), "cache string, entry string, bytes long, used long")

    def keep(batch, n):
        batch.write.mode("append").parquet(f"{tmp_path}/out")

    feed.put([("x", "old", 60, 1)])
    query = timed.bounded_cache(feed.stream(), 1000, ttl_ms=1).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/state").trigger(processingTime="1 second").start()
    try:
        for n, (entry, size) in enumerate((("new", 70), ("newer", 80)), 1):
            end = time.time() + 40
            while time.time() < end and len(list((tmp_path / "out").glob("*.parquet"))) < n:
                time.sleep(0.5)
            feed.put([("x", entry, size, n + 1)])
        time.sleep(5)
    finally:
        query.stop()
    held = {(r.entries, r.bytes) for r in out(spark, tmp_path)}
    assert {(1, 60), (1, 70)} <= held <= {(1, 60), (1, 70), (1, 80)}


def test_sessions_close_and_late_events_are_dropped(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), "k string, ts timestamp")
    for rows in ([("a", 0), ("a", 50), ("b", 10)], [("a", 300)], [("a", 20), ("a", 310)], [("z", 2000)], [("z", 2001)]):
        feed.put([(k, at(s)) for k, s in rows])
        run(timed.sessions(feed.stream(), "k", "ts", "60 seconds", "30 seconds"), tmp_path, "append")
    got = sorted((r.k, int(r.start.replace(tzinfo=dt.UTC).timestamp()) - BASE, r.n) for r in out(spark, tmp_path))
    assert got == [("a", 0, 2), ("a", 300, 2), ("b", 10, 1)]  # the event at 20 came after the watermark of 270


def test_repeats_go_and_state_ends_with_the_watermark(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), "id long, ts timestamp")
    for rows in ([(1, 0), (1, 1), (2, 2)], [(1, 20), (3, 25)], [(4, 500)], [(1, 501)], [(2, 3), (5, 502)]):
        feed.put([(k, at(s)) for k, s in rows])
        run(timed.first_seen(feed.stream(), ["id"], "ts", "60 seconds"), tmp_path, "append")
    got = sorted((r.id, int(r.ts.replace(tzinfo=dt.UTC).timestamp()) - BASE) for r in out(spark, tmp_path))
    assert [k for k, _ in got] == [1, 1, 2, 3, 4, 5]  # 1 comes again after its state has gone; 2 at 3 is late
    assert got[1] == (1, 501)


def test_answers_in_time_and_questions_without(spark, tmp_path):
    asked = Feed(spark, f"{tmp_path}/q", "id long, asked timestamp")
    said = Feed(spark, f"{tmp_path}/a", "id long, said timestamp, text string")
    asked.put([(1, at(0)), (2, at(5)), (3, at(6)), (4, at(7))])
    said.put([(1, at(50), "in time"), (2, at(70), "too long"), (9, at(1), "no question"), (4, at(3), "before")])
    asked.put([(5, at(1000))])
    said.put([(3, at(20), "late"), (5, at(1010), "in time")])
    asked.put([(6, at(3000))])
    said.put([(7, at(3000), "none")])
    for outer in (False, True):
        place = f"{tmp_path}/{outer}"
        run(timed.answered(asked.stream(), said.stream(), "60 seconds", "10 seconds", outer), place, "append")
        got = {(r.id, r.text) for r in out(spark, place)}
        assert {(1, "in time"), (5, "in time")} <= got and not {(2, "too long"), (4, "before")} & got
        assert {k for k, t in got if t is None} == ({2, 4} | ({3} - {k for k, t in got if t}) if outer else set())
