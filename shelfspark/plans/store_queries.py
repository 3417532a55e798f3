"""Queries over stored tables: lookups, writes with hashes, caches, reviews, pauses, counters, log lines."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.operators import store, walks
from shelfspark.plans.lineage import scratch_path
from shelfspark.plans.reply_queries import _pick
from shelfspark.registry import query, table


@query("migrated_table", "SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE '' END AS name, CASE WHEN c_custkey % 2 = 0 THEN 'new' ELSE '' END AS note FROM customer")
def migrated_table(spark, sf_dir):
    """Odd customers were written before the table had its two later columns."""
    c = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "migrated")
    c.filter("c_custkey % 2 = 1").select(F.col("c_custkey").alias("id")).write.parquet(f"{path}/v=1")
    c.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("new").alias("note")).write.parquet(f"{path}/v=2")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("note", T.StringType())])
    return store.open_table(spark, path, schema, {"name": "", "note": ""})


@query("stored_lookup", "SELECT o_custkey AS id, c_name AS name, c_custkey IS NOT NULL AS present FROM (SELECT DISTINCT o_custkey FROM orders) LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 3 <> 0")
def stored_lookup(spark, sf_dir):
    stored = table(spark, sf_dir, "customer").filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return store.lookup(stored, table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")).distinct(), "id")


def _apps(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("id"), F.when(k % 3 == 0, "").otherwise(F.col("c_name")).alias("about"), F.when(k % 4 == 0, "").otherwise("secure").alias("security"), F.lit("t").alias("trust"), F.lit("q").alias("queries"), F.when(k % 2 == 0, F.encode(F.lit("icon"), "UTF-8")).alias("icon"), F.lit(None).cast("binary").alias("vector"), F.lit("h").alias("apk"), F.lit("").alias("files_hash"))


def _updates(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").filter("c_custkey % 5 = 0").select(k.alias("id"), F.when(k % 2 == 0, "").otherwise("new about").alias("about"), F.when(k % 3 == 0, "").otherwise("t2").alias("trust"), F.encode(F.when(k % 10 == 0, "").otherwise("i2"), "UTF-8").alias("icon"))


@query("written_hashes", "WITH a AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 AND c_custkey % 2 <> 0 THEN 'new about' WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END AS about, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'secure' END AS security, CASE WHEN c_custkey % 5 = 0 THEN CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 't2' END ELSE 't' END AS trust, CASE WHEN c_custkey % 5 = 0 AND c_custkey % 10 <> 0 THEN 'i2' WHEN c_custkey % 2 = 0 THEN 'icon' ELSE '' END AS icon FROM customer) SELECT id, about, trust, icon, CASE WHEN about || icon || security || trust = '' THEN '' ELSE sha256(strlen(about) || chr(0) || about || strlen(icon) || chr(0) || icon || strlen(security) || chr(0) || security || strlen(trust) || chr(0) || trust || '0' || chr(0)) END AS files_hash FROM a")
def written_hashes(spark, sf_dir):
    w = store.write(_apps(spark, sf_dir), _updates(spark, sf_dir))
    return w.select("id", "about", "trust", F.coalesce(F.decode("icon", "UTF-8"), F.lit("")).alias("icon"), "files_hash")


@query("apps_with_files", "SELECT c_custkey AS id, 'h' AS apk FROM customer WHERE c_custkey % 3 = 0")
def apps_with_files(spark, sf_dir):
    apps = _apps(spark, sf_dir).withColumn("files_hash", F.when(F.col("id") % 3 == 0, "x").otherwise(""))
    return store.files_by_app(apps).select("id", "apk")


@query("avatars_to_fetch", "SELECT 'p' || c_custkey AS pubkey FROM customer WHERE c_custkey % 4 <> 0 AND NOT (c_custkey % 2 = 0 AND c_custkey % 3 <> 0)")
def avatars_to_fetch(spark, sf_dir):
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer")
    key = F.concat(F.lit("p"), k).alias("pubkey")
    stored = c.filter(k % 2 == 0).select(key, F.concat(F.lit("u"), k).alias("picture"), F.encode(F.when(k % 3 == 0, "").otherwise("w"), "UTF-8").alias("webp"))
    profiles = c.select(key, F.when(k % 4 == 0, " ").otherwise(F.concat(F.lit("u"), k)).alias("picture"))
    return store.avatar_work(stored, profiles).select("pubkey")


@query("avatar_lookup", "SELECT 'p' || c_custkey AS pubkey, c_custkey % 2 = 0 AND c_custkey % 3 <> 0 AS hit FROM customer")
def avatar_lookup(spark, sf_dir):
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer")
    key = F.concat(F.lit("p"), k).alias("pubkey")
    stored = c.filter(k % 2 == 0).select(key, F.lit("u").alias("picture"), F.encode(F.when(k % 3 == 0, "").otherwise("w"), "UTF-8").alias("webp"))
    return store.avatars(stored, c.select(key)).select("pubkey", "hit")


@query("quality_written", "SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN ['ok', 'degraded', 'failed'][c_custkey % 3 + 1] ELSE 'ok' END AS quality, CASE WHEN c_custkey % 2 = 0 THEN CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'why' END ELSE 'old' END AS quality_note, CAST(CASE WHEN c_custkey % 2 = 0 THEN greatest(0, c_custkey - 50) ELSE 7 END AS BIGINT) AS took_ms FROM customer")
def quality_written(spark, sf_dir):
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer")
    target = c.select(k.alias("id"), F.lit("ok").alias("quality"), F.lit("old").alias("quality_note"), F.lit(7).cast("long").alias("took_ms"))
    runs = c.filter(k % 2 == 0).select(k.alias("id"), _pick(["ok", "degraded", "failed"], k % 3).alias("quality"), F.when(k % 3 == 0, "").otherwise("why").alias("quality_note"), (k - 50).alias("took_ms"))
    return store.set_quality(target, runs)


@query("cache_written", "WITH e AS (SELECT event_type AS kind, 'k' || user_id AS key, 'v' || event_id AS value, event_id // 50 AS \"at\", event_id % 2 AS new FROM events) SELECT kind, key, value, \"at\" FROM (SELECT *, row_number() OVER (PARTITION BY kind, key ORDER BY \"at\" DESC, new DESC, value DESC) AS n FROM e) WHERE n = 1")
def cache_written(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    rows = lambda some: e.filter(k % 2 == some).select(F.col("event_type").alias("kind"), F.concat(F.lit("k"), "user_id").alias("key"), F.concat(F.lit("v"), k).alias("value"), F.floor(k / 50).alias("at"))
    return store.cache_put(rows(0), rows(1))


# Reviews: customers are cases, their orders the actions on them.
_ACTIONS = ["approve", "reject", "restore", "save"]


@query("review_states", """WITH RECURSIVE a AS (SELECT o_custkey AS id, ['approve', 'reject', 'restore', 'save'][o_orderkey % 4 + 1] AS action, o_orderkey % 3 = 0 AS forced, ' r' || o_orderkey || ' ' AS reason, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders),
s AS (SELECT c_custkey AS id, 0::BIGINT AS n, 'pending' AS status, CASE WHEN c_custkey % 2 = 0 THEN ['draft'] ELSE ['x'] END AS tags, '' AS note, 0 AS refusals FROM customer
UNION ALL SELECT s.id, a.n,
 CASE WHEN bad THEN status WHEN action = 'approve' THEN 'approved' WHEN action = 'reject' THEN 'rejected' WHEN action = 'restore' THEN 'pending' ELSE status END,
 CASE WHEN bad THEN tags WHEN action = 'approve' THEN list_filter(tags, lambda t: t <> 'draft') || CASE WHEN list_contains(tags, 'reviewed') THEN []::VARCHAR[] ELSE ['reviewed'] END WHEN action = 'restore' THEN list_filter(tags, lambda t: t <> 'reviewed') || CASE WHEN list_contains(tags, 'draft') THEN []::VARCHAR[] ELSE ['draft'] END ELSE tags END,
 CASE WHEN bad THEN note WHEN action = 'reject' THEN 'rejected: ' || trim(reason) WHEN action = 'restore' AND starts_with(note, 'rejected: ') THEN '' ELSE note END,
 refusals + CASE WHEN bad THEN 1 ELSE 0 END
 FROM (SELECT s.id, a.n, status, tags, note, refusals, action, reason, (action IN ('approve', 'reject', 'save') AND status <> 'pending') OR (action = 'approve' AND s.id % 3 = 0 AND NOT forced) OR (action = 'restore' AND NOT (status = 'rejected' OR (status = 'approved' AND list_contains(tags, 'reviewed')))) AS bad FROM s JOIN a ON s.id = a.id AND a.n = s.n + 1) s, (SELECT 0) u, LATERAL (SELECT s.n) a(n))
SELECT id, status, array_to_string(tags, ',') AS tags, note, refusals FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC) AS k FROM s) WHERE k = 1""")
def review_states(spark, sf_dir):
    k, o = F.col("c_custkey"), F.col("o_orderkey")
    none = F.array().cast("array<string>")
    cases = table(spark, sf_dir, "customer").select(k.alias("id"), F.when(k % 2 == 0, F.array(F.lit("draft"))).otherwise(F.array(F.lit("x"))).alias("tags"), F.lit("").alias("note"), F.when(k % 3 == 0, F.array(F.lit("p"))).otherwise(none).alias("problems"))
    actions = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), o.alias("at"), _pick(_ACTIONS, o % 4).alias("action"), (o % 3 == 0).alias("forced"), F.concat(F.lit(" r"), o, F.lit(" ")).alias("reason"))
    return store.review_log(cases, actions).withColumn("tags", F.array_join("tags", ","))


@query("live_providers", "WITH f AS (SELECT event_type AS provider, event_id AS t, CASE WHEN value > 90 THEN 600 ELSE 60 END AS pause FROM events WHERE event_type <> 'click'), m AS (SELECT max(t) + 60 AS now FROM f), u AS (SELECT provider, arg_max(t + pause, t) AS until FROM f GROUP BY 1), p AS (SELECT DISTINCT event_type AS provider FROM events), l AS (SELECT provider, until IS NULL OR now >= until AS live FROM p LEFT JOIN u USING (provider), m) SELECT provider FROM l WHERE live OR NOT (SELECT bool_or(live) FROM l)")
def live_providers(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    failures = e.filter("event_type <> 'click'").select(F.col("event_type").alias("provider"), F.col("event_id").alias("at"), F.when(F.col("value") > 90, 600).otherwise(60).alias("pause"))
    now = failures.agg((F.max("at") + 60).alias("now")).first()["now"]
    providers = e.select(F.col("event_type").alias("provider"), F.lit(0).alias("pos")).distinct()
    return store.live_providers(providers, failures, F.lit(now)).select("provider")


@query("model_usage", "SELECT event_type AS model, count(*) AS calls, CAST(count(*) FILTER (event_id % 3 = 0) AS BIGINT) AS cached_calls, CAST(sum(event_id % 100) AS BIGINT) AS prompt, CAST(sum(event_id % 7) AS BIGINT) AS completion, CAST(0 AS BIGINT) AS reasoning FROM events GROUP BY 1")
def model_usage(spark, sf_dir):
    k = F.col("event_id")
    calls = table(spark, sf_dir, "events").select(F.col("event_type").alias("model"), (k % 3 == 0).alias("cached"), (k % 100).alias("prompt"), (k % 7).alias("completion"), F.lit(0).cast("long").alias("reasoning"))
    return store.usage(calls, ["model"])


@query("repair_counts", "SELECT user_id, CAST(count(*) FILTER (event_type = 'error') AS BIGINT) AS repairs FROM events GROUP BY user_id")
def repair_counts(spark, sf_dir):
    lines = table(spark, sf_dir, "events").select("user_id", F.when(F.col("event_type") == "error", "10:00: repair: fixed").otherwise("repair none").alias("value"))
    return store.repairs(lines, ["user_id"])


@query("tolerant_ids", "SELECT DISTINCT 'u' || user_id AS id FROM events WHERE event_id % 3 = 0")
def tolerant_ids(spark, sf_dir):
    k = F.col("event_id")
    line = F.when(k % 3 == 0, F.concat(F.lit('{"id":"u'), F.col("user_id"), F.lit('","x":1}'))).when(k % 3 == 1, '{"id": "broken"').otherwise('{"other":1}')
    return store.json_ids(table(spark, sf_dir, "events").select(line.alias("value")))


PLAN = [("a", ["a1", "a2"]), ("b", ["b1"]), ("c", ["c1", "c2"])]
_MODELS = ", ".join(f"({k}, '{p}', '{m}', {n})" for k, (p, m, n) in enumerate((p, m, n) for p, ms in PLAN for n, m in enumerate(ms)))


# Nobody is down for long here, so every request walks alone; pauses that last are tested against a plain walk.
@query("model_walks", f"""WITH m(k, provider, model, n) AS (VALUES {_MODELS}),
o AS (SELECT event_id, user_id, m.*, (event_id * 7 + k * 3) % 4 AS first, (event_id + k) % 3 AS second FROM events, m),
e AS (SELECT *, first = 0 OR (first = 1 AND second = 0) AS good, lag(first = 2, 1, false) OVER (PARTITION BY event_id, provider ORDER BY n) AS ended FROM o),
r AS (SELECT event_id, min(k) AS k FROM e WHERE good AND NOT ended GROUP BY event_id)
SELECT x.user_id, x.event_id, provider, model, coalesce(first = 1, false) AS repaired FROM events x LEFT JOIN (SELECT e.* FROM e JOIN r USING (event_id, k)) y ON y.event_id = x.event_id""")
def model_walks(spark, sf_dir):
    """Events as requests of users; what each model would give is dealt by the event's number."""
    e = table(spark, sf_dir, "events")
    known = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(p).alias("provider"), F.lit(m).alias("model")) for k, (p, m) in enumerate((p, m) for p, ms in PLAN for m in ms)])
    first = _pick(["ok", "rejected", "down", "failed"], (F.col("event_id") * 7 + F.col("k") * 3) % 4)
    second = _pick(["ok", "rejected", "failed"], (F.col("event_id") + F.col("k")) % 3)
    outcomes = e.select("event_id", F.inline(known)).select("event_id", "provider", "model", first.alias("first"), second.alias("second"), F.lit(0).alias("pause"))
    requests = e.select("user_id", "event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("at"))
    return walks.walk(requests, outcomes, PLAN, "user_id", "event_id").select("user_id", "event_id", "provider", "model", "repaired")
