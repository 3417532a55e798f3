"""Queries over events, orders and vectors: facts, caches, merges, plans, backoff, windows, vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.functions import vectors
from shelfspark.operators import facts, joins, ordered, tables
from shelfspark.operators.keyed_table import KeyedTable
from shelfspark.plans.lineage import scratch_path
from shelfspark.registry import query, table

_FACTS = """r AS (SELECT user_id, event_type AS fact, CASE WHEN value >= 50 THEN 'yes' ELSE 'no' END AS value, event_id AS pos, CASE WHEN event_id % 3 = 0 THEN 'because ' || event_id ELSE '' END AS reason, 'e' || (event_id % 7) || ', e' || (event_id % 5) AS evidence FROM events),
y AS (SELECT user_id, fact, max(value) AS value, min(pos) AS pos, min(CASE WHEN value = 'yes' THEN pos END) AS yp, arg_min(reason, pos) FILTER (reason <> '') AS any_reason FROM r GROUP BY 1, 2),
v AS (SELECT user_id, fact, string_agg(e, ', ' ORDER BY e) AS evidence FROM (SELECT DISTINCT user_id, fact, trim(unnest(string_split(evidence, ','))) AS e FROM r) GROUP BY 1, 2),
f AS (SELECT y.user_id, y.fact, y.value, coalesce(nullif(o.reason, ''), any_reason, '') AS reason, v.evidence, y.pos FROM y JOIN v USING (user_id, fact) LEFT JOIN r o ON o.user_id = y.user_id AND o.fact = y.fact AND o.pos = y.yp)"""


def _fact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    text = lambda c: F.col(c).cast("string")
    return e.select("user_id", F.col("event_type").alias("fact"), F.when(F.col("value") >= 50, "yes").otherwise("no").alias("value"), F.col("event_id").alias("pos"), F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("because "), text("event_id"))).otherwise("").alias("reason"), F.concat(F.lit("e"), (F.col("event_id") % 7).cast("string"), F.lit(", e"), (F.col("event_id") % 5).cast("string")).alias("evidence"))


@query("facts_one_per_fact", f"WITH {_FACTS} SELECT user_id, fact, value, reason, evidence FROM f")
def facts_one_per_fact(spark, sf_dir):
    return facts.one_per_fact(_fact_rows(spark, sf_dir), ["user_id"]).select("user_id", "fact", "value", "reason", "evidence")


@query("facts_csv_text", f"""WITH {_FACTS} SELECT user_id, string_agg('"' || fact || '","' || value || '","' || concat_ws('. ', nullif(evidence, ''), nullif(reason, '')) || '"', chr(10) ORDER BY pos) AS csv FROM f GROUP BY user_id""")
def facts_csv_text(spark, sf_dir):
    return facts.facts_csv(facts.one_per_fact(_fact_rows(spark, sf_dir), ["user_id"]), ["user_id"])


@query("security_doc_json", f"""WITH {_FACTS}, a AS (SELECT user_id, string_agg('"' || fact || '":' || CASE value WHEN 'yes' THEN 'true' ELSE 'false' END, ',' ORDER BY fact) FILTER (value = 'yes' OR fact IN ('click', 'error')) AS facts, string_agg('"' || fact || '":"' || evidence || '"', ',' ORDER BY fact) FILTER (value = 'yes') AS notes FROM f GROUP BY 1) SELECT user_id, '{{"facts":{{' || coalesce(facts, '') || '}}' || coalesce(',"notes":{{' || notes || '}}', '') || '}}' AS json FROM a""")
def security_doc_json(spark, sf_dir):
    return facts.security_json(facts.one_per_fact(_fact_rows(spark, sf_dir), ["user_id"]), ["user_id"], ("click", "error"))


@query("latest_event_per_user", "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS n FROM events) WHERE n = 1")
def latest_event_per_user(spark, sf_dir):
    return ordered.latest(table(spark, sf_dir, "events").select("user_id", "ts", "event_id"), "user_id", "ts", "event_id").select("user_id", "event_id")


_CACHE = "c AS (SELECT event_type AS kind, CAST(user_id AS VARCHAR) AS key, CAST(floor(epoch(ts)) AS BIGINT) AS at_s, props AS value FROM events), m AS (SELECT max(at_s) AS now_s FROM c)"


def _cache(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("kind"), F.col("user_id").cast("string").alias("key"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("at"), F.col("props").alias("value"))


@query("cache_ttl_lookup", f"WITH {_CACHE}, w AS (SELECT DISTINCT kind, key FROM c), n AS (SELECT kind, key, max(at_s) AS at_s FROM c GROUP BY 1, 2) SELECT kind, key, coalesce(m.now_s - n.at_s <= 7 * 86400, false) AS hit FROM w LEFT JOIN n USING (kind, key), m")
def cache_ttl_lookup(spark, sf_dir):
    c = _cache(spark, sf_dir)
    got = tables.cache_get(c, c.select("kind", "key").distinct().join(F.broadcast(c.agg(F.max("at").alias("now")))), F.col("now"), F.lit(7 * 86400))
    return got.select("kind", "key", "hit")


@query("cache_prune", f"WITH {_CACHE} SELECT kind, CAST(count(*) FILTER (at_s >= now_s - 5 * 86400) AS BIGINT) AS kept, CAST(count(*) FILTER (at_s < now_s - 5 * 86400) AS BIGINT) AS dropped FROM c, m GROUP BY kind")
def cache_prune(spark, sf_dir):
    c = _cache(spark, sf_dir)
    now = c.agg(F.max("at").alias("now"))
    kept = tables.prune(c.join(F.broadcast(now)), F.col("now") - 5 * 86400).groupBy("kind").agg(F.count(F.lit(1)).alias("kept"))
    return c.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).join(kept, "kind", "left").select("kind", F.coalesce("kept", F.lit(0)).alias("kept"), (F.col("n") - F.coalesce("kept", F.lit(0))).alias("dropped"))


_UPSERT = "WITH u AS (SELECT c_custkey + 10 AS k, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'seg' || (c_custkey % 5) END AS s, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal + 1 END AS b FROM customer WHERE c_custkey % 2 = 0) SELECT coalesce(c_custkey, k) AS c_custkey, CASE WHEN coalesce(s, '') <> '' THEN s ELSE c_mktsegment END AS c_mktsegment, coalesce(b, c_acctbal) AS c_acctbal FROM customer FULL JOIN u ON c_custkey = k"


@query("upsert_merge", _UPSERT)
def upsert_merge(spark, sf_dir):
    return tables.merge(*_customers(spark, sf_dir), "c_custkey")


def _customers(spark, sf_dir):
    """Customers, and updates of half of them and some that aren't there."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    u = c.filter("c_custkey % 2 = 0").select((F.col("c_custkey") + 10).alias("c_custkey"), F.when(F.col("c_custkey") % 4 == 0, "").otherwise(F.concat(F.lit("seg"), (F.col("c_custkey") % 5).cast("string"))).alias("c_mktsegment"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal") + 1).alias("c_acctbal"))
    return c, u


@query("bucketed_upsert", f"SELECT * FROM ({_UPSERT}) WHERE c_custkey % 7 <> 0 AND coalesce(c_acctbal, 0) >= 0")
def bucketed_upsert(spark, sf_dir):
    """The same upsert in a table of buckets, then a delete and a prune, each a generation of its own."""
    customers, updates = _customers(spark, sf_dir)
    stored = KeyedTable(spark, scratch_path(spark, "keyed"))
    stored.create(customers, "c_custkey", 32)
    stored.upsert(updates)
    stored.delete(stored.read().filter("c_custkey % 7 = 0"))
    stored.prune(F.col("c_acctbal") < 0)
    return stored.read()


@query("bucketed_lookup", f"SELECT * FROM ({_UPSERT}) WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def bucketed_lookup(spark, sf_dir):
    customers, updates = _customers(spark, sf_dir)
    stored = KeyedTable(spark, scratch_path(spark, "keyed"))
    stored.create(customers, "c_custkey", 32)
    stored.upsert(updates)
    return stored.lookup(table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")))


@query("delete_then_anti", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def delete_then_anti(spark, sf_dir):
    gone = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return tables.delete(table(spark, sf_dir, "customer").select("c_custkey"), gone, "c_custkey")


BACKOFF_SQL = "SELECT user_id, CAST(count(*) AS BIGINT) AS tries, CAST(max(CAST(floor(epoch(ts)) AS BIGINT)) + CASE WHEN count(*) > 5 THEN 2592000 ELSE least(2592000, 86400 * CAST(pow(2, count(*) - 1) AS BIGINT)) END AS BIGINT) AS until FROM events WHERE event_type = 'error' GROUP BY user_id"


@query("refusal_backoff", BACKOFF_SQL)
def refusal_backoff(spark, sf_dir):
    e = table(spark, sf_dir, "events").filter("event_type = 'error'").select("user_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("at"))
    return tables.refusals(e, "user_id", "at")


@query("lru_evict", "SELECT doc_id, doc_id < 20 OR sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id DESC ROWS UNBOUNDED PRECEDING) > 40000 AS evicted FROM documents")
def lru_evict(spark, sf_dir):
    return ordered.evict(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), ["source"], "doc_id", "n_chars", 40_000, 20).select("doc_id", "evicted")


@query("budget_prefix", "WITH w AS (SELECT source, n_chars, coalesce(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM documents) SELECT source, CAST(count(*) AS BIGINT) AS kept, CAST(sum(n_chars) AS BIGINT) AS bytes FROM w WHERE used <= 12000 GROUP BY source")
def budget_prefix(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    return ordered.budget_prefix(d, ["source"], ["doc_id"], F.col("n_chars"), 12_000).groupBy("source").agg(F.count(F.lit(1)).alias("kept"), F.sum("n_chars").alias("bytes"))


@query("cap_per_group_then_global", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents) WHERE n <= 6 ORDER BY doc_id LIMIT 48")
def cap_per_group_then_global(spark, sf_dir):
    return ordered.cap_then_limit(table(spark, sf_dir, "documents").select("doc_id", "source"), ["source"], ["doc_id"], 6, 48).select("doc_id")


@query("context_frames", "SELECT conv_id, turn, CAST(count(*) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 3 FOLLOWING) AS BIGINT) AS n_ctx FROM conversations")
def context_frames(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return ordered.frame(c, ["conv_id"], "turn", "role", 2, 3).select("conv_id", "turn", F.size("context").cast("long").alias("n_ctx"))


@query("islands_merge", "WITH s AS (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS b, CAST(floor(epoch(ts)) AS BIGINT) + 3600 * (1 + event_id % 30) AS e FROM events), m AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY b, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM s), n AS (SELECT *, sum(CASE WHEN r IS NULL OR b > r THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY b, e ROWS UNBOUNDED PRECEDING) AS i FROM m) SELECT user_id, min(b) AS begin, max(e) AS stop FROM n GROUP BY user_id, i")
def islands_merge(spark, sf_dir):
    at = F.unix_timestamp(F.col("ts").cast("timestamp"))
    s = table(spark, sf_dir, "events").select("user_id", at.alias("begin"), (at + 3600 * (1 + F.col("event_id") % 30)).alias("stop"))
    return ordered.islands(s, ["user_id"], "begin", "stop")


@query("nearest_within_range", "WITH p AS (SELECT event_id, user_id, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events WHERE event_type = 'purchase'), s AS (SELECT event_id AS id, user_id, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events WHERE event_type = 'signup'), j AS (SELECT p.event_id, s.id, row_number() OVER (PARTITION BY p.event_id ORDER BY abs(p.t - s.t), s.t, s.id) AS n FROM p JOIN s ON p.user_id = s.user_id AND abs(p.t - s.t) <= 720000) SELECT p.event_id, j.id AS match FROM p LEFT JOIN j ON p.event_id = j.event_id AND n = 1")
def nearest_within_range(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("t"))
    return ordered.nearest_within(e.filter("event_type = 'purchase'"), e.filter("event_type = 'signup'"), ["user_id"], "t", 720_000, "event_id").select("event_id", "match")


# Repositories are parts; each line item tags a version of its part, each part asks for one.
@query("closest_version", """WITH t AS (SELECT l_partkey AS repo, l_orderkey * 10 + l_linenumber AS pos, l_suppkey % 3 AS major, l_linenumber AS minor, l_orderkey % 50 AS patch, CASE WHEN l_returnflag = 'R' THEN 'rc' || (l_suppkey % 4) ELSE '' END AS pre FROM lineitem),
n AS (SELECT *, CASE WHEN pos % 2 = 0 THEN 'v' ELSE 'app-' END || major || '.' || minor || '.' || patch || CASE WHEN pre <> '' THEN '-' || pre ELSE '' END AS tag FROM t),
w AS (SELECT p_partkey AS repo, p_size % 3 AS wmajor, p_size % 8 AS wminor, p_partkey % 50 AS wpatch, CASE WHEN p_partkey % 5 = 0 THEN 'rc1' ELSE '' END AS wpre FROM part),
a AS (SELECT *, wmajor || '.' || wminor || '.' || wpatch || CASE WHEN wpre <> '' THEN '-' || wpre ELSE '' END AS version FROM w),
m AS (SELECT *, tag = 'v' || version AS same, abs(minor - wminor) * 1000 + abs(patch - wpatch) + CASE WHEN pre <> wpre THEN 1 ELSE 0 END AS far, (minor, patch, pre = '', pre) > (wminor, wpatch, wpre = '', wpre) AS newer FROM a JOIN n USING (repo) WHERE major = wmajor),
r AS (SELECT repo, tag, row_number() OVER (PARTITION BY repo ORDER BY same DESC, CASE WHEN same THEN 0 ELSE far END, newer, CASE WHEN newer THEN minor ELSE -minor END, CASE WHEN newer THEN patch ELSE -patch END, CASE WHEN newer THEN (pre = '')::INT ELSE -(pre = '')::INT END, CASE WHEN newer THEN pre ELSE '' END, CASE WHEN newer THEN '' ELSE pre END DESC, pos) AS k FROM m)
SELECT a.repo, version, tag FROM a LEFT JOIN r ON r.repo = a.repo AND k = 1""")
def closest_version(spark, sf_dir):
    text = lambda c: c.cast("string")
    dotted = lambda *parts: F.concat_ws(".", *[text(p) for p in parts])
    li = table(spark, sf_dir, "lineitem")
    pos = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    pre = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("-rc"), text(F.col("l_suppkey") % 4))).otherwise("")
    tags = li.select(F.col("l_partkey").alias("repo"), pos.alias("pos"), F.concat(F.when(pos % 2 == 0, "v").otherwise("app-"), dotted(F.col("l_suppkey") % 3, F.col("l_linenumber"), F.col("l_orderkey") % 50), pre).alias("tag"))
    wanted = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("repo"), F.concat(dotted(F.col("p_size") % 3, F.col("p_size") % 8, F.col("p_partkey") % 50), F.when(F.col("p_partkey") % 5 == 0, "-rc1").otherwise("")).alias("version"))
    return joins.closest_version(wanted, tags, "repo")


_PLAN = """o AS (SELECT o_orderkey, CAST(o_custkey % 7 AS VARCHAR) AS apk, o_orderpriority AS feature, CAST(o_custkey % 5 AS VARCHAR) AS facts, CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE 'c' END AS commit, o_orderkey % 3 <> 0 AS repo, o_orderkey % 4 = 0 AS need_readme, o_orderkey % 5 <> 0 AS has_about, o_orderkey % 7 <> 0 AS has_security, o_orderkey % 8 <> 0 AS has_icon, o_orderkey % 9 <> 0 AS has_vector, o_orderkey % 10 <> 0 AS has_facts FROM orders),
p AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN 3 ELSE 4 END AS version, CAST(o_custkey % 7 + (CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END) AS VARCHAR) AS apk, CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE o_orderpriority END AS feature, CAST(o_custkey % 5 AS VARCHAR) AS facts, CASE o_orderkey % 3 WHEN 0 THEN 'apk' WHEN 1 THEN 'none' ELSE 'listing' END AS icon FROM orders WHERE o_orderkey % 12 <> 0),
m AS (SELECT o.*, CASE WHEN p.version = 4 THEN p.apk ELSE '' END AS mapk, CASE WHEN p.version = 4 THEN p.feature ELSE '' END AS mfeature, CASE WHEN p.version = 4 THEN p.facts ELSE '' END AS mfacts, CASE WHEN p.version = 4 THEN p.icon ELSE '' END AS micon FROM o LEFT JOIN p ON k = o_orderkey),
w AS (SELECT *, apk <> mapk OR NOT has_facts AS scan, feature <> mfeature OR NOT has_about AS about, NOT has_security OR facts <> mfacts AS security, feature <> mfeature OR NOT has_vector AS vector FROM m),
x AS (SELECT *, (NOT has_icon AND micon <> 'none') OR (NOT (micon = 'apk' AND apk = mapk) AND scan) AS icon FROM w)"""


def _planned(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    flag = lambda n: (k % n != 0)
    orders = table(spark, sf_dir, "orders")
    seen = orders.select(k, F.struct((c % 7).cast("string").alias("apk"), F.col("o_orderpriority").alias("feature"), (c % 5).cast("string").alias("facts"), F.when(k % 6 == 0, "").otherwise("c").alias("commit"), flag(3).alias("repo"), (k % 4 == 0).alias("need_readme"), flag(5).alias("has_about"), flag(7).alias("has_security"), flag(8).alias("has_icon"), flag(9).alias("has_vector"), flag(10).alias("has_facts")).alias("seen"))
    memo = orders.filter("o_orderkey % 12 <> 0").select(k.alias("k"), F.struct(F.when(k % 11 == 0, 3).otherwise(4).alias("version"), (c % 7 + F.when(k % 13 == 0, 1).otherwise(0)).cast("string").alias("apk"), F.when(k % 17 == 0, "").otherwise(F.col("o_orderpriority")).alias("feature"), (c % 5).cast("string").alias("facts"), F.when(k % 3 == 0, "apk").when(k % 3 == 1, "none").otherwise("listing").alias("icon")).alias("memo"))
    return seen.join(memo, k == F.col("k"), "left")


@query("plan_work", f"WITH {_PLAN} SELECT o_orderkey, repo AND commit <> '' AND (about OR security OR (need_readme AND mfeature = '')) AS clone, scan OR icon AS download, scan, icon, about, security, vector FROM x")
def plan_work(spark, sf_dir):
    return _planned(spark, sf_dir).select("o_orderkey", tables.plan_work(F.col("memo"), F.col("seen")).alias("w")).select("o_orderkey", "w.*")


@query("next_memo", "SELECT o_orderkey, 4 AS version, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 = 0 THEN 'new' ELSE o_orderstatus END AS apk, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 = 0 THEN 'nf' ELSE o_orderpriority END AS facts, CASE WHEN o_orderkey % 5 = 0 THEN 'na' ELSE 'oa' END AS about, CASE WHEN o_orderkey % 5 = 0 AND o_orderkey % 7 = 0 THEN 'nx' ELSE 'ox' END AS feature, CASE WHEN o_orderkey % 2 = 1 THEN 'apk' ELSE 'none' END AS icon FROM orders")
def next_memo(spark, sf_dir):
    k = F.col("o_orderkey")
    prev = F.struct(F.col("o_orderstatus").alias("apk"), F.col("o_orderpriority").alias("facts"), F.lit("oa").alias("about"), F.lit("ox").alias("feature"), F.lit("none").alias("icon"))
    new = F.struct(F.lit("new").alias("apk"), F.lit("nf").alias("facts"), F.lit("na").alias("about"), F.lit("nx").alias("feature"), F.lit("apk").alias("icon"))
    done = F.struct((k % 2 == 0).alias("scan"), (k % 3 == 0).alias("security"), (k % 5 == 0).alias("about"), (k % 7 == 0).alias("vector"), F.lit(True).alias("feature"), (k % 2 == 1).alias("icon"))
    return table(spark, sf_dir, "orders").select(k, tables.next_memo(prev, new, done).alias("m")).select("o_orderkey", "m.*")


# Runs of users: their events are marks of stages, those of every second user planned two stages beside.
_OUTCOME = """WITH m AS (SELECT user_id, event_type AS stage, CASE WHEN event_type = 'error' AND value > 90 THEN 'failed' WHEN event_type IN ('error', 'view') THEN 'degraded' ELSE 'ok' END AS kind FROM events WHERE user_id % 7 <> 0),
s AS (SELECT user_id, list(DISTINCT stage) FILTER (kind = 'failed') AS bad, list(DISTINCT stage) FILTER (kind = 'degraded') AS fallback, list(DISTINCT stage) FILTER (kind <> 'failed') AS done FROM m GROUP BY 1),
p AS (SELECT user_id, CASE WHEN user_id % 2 = 0 THEN ['purchase', 'click'] ELSE []::VARCHAR[] END AS plan FROM (SELECT DISTINCT user_id FROM events)),
j AS (SELECT user_id, coalesce(bad, []) AS bad, coalesce(fallback, []) AS fallback, list_sort(list_filter(plan, lambda x: NOT list_contains(coalesce(bad, []), x) AND NOT list_contains(coalesce(done, []), x))) AS missed FROM p LEFT JOIN s USING (user_id))
SELECT user_id, CASE WHEN len(bad) > 0 OR len(missed) > 0 THEN 'failed' WHEN len(fallback) > 0 THEN 'degraded' ELSE 'ok' END AS quality, array_to_string(missed, ',') AS missed FROM j"""


def _outcome(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    kind = F.when((F.col("event_type") == "error") & (F.col("value") > 90), "failed").when(F.col("event_type").isin("error", "view"), "degraded").otherwise("ok")
    marks = e.filter("user_id % 7 <> 0").select("user_id", F.col("event_type").alias("stage"), kind.alias("kind"))
    planned = F.when(F.col("user_id") % 2 == 0, F.array(F.lit("purchase"), F.lit("click"))).otherwise(F.array().cast("array<string>"))
    return tables.run_outcome(marks, e.select("user_id").distinct().select("user_id", planned.alias("stages")), "user_id")


@query("run_outcome", _OUTCOME)
def run_outcome(spark, sf_dir):
    return _outcome(spark, sf_dir).withColumn("missed", F.array_join("missed", ","))


@query("run_summary", f"WITH q AS ({_OUTCOME}) SELECT CAST(count(*) FILTER (quality = 'ok') AS BIGINT) AS ok, CAST(count(*) FILTER (quality = 'degraded') AS BIGINT) AS degraded, CAST(count(*) FILTER (quality = 'failed') AS BIGINT) AS failed FROM q")
def run_summary(spark, sf_dir):
    return tables.run_summary(_outcome(spark, sf_dir))


@query("review_state", "SELECT user_id, CASE arg_max(event_type, event_id) WHEN 'purchase' THEN 'approved' WHEN 'error' THEN 'rejected' ELSE 'pending' END AS status FROM events GROUP BY user_id")
def review_state(spark, sf_dir):
    action = F.when(F.col("event_type") == "purchase", "approve").when(F.col("event_type") == "error", "reject").otherwise("restore")
    return tables.review_state(table(spark, sf_dir, "events").select("user_id", "event_id", action.alias("action")), "user_id", "event_id")


@query("sheet_vs_scan_outer", "WITH a AS (SELECT user_id, event_type AS fact, count(*) AS n, arg_min(CASE WHEN value > 50 THEN 'yes' ELSE 'no' END, event_id) AS v FROM events WHERE event_id % 2 = 0 GROUP BY 1, 2), b AS (SELECT user_id, event_type AS fact, CASE WHEN max(value) > 70 THEN 'yes' ELSE 'no' END AS s FROM events WHERE event_id % 2 = 1 GROUP BY 1, 2) SELECT user_id, fact, CASE WHEN s IS NULL THEN 'extra' WHEN v IS NULL THEN 'missing' WHEN n > 1 THEN 'duplicate' WHEN v <> s THEN 'wrong' ELSE 'same' END AS status FROM a FULL JOIN b USING (user_id, fact)")
def sheet_vs_scan_outer(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("fact"), "event_id", "value")
    reply = e.filter("event_id % 2 = 0").select("user_id", "fact", F.when(F.col("value") > 50, "yes").otherwise("no").alias("value"), F.col("event_id").alias("pos"))
    scan = e.filter("event_id % 2 = 1").groupBy("user_id", "fact").agg(F.when(F.max("value") > 70, "yes").otherwise("no").alias("value"))
    return tables.compare_facts(reply, scan, ["user_id"])


@query("quantize_vectors", "SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, CAST(greatest(-127, least(127, round(CAST(embedding[i] AS DOUBLE) / (0.3::DOUBLE / 127)))) AS TINYINT) AS q FROM embeddings, (SELECT unnest(range(1, 65)) AS i)")
def quantize_vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(vectors.quantize(F.col("embedding"))).alias("pos", "q"))


@query("l2_norms", "SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS norm FROM embeddings")
def l2_norms(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(vectors.norm(F.col("embedding")), 6).alias("norm"))


@query("mean_pool_by_label", "WITH e AS (SELECT label, CAST(i - 1 AS INTEGER) AS pos, CAST(embedding[i] AS DOUBLE) AS x FROM embeddings, (SELECT unnest(range(1, 65)) AS i)) SELECT label, pos, round(avg(x), 6) AS mean FROM e GROUP BY label, pos")
def mean_pool_by_label(spark, sf_dir):
    return vectors.mean_pool(table(spark, sf_dir, "embeddings"), "label", "embedding").select("label", "pos", F.round("mean", 6).alias("mean"))


_Q = "SELECT vec_id, list_transform(embedding, lambda x: CAST(greatest(-127, least(127, round(CAST(x AS DOUBLE) / (0.3::DOUBLE / 127)))) AS INTEGER)) AS v FROM embeddings"


# Queries are the vectors whose id is divisible by 20, against all.
@query("topk_int8_dot", f"WITH v AS ({_Q}), d AS (SELECT a.vec_id AS query, b.vec_id, CAST(list_sum(list_transform(range(1, 65), lambda i: a.v[i] * b.v[i])) AS INTEGER) AS dot FROM v a, v b WHERE a.vec_id % 20 = 0) SELECT query, CAST(rank AS INTEGER) AS rank, vec_id, dot FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY dot DESC, vec_id) AS rank FROM d) WHERE rank <= 10")
def topk_int8_dot(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").select("vec_id", vectors.quantize(F.col("embedding")).alias("v"))
    return vectors.top_k(v.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query"), F.col("v").alias("q")), v, 10)


@query("topk_inverted_lists")
def topk_inverted_lists(spark, sf_dir):
    """The same search in inverted lists: nearly all of the neighbours that ``topk_int8_dot`` finds, from some of the lists."""
    v = table(spark, sf_dir, "embeddings").select("vec_id", vectors.quantize(F.col("embedding")).alias("v"))
    return vectors.inverted_lists(v.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query"), F.col("v").alias("q")), v, 10)
