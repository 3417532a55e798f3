"""Queries over lines and files of source: predicates, calls, scores, budgets, quotes. Code is dealt to lineitems and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.functions import urls
from shelfspark.operators import digest, quotes
from shelfspark.plans.reply_queries import _pick
from shelfspark.plans.scan_queries import _list, _quoted
from shelfspark.registry import query, table

LINES = [
    "import okhttp3.Request.Builder", "  val r = Request.Builder().url(BASE_URL)", "client.post(\"https://api.acme.io/v1\") { token }", "}", "// http.get(x)", "val API_URL = \"https://acme.io/\"", "val page = \"https://acme.io/\"",
    "requestPermissions(arrayOf(CAMERA))", "fun login(user: String) {", "auth.signIn(user)", "private fun send(x: Int) = x", "});", "if (x) { SmsManager.getDefault() }", "out.write(location.latitude)", "def run(self):", "   ", "val placeholder = http.get(u)", "class A(private val x: Int)",
    "fusedLocationProvider.getLastLocation()", "contentResolver.query(ContactsContract.X)", "package com.acme", "RequestBody.create(email)", "webView.addJavascriptInterface(this)", "return",
]
CALLEES = ["client.post", "api?.get", "fetch", "window.fetch", "call.execute(", "socket.send", "Foo::upload", "httpClient.upload<T>", "okHttp.x", "smsManager.sendTextMessage", "getAndroidId", "list.get", "LocationManager.x", "recorder.startRecording", "camera.takePicture"]
FILES = ["app/src/Main.kt", "app/src/test/MainTest.kt", "lib/a_test.go", "web/x.js", "src/androidTest/T.java", "b/Other.kt"]
_ROWS = f"r AS (SELECT l_orderkey AS tree_id, (l_linenumber * 100000 + l_partkey) * 100000 + l_suppkey AS line, {_list(FILES)}[l_suppkey % 6 + 1] AS path, {_list(LINES)}[l_partkey % 24 + 1] AS text, {_list(CALLEES)}[l_partkey % 15 + 1] AS callee FROM lineitem)"


def _rows(spark, sf_dir):
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("tree_id"), ((F.col("l_linenumber") * 100000 + p) * 100000 + s).alias("line"), _pick(FILES, s % 6).alias("path"), _pick(LINES, p % 24).alias("text"), _pick(CALLEES, p % 15).alias("callee"))


def _any(x: str, parts) -> str:
    return "(" + " OR ".join(f"contains({x}, {_quoted(p)})" for p in parts) + ")"


@query("line_kinds", f"WITH {_ROWS}, l AS (SELECT *, lower(trim(text)) AS low FROM r) SELECT tree_id, line, low <> '' AND NOT regexp_matches(low, '^(import |//|[*]|/[*])') AND NOT contains(low, 'placeholder') AND ({_any('low', quotes.SENDS)} OR (regexp_matches(text, '{urls.HOST}') AND {_any('low', quotes.ENDPOINTS)})) AS sends, {_any('lower(text)', quotes.CHOICES)} AS choice, NOT regexp_matches(low, '^(//|import |package )') AND {_any('low', quotes.ACCOUNTS)} AS account, regexp_matches(text, '[^\\x00-\\x20{{}}()\\[\\],;:]') AS code, low <> '' AND NOT regexp_matches(low, '^(//|[*]|import )') AND (regexp_matches(low, '^(fun|func|def|function|fn) ') OR (contains(low, '(') AND {_any('low', quotes.INNER_HEADS)})) AS head, contains(lower(path), '/test/') OR contains(lower(path), '/androidtest/') OR ends_with(lower(path), '_test.go') AS test FROM l")
def line_kinds(spark, sf_dir):
    t = F.col("text")
    return _rows(spark, sf_dir).select("tree_id", "line", quotes.sends(t).alias("sends"), quotes.is_choice(t).alias("choice"), quotes.is_account(t).alias("account"), quotes.is_code(t).alias("code"), quotes.is_head(t).alias("head"), quotes.test_path(F.col("path")).alias("test"))


_TAIL = "CASE WHEN contains(callee, '?.') THEN string_split(callee, '?.')[-1] WHEN contains(callee, '::') THEN string_split(callee, '::')[-1] ELSE string_split(callee, '.')[-1] END"
_DEVICE = "CASE " + " ".join(f"WHEN {_any('low', parts)} THEN '{fact}'" for fact, parts in quotes.DEVICE_CALLS) + " ELSE '' END"


@query("call_kinds", f"WITH {_ROWS}, c AS (SELECT tree_id, line, callee, lower(callee) AS low, regexp_extract({_TAIL}, '^[^(< ]*') AS name FROM r), n AS (SELECT *, lower(name) AS last FROM c) SELECT tree_id, line, name, CASE WHEN {_any('low', ('httpurlconnection', 'okhttp', 'enqueue', 'newcall', 'openconnection', 'xmlhttprequest', 'websocket'))} THEN true WHEN last IN ('post', 'put', 'patch', 'delete', 'get') THEN {_any('low', ('client.', 'http.', 'httpclient', 'api.', 'retrofit', 'socket.'))} WHEN last = 'fetch' THEN NOT contains(low, '.') WHEN last = 'execute' THEN {_any('low', ('call.', 'request.', 'http'))} WHEN last = 'send' THEN {_any('low', ('socket', 'web_socket'))} WHEN last = 'upload' THEN {_any('low', ('http', 'client', 'request'))} ELSE false END AS sends, {_DEVICE} AS device, strlen(name) >= 4 AND last NOT IN ({', '.join(map(_quoted, quotes.COMMON_CALLS))}) AS linkable FROM n")
def call_kinds(spark, sf_dir):
    c = F.col("callee")
    return _rows(spark, sf_dir).select("tree_id", "line", quotes.last_name(c).alias("name"), quotes.sends_data(c).alias("sends"), quotes.device_fact(c).alias("device"), quotes.linkable(quotes.last_name(c)).alias("linkable"))


_GROUPS = f"""q AS (SELECT tree_id, path, line, text FROM r WHERE regexp_matches(text, '[^\\x00-\\x20{{}}()\\[\\],;:]')),
g AS (SELECT tree_id, path, string_agg(text, chr(10) ORDER BY line) AS text, count(*) AS n FROM q GROUP BY 1, 2),
h AS (SELECT *, lower(text) AS low, array_to_string(list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(text, '{urls.HOST}', 1), lambda x: lower(x)), lambda x: x NOT IN ('github.com')))), ', ') AS domains FROM g)"""
_SCORE = f"CASE WHEN {_any('low', quotes.BODIES)} AND {_any('low', quotes.USER_DATA)} THEN 3 WHEN {_any('low', quotes.BODIES)} THEN 2 WHEN domains <> '' THEN 1 ELSE 0 END + CASE WHEN {_any('low', quotes.DEVICE_TOKENS)} THEN 3 ELSE 0 END"
_PAYLOAD = "concat_ws(', ', " + ", ".join(f"CASE WHEN contains(low, '{p}')" + (f" OR contains(low, '{p.replace(' ', '')}')" if " " in p else "") + f" THEN '{p}' END" for p in quotes.PAYLOADS) + ")"


@query("outbound_groups", f"WITH {_ROWS}, {_GROUPS}, s AS (SELECT tree_id, path, CAST({_SCORE} AS INTEGER) AS score, domains, CASE WHEN {_any('low', quotes.BODIES)} THEN {_PAYLOAD} ELSE '' END AS payload, n FROM h) SELECT tree_id, path, score, domains, payload, n FROM (SELECT *, row_number() OVER (PARTITION BY tree_id ORDER BY score DESC, path) AS k FROM s) WHERE k <= 2")
def outbound_groups(spark, sf_dir):
    lines = _rows(spark, sf_dir).filter(quotes.is_code(F.col("text"))).select("tree_id", "path", "line", "text")
    return quotes.outbound_groups(lines, most=2)


@query("quote_budget", f"WITH {_ROWS}, s AS (SELECT tree_id, path, line, coalesce(sum(strlen(line || ': ' || text || chr(10))) OVER (PARTITION BY tree_id ORDER BY path, line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM r) SELECT tree_id, path, line FROM s WHERE before <= 90")
def quote_budget(spark, sf_dir):
    return quotes.within_bytes(_rows(spark, sf_dir), ["tree_id"], ["path", "line"], 90).select("tree_id", "path", "line")


@query("device_quotes", f"WITH {_ROWS}, c AS (SELECT tree_id, path, line, lower(callee) AS low FROM r), d AS (SELECT tree_id, path, line, {_DEVICE} AS fact, CASE WHEN line % 3 = 0 THEN 7 ELSE 6 END AS score FROM c), e AS (SELECT tree_id, path, line, score, unnest(CASE fact WHEN 'location' THEN ['coarse_location', 'fine_location'] WHEN 'sms' THEN ['read_sms', 'receive_sms', 'send_sms'] ELSE [fact] END) AS fact FROM d WHERE fact <> ''), a AS (SELECT * FROM e WHERE fact IN ('fine_location', 'send_sms', 'camera') AND tree_id % 2 = 0) SELECT tree_id, fact, score, path, line AS pos FROM (SELECT *, row_number() OVER (PARTITION BY tree_id, fact ORDER BY score DESC, line DESC, path DESC) AS k FROM a) WHERE k = 1")
def device_quotes(spark, sf_dir):
    r = _rows(spark, sf_dir)
    q = r.select("tree_id", quotes.device_fact(F.col("callee")).alias("fact"), F.when(F.col("line") % 3 == 0, 7).otherwise(6).alias("score"), "path", F.col("line").alias("pos")).filter("fact <> ''")
    asked = r.filter("tree_id % 2 = 0").select("tree_id", F.explode(F.array(*map(F.lit, ("fine_location", "send_sms", "camera")))).alias("fact"))
    return quotes.best_quotes(q, asked, ["tree_id"])


_NEEDLES = [*quotes.CODE_NEEDLES, *digest.PERMISSION_NEEDLES]
_HIT = lambda part: "CASE " + " ".join(f"WHEN contains(low, '{n}') THEN '{t if part == 0 else f}'" for t, f, n in _NEEDLES) + " END"


@query("signal_hits", f"WITH {_ROWS}, l AS (SELECT *, lower(trim(text)) AS low FROM r), h AS (SELECT tree_id, path, line, {_HIT(0)} AS topic, {_HIT(1)} AS fact FROM l WHERE NOT regexp_matches(low, '^(import |package )')), o AS (SELECT tree_id, path, topic, fact, min(line) AS line FROM h WHERE fact IS NOT NULL GROUP BY 1, 2, 3, 4), n AS (SELECT *, row_number() OVER (PARTITION BY tree_id, fact ORDER BY path, line) AS k FROM o), m AS (SELECT *, row_number() OVER (PARTITION BY tree_id ORDER BY path, line, fact) AS j FROM n WHERE k <= 6) SELECT tree_id, path, line, topic, fact, CAST(row_number() OVER (PARTITION BY tree_id ORDER BY topic, fact, path, line) AS INTEGER) AS pos FROM m WHERE j <= 48")
def signal_hits(spark, sf_dir):
    code = _rows(spark, sf_dir).filter(~F.lower(F.trim("text")).rlike("^(?:import |package )"))
    return quotes.sorted_hits(digest.needle_hits(code, _NEEDLES), ["tree_id"]).select("tree_id", "path", "line", "topic", "fact", "pos")


@query("hint_words", f"SELECT doc_id, array_to_string(list_filter(string_split_regex(lower(left(text, 300)), '[^a-z0-9_]+'), lambda w: len(w) >= 4 AND w NOT IN ({', '.join(map(_quoted, quotes.HINT_STOP))})), ',') AS words, regexp_matches(text, '(^|[^A-Za-z0-9])' || lang || '($|[^A-Za-z0-9])') AS has FROM documents")
def hint_words(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(quotes.hint_tokens(F.substring("text", 1, 300)), ",").alias("words"), quotes.contains_word(F.col("text"), F.col("lang")).alias("has"))


DIGESTS = ["Files: 3\n\nReadme README.md:\nA chat app.\n\nIt sends notes.\n\nOutbound:\nx\n\nUses:\ncamera app/Main.kt\n12: val x = 1\nmicrophone b.kt\n3: y z\n\nSignals:\n- x", "Files: 1", "Files: 2\n\nUses:\nsend_sms a.kt\n1: sms", "\nReadme r.md:\nOnly readme"]


@query("digest_sections", "SELECT doc_id, ['camera,microphone', '', 'send_sms', ''][doc_id % 4 + 1] AS quoted, ['A chat app.' || chr(10) || chr(10) || 'It sends notes.', '', '', 'Only readme'][doc_id % 4 + 1] AS readme FROM documents")
def digest_sections(spark, sf_dir):
    d = _pick(DIGESTS, F.col("doc_id") % 4)
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(quotes.quoted_facts(d), ",").alias("quoted"), quotes.digest_readme(d).alias("readme"))
