"""Queries over listings, their sources and runs: projections, choices, carried rows, trees against packages, flags, formats.

Orders stand for listings, lineitems for their assets, documents for files of source trees.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.functions import formats
from shelfspark.operators import digest, listing, trees
from shelfspark.plans.reply_queries import _pick
from shelfspark.plans.scan_queries import _list, _quoted
from shelfspark.registry import query, table

PLATFORMS = ["android-arm64-v8a", "linux-x86_64", "android-armeabi-v7a"]
KEY = "7e7e9c42a91bfef19fa929e5fda1b72e0ebc1a4c1141673e2794234d86addf4e"
COORDINATES = [f"30617:{KEY}:repo", f"30023:{KEY}:x", "30617:short:y", f"30617:{KEY}:"]


def _listings(spark, sf_dir):
    k = F.col("o_orderkey")
    tag = lambda *x: F.array(*[F.lit(i) if isinstance(i, str) else i.cast("string") for i in x])
    tags = F.array(tag("d", k), tag("f", _pick(PLATFORMS, k % 3)), tag("f", _pick(PLATFORMS, k % 2)), tag("name", F.concat(F.lit("App "), k)), tag("t", "chat"), tag("t", _pick(["notes", "music"], k % 2)), tag("url", F.lit(" https://acme.io ")), tag("repository", F.when(k % 4 == 0, F.lit("https://git.acme.io/x")).otherwise(F.lit(" "))), tag("a", _pick(COORDINATES, k % 4)), F.when(k % 5 == 0, tag("a", F.lit(COORDINATES[0]), F.lit(" wss://relay "))).otherwise(tag("a", F.lit(COORDINATES[0]))), tag("license", _pick(["MIT", "GPL-3.0-only", ""], k % 3)))
    line, part, supp = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    asset = F.array(tag("f", _pick(PLATFORMS, part % 3)), tag("url", F.when(supp % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("https://a/"), part))), tag("x", F.when(part % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("h"), supp))), tag("commit", F.concat(F.lit("c"), line)))
    order = (line * 100000 + part) * 100000 + supp
    assets = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), asset.alias("a")))), lambda s: s["a"]).alias("assets"))
    o = table(spark, sf_dir, "orders").join(assets, k == F.col("l_orderkey"), "left")
    return o.select(F.concat(F.lit("app."), k).alias("app_id"), k.alias("k"), F.concat(F.lit("p"), F.col("o_custkey")).alias("pubkey"), F.when(k % 7 == 0, None).otherwise("Content").alias("content"), tags.alias("tags"), F.array(tag("version", F.concat(F.lit("1."), k % 9))).alias("release"), F.coalesce("assets", F.array().cast("array<array<array<string>>>")).alias("assets"))


_ASSETS = """x AS (SELECT l_orderkey AS k, (l_linenumber * 100000 + l_partkey) * 100000 + l_suppkey AS o, l_partkey % 3 = 0 AS mine, CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE 'https://a/' || l_partkey END AS url, CASE WHEN l_partkey % 4 = 0 THEN '' ELSE 'h' || l_suppkey END AS hash, 'c' || l_linenumber AS c FROM lineitem),
b AS (SELECT k, arg_min({'u': url, 'h': hash, 'c': c}, o) FILTER (mine AND url <> '' AND hash <> '') AS best, arg_min({'u': url, 'h': hash, 'c': c}, o) FILTER (url <> '' OR hash <> '') AS other FROM x GROUP BY 1)"""
_REPO = f"CASE WHEN k % 4 = 0 THEN 'https://git.acme.io/x' WHEN k % 5 = 0 THEN '{COORDINATES[0]} wss://relay' ELSE '{COORDINATES[0]}' END"


@query("listing_input", f"WITH {_ASSETS}, l AS (SELECT o_orderkey AS k, 'p' || o_custkey AS pubkey FROM orders) SELECT 'app.' || l.k AS app_id, pubkey, 'App ' || l.k AS name, '' AS summary, CASE WHEN l.k % 7 = 0 THEN '' ELSE 'Content' END AS content, 'chat,' || ['notes', 'music'][l.k % 2 + 1] AS topics, 'https://acme.io' AS website, {_REPO.replace('k %', 'l.k %')} AS repository, ['MIT', 'GPL-3.0-only', ''][l.k % 3 + 1] AS license, '' AS icon_url, '1.' || (l.k % 9) AS version, coalesce(best.u, other.u, '') AS apk_url, coalesce(best.h, other.h, '') AS apk_hash, coalesce(best.c, other.c, '') AS commit FROM l LEFT JOIN b ON l.k = b.k")
def listing_input(spark, sf_dir):
    return listing.listing_input(_listings(spark, sf_dir)).withColumn("topics", F.array_join("topics", ","))


@query("listings_selected", "SELECT 'app.' || o_orderkey AS app_id FROM orders WHERE (o_orderkey % 3 = 0 OR o_orderkey % 2 = 0) AND contains('app.' || o_orderkey, '.1') AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey < 10)")
def listings_selected(spark, sf_dir):
    some = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").filter("c_nationkey < 10"), F.col("o_custkey") == F.col("c_custkey")).select(F.concat(F.lit("app."), "o_orderkey").alias("app_id"))
    return listing.select_listings(_listings(spark, sf_dir), ".1", some).select("app_id")


@query("listing_people", "SELECT 'app.' || o_orderkey AS app_id, c_name AS picture, CASE WHEN o_orderkey % 2 = 0 THEN 's' || o_orderkey END AS signer FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_nationkey < 10")
def listing_people(spark, sf_dir):
    pictures = table(spark, sf_dir, "customer").filter("c_nationkey < 10").select(F.concat(F.lit("p"), "c_custkey").alias("pubkey"), F.col("c_name").alias("picture"))
    signers = table(spark, sf_dir, "orders").filter("o_orderkey % 2 = 0").select(F.concat(F.lit("app."), "o_orderkey").alias("app_id"), F.concat(F.lit("s"), "o_orderkey").alias("signer"))
    return listing.with_people(_listings(spark, sf_dir), pictures, signers).select("app_id", "picture", "signer")


# Runs: fact rows of customers, from events; what was stored before, from other events.
_RUN = """r AS (SELECT user_id AS app_id, ['offline_capable', 'open_source', 'camera', 'source_available', 'ads'][event_id % 5 + 1] AS fact, CASE WHEN event_id % 3 = 0 THEN 'no' ELSE 'yes' END AS value, CASE WHEN event_id % 2 = 0 THEN 'apk' ELSE 'model' END AS basis, event_id AS pos FROM events WHERE event_type <> 'click'),
src AS (SELECT DISTINCT user_id AS app_id FROM events WHERE user_id % 3 = 0), apps AS (SELECT DISTINCT user_id AS app_id FROM events),
kept AS (SELECT app_id, fact, value, basis, pos FROM r WHERE fact NOT IN ('open_source', 'source_available') AND NOT (fact = 'offline_capable' AND basis <> 'apk')),
run AS (SELECT * FROM kept UNION ALL SELECT app_id, 'offline_capable', 'no', 'apk', NULL FROM apps WHERE app_id NOT IN (SELECT app_id FROM kept WHERE fact = 'offline_capable') UNION ALL SELECT app_id, 'source_available', 'yes', 'source', NULL FROM src)"""


def _run(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    rows = e.filter("event_type <> 'click'").select(F.col("user_id").alias("app_id"), _pick(["offline_capable", "open_source", "camera", "source_available", "ads"], F.col("event_id") % 5).alias("fact"), F.when(F.col("event_id") % 3 == 0, "no").otherwise("yes").alias("value"), F.when(F.col("event_id") % 2 == 0, "apk").otherwise("model").alias("basis"), F.col("event_id").cast("string").alias("pos"))
    apps = e.select(F.col("user_id").alias("app_id")).distinct()
    source = apps.filter("app_id % 3 = 0").select("app_id", F.lit("source_available").alias("fact"), F.lit("yes").alias("value"), F.lit("source").alias("basis"))
    return listing.run_rows(rows, apps, source)


@query("run_rows", f"WITH {_RUN} SELECT app_id, fact, value, basis, coalesce(CAST(pos AS VARCHAR), '') AS pos FROM run")
def run_rows(spark, sf_dir):
    return _run(spark, sf_dir)


@query("carried_source_rows", f"WITH {_RUN}, old AS (SELECT DISTINCT user_id AS app_id FROM events WHERE user_id % 2 = 0) SELECT app_id, fact, value FROM run UNION ALL SELECT app_id, 'source_available', 'no' FROM old WHERE app_id NOT IN (SELECT app_id FROM src)")
def carried_source_rows(spark, sf_dir):
    old = table(spark, sf_dir, "events").select(F.col("user_id").alias("app_id")).distinct().filter("app_id % 2 = 0").select("app_id", F.lit("source_available").alias("fact"), F.lit("no").alias("value"), F.lit("").alias("basis"), F.lit("").alias("pos"))
    return listing.carry_source_row(_run(spark, sf_dir), old).select("app_id", "fact", "value")


REASONS = ["no-change, shows where you are", "No change keeps it", "INTERNET permission absent", "  two   spaces ", "x" * 170, "no-change no network permission"]


@query("justified_rows", f"WITH r AS (SELECT event_id, user_id, CASE WHEN event_id % 4 = 0 THEN 'no' ELSE 'yes' END AS value, {_list(REASONS)}[event_id % 6 + 1] AS t FROM events), c AS (SELECT *, trim(regexp_replace(trim(regexp_replace(t, '\\s+', ' ', 'g')), '(?i)^no[- ]change,? ', '')) AS b FROM r) SELECT event_id, CASE WHEN value = 'yes' AND b <> '' AND lower(b) NOT IN ('internet permission absent', 'no network permission') AND strlen(b) <= 160 THEN b ELSE 'old' END AS reason FROM c")
def justified_rows(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    rows = e.select("event_id", F.lit("camera").alias("fact"), F.when(F.col("event_id") % 4 == 0, "no").otherwise("yes").alias("value"), F.lit("old").alias("reason"))
    reasons = e.select("event_id", F.lit("camera").alias("fact"), _pick(REASONS, F.col("event_id") % 6).alias("reason"))
    return listing.justify(rows, reasons, ["event_id"]).select("event_id", "reason")


LISTED, FOUND = ["", "MIT", "GPL-3.0-or-later", "Proprietary", "gpl-3.0"], ["", "GPL-3.0", "BUSL-1.1", "MIT"]
_FREE = "|".join(listing.FREE)
_SAME = "(starts_with(a, b) OR starts_with(b, a))"
_SOURCE = f"""s AS (SELECT o_orderkey AS k, {_list(LISTED)}[o_orderkey % 5 + 1] AS listed, {_list(FOUND)}[o_custkey % 4 + 1] AS found FROM orders), n AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(upper(listed), '-ONLY$', ''), '-OR-LATER$', ''), '\\+$', '') AS a, upper(found) AS b FROM s)"""


@query("source_rows", f"WITH {_SOURCE} SELECT k, CASE WHEN k % 6 = 0 OR k % 6 = 1 OR k % 6 = 3 THEN 'no' WHEN k % 6 > 3 THEN 'yes' END AS value, CASE k % 6 WHEN 0 THEN 'No repository is listed.' WHEN 1 THEN 'The listed repository could not be read.' WHEN 2 THEN NULL WHEN 3 THEN 'The listed repository has no app code.' ELSE CASE WHEN found = '' AND listed = '' THEN 'No license is declared.' WHEN found = '' AND regexp_matches(upper(listed), '^({_FREE})') THEN listed || ' license.' WHEN found = '' THEN listed || ', not an open source license.' WHEN found = 'BUSL-1.1' THEN found || ', not an open source license.' WHEN listed <> '' AND NOT {_SAME} THEN found || ' license. The listing says ' || listed || '.' ELSE found || ' license.' END END AS reason FROM n")
def source_rows(spark, sf_dir):
    k = F.col("o_orderkey")
    found = _pick(FOUND, F.col("o_custkey") % 4)
    row = listing.source_row(k % 6 != 0, k % 6 == 1, k % 6 > 2, k % 6 > 3, _pick(LISTED, k % 5), found, found != "BUSL-1.1")
    return table(spark, sf_dir, "orders").select(k.alias("k"), row.alias("r")).select("k", "r.value", "r.reason")


@query("top_followers", "SELECT o_orderkey % 50 AS app_id, o_custkey AS follower, o_totalprice AS rank FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey % 50 ORDER BY o_totalprice DESC, o_custkey) AS n FROM orders) WHERE n <= 5")
def top_followers(spark, sf_dir):
    return listing.top_followers(table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 50).alias("app_id"), F.col("o_custkey").alias("follower"), F.col("o_totalprice").alias("rank")))


@query("follower_names", """WITH p AS (SELECT 'u' || user_id AS pubkey, CAST(epoch(ts) AS BIGINT) // 86400 AS created_at, event_id AS pos, CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS dn, CASE WHEN event_id % 5 = 0 THEN '' ELSE ' n' || event_id END AS nm FROM events WHERE user_id % 2 = 0), l AS (SELECT *, row_number() OVER (PARTITION BY pubkey ORDER BY created_at DESC, pos) AS n FROM p) SELECT pubkey, coalesce(nullif(trim(dn), ''), trim(nm)) AS name FROM l WHERE n = 1 AND coalesce(nullif(trim(dn), ''), trim(nm)) <> ''""")
def follower_names(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    content = F.to_json(F.struct(F.when(k % 3 == 0, "").otherwise(F.col("event_type")).alias("display_name"), F.when(k % 5 == 0, "").otherwise(F.concat(F.lit(" n"), k)).alias("name")))
    profiles = e.select(F.concat(F.lit("u"), "user_id").alias("pubkey"), F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 86400).alias("created_at"), k.alias("pos"), content.alias("content"))
    wanted = e.filter("user_id % 2 = 0").select(F.concat(F.lit("u"), "user_id").alias("pubkey"))
    return listing.follower_names(profiles, wanted, formats.profile_name(F.col("content")))


# Trees: forty of them, each document a file by its id; a build line is put before its text.
PATHS = ["LICENSE", "app/build.gradle", "README.md", "src/Main.kt", "fastlane/en-US/full_description.txt", "pubspec.yaml", "docs/LICENSE.md", "app/src/main/AndroidManifest.xml"]
SNIPPETS = ["Permission is hereby granted, free of charge", 'applicationId "com.acme.app{i}"\nversionName "1.{j}"', "com.acme.app{i} 1.{j}", "fun main() // 1.{j}", "A chat app.", "version: 1.{j}+4", "GNU General Public License version 3", '<manifest package="com.acme.app{i}.free">']


def _snippet():
    k = F.col("doc_id")
    one = _pick(SNIPPETS, k % 8)
    return F.replace(F.replace(one, F.lit("{i}"), (k % 7).cast("string")), F.lit("{j}"), (k % 5).cast("string"))


_FILES = f"f AS (SELECT doc_id % 40 AS tree_id, 't' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || '/' || {_list(PATHS)}[doc_id % 8 + 1] AS nested, {_list(PATHS)}[doc_id % 8 + 1] AS base, doc_id, replace(replace({_list(SNIPPETS)}[doc_id % 8 + 1], '{{i}}', CAST(doc_id % 7 AS VARCHAR)), '{{j}}', CAST(doc_id % 5 AS VARCHAR)) || chr(10) || text AS body FROM documents), a AS (SELECT range AS tree_id, 'com.acme.app' || (range % 9) AS package, CASE WHEN range % 10 = 0 THEN '' ELSE '1.' || (range % 6) END AS version FROM range(40))"


def _files(spark, sf_dir):
    k = F.col("doc_id")
    d = table(spark, sf_dir, "documents")
    base = _pick(PATHS, k % 8)
    root = base.isin("LICENSE")
    path = F.when(root, F.concat(base, F.lit("."), F.lpad(k.cast("string"), 8, "0"))).otherwise(F.concat(F.lit("t"), F.lpad(k.cast("string"), 8, "0"), F.lit("/"), base))
    files = d.select((k % 40).alias("tree_id"), path.alias("path"), F.concat(_snippet(), F.lit("\n"), "text").alias("body"))
    t = F.col("id")
    apps = spark.range(40).select(t.alias("tree_id"), F.concat(F.lit("com.acme.app"), t % 9).alias("package"), F.when(t % 10 == 0, "").otherwise(F.concat(F.lit("1."), t % 6)).alias("version"))
    return files, apps


_TOKEN = "regexp_matches(body, '(^|[^0-9A-Za-z._-])' || regexp_escape(version) || '($|[^0-9A-Za-z._-])')"
_FACTS = f"""{_FILES}, j AS (SELECT f.*, a.package, a.version, base IN ('pubspec.yaml', 'app/build.gradle', 'app/src/main/AndroidManifest.xml') AND strlen(body) <= 262144 AS build FROM f JOIN a USING (tree_id)),
e AS (SELECT *, CASE WHEN build THEN regexp_extract_all(body, {_quoted(trees.ID)}, 1) || CASE WHEN base = 'app/src/main/AndroidManifest.xml' THEN regexp_extract_all(body, {_quoted(trees.MANIFEST_PACKAGE)}, 1) ELSE [] END ELSE [] END AS is_, CASE WHEN build THEN regexp_extract_all(body, {_quoted(trees.VERSION)}, 1) ELSE [] END AS vs FROM j),
g AS (SELECT tree_id, any_value(package) AS pkg, any_value(version) AS ver, bool_or(base = 'src/Main.kt') AS code, bool_or(base = 'LICENSE') AS mit, list_sort(list_distinct(flatten(list(is_)))) AS ids, bool_or(build AND contains(body, package)) AS p, list_sort(list_distinct(flatten(list(vs)))) AS versions, bool_or(build AND version <> '' AND {_TOKEN}) AS v FROM e GROUP BY 1),
tf AS (SELECT tree_id, code, CASE WHEN mit THEN 'MIT' ELSE '' END AS license, ids, p OR len(list_filter(ids, lambda i: i = pkg OR starts_with(pkg, i || '.') OR starts_with(i, pkg || '.'))) > 0 AS package, CASE WHEN ver = '' THEN [] ELSE versions END AS versions, v OR (ver <> '' AND len(list_filter(versions, lambda x: x = ver OR starts_with(x, ver || '+') OR starts_with(ver, x || '-'))) > 0) AS version FROM g)"""


@query("tree_facts", f"WITH {_FACTS} SELECT tree_id, code, license, array_to_string(ids, ',') AS ids, package, array_to_string(versions, ',') AS versions, version FROM tf")
def tree_facts(spark, sf_dir):
    f = trees.tree_facts(*_files(spark, sf_dir))
    return f.select("tree_id", "code", "license", F.array_join("ids", ",").alias("ids"), "package", F.array_join("versions", ",").alias("versions"), "version")


@query("tree_matches", f"WITH {_FILES}, s AS (SELECT a.tree_id, a.version, bool_or(base = 'src/Main.kt') AS code, bool_or(base IN ('app/build.gradle', 'app/src/main/AndroidManifest.xml') AND (contains(body, '\"' || package || '\"') OR contains(body, '''' || package || ''''))) AS identity, bool_or(base <> 'README.md' AND version <> '' AND {_TOKEN}) AS found FROM a LEFT JOIN f USING (tree_id) GROUP BY 1, 2), r AS (SELECT tree_id, CASE WHEN version = '' THEN 'version' WHEN NOT coalesce(code, false) OR NOT coalesce(identity, false) THEN 'package' WHEN NOT found THEN 'version' ELSE '' END AS reason FROM s) SELECT tree_id, reason = '' AS ok, reason FROM r")
def tree_matches(spark, sf_dir):
    return trees.matches_package(*_files(spark, sf_dir))


LIBS = [("/com/acme/ads", "Acme Ads", "Advertisement"), ("/com/chatty/sdk", "Chatty", "Mobile Analytics"), ("/io/free", "Free", "Utility"), ("/com/granted/stats", "", "Mobile Analytics"), ("/com/zzunknown/core", "Zed", "advertisement")]
_UNNAMED = """lib AS (SELECT range AS tree_id, unnest([['Acme Ads', 'com.acme.ads', 'acme', ''], ['Chatty', 'com.chatty.sdk', 'chatty', ''], ['/com/granted/stats', 'com.granted.stats', 'granted', 'stats'], ['Zed', 'com.zzunknown.core', 'zzunknown', '']]) AS l FROM range(40)),
un AS (SELECT tree_id, list_sort(list(l[1])) AS names FROM lib WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.tree_id = lib.tree_id AND strlen(body) <= 262144 AND (contains(lower(body), l[2]) OR contains(lower(body), l[3]) OR (l[4] <> '' AND contains(lower(body), l[4])))) GROUP BY 1)"""


def _unnamed(spark, files):
    rows = [(p, n, t) for p, n, t in LIBS]
    libs = spark.range(40).select(F.col("id").alias("tree_id"), F.explode(F.array(*[F.struct(F.lit(p).alias("id"), F.lit(n).alias("name"), F.lit(t).alias("type"), F.lit(p).alias("path")) for p, n, t in rows])).alias("l")).select("tree_id", "l.*").withColumn("anti", F.array().cast("array<string>"))
    return trees.unmentioned(libs, files)


@query("unmentioned_libraries", f"WITH {_FILES}, {_UNNAMED} SELECT tree_id, array_to_string(names, ',') AS names FROM un")
def unmentioned_libraries(spark, sf_dir):
    files, _ = _files(spark, sf_dir)
    return _unnamed(spark, files).select("tree_id", F.array_join("names", ",").alias("names"))


@query("problem_flags", f"WITH {_FACTS}, {_UNNAMED}, w AS (SELECT tf.tree_id, list_filter([CASE WHEN len(ids) > 0 AND NOT package THEN 'package com.acme.app' || (tf.tree_id % 9) || ' is not declared in the source (' || array_to_string(ids[1:3], ', ') || ')' END, CASE WHEN names IS NOT NULL THEN 'the APK has ' || array_to_string(names, ', ') || ', which the source never references' END, CASE WHEN tf.tree_id % 2 = 0 AND tf.tree_id % 10 <> 0 AND len(versions) > 0 AND NOT version THEN 'version 1.' || (tf.tree_id % 6) || ' is not in the source at this commit' END], lambda x: x IS NOT NULL) AS why FROM tf LEFT JOIN un USING (tree_id)) SELECT tree_id, concat_ws('|', CASE WHEN tree_id % 3 <> 0 AND len(why) > 0 THEN 'source_mismatch=' || upper(array_to_string(why, '; ')[1]) || array_to_string(why, '; ')[2:] || '.' END, CASE WHEN tree_id % 4 = 1 THEN 'no_english=The app''s own text is not in English and has no English translation.' END) AS flags FROM w")
def problem_flags(spark, sf_dir):
    files, apps = _files(spark, sf_dir)
    facts = trees.tree_facts(files, apps)
    t = F.col("tree_id")
    own = apps.select(t.alias("k"), F.col("package").alias("pkg"), F.col("version").alias("ver"))
    both = facts.join(own, t == F.col("k")).join(_unnamed(spark, files).select(t.alias("m"), "names"), t == F.col("m"), "left")
    got = trees.flags(F.col("pkg"), F.col("ver"), t % 3 != 0, F.struct("ids", "package", "versions", "version"), F.coalesce("names", F.array().cast("array<string>")), t % 2 == 0, F.when(t % 4 == 0, None).otherwise(t % 4 != 1))
    return both.select("tree_id", F.array_join(F.transform(got, lambda f: F.concat(f["id"], F.lit("="), f["note"])), "|").alias("flags"))


@query("tree_sizes", f"WITH {_FILES} SELECT tree_id, CAST(count(*) AS BIGINT) AS files, CAST(sum(strlen(body)) AS BIGINT) AS bytes FROM f GROUP BY tree_id")
def tree_sizes(spark, sf_dir):
    return trees.tree_size(_files(spark, sf_dir)[0])


@query("path_kinds", f"WITH f AS (SELECT doc_id, {_list(PATHS)}[doc_id % 8 + 1] AS path FROM documents) SELECT doc_id, path NOT IN ('docs/LICENSE.md', 'fastlane/en-US/full_description.txt') AS kept FROM f")
def path_kinds(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", digest.keep_path(_pick(PATHS, F.col("doc_id") % 8)).alias("kept"))


# -- formats ---------------------------------------------------------------------


@query("run_formats", "SELECT o_orderkey, CASE WHEN d < 1000 THEN d || 'ms' WHEN d < 60000 THEN printf('%.1fs', d / 1000.0) ELSE (d // 60000) || 'm' || (d // 1000 % 60) || 's' END AS took, left(h, 12) AS short, coalesce(nullif(trim(regexp_replace(' ' || o_orderstatus || '  ', '\\s+', ' ', 'g')), ''), 'none') AS words, regexp_replace(lower(trim(' ' || o_orderpriority)), '[^a-z0-9.-]', '', 'g') AS name, CASE WHEN o_orderkey % 2 = 0 THEN 'base-x' ELSE 'base' END AS dump FROM (SELECT *, greatest(0, o_orderkey * 37 % 200000 - 100) AS d, sha256(CAST(o_orderkey AS VARCHAR)) AS h FROM orders)")
def run_formats(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", formats.duration_text(k * 37 % 200000 - 100).alias("took"), formats.short_hash(F.concat(F.lit(" "), F.sha2(k.cast("string"), 256))).alias("short"), formats.join_or(F.array(F.lit(" "), F.col("o_orderstatus"), F.lit("")), "none").alias("words"), formats.safe_name(F.concat(F.lit(" "), "o_orderpriority")).alias("name"), formats.dump_name(F.lit("base"), F.when(k % 2 == 0, " x ").otherwise(" ")).alias("dump"))


REMOTES = ["https://gitlab.com/group/sub/app.git", "http://gitlab.com/a/b", "https://u@gitlab.com/a/b", "https://gitlab.com/", " https://git.acme.io:8443/team/my-app/-/tree/main "]
MESSAGES = ["fatal: Repository not found", "timeout", "remote: ACCESS DENIED", "is this a git repository?"]
REPLIES = ["```json\n{\"a\": 1}\n```", "Here: {\"b\": 2} done", "{\"c\": 3}", "none", "``` {x} ```"]


@query("remote_formats", f"SELECT o_orderkey, ['https://gitlab.com/api/v4 group%2Fsub%2Fapp', NULL, NULL, NULL, 'https://git.acme.io:8443/api/v4 team%2Fmy-app'][o_orderkey % 5 + 1] AS api, CASE WHEN o_orderkey % 7 = 0 THEN 'not-remote' WHEN o_orderkey % 4 = 1 THEN 'failed' ELSE 'unreadable' END AS failure, CASE WHEN o_orderkey % 600 IN (401, 402, 403) THEN 'account:600' WHEN o_orderkey % 600 IN (408, 429) OR o_orderkey % 600 >= 500 THEN 'provider:60' ELSE 'request:0' END AS http, ['{{\"a\": 1}}', '{{\"b\": 2}}', '{{\"c\": 3}}', 'none', '{{x}}'][o_orderkey % 5 + 1] AS content, 'https://m/v1/chat/completions' AS url FROM orders")
def remote_formats(spark, sf_dir):
    k = F.col("o_orderkey")
    http = formats.http_failure(k % 600)
    api = formats.gitlab_api(_pick(REMOTES, k % 5))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.when(api.isNotNull(), F.concat_ws(" ", api["root"], api["project"])).alias("api"), formats.repository_failure(_pick(MESSAGES, k % 4), k % 7 != 0).alias("failure"), F.concat_ws(":", http["kind"], http["pause"].cast("string")).alias("http"), formats.json_content(_pick(REPLIES, k % 5)).alias("content"), formats.completions_url(_pick(["https://m/v1", "https://m/v1/", "https://m/v1/chat/completions"], k % 3)).alias("url"))


@query("icon_sources", "SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 OR (o_orderkey % 2 = 0 AND o_orderkey % 3 <> 2 AND o_orderkey % 5 = 0) OR (o_orderkey % 2 <> 0 AND o_orderkey % 3 = 2) THEN NULL WHEN o_orderkey % 4 = 0 THEN 'apk' WHEN o_orderkey % 7 = 0 THEN 'none' ELSE 'listing' END AS source FROM orders")
def icon_sources(spark, sf_dir):
    k = F.col("o_orderkey")
    got = formats.icon_source(F.when(k % 9 == 0, " ").otherwise("h"), k % 2 == 0, _pick(["apk", "listing", "none"], k % 3), F.when(k % 5 == 0, "h").otherwise("old"), k % 4 == 0, F.when(k % 7 == 0, "").otherwise("https://i"))
    return table(spark, sf_dir, "orders").select("o_orderkey", got.alias("source"))


@query("request_keys", "SELECT conv_id, sha256(string_agg(role || chr(0) || text || chr(0), '' ORDER BY turn)) AS key FROM conversations GROUP BY conv_id")
def request_keys(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("m"))
    return c.select("conv_id", formats.request_key(F.col("m")).alias("key"))


@query("feature_documents", "WITH f AS (SELECT doc_id, lang, source, CASE WHEN doc_id % 3 = 0 THEN '' ELSE left(text, 50) END AS content, left(text, 30) AS readme, CASE WHEN doc_id % 2 = 0 THEN '' ELSE lang END AS summary FROM documents), t AS (SELECT doc_id, summary, source, regexp_replace(regexp_replace(source || chr(10) || summary || chr(10) || CASE WHEN trim(summary) = '' AND trim(content) = '' THEN trim(readme) ELSE trim(content) END || chr(10) || 'a b', '^\\s+', ''), '\\s+$', '') AS feature FROM f) SELECT doc_id, sha256(feature || CASE WHEN summary <> '' THEN chr(10) || chr(10) || summary ELSE '' END || CASE WHEN doc_id % 5 <> 0 THEN chr(10) || chr(10) || 'q' ELSE '' END) AS hash FROM t")
def feature_documents(spark, sf_dir):
    k = F.col("doc_id")
    summary = F.when(k % 2 == 0, "").otherwise(F.col("lang"))
    feature = formats.feature_text(F.col("source"), summary, F.when(k % 3 == 0, "").otherwise(F.substring("text", 1, 50)), F.substring("text", 1, 30), F.array(F.lit("a"), F.lit("b")))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(formats.vector_document(feature, summary, F.when(k % 5 == 0, " ").otherwise(" q ")), 256).alias("hash"))


@query("either_plan", "SELECT o_orderkey, concat_ws(' ', CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 THEN 'clone' END, CASE WHEN o_orderkey % 5 = 0 THEN 'apk' END, CASE WHEN o_orderkey % 7 = 0 THEN 'vector' END) AS words FROM orders")
def either_plan(spark, sf_dir):
    k = F.col("o_orderkey")
    no = F.lit(False)
    work = lambda clone, download, vector: F.struct(clone.alias("clone"), download.alias("download"), *[no.alias(x) for x in ("scan", "icon", "about", "security")], vector.alias("vector"))
    both = formats.either_work(work(k % 2 == 0, no, k % 7 == 0), work(k % 3 == 0, k % 5 == 0, no))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(formats.plan_words(both), " ").alias("words"))
