"""Queries over packages: dangerous permissions, trackers by class, overlaps, native names, labels, inventories, strings."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.functions.text import COMMON_WORDS
from shelfspark.operators import packages
from shelfspark.plans.reply_queries import _pick
from shelfspark.plans.scan_queries import _LIBS, _PERMS, LIBRARIES, PERMISSIONS, _list, _quoted
from shelfspark.registry import query, table

_LINES = "l AS (SELECT l_orderkey AS app_id, l_partkey AS p, l_suppkey AS s, l_linenumber AS n FROM lineitem)"


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("app_id"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), F.col("l_linenumber").alias("n"))


@query("dangerous_permissions", f"WITH {_PERMS}, {_LINES}, d AS (SELECT DISTINCT app_id, replace(perm, 'android.permission.', '') AS id FROM l JOIN perms ON (s + 7 * n) % 24 = k WHERE replace(perm, 'android.permission.', '') IN ({', '.join(map(_quoted, packages.DANGEROUS))})) SELECT app_id, string_agg(id, ',' ORDER BY id) AS ids FROM d GROUP BY app_id")
def dangerous_permissions(spark, sf_dir):
    apps = _lines(spark, sf_dir).groupBy("app_id").agg(F.collect_list(_pick(PERMISSIONS, (F.col("s") + 7 * F.col("n")) % 24)).alias("ps"))
    return apps.select("app_id", F.array_join(F.array_sort(packages.dangerous(F.col("ps"))), ",").alias("ids")).filter("ids <> ''")


CLASSES = ["/com/acme/ads/Banner", "/com/google/firebase/analytics/connector/A", "/com/google/firebase/analytics/B", "/io/sentry/Hub", "/com/acme/Core", "/org/none/C", "/com/appsflyer/x/D"]
RULES = [("Acme", r"com\.acme\."), ("Acme Ads", r"com\.acme\.ads"), ("Firebase", r"com\.google\.firebase\.analytics|com\.firebase"), ("Sentry", r"^io\.sentry\."), ("AppsFlyer", r"com\.appsflyer\.")]


@query("tracker_hits", f"WITH {_LINES}, c AS (SELECT DISTINCT app_id, {_list(CLASSES)}[p % 7 + 1] AS path FROM l), d AS (SELECT app_id, replace(path[2:], '/', '.') AS dotted FROM c WHERE NOT (path = '{packages.STUBS[0]}' OR starts_with(path, '{packages.STUBS[0]}/'))) SELECT DISTINCT app_id, (SELECT min(rule) FROM (VALUES " + ", ".join(f"({_quoted(n)}, {_quoted(p)})" for n, p in RULES) + ") r(rule, pattern) WHERE regexp_matches(dotted, pattern)) AS rule FROM d WHERE rule IS NOT NULL")
def tracker_hits(spark, sf_dir):
    classes = _lines(spark, sf_dir).select("app_id", _pick(CLASSES, F.col("p") % 7).alias("path")).distinct()
    return packages.tracker_hits(classes, RULES)


FOUND = ["/com/acme", "/com/acme/ads", "/io/sentry", "/com/appsflyer/x", "/com/acmesome"]
CODES = ["com.acme.ads.", "io\\.sentry.core|x", "com.appsflyer", "com.(a|b)", "org.none"]


@query("signature_overlaps", f"WITH {_LINES}, f AS (SELECT DISTINCT app_id, {_list(FOUND)}[p % 5 + 1] AS path FROM l), g AS (SELECT DISTINCT app_id, {_list(CODES)}[s % 5 + 1] AS code, ['/com/acme/ads', '/io/sentry/core', '/com/appsflyer', '', '/org/none'][s % 5 + 1] AS sig FROM l), j AS (SELECT g.app_id, code AS rule, path FROM g JOIN f USING (app_id) WHERE sig <> '' AND (path = sig OR starts_with(path, sig || '/') OR starts_with(sig, path || '/'))) SELECT app_id, rule, arg_min(path, (len(path), path)) AS id FROM j GROUP BY 1, 2")
def signature_overlaps(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    found = lines.select("app_id", _pick(FOUND, F.col("p") % 5).alias("path")).distinct().withColumn("id", F.col("path"))
    rules = lines.select("app_id", _pick(CODES, F.col("s") % 5).alias("rule")).distinct().withColumn("path", packages.signature_path(F.col("rule"))).filter("path <> ''")
    return packages.overlapping(found, rules)


NAMES = ["libflutter.so", "libfoo.so", "libsqlcipher.so", "libhermes.so"]


@query("native_libraries", f"WITH {_LINES} SELECT DISTINCT app_id, ['Flutter', NULL, 'SQLCipher', 'Hermes'][p % 4 + 1] AS id, CASE WHEN p % 4 = 2 THEN 'Utility' ELSE 'Development Framework' END AS type FROM l WHERE p % 4 <> 1")
def native_libraries(spark, sf_dir):
    return packages.native_libraries(_lines(spark, sf_dir).select("app_id", _pick(NAMES, F.col("p") % 4).alias("file"))).select("app_id", "id", "type")


def _libraries(spark, sf_dir):
    lib = F.element_at(F.array(*[F.struct(F.lit(i).alias("id"), F.lit(n).alias("name"), F.lit(t).alias("type"), F.lit(p).alias("path"), F.array(*map(F.lit, a)).cast("array<string>").alias("anti")) for i, n, t, p, a in LIBRARIES]), (F.col("p") % 12 + 1).cast("int"))
    return _lines(spark, sf_dir).select("app_id", lib.alias("l"), F.when(F.col("p") % 12 == 11, 1).otherwise(0).alias("emphasize")).select("app_id", "l.*", "emphasize").distinct()


_OWN = f"{_LIBS}, {_LINES}, o AS (SELECT DISTINCT app_id, libs.* FROM l JOIN libs ON p % 12 = k)"


@query("package_reports", f"WITH {_OWN}, b AS (SELECT *, k = 11 OR len(antis) > 0 OR regexp_matches(lower(id || ' ' || name), '/com/google/android/gms|play services|play-services|firebase/messaging|firebase cloud messaging|firebase-messaging') OR lower(type) IN ('mobile analytics', 'advertisement') AS notable FROM o) SELECT app_id, count(DISTINCT id) AS library_count, coalesce(string_agg(name, ',' ORDER BY name, id) FILTER (notable), '') AS names, coalesce(array_to_string(list_sort(list_distinct(flatten(list(antis) FILTER (notable)))), ','), '') AS anti FROM b GROUP BY app_id")
def package_reports(spark, sf_dir):
    r = packages.report(_libraries(spark, sf_dir))
    return r.select("app_id", "library_count", F.array_join("names", ",").alias("names"), F.array_join("anti", ",").alias("anti"))


@query("package_inventories", f"WITH {_OWN}, t AS (SELECT app_id, CASE WHEN lower(type) = 'development framework' THEN NULL ELSE CASE WHEN name = '' THEN id ELSE name END || CASE WHEN (type = '' OR lower(type) = 'utility') AND len(antis) = 0 THEN '' ELSE ' (' || array_to_string(CASE WHEN type = '' OR lower(type) = 'utility' THEN antis ELSE [type] || antis END, ', ') || ')' END END AS label FROM o), g AS (SELECT app_id, string_agg(DISTINCT label, ', ' ORDER BY label) AS labels FROM t GROUP BY 1) SELECT app_id, 'package: com.acme.a' || app_id || coalesce(chr(10) || 'libraries: ' || labels, '') || chr(10) || 'permissions: CAMERA, x.Y' AS inventory FROM g")
def package_inventories(spark, sf_dir):
    label = packages.library_label(F.col("name"), F.col("id"), F.col("type"), F.col("anti"))
    g = _libraries(spark, sf_dir).groupBy("app_id").agg(F.collect_set(label).alias("labels"))
    none = F.array().cast("array<string>")
    text = packages.inventory(F.concat(F.lit(" com.acme.a"), "app_id"), none, F.col("labels"), none, F.array(F.lit("android.permission.CAMERA"), F.lit("x.Y"), F.lit("android.permission.CAMERA")), none)
    return g.select("app_id", text.alias("inventory"))


CATEGORIES = [["Advertisement", "Analytics"], ["Profiling", "location"], [], ["Crash reporting"]]


@query("tracker_kinds", "SELECT o_orderkey, ['Ads,Tracking', 'Tracking', '', ''][o_orderkey % 4 + 1] AS anti, ['Advertisement', 'Profiling', 'Tracker', 'Crash reporting'][o_orderkey % 4 + 1] AS type, ['/a/b', '', '', '/x'][o_orderkey % 4 + 1] AS path, ['/a/b/C', '/a/D'][o_orderkey % 2 + 1] AS class FROM orders")
def tracker_kinds(spark, sf_dir):
    k = F.col("o_orderkey")
    c = _pick(CATEGORIES, k % 4)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(packages.tracker_anti(c), ",").alias("anti"), packages.tracker_type(c).alias("type"), packages.dotted_path(_pick([" a.b", "@string/x", "", "x"], k % 4)).alias("path"), packages.descriptor_path(_pick(["La/b/C;", "La/D$1;"], k % 2)).alias("class"))


UI = ["Save the file now", "Open all of your notes", "Alle Dateien jetzt speichern", "Neue Notiz sofort anlegen", "Hill", "Search for a contact", "Bitte warten Sie kurz"]
KEYS = ["title", "abc_x", "save", "copy", "open_all", "com.x", "note"]


@query("english_strings", "WITH u AS (SELECT user_id AS app_id, event_id % 7 AS t, CASE WHEN event_id % 4 = 0 THEN 'en' WHEN event_id % 4 = 1 THEN 'de' ELSE '' END AS lang, ['title', 'abc_x', 'save', 'copy', 'open_all', 'com.x', 'note'][event_id % 7 + 1] || CASE WHEN event_id % 7 IN (0, 2, 4, 6) THEN CAST(event_id AS VARCHAR) ELSE '' END AS name, " + _list(UI) + "[(event_id + user_id) % 7 + 1] AS value FROM events), o AS (SELECT * FROM u WHERE t IN (0, 2, 4, 6)), w AS (SELECT *, len(list_filter(string_split(value, ' '), lambda x: x <> '')) >= 3 AS phrase FROM o), s AS (SELECT app_id, lang, name, phrase AND lang = '' AS counts, len(list_filter(string_split(lower(value), ' '), lambda x: list_contains(" + _list(COMMON_WORDS) + ", x))) > 0 AS common FROM w), g AS (SELECT app_id, count(*) FILTER (counts) AS n, count(*) FILTER (counts AND common) AS hits, count(DISTINCT CASE WHEN lang = '' THEN name END) AS defaults, count(DISTINCT CASE WHEN lang = 'en' THEN name END) AS en FROM s GROUP BY 1) SELECT app_id, CASE WHEN n < 8 THEN NULL WHEN hits * 100 >= n * 25 THEN true ELSE en * 2 >= defaults END AS english FROM g")
def english_strings(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    name = F.concat(_pick(KEYS, k % 7), F.when((k % 7).isin(0, 2, 4, 6), k.cast("string")).otherwise(""))
    strings = e.select(F.col("user_id").alias("app_id"), F.when(k % 4 == 0, "en").when(k % 4 == 1, "de").otherwise("").alias("lang"), name.alias("name"), _pick(UI, (k + F.col("user_id")) % 7).alias("value"))
    return packages.english_strings(strings)
