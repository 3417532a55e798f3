"""Queries over the packages of apps: scan rows, prose, notes, the note from the scan alone, the stored document.

Orders stand for apps; the libraries and permissions of an app are dealt by its lineitems.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.operators import facts, scan
from shelfspark.plans.lineage import spread
from shelfspark.registry import query, table

P = "android.permission."
PERMISSIONS = [P + x for x in "READ_CONTACTS WRITE_CONTACTS READ_SMS RECEIVE_SMS SEND_SMS ACCESS_COARSE_LOCATION ACCESS_FINE_LOCATION ACCESS_BACKGROUND_LOCATION CAMERA RECORD_AUDIO READ_CALL_LOG REQUEST_INSTALL_PACKAGES QUERY_ALL_PACKAGES SYSTEM_ALERT_WINDOW BIND_ACCESSIBILITY_SERVICE BIND_NOTIFICATION_LISTENER_SERVICE BIND_DEVICE_ADMIN BIND_VPN_SERVICE BIND_INPUT_METHOD PACKAGE_USAGE_STATS INTERNET INTERNET VIBRATE WAKE_LOCK".split()]
LIBRARIES = [
    ("/com/acme/ads", "Acme Ads", "Advertisement", "/com/acme/ads", []),
    ("/com/acme/stats", "", "Mobile Analytics", "/com/acme/stats", []),
    ("/com/google/android/gms", "Google Mobile Services", "Development Framework", "/com/google/android/gms", []),
    ("/com/google/cast", "Google Cast", "Utility", "/com/google/android/gms/cast", []),
    ("/com/google/firebase", "Firebase", "Utility", "/com/google/firebase/messaging", []),
    ("/com/google/firebase/analytics", "Firebase Analytics", "Mobile Analytics", "/com/google/firebase/analytics", ["Tracking"]),
    ("/io/flutter", "Flutter", "Utility", "/io/flutter", ["Tracking"]),
    ("/com/kit", "Kit", "Development Framework", "/com/kit", ["Ads"]),
    ("/io/sentry", "Sentry", "Utility", "/io/sentry", ["NonFreeNet", "Tracking"]),
    ("/org/plain", "Plain", "Utility", "/org/plain", []),
    ("/com/both", "Both", "utility", "/com/both", ["Ads", "Tracking"]),
    ("/org/other", "Other", "", "/org/other", []),
]


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _list(items) -> str:
    return "[" + ",".join(map(_quoted, items)) + "]"


_LIBS = "libs(k, id, name, type, path, antis) AS (VALUES " + ", ".join(f"({k}, {_quoted(i)}, {_quoted(n)}, {_quoted(t)}, {_quoted(p)}, {_list(a)}::VARCHAR[])" for k, (i, n, t, p, a) in enumerate(LIBRARIES)) + ")"
_PERMS = "perms(k, perm) AS (VALUES " + ", ".join(f"({k}, {_quoted(p)})" for k, p in enumerate(PERMISSIONS)) + ")"
_MAP = "pf(perm, fact) AS (VALUES " + ", ".join(f"({_quoted(p)}, {_quoted(f)})" for p, f in facts.PERMISSION_FACTS.items()) + ")"
_SCAN = f"""{_LIBS}, {_PERMS}, {_MAP},
a AS (SELECT o_orderkey AS app_id, o_orderkey % 5 <> 0 AS manifest FROM orders),
l AS (SELECT l_orderkey AS app_id, CASE WHEN name = '' THEN id ELSE name END AS label, lower(path || ' ' || id || ' ' || name) AS blob, lower(type) = 'development framework' OR lower(name) IN ('flutter', 'react native', 'hermes', 'sqlcipher') AS framework, lower(type) AS type, antis FROM lineitem JOIN libs ON l_partkey % 12 = k),
lf AS (SELECT app_id, 'google_services' AS fact, 'Google Play services: ' || label AS label FROM l WHERE regexp_matches(blob, '/com/google/android/gms|play-services|play services|google mobile services')
  UNION ALL SELECT app_id, 'google_services', 'Firebase Cloud Messaging: ' || label FROM l WHERE regexp_matches(blob, 'firebase/messaging|firebase-messaging|firebase cloud messaging')
  UNION ALL SELECT app_id, 'tracking', label FROM l WHERE NOT framework AND (type = 'mobile analytics' OR list_contains(antis, 'Tracking'))
  UNION ALL SELECT app_id, 'ads', label FROM l WHERE NOT framework AND (type = 'advertisement' OR list_contains(antis, 'Ads'))),
lr AS (SELECT app_id, fact, 'yes' AS value, string_agg(DISTINCT label, ', ' ORDER BY label) AS evidence FROM lf JOIN a USING (app_id) GROUP BY 1, 2),
asked AS (SELECT DISTINCT l_orderkey AS app_id, perm FROM lineitem JOIN perms ON (l_suppkey + 7 * l_linenumber) % 24 = k),
named AS (SELECT app_id, fact, replace(asked.perm, '{P}', '') AS id FROM asked JOIN pf ON lower(asked.perm) = pf.perm
  UNION SELECT app_id, fact, 'ACCESS_BACKGROUND_LOCATION' FROM asked JOIN pf ON lower(asked.perm) = pf.perm WHERE fact IN ('coarse_location', 'fine_location') AND app_id IN (SELECT app_id FROM asked WHERE perm = '{P}ACCESS_BACKGROUND_LOCATION')),
s AS (SELECT * FROM lr
  UNION ALL SELECT app_id, 'google_services', 'no', '' FROM a WHERE app_id NOT IN (SELECT app_id FROM lr WHERE fact = 'google_services')
  UNION ALL SELECT app_id, fact, 'yes', string_agg(id, ', ' ORDER BY id) FROM (SELECT n.app_id, n.fact, n.id FROM named n JOIN a USING (app_id) WHERE manifest) GROUP BY 1, 2
  UNION ALL SELECT app_id, 'offline_capable', 'yes', 'No INTERNET' FROM a WHERE manifest AND app_id NOT IN (SELECT app_id FROM asked WHERE perm = '{P}INTERNET'))"""


def _scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    pick = lambda items, k: F.element_at(F.array(*items), (k + 1).cast("int"))
    lib = pick([F.struct(F.lit(i).alias("id"), F.lit(n).alias("name"), F.lit(t).alias("type"), F.lit(p).alias("path"), F.array(*map(F.lit, a)).cast("array<string>").alias("anti")) for i, n, t, p, a in LIBRARIES], F.col("l_partkey") % 12)
    libraries = lines.select(F.col("l_orderkey").alias("app_id"), lib.alias("l")).select("app_id", "l.*")
    asked = spread(lines, "l_orderkey", lines.count()).groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_set(pick(list(map(F.lit, PERMISSIONS)), (F.col("l_suppkey") + 7 * F.col("l_linenumber")) % 24)).alias("permissions"))
    apps = table(spark, sf_dir, "orders").join(asked, F.col("o_orderkey") == F.col("k"), "left").select(F.col("o_orderkey").alias("app_id"), F.concat(F.lit(" AB"), "o_orderkey").alias("hash"), (F.col("o_orderkey") % 5 != 0).alias("manifest"), F.coalesce("permissions", F.array().cast("array<string>")).alias("permissions"))
    return scan.scan_rows(apps, libraries)


@query("scan_rows", f"WITH {_SCAN} SELECT app_id, fact, value, evidence, 'ab' || app_id AS source FROM s")
def scan_rows(spark, sf_dir):
    return _scan(spark, sf_dir).select("app_id", "fact", "value", "evidence", "source")


_KNOWN = "CASE fact " + " ".join(f"WHEN {_quoted(f)} THEN {_quoted(t)}" for f, t in scan.DESCRIBED.items()) + " ELSE '' END"


@query("scan_prose", f"WITH {_SCAN}, d AS (SELECT app_id, fact, evidence, CASE WHEN fact = 'tracking' THEN 'Includes a tracker: ' || evidence WHEN fact = 'ads' THEN 'Includes ads: ' || evidence WHEN fact = 'google_services' AND value = 'no' THEN 'No Google services' WHEN fact = 'google_services' THEN 'Includes Google services: ' || evidence WHEN fact = 'offline_capable' THEN 'No INTERNET' ELSE {_KNOWN} END AS text FROM s) SELECT app_id, string_agg('- ' || fact || ': ' || text || chr(10), '' ORDER BY fact, evidence) AS prose FROM d WHERE text <> '' GROUP BY app_id")
def scan_prose(spark, sf_dir):
    return scan.prose(_scan(spark, sf_dir), ["app_id"])


@query("facts_to_explain", f"WITH {_SCAN} SELECT fact, CAST(count(*) AS BIGINT) AS n FROM s WHERE value = 'yes' AND fact <> 'offline_capable' GROUP BY fact")
def facts_to_explain(spark, sf_dir):
    r = _scan(spark, sf_dir).filter(scan.needs_reason(F.col("fact"), F.col("value"), F.col("evidence")))
    return r.groupBy("fact").agg(F.count(F.lit(1)).alias("n"))


PARTS = ["READ_SMS", "CAMERA", "Google Play services: Google Cast", "Google Play services: Google Mobile Services", "Firebase Cloud Messaging: Firebase", "Sentry", "AdMob", "ACCESS_FINE_LOCATION"]
REASONS = ["", "camera permission", "Google Cast plays media on a TV", "Reports crashes to Sentry.", "read_sms, camera permissions", "uses READ_SMS to verify", "shows ads"]


def notes_sql(source: str) -> str:
    """CTEs up to ``noted`` (all columns of ``source``, note): source has reason and evidence."""
    first = "list_filter({x}, lambda e, i: list_position({x}, e) = i)"
    return f"""parts AS (SELECT *, list_filter(list_transform(string_split(evidence, ','), lambda p: trim(p)), lambda p: p <> '') AS ps FROM {source}),
cut AS (SELECT *, list_filter(ps, lambda p: regexp_matches(p, '^[A-Z0-9_]+$')) AS ids, list_filter(ps, lambda p: NOT regexp_matches(p, '^[A-Z0-9_]+$')) AS others FROM parts),
said AS (SELECT *, CASE WHEN len(ids) > 0 AND trim(reason) <> '' AND regexp_replace(regexp_replace(lower(trim(reason)), ' permissions$', ''), ' permission$', '') = lower(array_to_string(ids, ', ')) THEN '' ELSE trim(reason) END AS phrase FROM cut),
kept AS (SELECT *, list_filter(others, lambda p: phrase = '' OR NOT (contains(lower(phrase), lower(regexp_replace(p, '^.*?: ', ''))) OR lower(regexp_replace(p, '^.*?: ', '')) IN ('google mobile services', 'play services', 'google play services'))) AS ks FROM said),
kinds AS (SELECT *, {first.format(x="list_transform(ks, lambda p: CASE WHEN contains(p, ': ') THEN split_part(p, ': ', 1) ELSE '' END)")} AS kk FROM kept),
names AS (SELECT *, list_transform(kk, lambda k: {{'kind': k, 'all_': list_transform(list_filter(ks, lambda p: (CASE WHEN contains(p, ': ') THEN split_part(p, ': ', 1) ELSE '' END) = k), lambda p: regexp_replace(p, '^.*?: ', ''))}}) AS g FROM kinds),
found AS (SELECT *, array_to_string(list_transform(g, lambda x: CASE WHEN x.kind = '' THEN '' ELSE x.kind || ': ' END || array_to_string(CASE WHEN len(x.all_) > 1 AND len(list_filter(x.all_, lambda n: lower(n) NOT IN ('google mobile services', 'play services', 'google play services'))) > 0 THEN list_filter(x.all_, lambda n: lower(n) NOT IN ('google mobile services', 'play services', 'google play services')) ELSE x.all_ END, ', ')), '; ') AS f FROM names),
reasoned AS (SELECT *, CASE WHEN phrase = '' THEN f WHEN f = '' THEN phrase ELSE phrase || CASE WHEN regexp_matches(phrase, '[.!?]$') THEN '' ELSE '.' END || ' ' || CASE WHEN contains(f, ': ') THEN '' ELSE 'Libraries: ' END || f || '.' END AS t, array_to_string(ids, ',') AS i FROM found),
noted AS (SELECT *, CASE WHEN i = '' OR contains(t, i) THEN t WHEN t = '' THEN i ELSE i || '. ' || t END AS note FROM reasoned)"""


@query("fact_notes", f"WITH e AS (SELECT l_orderkey, l_linenumber, {_list(PARTS)}[l_partkey % 8 + 1] || ', ' || {_list(PARTS)}[l_suppkey % 8 + 1] || ',' || {_list(PARTS)}[l_linenumber % 8 + 1] AS evidence, {_list(REASONS)}[CAST(l_quantity AS BIGINT) % 7 + 1] AS reason FROM lineitem), {notes_sql('e')} SELECT l_orderkey, l_linenumber, note FROM noted")
def fact_notes(spark, sf_dir):
    pick = lambda items, k: F.element_at(F.array(*map(F.lit, items)), (k + 1).cast("int"))
    e = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.concat(pick(PARTS, F.col("l_partkey") % 8), F.lit(", "), pick(PARTS, F.col("l_suppkey") % 8), F.lit(","), pick(PARTS, F.col("l_linenumber") % 8)).alias("evidence"), pick(REASONS, F.col("l_quantity").cast("long") % 7).alias("reason"))
    return e.select("l_orderkey", "l_linenumber", scan.notes_text(F.col("reason"), F.col("evidence")).alias("note"))


STATED = ["Scan a QR code.", "Sends text messages to contacts", "", "Maps near you"]
_USED = "CASE fact " + " ".join(f"WHEN {_quoted(f)} THEN regexp_matches(stated, {_quoted(p)})" for f, p in scan.STATED.items()) + " ELSE false END"
_NOUN = "CASE key " + " ".join(f"WHEN '{k}' THEN {_quoted(n)}" for k, (n, _) in scan.ACCESS.items()) + " END"
_LINE = "CASE key " + " ".join(f"WHEN '{k}' THEN {_quoted(x)}" for k, (_, x) in scan.ACCESS.items()) + " END"


def _libs_sql(fact: str, none: str, one: str, many: str) -> str:
    names = f"string_split(max(evidence) FILTER (fact = '{fact}'), ', ')"
    return f"CASE WHEN count(*) FILTER (fact = '{fact}') = 0 THEN NULL WHEN max(evidence) FILTER (fact = '{fact}') = '' THEN 'Includes {none}.' WHEN len({names}) = 1 THEN 'Includes {one}' || {names}[1] || '.' ELSE 'Includes {many}' || array_to_string(({names})[1:len({names}) - 1], ', ') || ' and ' || ({names})[len({names})] || '.' END"


@query("security_template", f"""WITH {_SCAN}, y AS (SELECT s.*, {_list(STATED)}[app_id % 4 + 1] AS stated, CASE WHEN app_id % 3 = 0 THEN ['camera', 'coarse_location', 'contacts'] ELSE [] END AS quoted FROM s WHERE value = 'yes'),
acc AS (SELECT app_id, fact, evidence, CASE WHEN fact IN ('coarse_location', 'fine_location') THEN 'location' ELSE fact END AS key, list_contains(quoted, fact) OR (fact = 'fine_location' AND list_contains(quoted, 'coarse_location')) OR {_USED} AS used FROM y WHERE fact IN ({', '.join(map(_quoted, scan.PERMISSION_FACTS))})),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY app_id, key ORDER BY fact) AS n FROM acc) WHERE n = 1),
af AS (SELECT app_id, list({_NOUN} ORDER BY fact) FILTER (NOT used) AS u, list({_LINE} ORDER BY fact) FILTER (used) AS shown FROM firsts GROUP BY 1),
flags AS (SELECT app_id, {_libs_sql('tracking', 'a tracker', 'the tracker ', 'the trackers ')} AS t, {_libs_sql('ads', 'an ad library', 'the ad library ', 'the ad libraries ')} AS d, bool_or(fact = 'google_services') AS g, bool_or(fact = 'offline_capable') AS off FROM y GROUP BY 1),
m AS (SELECT a.app_id, t, d, coalesce(g, false) AS g, coalesce(off, false) AS off, coalesce(u, []) AS u, coalesce(shown, []) AS shown, af.app_id IS NULL AS none FROM a LEFT JOIN flags USING (app_id) LEFT JOIN af USING (app_id)),
w AS (SELECT *, CASE WHEN len(u) = 0 THEN NULL WHEN len(u) = 1 THEN u[1] || ' has no shown use.' ELSE array_to_string(list_transform(u[1:len(u) - 1], lambda x, i: CASE WHEN i = 1 THEN x ELSE lower(x[1]) || x[2:] END), ', ') || ' and ' || lower(u[len(u)][1]) || u[len(u)][2:] || ' have no shown use.' END AS un FROM m),
z AS (SELECT *, concat_ws(' ', t, d, un) AS warn, array_to_string(shown || CASE WHEN g THEN ['Includes Google Play services.'] ELSE [] END, ' ') AS said FROM w)
SELECT app_id, CASE WHEN warn <> '' THEN warn || chr(10) || chr(10) ELSE '' END || concat_ws(' ', nullif(said, ''), CASE WHEN none THEN 'It asks for no sensitive access.' WHEN said = '' AND warn <> '' THEN 'It asks for no other sensitive access.' END, CASE WHEN off THEN 'Data stays on the phone.' END) AS security, coalesce(r, '') AS reasons FROM z LEFT JOIN (SELECT app_id, string_agg(fact || '=' || split_part(evidence, ',', 1) || ' has no shown use.', ';' ORDER BY fact) AS r FROM acc WHERE NOT used GROUP BY 1) USING (app_id)""")
def security_template(spark, sf_dir):
    row = F.struct("fact", "value", "basis", "evidence")
    apps = _scan(spark, sf_dir).groupBy("app_id").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    quoted = F.when(F.col("app_id") % 3 == 0, F.array(*map(F.lit, ("camera", "coarse_location", "contacts")))).otherwise(F.array().cast("array<string>"))
    got = apps.select("app_id", scan.security_template(F.col("rows"), quoted, F.element_at(F.array(*map(F.lit, STATED)), (F.col("app_id") % 4 + 1).cast("int"))).alias("t"))
    return got.select("app_id", "t.security", F.array_join(F.transform(F.array_sort(F.map_entries("t.reasons")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("reasons"))


DOC_FACTS = ["google_services", "tracking", "ads", "offline_capable", "source_available", "camera", "other", ""]
DOC_TEXTS = ["Warning here.\n\nBody text.", "Only body", "A\n---\nB", "no-change", ""]
DOC_NOTES = ["", "why", " because "]


@query("security_document", f"""WITH r AS (SELECT l_orderkey AS app_id, (l_linenumber * 100000 + l_partkey) * 100000 + l_suppkey AS pos, {_list(DOC_FACTS)}[l_partkey % 8 + 1] AS fact, ['yes', 'no', 'maybe'][l_suppkey % 3 + 1] AS value, trim({_list(DOC_NOTES)}[CAST(l_quantity AS BIGINT) % 3 + 1]) AS notes FROM lineitem),
u AS (SELECT * FROM r WHERE fact <> '' AND value IN ('yes', 'no')),
f AS (SELECT app_id, fact, arg_max(value, pos) AS value FROM u WHERE fact NOT IN ('camera', 'other') AND (value = 'yes' OR fact IN ('source_available', 'google_services', 'offline_capable')) GROUP BY 1, 2),
n AS (SELECT app_id, fact, arg_max(notes, pos) AS notes FROM u WHERE notes <> '' AND (fact = 'camera' OR (fact <> 'other' AND (value = 'yes' OR fact = 'source_available'))) GROUP BY 1, 2),
fa AS (SELECT app_id, string_agg('"' || fact || '":' || CASE value WHEN 'yes' THEN 'true' ELSE 'false' END, ',' ORDER BY fact) AS fs FROM f GROUP BY 1),
na AS (SELECT app_id, string_agg('"' || fact || '":"' || notes || '"', ',' ORDER BY fact) AS ns FROM n GROUP BY 1),
d AS (SELECT DISTINCT app_id, app_id % 5 AS t FROM r)
SELECT app_id, '{{' || coalesce('"facts":{{' || fs || '}},', '') || coalesce('"notes":{{' || ns || '}},', '') || CASE WHEN app_id % 2 = 0 THEN '"permissions":["CAMERA","READ_SMS"],' ELSE '' END || CASE t WHEN 0 THEN '"notice":"Warning here.","body":"Body text."' WHEN 1 THEN '"notice":"","body":"Only body"' WHEN 2 THEN '"notice":"A","body":"B"' ELSE '"notice":"","body":""' END || CASE WHEN app_id % 3 = 0 THEN ',"keywords":["chat"]' ELSE '' END || '}}' AS json FROM d LEFT JOIN fa USING (app_id) LEFT JOIN na USING (app_id)""")
def security_document(spark, sf_dir):
    pick = lambda items, k: F.element_at(F.array(*map(F.lit, items)), (k + 1).cast("int"))
    one = F.struct(((F.col("l_linenumber") * 100000 + F.col("l_partkey")) * 100000 + F.col("l_suppkey")).alias("pos"), pick(DOC_FACTS, F.col("l_partkey") % 8).alias("fact"), pick(["yes", "no", "maybe"], F.col("l_suppkey") % 3).alias("value"), pick(DOC_NOTES, F.col("l_quantity").cast("long") % 3).alias("notes"))
    apps = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("app_id")).agg(F.array_sort(F.collect_list(one)).alias("rows"))
    perms = F.when(F.col("app_id") % 2 == 0, "READ_SMS, CAMERA,ACCESS_BACKGROUND_LOCATION,CAMERA").otherwise("")
    none = F.array().cast("array<string>")
    keywords = F.when(F.col("app_id") % 3 == 0, F.array(F.lit("chat"))).otherwise(none)
    return apps.select("app_id", scan.document_json(F.col("rows"), perms, pick(DOC_TEXTS, F.col("app_id") % 5), keywords, none).alias("json"))
