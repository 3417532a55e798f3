"""Queries over model replies: checks of about and security replies, terms, vocabulary, and what is used where none passes.

Replies are put together from texts of the tables and from phrases that trip each check.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.functions import text as tx
from shelfspark.operators import replies
from shelfspark.plans.scan_queries import _list, _quoted
from shelfspark.plans.text_queries import _LINE
from shelfspark.registry import query, table

OPENINGS = ["Zap keeps the the notes you write.", "This is fine, e.g. for you and for all of the others.", "Keep your notes in one place. send them to your friends.", "Get it on F-Droid today and keep all of your notes.", "", "Notes , and more", "The Music Player plays what you have on your phone."]
NAMES = ["Zap", "Music Player", "Ox", "Relay"]
DEV = "A relay for notes. The player plays music. See https://zap.com/zap for more."
KEYWORDS = [["notes", "lightning wallet"], ["Notes"], ["a", "b", "c", "d", "e", "f", "g", "h", "i"], ["one two three four"], []]
GOOD = ["keep notes", "write a note", "share notes now", "find my notes", "notes for phone"]
QUERIES = [GOOD, GOOD[:3], [*GOOD[:4], "one"], [*GOOD[:4], "zap notes"], [*GOOD, "Big Notes"], [*GOOD[:4], "relay list"]]


def _pick(items, k):
    return F.element_at(F.array(*[F.array(*map(F.lit, i)).cast("array<string>") if isinstance(i, list) else F.lit(i) for i in items]), (k + 1).cast("int"))


def _lists(items) -> str:
    return "[" + ",".join(_list(i) + "::VARCHAR[]" for i in items) + "]"


_TRIM = "'\"''(),.;:!?'"
GARBLED_SQL = f"""CASE WHEN len(twice) > 0 THEN 'doubled word "' || ws[twice[1]] || ' ' || ws[twice[1] + 1] || '"' WHEN len(smalls) > 0 THEN 'sentence starts lowercase: "' || smalls[1] || '"' WHEN regexp_extract(about, '{replies.STRAY}') <> '' THEN 'stray punctuation "' || regexp_extract(about, '{replies.STRAY}') || '"' END"""


def garbled_ctes(source: str) -> str:
    """CTEs up to ``garb`` (all of ``source``, ws, twice, smalls) for a column ``about``."""
    return f"""gw AS (SELECT *, list_filter(string_split_regex(about, '[\\s\\x{{85}}\\x{{a0}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{3000}}]+'), lambda w: w <> '') AS ws FROM {source}),
gb AS (SELECT *, list_transform(ws, lambda w: trim(lower(w), {_TRIM})) AS bare FROM gw),
garb AS (SELECT *, list_filter(range(1, len(ws)), lambda i: bare[i] <> '' AND bare[i] = bare[i + 1] AND NOT regexp_matches(bare[i], '[0-9]')) AS twice, list_filter(regexp_extract_all(about, '{replies.LOWER_START}'), lambda m: NOT regexp_matches(m, '{replies.ABBREVIATION}')) AS smalls FROM gb)"""


def english_sql(x: str) -> str:
    words = f"list_filter(string_split_regex(lower({x}), '[^\\p{{L}}'']+'), lambda w: w <> '')"
    return f"""CASE WHEN len(regexp_replace({x}, '[\\P{{L}}\\p{{Latin}}]', '', 'g')) > len(regexp_replace({x}, '[^A-Za-z]', '', 'g')) THEN false WHEN len({words}) < 6 THEN NULL ELSE len(list_filter({words}, lambda w: list_contains({_list(tx.COMMON_WORDS)}, w))) * 100 >= len({words}) * 15 END"""


_ABOUTS = f"d AS (SELECT doc_id, {_LINE} AS line FROM documents), ab AS (SELECT doc_id, trim({_list(OPENINGS)}[doc_id % 7 + 1] || ' ' || left(line, doc_id * 37 % 320)) AS about, {_list(NAMES)}[doc_id % 4 + 1] AS name, {_lists(KEYWORDS)}[doc_id % 5 + 1] AS kw, {_lists(QUERIES)}[doc_id % 6 + 1] AS qs FROM d)"


def _abouts(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", tx.one_line(F.col("text")).alias("line"))
    about = F.trim(F.concat(_pick(OPENINGS, F.col("doc_id") % 7), F.lit(" "), F.substring(F.col("line"), F.lit(1), (F.col("doc_id") * 37 % 320).cast("int"))))
    return d.select("doc_id", about.alias("about"), _pick(NAMES, F.col("doc_id") % 4).alias("name"), _pick(KEYWORDS, F.col("doc_id") % 5).alias("kw"), _pick(QUERIES, F.col("doc_id") % 6).alias("qs"))


_DEV = f"regexp_replace({_quoted(DEV)}, '{replies.LINK}', ' ', 'g')"
_ORDINARY = f"len(list_filter(string_split(name, ' '), lambda w: NOT (w = lower(w) OR regexp_matches({_DEV}, '\\b' || regexp_escape(lower(w)))))) = 0"
_TERMS = f"""names AS (SELECT *, {_ORDINARY} AS ordinary FROM garb),
terms AS (SELECT *, CASE WHEN contains(name, ' ') OR ordinary THEN '' ELSE lower(name) END AS brand FROM names),
kq AS (SELECT *, CASE WHEN len(kw) > 8 THEN len(kw) || ' keywords, want at most 8' ELSE (list_transform(list_filter(kw, lambda k: NOT regexp_matches(k, '^[a-z0-9 -]+$') OR len(string_split(k, ' ')) > 3), lambda k: 'keyword "' || k || '" is not one to three lowercase words'))[1] END AS kf,
 CASE WHEN len(qs) < 5 OR len(qs) > 10 THEN len(qs) || ' queries, want 5 to 10' ELSE (list_filter(list_transform(qs, lambda q: CASE WHEN q <> lower(q) THEN 'query "' || q || '" is not lowercase' WHEN len(string_split(q, ' ')) NOT BETWEEN 2 AND 6 THEN 'query "' || q || '" has ' || len(string_split(q, ' ')) || ' words, want 2 to 6' WHEN len(brand) >= 4 AND contains(q, brand) THEN 'query "' || q || '" names the app' END), lambda r: r IS NOT NULL))[1] END AS qf FROM terms)"""


@query("garbled_reasons", f"WITH {_ABOUTS}, {garbled_ctes('ab')} SELECT doc_id, {GARBLED_SQL} AS why FROM garb")
def garbled_reasons(spark, sf_dir):
    return _abouts(spark, sf_dir).select("doc_id", replies.garbled(F.col("about")).alias("why"))


_RULES = f"""CASE WHEN about = '' THEN NULL WHEN len(about) NOT BETWEEN 100 AND 300 THEN 'about is ' || len(about) || ' characters, want 100 to 300' WHEN NOT coalesce({english_sql('about')}, true) THEN 'about is not English' WHEN len(name) >= 3 AND regexp_matches(about, '\\b' || regexp_escape(name) || '\\b') AND NOT ordinary THEN 'about names the app "' || name || '"' ELSE 'about has ' || ({GARBLED_SQL}) END"""


@query("reply_rules", f"WITH {_ABOUTS}, {garbled_ctes('ab')}, {_TERMS} SELECT doc_id, coalesce({_RULES}, kf, qf) AS why, (ordinary) AS ordinary_name, brand FROM kq")
def reply_rules(spark, sf_dir):
    dev = F.lit(DEV)
    return _abouts(spark, sf_dir).select("doc_id", replies.about_rules(F.col("about"), F.col("kw"), F.col("qs"), F.col("name"), dev).alias("why"), replies.ordinary_name(F.col("name"), dev).alias("ordinary_name"), replies.brand_name(F.col("name"), dev).alias("brand"))


@query("clean_terms", f"WITH {_ABOUTS}, {garbled_ctes('ab')}, {_TERMS} SELECT doc_id, array_to_string((list_filter(kw, lambda k: regexp_matches(k, '^[a-z0-9 -]+$') AND len(string_split(k, ' ')) <= 3))[1:8], '|') AS keywords, array_to_string((list_filter(qs, lambda q: q = lower(q) AND len(string_split(q, ' ')) BETWEEN 2 AND 6 AND NOT (len(brand) >= 4 AND contains(q, brand))))[1:10], '|') AS queries FROM kq")
def clean_terms(spark, sf_dir):
    t = _abouts(spark, sf_dir).select("doc_id", replies.clean_terms(F.col("kw"), F.col("qs"), replies.brand_name(F.col("name"), F.lit(DEV))).alias("t"))
    return t.select("doc_id", F.array_join("t.keywords", "|").alias("keywords"), F.array_join("t.queries", "|").alias("queries"))


VERDICTS = ["keep", "Write it", "", "keep as is"]


@query("usable_replies", f"WITH {_ABOUTS}, v AS (SELECT doc_id, {_list(VERDICTS)}[doc_id % 4 + 1] AS verdict, CASE WHEN doc_id % 11 = 0 THEN ' No-change ' ELSE about END AS about, CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'A description.' END AS description FROM ab), r AS (SELECT *, CASE WHEN lower(trim(about)) = 'no-change' OR (starts_with(lower(verdict), 'keep') AND description <> '') THEN '' ELSE trim(about) END AS written FROM v) SELECT doc_id, written, CASE WHEN starts_with(lower(verdict), 'write') AND written = '' THEN 'verdict write, but about is empty' WHEN written = '' THEN CASE WHEN description = '' THEN 'empty about, and the description is not usable' END WHEN len(written) > 320 THEN 'about is ' || len(written) || ' characters' WHEN regexp_matches(written, '{replies.OTHER_BUILD}') THEN 'about describes another build: \"' || regexp_extract(written, '{replies.OTHER_BUILD}') || '\"' END AS why FROM r")
def usable_replies(spark, sf_dir):
    a = _abouts(spark, sf_dir).select("doc_id", _pick(VERDICTS, F.col("doc_id") % 4).alias("verdict"), F.when(F.col("doc_id") % 11 == 0, " No-change ").otherwise(F.col("about")).alias("about"), F.when(F.col("doc_id") % 3 == 0, "").otherwise("A description.").alias("description"))
    a = a.withColumn("written", replies.reply_about(F.col("verdict"), F.col("about"), F.col("description")))
    return a.select("doc_id", "written", F.coalesce(replies.verdict_fails(F.col("verdict"), F.col("written")), replies.usable_about(F.col("written"), F.col("description"))).alias("why"))


_STOPPED = f"list_filter(string_split_regex(lower({{x}}), '[^\\p{{{{L}}}}\\p{{{{Nd}}}}]+'), lambda w: strlen(w) >= 4 AND NOT list_contains({_list(tx.STOP_WORDS)}, w))"


def _stems_sql(x: str) -> tuple[str, str]:
    from shelfspark.plans.text_queries import _stem_sql

    own = _STOPPED.format(x=x)
    return own, f"list_transform({own}, lambda w: {_stem_sql('w')})"


_OWN, _OWN_STEMS = _stems_sql("about")
_, _HAVE = _stems_sql("corpus")


@query("unbacked_words", f"WITH {_ABOUTS}, c AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN line ELSE left(line, 200) || ' zap' END AS corpus FROM d), j AS (SELECT doc_id, about, corpus FROM ab JOIN c USING (doc_id)), s AS (SELECT doc_id, corpus, {_OWN} AS own, {_OWN_STEMS} AS stems, list_distinct({_HAVE}) AS have, {english_sql('corpus')} AS eng FROM j), f AS (SELECT *, list_filter(range(1, len(own) + 1), lambda i: list_position(stems, stems[i]) = i) AS firsts FROM s), m AS (SELECT *, list_filter(firsts, lambda i: NOT list_contains(have, stems[i])) AS missing FROM f) SELECT doc_id, CASE WHEN coalesce(eng, true) AND len(have) >= 40 AND len(missing) > greatest(2, len(firsts) // 4) THEN 'about uses words the developer did not: ' || array_to_string(list_transform(missing, lambda i: own[i]), ', ') END AS why FROM m")
def unbacked_words(spark, sf_dir):
    corpus = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("k"), tx.one_line(F.col("text")).alias("line"))
    both = _abouts(spark, sf_dir).join(corpus, F.col("doc_id") == F.col("k"))
    return both.select("doc_id", replies.unbacked_words(F.col("about"), F.when(F.col("doc_id") % 2 == 0, F.col("line")).otherwise(F.concat(F.substring("line", 1, 200), F.lit(" zap")))).alias("why"))


# Attempts: lineitems of an order, by line number; what fails is dealt by their keys.
_ATTEMPTS = """t AS (SELECT l_orderkey AS app_id, (l_linenumber * 100000 + l_partkey) * 100000 + l_suppkey AS attempt, l_partkey % 5 <> 0 AS replied, CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE 'text ' || l_partkey END AS about, CASE WHEN l_partkey % 4 = 1 THEN 'unusable' END AS unusable, CASE WHEN l_suppkey % 4 = 1 THEN 'broken' END AS broken, CASE WHEN l_linenumber % 2 = 1 THEN 'unverified' END AS unverified, CASE WHEN l_orderkey % 3 = 0 THEN ' kept text ' ELSE '' END AS description FROM lineitem),
k AS (SELECT *, CASE WHEN NOT replied OR unusable IS NOT NULL THEN 3 WHEN broken IS NOT NULL THEN 2 WHEN unverified IS NOT NULL THEN 1 ELSE 0 END AS kind FROM t),
g AS (SELECT app_id, arg_min(about, attempt) FILTER (kind = 0) AS a0, arg_min(about, attempt) FILTER (kind = 1) AS a1, arg_min(about, attempt) FILTER (kind = 2) AS a2, arg_min('m' || attempt, attempt) FILTER (kind = 0) AS m0, bool_or(replied) AS replied, trim(max(description)) AS description, arg_max(coalesce(unusable, broken, unverified, 'no reply'), attempt) AS last FROM k GROUP BY 1)"""


@query("about_ladder", f"WITH {_ATTEMPTS}, s AS (SELECT *, CASE WHEN a0 IS NOT NULL THEN 0 WHEN a1 IS NOT NULL THEN 1 WHEN replied AND description <> '' THEN 2 WHEN a2 IS NOT NULL THEN 3 ELSE 4 END AS step FROM g), x AS (SELECT *, CASE step WHEN 0 THEN a0 WHEN 1 THEN a1 WHEN 3 THEN a2 END AS got FROM s) SELECT app_id, CASE WHEN step = 4 THEN NULL WHEN step = 2 OR got = '' THEN description ELSE got END AS about, coalesce(step = 2 OR got = '', false) AS kept, CASE step WHEN 1 THEN 'no model''s paragraph was verified against the developer text' WHEN 2 THEN 'every model reply was unusable, kept the listing description' WHEN 3 THEN 'no model''s reply followed every about rule' END AS degraded, CASE WHEN step = 0 THEN m0 END AS model, CASE WHEN step = 4 THEN last END AS error, CASE step WHEN 0 THEN 'raw' WHEN 1 THEN 'raw' WHEN 3 THEN 'clean' ELSE '' END AS terms FROM x")
def about_ladder(spark, sf_dir):
    part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    word = lambda x: F.array(F.lit(x))
    attempt = (line * 100000 + part) * 100000 + supp
    r = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("app_id"), attempt.alias("attempt"), F.concat(F.lit("m"), attempt).alias("model"), (part % 5 != 0).alias("replied"), F.when(supp % 3 == 0, "").otherwise(F.concat(F.lit("text "), part)).alias("about"), word("raw").alias("keywords"), word("raw").alias("queries"), F.struct(word("clean").alias("keywords"), word("clean").alias("queries")).alias("clean"), F.when(part % 4 == 1, "unusable").alias("unusable"), F.when(supp % 4 == 1, "broken").alias("broken"), F.when(line % 2 == 1, "unverified").alias("unverified"), F.when(F.col("l_orderkey") % 3 == 0, " kept text ").otherwise("").alias("description"))
    return replies.about_ladder(r).select("app_id", "about", "kept", "degraded", "model", "error", F.array_join("keywords", "").alias("terms"))


# Security notes: two phrases each, against scan rows dealt by the same keys.
WARNINGS = ["Includes the tracker Sentry.", "Camera access has no shown use.", "Reads your contacts", "Zap is a chat app for you.", "This helps users chat.", "no-change", "Shows ads from Acme.", "Data stays on the phone.", "The scan shows READ_SMS.", "It asks for no sensitive access.", ""]
SECOND = ["Uses the camera.", "Sends crash reports to analytics.", "Push arrives through Google.", "A simple note taking tool for everyone who writes.", "Uses CAMERA_ACCESS here.", "Built on F-Droid code.", "Says what the code does.", "It reads contacts.", "", "Zap talks to relays."]
CAMERA_NOTES = ["", "CAMERA. Scans a code to log in.", "CAMERA has no shown use.", "CAMERA. Google needs it."]
SOURCES = ["", "fun main()"]
_NOTES = f"""n AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN {_list(WARNINGS)}[l_partkey % 11 + 1] = 'no-change' THEN 'No-change' ELSE trim({_list(WARNINGS)}[l_partkey % 11 + 1] || CASE WHEN l_linenumber % 2 = 0 THEN chr(10) || chr(10) ELSE ' ' END || {_list(SECOND)}[l_suppkey % 10 + 1]) END AS security, CASE WHEN l_orderkey % 4 = 0 THEN 'Stored note.' ELSE '' END AS current,
 l_orderkey % 3 = 0 AS google, l_partkey % 3 = 0 AS tracking, l_suppkey % 5 = 0 AS ads, l_orderkey % 2 = 0 AS camera, l_partkey % 7 = 0 AS offline, {_list(CAMERA_NOTES)}[l_linenumber % 4 + 1] AS note, {_list(SOURCES)}[l_suppkey % 2 + 1] AS source, CASE WHEN l_orderkey % 5 = 0 THEN 'Scan a QR code' ELSE 'Notes' END AS stated, l_orderkey % 7 = 0 AS quoted FROM lineitem),
kept AS (SELECT *, trim(CASE WHEN lower(security) = 'no-change' THEN current ELSE security END) AS text, camera AND regexp_matches(note, '{replies.NO_USE}') AS unused FROM n),
w AS (SELECT *, unused OR tracking OR ads AS risk, contains(text, chr(10) || chr(10)) AS warned, lower(array_to_string(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> ''), ' ')) AS low FROM kept)"""


def _notes(spark, sf_dir):
    o, p, s, line = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    one = _pick(WARNINGS, p % 11)
    text = F.when(one == "no-change", "No-change").otherwise(F.trim(F.concat(one, F.when(line % 2 == 0, "\n\n").otherwise(" "), _pick(SECOND, s % 10))))
    row = lambda fact, value, when: F.when(when, F.struct(F.lit(fact).alias("fact"), F.lit(value).alias("value"), F.lit("apk").alias("basis")))
    rows = F.array_compact(F.array(row("google_services", "yes", o % 3 == 0), row("google_services", "no", o % 3 != 0), row("tracking", "yes", p % 3 == 0), row("ads", "yes", s % 5 == 0), row("camera", "yes", o % 2 == 0), row("offline_capable", "yes", p % 7 == 0)))
    note = _pick(CAMERA_NOTES, line % 4)
    notes = F.when(note != "", F.create_map(F.lit("camera"), note)).otherwise(F.create_map().cast("map<string,string>"))
    quoted = F.when(o % 7 == 0, F.array(F.lit("camera"))).otherwise(F.array().cast("array<string>"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text.alias("security"), F.when(o % 4 == 0, "Stored note.").otherwise("").alias("current"), rows.alias("rows"), notes.alias("notes"), _pick(SOURCES, s % 2).alias("source"), F.when(o % 5 == 0, "Scan a QR code").otherwise("Notes").alias("stated"), quoted.alias("quoted"))


SUMMARY = "A simple note taking tool."
_MENTION = lambda x, p, what: f"WHEN regexp_matches({x}, '{p}') THEN 'mentions \"' || regexp_extract({x}, '{p}') || '\"{what}'"
_FITS = f"""CASE {_MENTION('text', replies.CODE_TALK, '; say what the app does, not what the code shows')} WHEN regexp_matches(text, '{replies.PERMISSION_ID}') THEN 'names the permission id "' || regexp_extract(text, '{replies.PERMISSION_ID}') || '"; say what it allows in words' WHEN NOT offline AND regexp_matches(text, '{replies.ON_PHONE}') THEN 'says data stays on the phone, but the app can use the internet' WHEN camera AND regexp_matches(text, '{replies.NO_ACCESS}') THEN 'says no sensitive access, but the scan has an access' WHEN risk AND NOT warned AND unused THEN 'an access has no shown use, but the note opens with no warning' WHEN risk AND NOT warned THEN 'the scan has a tracking or ads library, but the note opens with no warning' WHEN NOT risk AND warned THEN 'the note opens with a warning, but nothing in the scan or fact notes calls for one' END"""
_AGAINST = f"""coalesce({_FITS}, CASE WHEN NOT google THEN CASE {_MENTION('text', replies.GOOGLE, ', but the scan found no Google services')} {_MENTION('note', replies.GOOGLE, ', but the scan found no Google services')} END END, CASE WHEN NOT tracking THEN CASE {_MENTION('text', replies.TRACKER, ', but the scan found no tracking library')} END END, CASE WHEN NOT ads THEN CASE {_MENTION('text', replies.ADS, ', but the scan found no ad library')} END END)"""
_PITCHED = f"""CASE WHEN text = '' OR lower(text) = 'no-change' THEN NULL WHEN regexp_matches(text, '{replies.PITCH}') THEN 'security describes the app: "' || regexp_extract(text, '{replies.PITCH}') || '"' WHEN starts_with(low, 'zap ') THEN 'security starts with the app name "Zap"' WHEN contains(low, 'a simple note taking tool') THEN 'security repeats the listing summary' END"""
_USES = "CASE WHEN source <> '' AND camera AND NOT quoted AND NOT regexp_matches(stated, '(?i)camera|\\bqr\\b|barcode|\\bscan|photo|picture|video') AND note <> '' AND NOT regexp_matches(note, '" + replies.NO_USE + "') THEN 'camera note gives a use, but no code or listing shows one; say it has no shown use' END"


@query("security_reply_checks", f"""WITH {_NOTES} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(CASE WHEN security = '' THEN 'empty security' WHEN lower(security) = 'no-change' AND current = '' THEN 'security no-change with no stored text' WHEN lower(security) <> 'no-change' AND regexp_matches(security, '{replies.OTHER_BUILD}') THEN 'security describes another build: "' || regexp_extract(security, '{replies.OTHER_BUILD}') || '"' END, {_PITCHED}, {_AGAINST}, {_USES}) AS why FROM w""")
def security_reply_checks(spark, sf_dir):
    n = _notes(spark, sf_dir)
    c = F.col
    return n.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", replies.security_reply_fails(c("security"), c("current"), c("rows"), c("notes"), F.lit("Zap"), F.lit(SUMMARY), c("source"), c("quoted"), c("stated")).alias("why"))


@query("locked_facts", f"WITH {_NOTES} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN google THEN 'yes' ELSE 'no' END AS google_services, CASE WHEN ads THEN 'yes' WHEN l_partkey % 2 = 0 THEN 'no' ELSE 'unknown' END AS ads, CASE WHEN tracking OR l_suppkey % 2 = 0 THEN 'yes' ELSE 'unknown' END AS tracking, CASE WHEN offline THEN 'yes' ELSE 'unknown' END AS offline_capable, 'unknown' AS open_source FROM w")
def locked_facts(spark, sf_dir):
    said = {"google_services": F.lit("yes"), "ads": F.when(F.col("l_partkey") % 2 == 0, " False").otherwise("maybe"), "tracking": F.when(F.col("l_suppkey") % 2 == 0, "TRUE").otherwise("")}
    return _notes(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", replies.lock_facts(said, F.col("rows")).alias("f")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "f.*")


@query("security_fallback", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 3 = 0 THEN 'reply' WHEN l_partkey % 3 = 1 AND l_orderkey % 4 <> 0 THEN 'template' END AS security FROM lineitem")
def security_fallback(spark, sf_dir):
    p = F.col("l_partkey") % 3
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", replies.security_fallback(F.when(p == 0, " reply "), p != 2, F.when(F.col("l_orderkey") % 4 == 0, "Stored").otherwise(" "), F.lit("template")).alias("security"))
