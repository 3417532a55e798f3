"""Queries that score replies against labelled cases, judge labels and drafts, tag cases and export references."""

from __future__ import annotations

from pyspark.sql import functions as F


from shelfspark.operators import replies, scoring
from shelfspark.plans.reply_queries import _ABOUTS, _NOTES, _TERMS, DEV, GARBLED_SQL, VERDICTS, QUERIES, _abouts, _lists, _notes, _pick, english_sql, garbled_ctes
from shelfspark.plans.scan_queries import _list, _quoted
from shelfspark.registry import query

DESCRIPTION = "A tool that keeps all of your notes in one place and shares them with the people that you choose to trust."
MUST = [[["notes", "memo"]], [["Zap"], ["keep"]], [], [["lightning"], ["notes"]]]
MUST_NOT = [["the the"], [], ["phone", "f-droid"]]
ACTIONS = ["keep", "write", ""]


def _groups(items):
    return lambda k: F.element_at(F.array(*[F.array(*[F.array(*map(F.lit, g)) for g in i]).cast("array<array<string>>") for i in items]), (k + 1).cast("int"))


def _groups_sql(items) -> str:
    return "[" + ",".join("[" + ",".join(_list(g) for g in i) + "]::VARCHAR[][]" for i in items) + "]"


def _missing_sql(groups: str, text: str) -> str:
    m = f"list_filter({groups}, lambda g: len(list_filter(g, lambda p: contains(lower({text}), lower(p)))) = 0)"
    return f"CASE WHEN len({m}) > 0 THEN 'missing ' || array_to_string(list_transform({m}, lambda g: array_to_string(g, '|')), ', ') END"


def _forbidden_sql(phrases: str, text: str) -> str:
    m = f"list_filter({phrases}, lambda p: contains(lower({text}), lower(p)))"
    return f"CASE WHEN len({m}) > 0 THEN 'contains ' || array_to_string({m}, ', ') END"


def _told(fails):
    return F.array_join(F.transform(F.sort_array(F.map_entries(fails)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; ")


_CASES = f"""{_ABOUTS}, v AS (SELECT doc_id, name, kw, qs, {_list(VERDICTS)}[doc_id % 4 + 1] AS verdict, about AS said, CASE WHEN doc_id % 3 = 0 THEN '' ELSE {_quoted(DESCRIPTION)} END AS description, {_groups_sql(MUST)}[doc_id % 4 + 1] AS must, {_lists(MUST_NOT)}[doc_id % 3 + 1] AS must_not, {_list(ACTIONS)}[doc_id % 3 + 1] AS action, CASE WHEN doc_id % 9 = 0 THEN 'unbacked' END AS verified, CASE WHEN doc_id % 13 = 0 THEN 'no reply' END AS error FROM ab),
r AS (SELECT *, CASE WHEN starts_with(lower(verdict), 'keep') AND description <> '' THEN '' ELSE trim(said) END AS written FROM v),
sh AS (SELECT *, CASE WHEN written = '' THEN description ELSE written END AS about FROM r), {garbled_ctes('sh')}, {_TERMS}"""


def _cases(spark, sf_dir):
    k = F.col("doc_id")
    a = _abouts(spark, sf_dir)
    return a.select(k, "name", "kw", "qs", F.col("about").alias("said"), _pick(VERDICTS, k % 4).alias("verdict"), F.when(k % 3 == 0, "").otherwise(DESCRIPTION).alias("description"), _groups(MUST)(k % 4).alias("must"), _pick(MUST_NOT, k % 3).alias("must_not"), _pick(ACTIONS, k % 3).alias("action"), F.when(k % 9 == 0, "unbacked").alias("verified"), F.when(k % 13 == 0, "no reply").alias("error"))


def _check(name: str, sql: str) -> str:
    return f"'{name}=' || ({sql})"


_SCORES = {
    "accepted": f"nullif(concat_ws(chr(10), CASE WHEN starts_with(lower(verdict), 'write') AND written = '' THEN 'verdict write, but about is empty' END, coalesce(CASE WHEN written = '' THEN CASE WHEN description = '' THEN 'empty about, and the description is not usable' END WHEN len(written) > 320 THEN 'about is ' || len(written) || ' characters' WHEN regexp_matches(written, '{replies.OTHER_BUILD}') THEN 'about describes another build: \"' || regexp_extract(written, '{replies.OTHER_BUILD}') || '\"' END, CASE WHEN written <> '' THEN verified END)), '')",
    "action": "CASE WHEN action = 'keep' AND written <> '' THEN 'wrote a paragraph, want the description kept' WHEN action = 'write' AND written = '' THEN 'kept the description, want a written paragraph' END",
    "english": f"CASE WHEN about <> '' AND NOT coalesce({english_sql('about')}, true) THEN 'not English' END",
    "garbled": f"CASE WHEN about <> '' THEN {GARBLED_SQL} END",
    "keywords": "kf",
    "length": "CASE WHEN about <> '' AND len(about) NOT BETWEEN 100 AND 300 THEN len(about) || ' characters, want 100 to 300' END",
    "must": f"CASE WHEN about <> '' THEN {_missing_sql('must', 'about')} END",
    "must_not": f"CASE WHEN about <> '' THEN {_forbidden_sql('must_not', 'about')} END",
    "name": "CASE WHEN about <> '' AND len(name) >= 3 AND regexp_matches(about, '\\b' || regexp_escape(name) || '\\b') AND NOT ordinary THEN 'names the app \"' || name || '\"' END",
    "queries": "qf",
}


@query("score_about", f"WITH {_CASES} SELECT doc_id, CASE WHEN error IS NOT NULL THEN 'reply=' || error ELSE concat_ws('; ', {', '.join(_check(k, s) for k, s in _SCORES.items())}) END AS fails FROM kq")
def score_about(spark, sf_dir):
    c = F.col
    want = {"action": c("action"), "must": c("must"), "must_not": c("must_not")}
    fails = scoring.score_about(want, {"name": c("name"), "dev": F.lit(DEV)}, {"verdict": c("verdict"), "about": c("said"), "keywords": c("kw"), "queries": c("qs")}, c("description"), c("verified"), c("error"))
    return _cases(spark, sf_dir).select("doc_id", _told(fails).alias("fails"))


_OFFERED = f"{_ABOUTS}, of_ AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '' ELSE about END AS about, {_groups_sql(MUST)}[doc_id % 4 + 1] AS must, {_lists(MUST_NOT)}[doc_id % 3 + 1] AS must_not, {_list(ACTIONS)}[doc_id % 3 + 1] AS action FROM ab), {garbled_ctes('of_')}, st AS (SELECT *, CASE WHEN about = '' THEN 'none' WHEN ({_missing_sql('must', 'about')}) IS NULL AND ({_forbidden_sql('must_not', 'about')}) IS NULL AND ({GARBLED_SQL}) IS NULL THEN 'ok' ELSE 'wrong' END AS state FROM garb)"


def _offered(spark, sf_dir):
    k = F.col("doc_id")
    return _abouts(spark, sf_dir).select(k, F.when(k % 5 == 0, "").otherwise(F.col("about")).alias("about"), _groups(MUST)(k % 4).alias("must"), _pick(MUST_NOT, k % 3).alias("must_not"), _pick(ACTIONS, k % 3).alias("action"))


@query("candidate_counts", f"WITH {_OFFERED} SELECT CAST(count(*) FILTER (state = 'ok') AS BIGINT) AS ok, CAST(count(*) FILTER (state = 'wrong') AS BIGINT) AS wrong, CAST(count(*) FILTER (state = 'none') AS BIGINT) AS none, CAST(count(*) FILTER (action = 'keep' AND state <> 'ok') AS BIGINT) AS bad FROM st")
def candidate_counts(spark, sf_dir):
    c = F.col
    s = _offered(spark, sf_dir).select(scoring.candidate_state(c("must"), c("must_not"), c("about"), c("action")).alias("s")).select("s.*")
    return scoring.candidate_counts(s)


@query("case_problems", f"WITH {_OFFERED}, p AS (SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN '' ELSE 'c' || doc_id END AS id, ['train', 'dev', 'test', 'other'][doc_id % 4 + 1] AS split, CASE WHEN doc_id % 19 = 0 THEN 'drop' ELSE action END AS action, CASE WHEN doc_id % 6 = 0 THEN 'x' ELSE '' END AS reference, about, CASE WHEN doc_id % 8 = 5 THEN [[]]::VARCHAR[][] WHEN doc_id % 8 = 6 THEN []::VARCHAR[][] ELSE must END AS must, CASE WHEN doc_id % 8 = 6 THEN []::VARCHAR[] ELSE must_not END AS must_not FROM st) SELECT doc_id, CASE WHEN id = '' THEN 'no id' ELSE id || ': ' || CASE WHEN split = 'other' THEN 'split \"other\" is not one of [train dev test]' WHEN action = 'drop' THEN 'action \"drop\" is not one of [keep write]' WHEN action = 'keep' AND reference <> '' THEN 'action keep has a reference about' WHEN action = 'keep' AND about = '' THEN 'action keep, but no description is offered' WHEN len(must) = 0 AND len(must_not) = 0 AND action = '' THEN 'want has no action, must, or must_not' WHEN len(list_filter(must, lambda g: len(g) = 0)) > 0 THEN 'empty must group' END END AS why FROM p")
def case_problems(spark, sf_dir):
    k, c = F.col("doc_id"), F.col
    none = F.array().cast("array<string>")
    must = F.when(k % 8 == 5, F.array(none)).when(k % 8 == 6, F.array().cast("array<array<string>>")).otherwise(c("must"))
    why = scoring.case_fails(F.when(k % 17 == 0, "").otherwise(F.concat(F.lit("c"), k)), _pick(["train", "dev", "test", "other"], k % 4), F.when(k % 19 == 0, "drop").otherwise(c("action")), F.when(k % 6 == 0, "x").otherwise(""), c("about"), must, F.when(k % 8 == 6, none).otherwise(c("must_not")))
    return _offered(spark, sf_dir).select("doc_id", why.alias("why"))


@query("training_references", f"WITH {_CASES}, u AS (SELECT *, description <> '' AND ({_missing_sql('must', 'description')}) IS NULL AND ({_forbidden_sql('must_not', 'description')}) IS NULL AS usable FROM kq), f AS (SELECT doc_id, CASE WHEN action <> 'write' AND usable THEN '' ELSE said END AS about, CASE WHEN action <> 'write' AND usable THEN '' ELSE verdict END AS verdict, action = 'keep' OR (action <> 'write' AND usable) AS keeps, kw, CASE WHEN doc_id % 10 = 0 THEN []::VARCHAR[] ELSE qs END AS qs FROM u) SELECT doc_id, CASE WHEN verdict <> '' THEN verdict WHEN about <> '' THEN 'write' ELSE 'keep' END AS verdict, about, CAST(len(kw) + len(qs) AS BIGINT) AS n_terms FROM f WHERE len(qs) > 0 AND (keeps OR about <> '')")
def training_references(spark, sf_dir):
    c, k = F.col, F.col("doc_id")
    ref = scoring.reference(c("action"), c("verdict"), c("said"), c("kw"), F.when(k % 10 == 0, F.array().cast("array<string>")).otherwise(c("qs")), scoring.candidate_ok(c("must"), c("must_not"), c("description")))
    got = _cases(spark, sf_dir).select("doc_id", ref.alias("r")).filter("r IS NOT NULL")
    return got.select("doc_id", "r.verdict", "r.about", (F.size("r.keywords") + F.size("r.queries")).cast("long").alias("n_terms"))


LEADS = ["", "Are you tired of notes that get lost whenever you change your phone, every single year?", "Notes.", "Keeps all of your notes in one place and shares them with people that you choose to trust."]


@query("mine_tags", f"WITH {_ABOUTS}, m AS (SELECT doc_id, about, doc_id % 3 AS n, {_list(LEADS)}[doc_id % 4 + 1] AS lead, doc_id % 5 = 0 AS none FROM ab), o AS (SELECT *, CASE WHEN lead = '' THEN 'no-lead' WHEN regexp_matches(lead, {_quoted(scoring.HOOK)}) THEN 'hook-first' WHEN len(lead) < 80 THEN 'slogan-first' END AS odd FROM m) SELECT doc_id, concat_ws(',', CASE WHEN n > 1 THEN 'multi-paragraph' END, CASE WHEN NOT coalesce({english_sql('about')}, true) THEN 'not-english' END, odd, CASE WHEN none THEN 'no-candidate' WHEN odd IS NULL THEN 'plain' END) AS tags FROM o")
def mine_tags(spark, sf_dir):
    k = F.col("doc_id")
    tags = scoring.mine_tags(F.array_repeat(F.lit("p"), (k % 3).cast("int")), _pick(LEADS, k % 4), F.col("about"), F.when(k % 5 == 0, "").otherwise("x"))
    return _abouts(spark, sf_dir).select("doc_id", F.array_join(tags, ",").alias("tags"))


DRAFT_MUST = [[["Notes ", ""], []], [[" "]], [["A", "b"]]]


@query("draft_labels", f"WITH {_ABOUTS}, w AS (SELECT doc_id, {_list(VERDICTS)}[doc_id % 4 + 1] AS verdict, about, CASE doc_id % 3 WHEN 0 THEN 'notes' WHEN 1 THEN '' ELSE 'a|b' END AS must FROM ab) SELECT doc_id, CASE WHEN starts_with(lower(verdict), 'keep') THEN 'keep' ELSE '' END AS action, must, 'the the,x' AS must_not, CASE WHEN starts_with(lower(verdict), 'keep') THEN '' ELSE about END AS about FROM w")
def draft_labels(spark, sf_dir):
    k = F.col("doc_id")
    w = scoring.want_of(_pick(VERDICTS, k % 4), _groups(DRAFT_MUST)(k % 3), F.array(F.lit(" The the"), F.lit(" "), F.lit("X")), F.col("about"))
    got = _abouts(spark, sf_dir).select("doc_id", w.alias("w"))
    return got.select("doc_id", "w.action", F.array_join(F.transform("w.must", lambda g: F.array_join(g, "|")), ";").alias("must"), F.array_join("w.must_not", ",").alias("must_not"), "w.about")


# Sheets: records dealt to lineitems, against the scan rows of reply_queries and a location row of those with an even order.
PLACE = "ACCESS_FINE_LOCATION, ACCESS_BACKGROUND_LOCATION"
RECORDS = [
    [["google_services", "yes", "Push arrives through Google."], ["camera", "yes", "CAMERA. Scans a code to log in."]],
    [["google_services", "no", ""], ["tracking", "yes", "Sentry and Acme report crashes."]],
    [["google_services", "no", "none here"], ["camera", "yes", "CAMERA"]],
    [["tracking", "yes", "Sentry reports crashes."], ["tracking", "yes", ""]],
    [["odd", "yes", ""]],
    [["google_services"]],
    [["camera", "no", "x"]],
    [["google_services", "yes", ""], ["fine_location", "yes", "ACCESS_FINE_LOCATION. Shows where you are."], ["offline_capable", "yes", "No INTERNET."]],
    [["fine_location", " YES ", "ACCESS_FINE_LOCATION, ACCESS_BACKGROUND_LOCATION. Shares it in chats."], ["ads", "yes", "Acme"], ["camera", "yes", "Scans codes"]],
    [],
]
WANTED = [[], [("camera", [["scan"]])], [("google_services", [["push", "cast"]]), ("odd", [["x"]])]]
_RECORDS_SQL = "[" + ",".join("[" + ",".join(_list(r) for r in recs) + "]::VARCHAR[][]" for recs in RECORDS) + "]"
_EVIDENCE = {"google_services": "Google Play services: Cast", "tracking": "Sentry, Acme", "ads": "Acme", "camera": "CAMERA", "offline_capable": "No INTERNET", "fine_location": PLACE}
_ROW = "{{'fact': '{f}', 'value': '{v}', 'evidence': '{e}'}}"
_WANT_ROWS = "list_filter([" + ", ".join(f"CASE WHEN {when} THEN " + _ROW.format(f=f, v=v, e=_EVIDENCE[f] if v == "yes" else "") + " END" for f, v, when in (("google_services", "yes", "google"), ("google_services", "no", "NOT google"), ("tracking", "yes", "tracking"), ("ads", "yes", "ads"), ("camera", "yes", "camera"), ("offline_capable", "yes", "offline"), ("fine_location", "yes", "camera"))) + "], lambda r: r IS NOT NULL)"
_SHEETS = f"""{_NOTES}, s0 AS (SELECT *, {_WANT_ROWS} AS rs, {_RECORDS_SQL}[l_partkey % 10 + 1] AS recs, l_suppkey % 3 AS wn FROM w),
s1 AS (SELECT *, list_transform(recs, lambda r: trim(r[1])) AS names FROM s0),
s2 AS (SELECT *, list_transform(recs, lambda r, i: CASE WHEN len(r) < 2 THEN {{'why': 'row "' || array_to_string(r, ',') || '" has no value', 'more': 0}} WHEN list_position(names, trim(r[1])) < i THEN {{'why': trim(r[1]) || ' twice', 'more': 0}} WHEN len(list_filter(rs, lambda x: x.fact = trim(r[1]))) = 0 THEN {{'why': trim(r[1]) || ' is not a scan row', 'more': 1}} WHEN lower(trim(r[2])) <> (list_filter(rs, lambda x: x.fact = trim(r[1])))[1].value THEN {{'why': trim(r[1]) || ' ' || lower(trim(r[2])) || ', the scan says ' || (list_filter(rs, lambda x: x.fact = trim(r[1])))[1].value, 'more': 1}} END) AS judged FROM s1),
s3 AS (SELECT *, (list_filter(range(1, len(judged) + 1), lambda i: judged[i] IS NOT NULL))[1] AS bad FROM s2),
s4 AS (SELECT *, CASE WHEN bad IS NULL THEN recs ELSE recs[1:bad - 1 + judged[bad].more] END AS readable, coalesce(judged[bad].why, CASE WHEN len(list_filter(rs, lambda x: NOT list_contains(names, x.fact))) > 0 THEN 'missing ' || array_to_string(list_transform(list_filter(rs, lambda x: NOT list_contains(names, x.fact)), lambda x: x.fact), ', ') END) AS rows_why FROM s3),
s5 AS (SELECT *, list_sort(list_transform(list_filter(rs, lambda x: len(list_filter(readable, lambda r: trim(r[1]) = x.fact)) > 0), lambda x: {{'fact': x.fact, 'value': x.value, 'evidence': x.evidence, 'note': trim(coalesce((list_filter(readable, lambda r: trim(r[1]) = x.fact))[1][3], ''))}})) AS seen FROM s4),
s6 AS (SELECT *, (list_filter(list_transform(seen, lambda x: CASE WHEN x.note <> '' AND x.evidence <> '' AND lower(trim(x.note, '. ')) = lower(trim(x.evidence, '. ')) THEN x.fact || ' note repeats the scan' WHEN x.fact = 'google_services' AND x.value = 'no' AND x.note <> '' THEN 'google_services no has a note' WHEN x.fact IN ('google_services', 'tracking', 'ads') AND x.value = 'yes' AND x.note = '' THEN x.fact || ' has no note'
  WHEN x.fact IN ('tracking', 'ads') AND x.value = 'yes' THEN x.fact || ' note does not name ' || (list_filter(string_split(x.evidence, ', '), lambda p: NOT contains(lower(x.note), lower(p))))[1]
  WHEN x.fact IN ('camera', 'fine_location') THEN CASE WHEN len(list_filter(string_split(x.evidence, ', '), lambda p: starts_with(x.note, p))) = 0 THEN x.fact || ' note does not start with ' || replace(x.evidence, ', ', ' or ') WHEN contains(x.evidence, 'ACCESS_BACKGROUND_LOCATION') AND NOT contains(x.note, 'ACCESS_BACKGROUND_LOCATION') THEN x.fact || ' note does not name ACCESS_BACKGROUND_LOCATION' WHEN len(list_filter(string_split_regex(regexp_replace(x.note, '{replies.PERMISSION_ID}', '', 'g'), '[^A-Za-z''-]+'), lambda q: q <> '')) < 3 THEN x.fact || ' note only names the permission' END END), lambda r: r IS NOT NULL))[1] AS notes_why,
  (list_filter(readable, lambda r: trim(r[1]) = 'camera'))[1] AS cam, (list_filter(readable, lambda r: trim(r[1]) = 'google_services'))[1] AS goo, (list_filter(readable, lambda r: trim(r[1]) = 'odd'))[1] AS odd FROM s5),
s7 AS (SELECT *, coalesce(notes_why, CASE wn WHEN 1 THEN CASE WHEN cam IS NULL THEN 'camera has no row' WHEN NOT contains(lower(coalesce(cam[3], '')), 'scan') THEN 'camera note missing scan' END WHEN 2 THEN CASE WHEN goo IS NULL THEN 'google_services has no row' WHEN NOT regexp_matches(lower(coalesce(goo[3], '')), 'push|cast') THEN 'google_services note missing push|cast' WHEN odd IS NULL THEN 'odd has no row' ELSE 'odd note missing x' END END) AS notes_fail FROM s6)"""


def _sheets(spark, sf_dir):
    n = _notes(spark, sf_dir)
    o, p, ads = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey") % 5 == 0
    none = F.array().cast("array<struct<fact:string,value:string,evidence:string>>")
    row = lambda f, v, when: F.when(when, F.array(F.struct(F.lit(f).alias("fact"), F.lit(v).alias("value"), F.lit(_EVIDENCE[f] if v == "yes" else "").alias("evidence")))).otherwise(none)
    # Whole arrays are concatenated: a lambda over elements is not compiled.
    rows = F.concat(row("google_services", "yes", o % 3 == 0), row("google_services", "no", o % 3 != 0), row("tracking", "yes", p % 3 == 0), row("ads", "yes", ads), row("camera", "yes", o % 2 == 0), row("offline_capable", "yes", p % 7 == 0), row("fine_location", "yes", o % 2 == 0))
    wanted = F.element_at(F.array(*[F.array(*[F.struct(F.lit(f).alias("fact"), F.array(*[F.array(*map(F.lit, g)) for g in gs]).alias("groups")) for f, gs in w]).cast("array<struct<fact:string,groups:array<array<string>>>>") for w in WANTED]), (F.col("l_suppkey") % 3 + 1).cast("int"))
    return n.withColumn("scan", rows).withColumn("records", _groups(RECORDS)(F.col("l_partkey") % 10)).withColumn("wanted", wanted)


@query("sheet_and_note_checks", f"WITH {_SHEETS} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, rows_why, notes_fail FROM s7")
def sheet_and_note_checks(spark, sf_dir):
    s = _sheets(spark, sf_dir).withColumn("sheet", scoring.sheet_check(F.col("scan"), F.col("records")))
    return s.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("sheet.why").alias("rows_why"), scoring.notes_fail(F.col("scan"), F.col("sheet.notes"), F.col("wanted")).alias("notes_fail"))


MORE = ["It may be sent to relays.", "It never sends your ads data.", "Your data is not shared with anyone.", "It is a safe and private app.", "Keeps your private key on disk.", "Talks to relay.example.com and api.acme.io.", "One. Two.\n\nThree.\n\nFour.", "Uses the camera to scan codes that others show you.", ""]
_SECURITY = {
    "accepted": "CASE WHEN l_partkey % 19 = 0 THEN 'refused' END",
    "absence": f"coalesce('\"' || nullif(regexp_extract(t, {_quoted(scoring.ABSENT)}), '') || '\"', '\"' || nullif(regexp_extract(t, {_quoted(scoring.NOT_SENT)}), '') || '\"')",
    "action": "CASE WHEN act = 'keep' AND NOT same THEN 'wrote a note, want no-change' WHEN act = 'write' AND same THEN 'no-change, want a new note' END",
    "banned": f"'\"' || (list_filter(regexp_extract_all(t, {_quoted(scoring.BANNED)}), lambda m: NOT regexp_matches(m, '{scoring.PRIVATE}')))[1] || '\"'",
    "english": f"CASE WHEN t <> '' AND NOT coalesce({english_sql('t')}, true) THEN 'not English' END",
    "hedge": f"'\"' || nullif(regexp_extract(t, '{scoring.HEDGE}'), '') || '\"'",
    "host": f"'\"' || (list_filter(regexp_extract_all(t, '{scoring.HOST}'), lambda h: NOT contains('get(\"relay.example.com\")', lower(h))))[1] || '\" is not in the source'",
    "length": "CASE WHEN t = '' THEN 'empty' WHEN len(t) > 500 THEN len(t) || ' characters, want under 500' END",
    "must": f"CASE WHEN t <> '' THEN {_missing_sql('must', 't')} END",
    "must_not": f"CASE WHEN t <> '' THEN {_forbidden_sql('must_not', 't')} END",
    "notes": "CASE WHEN t <> '' THEN notes_fail END",
    "permission_id": f"'\"' || nullif(regexp_extract(t, '{replies.PERMISSION_ID}'), '') || '\"'",
    "rows": "CASE WHEN t <> '' THEN rows_why END",
    "warning": f"CASE WHEN t = '' THEN NULL WHEN len(string_split(t, chr(10) || chr(10))) > 2 THEN len(string_split(t, chr(10) || chr(10))) || ' blocks, want a warning and the rest' WHEN len(string_split(t, chr(10) || chr(10))) = 2 AND len(regexp_extract_all(trim(string_split(t, chr(10) || chr(10))[1]), '{scoring.SENTENCE_END}')) > 1 THEN 'the warning is more than one sentence' WHEN warning AND NOT contains(t, chr(10) || chr(10)) THEN 'no warning, want one first' WHEN NOT warning AND contains(t, chr(10) || chr(10)) THEN 'opens with a warning, want none' END",
}


@query("score_security", f"WITH {_SHEETS}, z AS (SELECT *, trim(CASE WHEN lower(security) = 'no-change' THEN current ELSE security || ' ' || {_list(MORE)}[l_linenumber % 9 + 1] END) AS t, lower(security) = 'no-change' AS same, {_list(ACTIONS)}[l_partkey % 3 + 1] AS act, CASE WHEN l_suppkey % 4 <> 0 THEN l_suppkey % 2 = 0 END AS warning, {_groups_sql(MUST)}[l_orderkey % 4 + 1] AS must, {_lists(MUST_NOT)}[l_orderkey % 3 + 1] AS must_not FROM s7) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey % 23 = 0 THEN 'reply=timeout' ELSE concat_ws('; ', {', '.join(_check(k, s) for k, s in sorted(_SECURITY.items()))}) END AS fails FROM z")
def score_security(spark, sf_dir):
    p, s, o, line, c = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey"), F.col("l_linenumber"), F.col
    text = F.when(F.lower("security") == "no-change", F.col("security")).otherwise(F.concat("security", F.lit(" "), _pick(MORE, line % 9)))
    want = {"action": _pick(ACTIONS, p % 3), "warning": F.when(s % 4 != 0, s % 2 == 0), "must": _groups(MUST)(o % 4), "must_not": _pick(MUST_NOT, o % 3), "notes": c("wanted")}
    scored = scoring.score_security_cases(_sheets(spark, sf_dir), want, {"rows": c("scan"), "source": F.lit('get("relay.example.com")'), "current": c("current")}, {"security": text}, c("records"), F.when(p % 19 == 0, "refused"), F.when(p % 23 == 0, "timeout"))
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", _told(c("fails")).alias("fails"))


_TAGGED = "CASE x.fact " + " ".join(f"WHEN '{f}' THEN '{t}'" for f, t in scoring.FACT_TAGS.items()) + " END"


@query("security_case_tags", f"WITH {_SHEETS}, y AS (SELECT *, list_filter(rs, lambda x: x.value = 'yes') AS ys FROM s0), f AS (SELECT *, flatten(list_transform(ys, lambda x: [{_TAGGED}, CASE WHEN x.fact = 'fine_location' THEN 'background-location' END])) || [CASE WHEN NOT camera AND NOT tracking AND NOT ads THEN 'no-access' END, CASE WHEN source = '' THEN 'no-source' END, CASE WHEN current <> '' THEN 'current' END] AS ts FROM y) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, array_to_string(list_filter(ts, lambda t, i: t IS NOT NULL AND list_position(ts, t) = i), ',') AS tags FROM f")
def security_case_tags(spark, sf_dir):
    tags = scoring.security_tags(F.col("scan"), F.col("source"), F.col("current"))
    return _sheets(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.array_join(tags, ",").alias("tags"))


@query("pass_rate", f"WITH {_CASES}, s AS (SELECT error IS NULL AND concat_ws('; ', {', '.join(_check(k, s) for k, s in _SCORES.items())}) = '' AS ok FROM kq) SELECT CAST(count(*) FILTER (ok) AS BIGINT) AS passed, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (ok) AS DOUBLE) / count(*) AS rate, CAST(count(*) FILTER (ok) AS DOUBLE) / count(*) >= 0.8 AS enough FROM s")
def pass_rate(spark, sf_dir):
    c = F.col
    want = {"action": c("action"), "must": c("must"), "must_not": c("must_not")}
    fails = scoring.score_about(want, {"name": c("name"), "dev": F.lit(DEV)}, {"verdict": c("verdict"), "about": c("said"), "keywords": c("kw"), "queries": c("qs")}, c("description"), c("verified"), c("error"))
    return scoring.pass_rate(_cases(spark, sf_dir).select(fails.alias("fails")), least=0.8)


@query("export_training", f"WITH {_ABOUTS}, c AS (SELECT doc_id, 'c' || doc_id AS id, ['train', 'dev', 'test'][doc_id % 3 + 1] AS split, about, {_lists(QUERIES)}[doc_id % 6 + 1] AS qs, doc_id % 7 = 0 AS none FROM ab) SELECT id, '{{\"messages\":[{{\"role\":\"system\",\"content\":\"Be plain.\"}},{{\"role\":\"user\",\"content\":' || to_json(about) || '}},{{\"role\":\"assistant\",\"content\":' || to_json('{{\"verdict\":\"keep\",\"about\":\"\",\"keywords\":[],\"queries\":' || CAST(to_json(qs) AS VARCHAR) || '}}') || '}}]}}' AS json FROM c WHERE split = 'train' AND NOT none")
def export_training(spark, sf_dir):
    k = F.col("doc_id")
    none = F.array().cast("array<string>")
    ref = scoring.reference(F.lit("keep"), F.lit(""), F.lit(""), none, F.when(k % 7 == 0, none).otherwise(F.col("qs")), F.lit(True))
    cases = _abouts(spark, sf_dir).select(F.concat(F.lit("c"), k).alias("id"), _pick(["train", "dev", "test"], k % 3).alias("split"), F.lit("Be plain.").alias("system"), F.col("about").alias("user"), ref.alias("reply"), F.create_map().cast("map<string,string>").alias("fails"))
    return scoring.export_training(cases)
