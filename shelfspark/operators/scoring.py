"""Scores of labelled cases: what a reply must and must not say, note shape, sheets against the scan, drafts, tags and references.

All are Columns over a case and a reply, so an eval run is one projection and its report a group-by.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions import about, markdown
from shelfspark.functions.regex import re2_to_java
from shelfspark.functions.text import let
from shelfspark.operators import evals, listing, replies, scan
from shelfspark.plans.lineage import cut

# Patterns of what a note must not say (RE2), and things that may be called private.
HEDGE = r"(?i)\b(?:may|might|could|potentially|possibly)\b|can be a risk"
ABSENT = r"(?i)\b(?:does not|doesn't|do not|don't|never|no|without|not|nor)\b(?:\s+[\w-]+){0,3}?\s+(?:google|firebase|play services|ads|adverts?|advertising|trackers?|tracking|analytics|internet|network access)\b"
NOT_SENT = r"(?i)\b(?:isn't|aren't|never|not) (?:\w+ )?(?:sent|shared|collected|uploaded|transmitted)\b|\bno data\b"
BANNED = r"(?i)\b(?:safe|safely|secure|malware|the scan|scanner shows|the source|source code|quotes?|snippets?|webviews?|javascript|certificates?)\b|\bprivate\b(?:\s+(\w+))?"
PRIVATE = r"(?i)^private\s+(?:key|keys|messages|message|chats|chat|notes|relay|relays)$"
HOST = r"(?i)\b(?:[a-z0-9](?:[a-z0-9-]*[a-z0-9])?\.)+(?:com|org|net|io|app|dev|me|co|social|xyz|info|cloud|ai|eu|de|uk|fr|ch|nl|ru|cn|jp|world|network|site|online|tech|chat|so|is|to|gg|tv|fm|im|ly|sh)\b"
SENTENCE_END = r"[.!?](?:\s|$)"
HOOK = r"(?i)\?[\"”’)]*$|^(?:welcome|introducing|tired of|are you|do you|have you|ever |imagine|meet |say goodbye|say hello|no worries|looking for|ready to|stop |finally|what if|why )|\bis here to\b"
MOST_SECURITY, SLOGAN = 500, 80
# What a mined case exercises, by fact.
FACT_TAGS = {
    "tracking": "tracker",
    "ads": "ads",
    "google_services": "google",
    "offline_capable": "offline",
    "coarse_location": "location",
    "fine_location": "location",
    "read_sms": "sms-calls",
    "receive_sms": "sms-calls",
    "send_sms": "sms-calls",
    "call_log": "sms-calls",
    "camera": "camera-mic",
    "microphone": "camera-mic",
    "contacts": "contacts",
    "request_install_packages": "packages",
    "query_all_packages": "packages",
    "accessibility_service": "system-access",
    "notification_listener": "system-access",
    "device_admin": "system-access",
    "vpn_service": "system-access",
    "input_method": "system-access",
    "usage_stats": "system-access",
    "system_alert_window": "system-access",
}
#: Judged classes are broadcast up to so many of them and characters of their JSON; beyond, cases meet them by shuffle.
BROADCAST_CLASSES, BROADCAST_CHARS = 1 << 18, 1 << 26
SPLITS, ACTIONS = ("train", "dev", "test"), ("keep", "write")
_TEXTS = "array<string>"


def _first(reasons: Column) -> Column:
    return F.get(F.filter(reasons, lambda r: r.isNotNull()), F.lit(0))


def missing_groups(must: Column, text: Column) -> Column:
    """Why a text misses phrase groups: each needs one phrase that occurs, case aside."""
    low = F.lower(text)
    missing = F.filter(must, lambda g: ~F.exists(g, lambda p: F.contains(low, F.lower(p))))
    return F.when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(F.transform(missing, lambda g: F.array_join(g, "|")), ", ")))


def forbidden_phrases(must_not: Column, text: Column) -> Column:
    found = F.filter(must_not, lambda p: F.contains(F.lower(text), F.lower(p)))
    return F.when(F.size(found) > 0, F.concat(F.lit("contains "), F.array_join(found, ", ")))


def candidate_ok(must: Column, must_not: Column, candidate: Column) -> Column:
    """Would keeping the offered description pass the labels and read well?"""
    return (candidate != "") & missing_groups(must, candidate).isNull() & forbidden_phrases(must_not, candidate).isNull() & replies.garbled(candidate).isNull()


def score_about(want: dict[str, Column], listing: dict[str, Column], reply: dict[str, Column], description: Column, verified: Column, error: Column) -> Column:
    """Map of failed check -> reason of an about reply: eleven checks; a reply that never came fails ``reply`` alone.

    ``want``: action, must, must_not. ``listing``: name, dev (developer text).
    ``reply``: verdict, about, keywords, queries. ``verified``: why the words
    aren't the developer's, or null.
    """
    about = replies.reply_about(reply["verdict"], reply["about"], description)
    kept = about == ""
    shown = F.when(kept, description).otherwise(about)
    usable = F.coalesce(replies.usable_about(about, description), F.when(about != "", verified))
    n = F.length(shown)
    if_shown = lambda c: F.when(shown != "", c)
    checks = {
        "accepted": F.nullif(F.concat_ws("\n", replies.verdict_fails(reply["verdict"], about), usable), F.lit("")),
        "action": F.when((want["action"] == "keep") & ~kept, "wrote a paragraph, want the description kept").when((want["action"] == "write") & kept, "kept the description, want a written paragraph"),
        "length": if_shown(F.when(~n.between(replies.LEAST_ABOUT, replies.MOST_ABOUT), F.concat(n.cast("string"), F.lit(f" characters, want {replies.LEAST_ABOUT} to {replies.MOST_ABOUT}")))),
        "english": if_shown(F.when(~F.coalesce(replies.english(shown), F.lit(True)), "not English")),
        "name": if_shown(F.when(replies.names_app(listing["name"], listing["dev"], shown), F.concat(F.lit("names the app "), replies.quote(listing["name"])))),
        "garbled": if_shown(replies.garbled(shown)),
        "must": if_shown(missing_groups(want["must"], shown)),
        "must_not": if_shown(forbidden_phrases(want["must_not"], shown)),
        "keywords": replies.keywords_fail(reply["keywords"]),
        "queries": replies.queries_fail(reply["queries"], replies.brand_name(listing["name"], listing["dev"])),
    }
    checks = {k: F.when(error.isNull(), c) for k, c in checks.items()}
    return evals.fails(checks | {"reply": error})


# -- notes and sheets ---------------------------------------------------------


def banned_word(text: Column) -> Column:
    """The first word that a note must not have; a private key is a thing."""
    return F.get(F.filter(F.regexp_extract_all(text, F.lit(re2_to_java(BANNED)), 0), lambda m: ~m.rlike(re2_to_java(PRIVATE))), F.lit(0))


def unbacked_host(text: Column, source: Column) -> Column:
    """The first host name that the source doesn't have."""
    return F.get(F.filter(F.regexp_extract_all(text, F.lit(re2_to_java(HOST)), 0), lambda h: ~F.contains(F.lower(source), F.lower(h))), F.lit(0))


def warned(text: Column) -> Column:
    return F.contains(F.trim(text), F.lit("\n\n"))


def warning_shape(text: Column) -> Column:
    """Why what comes before an empty line is no single warning."""
    blocks = F.split(F.trim(text), "\n\n")
    ends = F.size(F.regexp_extract_all(F.trim(blocks[0]), F.lit(re2_to_java(SENTENCE_END)), 0))
    return F.when(F.size(blocks) > 2, F.concat(F.size(blocks).cast("string"), F.lit(" blocks, want a warning and the rest"))).when((F.size(blocks) == 2) & (ends > 1), "the warning is more than one sentence")


def _by_fact(rows: Column) -> Column:
    """One (fact, yes, value, evidence) per fact of an array of rows, in order of appearance: values of the last row, evidence joined."""

    def one(r: Column) -> Column:
        return let(F.filter(rows, lambda x: x["fact"] == r["fact"]), lambda mine: merged(r, mine))

    def merged(r: Column, mine: Column) -> Column:
        joined = F.aggregate(mine, F.lit(""), lambda acc, x: F.when(acc == "", x["evidence"]).otherwise(F.concat(acc, F.lit(", "), x["evidence"])))
        return F.struct(r["fact"].alias("fact"), F.exists(mine, lambda x: x["value"] == "yes").alias("yes"), F.element_at(mine, -1)["value"].alias("value"), joined.alias("evidence"))

    firsts = let(F.transform(rows, lambda r: r["fact"]), lambda names: F.filter(rows, lambda r, i: F.array_position(names, r["fact"]) == i + 1))
    return F.transform(firsts, one)


def sheet_check(rows: Column, records: Column) -> Column:
    """Struct (why, notes) of a reply's sheet against scan rows: one record per scanned fact with its value, and no other.

    ``why`` is the first record's reason, else the missing facts. ``notes`` are
    (fact, note) of the records read up to there.
    """
    whole = F.struct(_by_fact(rows).alias("want"), _records(records).alias("read"))
    return let(whole, lambda p: _sheet(p["want"], p["read"]))


def _records(records: Column) -> Column:
    return F.transform(records, lambda r: F.struct(F.size(r).alias("n"), F.trim(F.coalesce(F.get(r, F.lit(0)), F.lit(""))).alias("fact"), F.lower(F.trim(F.coalesce(F.get(r, F.lit(1)), F.lit("")))).alias("value"), F.trim(F.coalesce(F.get(r, F.lit(2)), F.lit(""))).alias("note"), F.array_join(r, ",").alias("raw")))


def _sheet(want: Column, read: Column) -> Column:
    return let(F.transform(read, lambda r: r["fact"]), lambda names: _sheet_of(want, read, names))


def _sheet_of(want: Column, read: Column, names: Column) -> Column:

    def judge(r: Column, i: Column) -> Column:
        return let(F.get(F.filter(want, lambda w: w["fact"] == r["fact"]), F.lit(0)), lambda scanned: against(r, i, scanned))

    def against(r: Column, i: Column, scanned: Column) -> Column:
        value = F.when(scanned["yes"], "yes").otherwise(scanned["value"])
        return F.coalesce(
            F.when(r["n"] < 2, F.struct(F.concat(F.lit("row "), replies.quote(r["raw"]), F.lit(" has no value")).alias("why"), F.lit(0).alias("more"))),
            F.when(F.array_position(names, r["fact"]) < i + 1, F.struct(F.concat(r["fact"], F.lit(" twice")).alias("why"), F.lit(0).alias("more"))),
            F.when(scanned.isNull(), F.struct(F.concat(r["fact"], F.lit(" is not a scan row")).alias("why"), F.lit(1).alias("more"))),
            F.when(r["value"] != value, F.struct(F.concat(r["fact"], F.lit(" "), r["value"], F.lit(", the scan says "), value).alias("why"), F.lit(1).alias("more"))),
        )

    judged = F.transform(read, judge)
    first = F.get(F.filter(F.transform(judged, lambda j, i: F.when(j.isNotNull(), F.struct(i.alias("i"), j["why"].alias("why"), j["more"].alias("more")))), lambda j: j.isNotNull()), F.lit(0))

    def told(bad: Column) -> Column:
        upto = F.coalesce(bad["i"] + bad["more"], F.size(read))
        notes = F.transform(F.slice(read, 1, upto), lambda r: F.struct(r["fact"].alias("fact"), r["note"].alias("note")))
        missing = F.filter(F.transform(want, lambda w: w["fact"]), lambda f: ~F.array_contains(names, f))
        return F.struct(F.coalesce(bad["why"], F.when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ", ")))).alias("why"), notes.alias("notes"))

    return let(first, told)


def _trim_dots(x: Column) -> Column:
    return F.lower(F.btrim(x, F.lit(". ")))


def permission_note_fails(fact: Column, evidence: Column, note: Column) -> Column:
    """Why a permission's note doesn't start with its id, lacks the background rider, or says nothing beside ids."""
    ids = F.filter(F.transform(F.split(evidence, ","), lambda p: F.trim(p)), lambda p: p != "")
    words = F.filter(F.split(F.regexp_replace(note, re2_to_java(replies.PERMISSION_ID), ""), "[^A-Za-z'-]+"), lambda w: w != "")
    return F.when(
        F.size(ids) > 0,
        F.coalesce(
            F.when(~F.exists(ids, lambda i: note.startswith(i)), F.concat(fact, F.lit(" note does not start with "), F.array_join(ids, " or "))),
            F.when(F.array_contains(ids, "ACCESS_BACKGROUND_LOCATION") & ~F.contains(note, F.lit("ACCESS_BACKGROUND_LOCATION")), F.concat(fact, F.lit(" note does not name ACCESS_BACKGROUND_LOCATION"))),
            F.when(F.size(words) < 3, F.concat(fact, F.lit(" note only names the permission"))),
        ),
    )


def notes_fail(rows: Column, notes: Column, wanted: Column) -> Column:
    """Why fact notes don't fit: the first reason by sorted fact, then the first of ``wanted`` (fact, groups) by fact."""
    said = lambda fact: F.get(F.filter(notes, lambda n: n["fact"] == fact), F.lit(0))["note"]

    def judge(r: Column) -> Column:
        return let(said(r["fact"]), lambda note: of(r, note))

    def of(r: Column, note: Column) -> Column:
        fact, yes = r["fact"], r["value"] == "yes"
        named = F.filter(F.transform(F.split(r["evidence"], ","), lambda p: F.trim(p)), lambda p: (p != "") & ~F.contains(F.lower(note), F.lower(p)))
        return F.when(
            note.isNotNull(),
            F.when((note != "") & (r["evidence"] != "") & (_trim_dots(note) == _trim_dots(r["evidence"])), F.concat(fact, F.lit(" note repeats the scan")))
            .when((fact == "google_services") & (r["value"] == "no") & (note != ""), "google_services no has a note")
            .when(fact.isin("google_services", "tracking", "ads") & yes & (note == ""), F.concat(fact, F.lit(" has no note")))
            .when(fact.isin("tracking", "ads") & yes, F.when(F.size(named) > 0, F.concat(fact, F.lit(" note does not name "), F.get(named, F.lit(0)))))
            .when(scan.is_permission(fact) & yes, permission_note_fails(fact, r["evidence"], note)),
        )

    def label(w: Column) -> Column:
        return let(said(w["fact"]), lambda note: F.when(note.isNull(), F.concat(w["fact"], F.lit(" has no row"))).otherwise(F.concat(w["fact"], F.lit(" note "), missing_groups(w["groups"], note))))

    first = let(F.array_sort(_by_fact(rows)), lambda facts: _first(F.transform(facts, judge)))
    return F.coalesce(first, _first(F.transform(F.array_sort(wanted), label)))


def score_security(want: dict[str, Column], case: dict[str, Column], reply: dict[str, Column], records: Column, accepted: Column, error: Column) -> Column:
    """Map of failed check -> reason of a security reply: fifteen checks.

    ``want``: action, warning, must, must_not, notes. ``case``: rows, source,
    current. ``records`` are those of the reply's sheet, or the previous one's
    where it says no-change; ``accepted`` why the reply would not be stored.
    """
    known = F.struct(F.trim(F.coalesce(reply["security"], F.lit(""))).alias("said"), F.trim(F.coalesce(case["current"], F.lit(""))).alias("current"), case["rows"].alias("rows"))

    def texts(k: Column) -> Column:
        same, text = _same_and_text(k["said"], k["current"])
        return F.struct(same.alias("same"), text.alias("text"), _sheet_and_notes(k["rows"], records, want["notes"]).alias("notes"))

    def judged(t: Column) -> Column:
        return F.struct(t["same"].alias("same"), t["text"].alias("text"), wording(t["text"], case["source"]).alias("wording"), t["notes"].alias("notes"))

    return let(let(let(known, texts), judged), lambda t: _security_fails(want, t["same"], t["text"], t["wording"], t["notes"], accepted, error))


def score_security_cases(cases: DataFrame, want: dict[str, Column], case: dict[str, Column], reply: dict[str, Column], records: Column, accepted: Column, error: Column, fails: str = "fails") -> DataFrame:
    """``cases`` with ``score_security`` of each; equal texts under equal labels, and equal sheets, are judged once however many cases have them."""
    same, text = _same_and_text(F.trim(F.coalesce(reply["security"], F.lit(""))), F.trim(F.coalesce(case["current"], F.lit(""))))
    said = F.struct(same.alias("same"), text.alias("text"), case["source"].alias("source"), *[want[k].alias(k) for k in ("action", "warning", "must", "must_not")])
    sheet = F.struct(case["rows"].alias("rows"), records.alias("records"), want["notes"].alias("wanted"))
    d = cases.select("*", accepted.alias("__accepted"), error.alias("__error"), said.alias("__said"), sheet.alias("__sheet"))
    # Both sides come from the bare cases: judging sheets does not repeat the join with the texts.
    texts = classes_of(d, "__said", "__text_fails", _texts_judged)
    sheets = classes_of(d, "__sheet", "__notes", lambda classes: classes.withColumn("__notes", evals.failed(_sheet_checks(_sheet_and_notes(*[F.col(f"__sheet.{k}") for k in ("rows", "records", "wanted")])))))
    d = d.join(texts, "__said").join(sheets, "__sheet")
    one = lambda check, reason: F.array(F.struct(F.lit(check).alias("check"), F.col(reason).cast("string").alias("reason")))
    none = F.array().cast("array<struct<check:string,reason:string>>")
    own = F.when(F.col("__accepted").isNotNull(), one("accepted", "__accepted")).otherwise(none)
    found = F.sort_array(F.concat("__text_fails", own, F.when(F.col("__said.text") != "", F.col("__notes")).otherwise(none)))
    return d.select(*cases.columns, F.map_from_entries(F.when(F.col("__error").isNull(), found).otherwise(one("reply", "__error"))).alias(fails))


def _texts_judged(classes: DataFrame) -> DataFrame:
    """Classes of texts and labels with what fails of the two; words are judged once per text."""
    k = lambda name: F.col(f"__said.{name}")
    texts = cut(classes, "texts").withColumn("__text", F.struct(k("text").alias("text"), k("source").alias("source")))
    d = judged_once(texts, "__text", "__wording", lambda c: c.withColumn("__wording", wording(F.col("__text.text"), F.col("__text.source"))))
    want = {n: k(n) for n in ("action", "warning", "must", "must_not")}
    return d.select("__said", evals.failed(_text_checks(want, k("same"), k("text"), F.col("__wording"))).alias("__text_fails"))


def classes_of(cases: DataFrame, by: str, name: str, judge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(by, name): what ``judge`` adds to the distinct structs ``by`` of ``cases``, formed once per struct; broadcast while that is bounded."""
    classes = cut(judge(cases.select(by).distinct()).select(by, name), "judged")
    n = classes.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.length(F.to_json(F.struct(by, name)))), F.lit(0)).alias("size")).first()
    return F.broadcast(classes) if n.rows <= BROADCAST_CLASSES and n.size <= BROADCAST_CHARS else classes


def judged_once(cases: DataFrame, by: str, name: str, judge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``cases`` with ``name``, what ``judge`` adds to the distinct structs ``by``: formed once per struct and joined to all that have it."""
    return cases.join(classes_of(cases, by, name, judge), by)


def _same_and_text(said: Column, current: Column) -> tuple[Column, Column]:
    same = replies.no_change(said)
    return same, F.when(same, current).otherwise(said)


def _sheet_and_notes(rows: Column, records: Column, wanted: Column) -> Column:
    return let(sheet_check(rows, records), lambda s: F.struct(s["why"].alias("rows"), notes_fail(rows, s["notes"], wanted).alias("notes")))


def wording(text: Column, source: Column) -> Column:
    """Struct of the checks of a note's words, by check, and whether it opens with a warning."""
    word = lambda p: replies.quote(replies.hit(text, p))
    checks = {
        "english": F.when(~F.coalesce(replies.english(text), F.lit(True)), F.lit("not English")),
        "hedge": word(HEDGE),
        "absence": F.coalesce(word(ABSENT), word(NOT_SENT)),
        "banned": replies.quote(banned_word(text)),
        "permission_id": word(replies.PERMISSION_ID),
        "host": F.concat(replies.quote(unbacked_host(text, source)), F.lit(" is not in the source")),
        "shape": warning_shape(text),
        "opens": warned(text),
    }
    return F.struct(*[c.alias(n) for n, c in checks.items()])


def _text_checks(want: dict[str, Column], same: Column, text: Column, said: Column) -> dict[str, Column]:
    """Checks of a note against the labels, by name; ``said`` is its ``wording``."""
    n = F.length(text)
    opens = said["opens"]
    checks = {name: said[name] for name in ("english", "hedge", "absence", "banned", "permission_id", "host")} | {
        "warning": F.coalesce(said["shape"], F.when(want["warning"] & ~opens, "no warning, want one first").when(~want["warning"] & opens, "opens with a warning, want none")),
        "must": missing_groups(want["must"], text),
        "must_not": forbidden_phrases(want["must_not"], text),
    }
    return {k: F.when(text != "", c) for k, c in checks.items()} | {
        "action": F.when((want["action"] == "keep") & ~same, "wrote a note, want no-change").when((want["action"] == "write") & same, "no-change, want a new note"),
        "length": F.when(text == "", "empty").when(n > MOST_SECURITY, F.concat(n.cast("string"), F.lit(f" characters, want under {MOST_SECURITY}"))),
    }


def _sheet_checks(notes: Column) -> dict[str, Column]:
    return {"rows": notes["rows"], "notes": notes["notes"]}


def _security_fails(want: dict[str, Column], same: Column, text: Column, said: Column, notes: Column, accepted: Column, error: Column) -> Column:
    checks = _text_checks(want, same, text, said) | {k: F.when(text != "", c) for k, c in _sheet_checks(notes).items()} | {"accepted": accepted}
    checks = {k: F.when(error.isNull(), c) for k, c in checks.items()}
    return evals.fails(checks | {"reply": error})


# -- cases --------------------------------------------------------------------


def case_fails(id_: Column, split: Column, action: Column, about: Column, description: Column, must: Column, must_not: Column) -> Column:
    """Why an about case can't be scored; null if it can."""
    at = F.concat(id_, F.lit(": "))
    return F.when(F.coalesce(id_, F.lit("")) == "", "no id").otherwise(
        F.concat(
            at,
            F.coalesce(
                F.when(~split.isin(*SPLITS), F.concat(F.lit("split "), replies.quote(split), F.lit(" is not one of [train dev test]"))),
                F.when((action != "") & ~action.isin(*ACTIONS), F.concat(F.lit("action "), replies.quote(action), F.lit(" is not one of [keep write]"))),
                F.when((action == "keep") & (about != ""), "action keep has a reference about"),
                F.when((action == "keep") & (description == ""), "action keep, but no description is offered"),
                F.when((F.size(must) == 0) & (F.size(must_not) == 0) & (action == ""), "want has no action, must, or must_not"),
                F.when(F.exists(must, lambda g: F.size(g) == 0), "empty must group"),
            ),
        )
    )


def select_cases(cases: DataFrame, split: str = "", tag: str = "", has: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Cases of a split and with a tag, if given, without those that ``has`` lists."""
    got = cases if not split else cases.filter(F.col("split") == split)
    got = got if not tag else got.filter(F.array_contains("tags", tag))
    return got if has is None else got.join(has.select(key).distinct(), key, "left_anti")


def mined_cases(events: DataFrame, kind: int = 32267) -> DataFrame:
    """Unlabelled cases (id, tags, listing, note) from listing events (kind, tags, content): of repeated tags the last counts, events without an id or content give none."""
    t = F.col("tags")
    last = lambda name: F.coalesce(F.try_element_at(listing.values(t, name), F.lit(-1)), F.lit(""))
    e = events.filter((F.col("kind") == kind) & (F.trim("content") != "")).withColumn("id", last("d")).filter("id <> ''")
    name = last("name")
    e = e.withColumn("candidate", about.offered(F.col("id"), name, F.col("content")))
    tags = mine_tags(markdown.paragraphs_of(F.col("content")), markdown.lead_of(F.col("content")), F.col("content"), F.col("candidate"))
    text = F.struct(name.alias("name"), last("summary").alias("summary"), F.col("content").alias("content"), listing.values(t, "t").alias("tags"), last("url").alias("website"), last("repository").alias("repository"), last("license").alias("license"))
    return e.select("id", tags.alias("tags"), text.alias("listing"), F.concat(F.lit("candidate: "), "candidate").alias("note"))


def candidate_state(must: Column, must_not: Column, candidate: Column, action: Column) -> Column:
    """Struct (state, bad): ok, wrong or none, and whether a keep label is bad for it."""
    state = F.when(candidate == "", "none").when(candidate_ok(must, must_not, candidate), "ok").otherwise("wrong")
    return F.struct(state.alias("state"), ((action == "keep") & (state != "ok")).alias("bad"))


def candidate_counts(cases: DataFrame, state: str = "state", bad: str = "bad") -> DataFrame:
    return cases.agg(*[F.count_if(F.col(state) == s).alias(s) for s in ("ok", "wrong", "none")], F.count_if(F.col(bad)).alias("bad"))


def reference(action: Column, verdict: Column, about: Column, keywords: Column, queries: Column, usable: Column) -> Column:
    """The reply to train on, or null: a usable description is kept unless the label says write."""
    keeps = (action == "keep") | ((action != "write") & usable)
    text = F.when((action != "write") & usable, "").otherwise(about)
    said = F.when((action != "write") & usable, "").otherwise(F.coalesce(verdict, F.lit("")))
    verdict = F.when(said != "", said).when(text != "", "write").otherwise("keep")
    return F.when((F.size(queries) > 0) & (keeps | (text != "")), F.struct(verdict.alias("verdict"), text.alias("about"), F.coalesce(keywords, F.array().cast(_TEXTS)).alias("keywords"), queries.alias("queries")))


def mine_tags(paragraphs: Column, lead: Column, content: Column, candidate: Column) -> Column:
    """What a mined case exercises, in order."""
    odd = F.when(lead == "", "no-lead").when(lead.rlike(re2_to_java(HOOK)), "hook-first").when(F.length(lead) < SLOGAN, "slogan-first")
    return F.array_compact(F.array(F.when(F.size(paragraphs) > 1, "multi-paragraph"), F.when(~F.coalesce(replies.english(content), F.lit(True)), "not-english"), odd, F.when(candidate == "", "no-candidate").when(odd.isNull(), "plain")))


def security_tags(rows: Column, source: Column, current: Column) -> Column:
    """What a security case exercises: tags of its yes rows in order of appearance, then what it lacks or has beside."""
    tags = F.create_map(*[F.lit(x) for kv in FACT_TAGS.items() for x in kv])
    yes = F.filter(rows, lambda r: r["value"] == "yes")
    own = F.flatten(F.transform(yes, lambda r: F.array_compact(F.array(F.try_element_at(tags, r["fact"]), F.when(r["fact"].isin(*scan.LOCATION) & F.contains(r["evidence"], F.lit("ACCESS_BACKGROUND_LOCATION")), "background-location")))))
    quiet = ~F.exists(yes, lambda r: scan.is_permission(r["fact"]) | r["fact"].isin("tracking", "ads"))
    return F.array_distinct(F.concat(own, F.array_compact(F.array(F.when(quiet, "no-access"), F.when(F.trim(source) == "", "no-source"), F.when(F.trim(current) != "", "current")))))


def lower_all(phrases: Column) -> Column:
    return F.filter(F.transform(phrases, lambda p: F.lower(F.trim(p))), lambda p: p != "")


def lower_groups(groups: Column) -> Column:
    return F.filter(F.transform(groups, lower_all), lambda g: F.size(g) > 0)


def phrase_groups(raw: Column) -> Column:
    """Groups of phrases from JSON: a list of lists, or one flat list as a single group."""
    flat = F.from_json(raw, "array<string>")
    nested = F.from_json(raw, "array<array<string>>")
    is_flat = F.trim(raw).rlike(r'^\[\s*("|\])')
    return F.when(is_flat, F.when(F.size(flat) > 0, F.array(flat)).otherwise(F.array().cast("array<array<string>>"))).otherwise(nested)


def want_of(verdict: Column, must: Column, must_not: Column, about: Column) -> Column:
    """Labels from a draft: phrases small, a verdict of keep has no about."""
    keeps = F.lower(F.trim(F.coalesce(verdict, F.lit("")))).startswith("keep")
    return F.struct(F.when(keeps, "keep").otherwise("").alias("action"), verdict.alias("verdict"), lower_groups(must).alias("must"), lower_all(must_not).alias("must_not"), F.when(keeps, "").otherwise(F.trim(about)).alias("about"))


def draft_fails(want: Column, invalid: Column, usable: Column, reference_fails: Column, keywords: Column, queries: Column, brand: Column) -> Column:
    """Why a drafted case's labels don't hold for its own reply."""
    return F.coalesce(
        F.when(F.size(want["must"]) == 0, "must is empty"),
        invalid,
        F.when((want["action"] == "keep") & ~usable, "verdict keep, but the Description fails your must or must_not, or reads garbled"),
        F.when(want["action"] != "keep", reference_fails),
        F.concat(F.lit("queries: "), replies.queries_fail(queries, brand)),
        F.concat(F.lit("keywords: "), replies.keywords_fail(keywords)),
    )


def export_training(cases: DataFrame, reply: str = "reply", fails: str = "fails", key: str = "id") -> DataFrame:
    """(key, json) of the train split's chat examples; cases without a reference are skipped, one that fails its own checks fails the job.

    ``cases`` has (key, split, system, user, reply, fails): ``reply`` from
    ``reference`` and ``fails`` the map of its score.
    """
    train = cases.filter(F.col("split") == "train").filter(F.col(reply).isNotNull())
    sure = F.when(F.size(fails) > 0, F.raise_error(F.concat(F.col(key), F.lit(": reference reply fails its own checks: "), evals.first_failure(F.col(fails))))).otherwise(F.to_json(reply))
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return train.select(key, F.to_json(F.struct(F.array(turn("system", F.col("system")), turn("user", F.col("user")), turn("assistant", sure)).alias("messages"))).alias("json"))


def pass_rate(results: DataFrame, fails: str = "fails", least: float = 0.0) -> DataFrame:
    """(passed, total, rate, enough): the share of results without a failed check, against a least rate."""
    n = results.agg(F.count_if(F.size(fails) == 0).alias("passed"), F.count(F.lit(1)).alias("total"))
    rate = F.when(F.col("total") > 0, F.col("passed") / F.col("total")).otherwise(F.lit(0.0))
    return n.withColumn("rate", rate).withColumn("enough", F.col("rate") >= least)
