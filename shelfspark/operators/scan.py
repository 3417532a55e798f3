"""What a package holds, as fact rows, and the texts made of them: prose, notes, sheet, the note from the scan alone, the stored document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.regex import re2_to_java as java
from shelfspark.functions.text import let
from shelfspark.operators import facts
from shelfspark.plans.lineage import spread

# What makes a library Google's services, or its messaging; frameworks by name.
GOOGLE = ("/com/google/android/gms", "play-services", "play services", "google mobile services")
MESSAGING = ("firebase/messaging", "firebase-messaging", "firebase cloud messaging")
FRAMEWORKS = ("flutter", "react native", "hermes", "sqlcipher")
# Names of Google's services that say nothing beside others.
GENERIC = ("google mobile services", "play services", "google play services")
# Permission facts in words.
DESCRIBED = {
    "contacts": "Can read contacts",
    "read_sms": "Can read SMS",
    "receive_sms": "Can receive SMS",
    "send_sms": "Can send SMS",
    "coarse_location": "Can read coarse location",
    "fine_location": "Can read fine location",
    "camera": "Can use the camera",
    "microphone": "Can use the microphone",
    "call_log": "Can read the call log",
    "request_install_packages": "Can install other apps",
    "query_all_packages": "Can see every installed app",
    "system_alert_window": "Can draw over other apps",
    "accessibility_service": "Can run as an accessibility service",
    "notification_listener": "Can read notifications",
    "device_admin": "Can act as a device admin",
    "vpn_service": "Can run a VPN",
    "input_method": "Can act as a keyboard",
    "usage_stats": "Can see which apps you use",
}
# An access as a noun, for a warning, and as a line of the note.
ACCESS = {
    "contacts": ("Contacts access", "Reads your contacts."),
    "read_sms": ("Reading text messages", "Reads text messages."),
    "receive_sms": ("Receiving text messages", "Receives text messages."),
    "send_sms": ("Sending text messages", "Can send text messages."),
    "location": ("Location access", "Reads your location."),
    "camera": ("Camera access", "Uses the camera."),
    "microphone": ("Microphone access", "Records audio."),
    "call_log": ("Call history access", "Reads your call history."),
    "request_install_packages": ("Installing apps", "Can install apps."),
    "query_all_packages": ("Seeing all installed apps", "Sees all installed apps."),
    "system_alert_window": ("Drawing over other apps", "Draws over other apps."),
    "accessibility_service": ("Accessibility access", "Can read and control the screen through accessibility."),
    "notification_listener": ("Reading notifications", "Reads your notifications."),
    "device_admin": ("Device admin access", "Has device admin access."),
    "vpn_service": ("VPN access", "Can route traffic through a VPN."),
    "input_method": ("Keyboard access", "Works as a keyboard."),
    "usage_stats": ("Reading app usage", "Reads app usage."),
}
# Words with which a listing states a use of an access.
STATED = {
    "camera": r"(?i)camera|\bqr\b|barcode|\bscan|photo|picture|video",
    "microphone": r"(?i)microphone|\bmic\b|voice|audio|record|speech|sound",
    "coarse_location": r"(?i)locat|\bgps\b|near|\bmaps?\b|position|where you",
    "fine_location": r"(?i)locat|\bgps\b|near|\bmaps?\b|position|where you",
    "contacts": r"(?i)contact|address book|phone ?book",
    "read_sms": r"(?i)\bsms\b|text messag",
    "receive_sms": r"(?i)\bsms\b|text messag",
    "send_sms": r"(?i)\bsms\b|text messag",
    "call_log": r"(?i)call (?:log|history)|recent calls",
    "request_install_packages": r"(?i)install|\bapks?\b|update",
    "query_all_packages": r"(?i)installed (?:apps|applications|packages)|app list|list of apps",
    "system_alert_window": r"(?i)overlay|floating|on top of|over other apps|pop-?up|bubble",
    "usage_stats": r"(?i)usage|screen time",
}
LOCATION = ("coarse_location", "fine_location")
PERMISSION_FACTS = tuple(DESCRIBED)
# Facts of a stored document, and those of which a no is stated.
PILLS = ("google_services", "ads", "tracking", "offline_capable", "source_available")
FALSE_PILLS = ("source_available", "google_services", "offline_capable")
_NONE = "array<string>"


def _has(x: Column, needles: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for n in needles:
        out = out | F.contains(x, F.lit(n))
    return out


def _blank(x: Column) -> Column:
    return F.coalesce(F.trim(x), F.lit("")) == ""


def is_permission(fact: Column) -> Column:
    return fact.isin(*PERMISSION_FACTS)


def library_facts(name: Column, id_: Column, kind: Column, path: Column, anti: Column) -> Column:
    """Array of (fact, label) that one library gives: Google's services and messaging of any library, tracking and ads of what is no framework."""
    label = F.trim(F.coalesce(F.nullif(name, F.lit("")), id_, F.lit("")))
    blob = F.lower(F.concat_ws(" ", path, id_, name))
    type_ = F.lower(F.coalesce(kind, F.lit("")))
    plain = (type_ != "development framework") & ~F.lower(F.coalesce(name, F.lit(""))).isin(*FRAMEWORKS)
    held = F.coalesce(anti, F.array().cast(_NONE))
    said = lambda fact, text, when: F.when(when, F.struct(F.lit(fact).alias("fact"), text.alias("label")))
    return F.array_compact(
        F.array(
            said("google_services", F.concat(F.lit("Google Play services: "), label), _has(blob, GOOGLE)),
            said("google_services", F.concat(F.lit("Firebase Cloud Messaging: "), label), _has(blob, MESSAGING)),
            said("tracking", label, plain & ((type_ == "mobile analytics") | F.array_contains(held, "Tracking"))),
            said("ads", label, plain & ((type_ == "advertisement") | F.array_contains(held, "Ads"))),
        )
    )


def scan_rows(apps: DataFrame, libraries: DataFrame, app: str = "app_id") -> DataFrame:
    """(app, fact, value, basis, source, evidence) of each app's package.

    ``apps`` has (app, hash, manifest, permissions), ``libraries`` (app, id,
    name, type, path, anti). Google's services are a row of every app, yes or
    no; permissions count only where the manifest could be read.
    """
    n = libraries.count()
    apps, libraries = spread(apps, app, n), spread(libraries, app, n)
    each = libraries.select(app, F.explode(library_facts(F.col("name"), F.col("id"), F.col("type"), F.col("path"), F.col("anti"))).alias("f")).select(app, "f.fact", F.nullif("f.label", F.lit("")).alias("label"))
    found = facts.library_rows(each, app)
    google = found.filter("fact = 'google_services'").select(F.col(app).alias("__has"))
    none = apps.join(google, F.col(app) == F.col("__has"), "left_anti").select(app, F.lit("google_services").alias("fact"), F.lit("no").alias("value"), F.lit("").alias("evidence"))
    asked = facts.permission_rows(apps.filter("manifest"), app, "permissions")
    rows = found.unionByName(none).unionByName(asked)
    source = apps.select(F.col(app).alias("__app"), F.lower(F.trim("hash")).alias("source"))
    return rows.join(source, F.col(app) == F.col("__app")).select(app, "fact", "value", F.lit("apk").alias("basis"), "source", "evidence")


def describe(fact: Column, value: Column, evidence: Column) -> Column:
    """A fact in plain English; empty where there is nothing to say. Permission ids stay out."""
    told = F.trim(F.coalesce(evidence, F.lit("")))
    with_ = lambda text: F.concat(F.lit(text), F.when(told != "", F.concat(F.lit(": "), told)).otherwise(""))
    known = F.create_map(*[F.lit(x) for kv in DESCRIBED.items() for x in kv])
    return (
        F.when((fact == "tracking") & (told == ""), "")
        .when(fact == "tracking", with_("Includes a tracker"))
        .when(fact == "ads", with_("Includes ads"))
        .when((fact == "google_services") & (value == "no"), "No Google services")
        .when(fact == "google_services", with_("Includes Google services"))
        .when(fact == "offline_capable", "No INTERNET")
        .otherwise(F.coalesce(F.try_element_at(known, fact), F.lit("")))
    )


def prose(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, prose): a line for each fact read from the package, in order of fact and evidence."""
    said = rows.filter((F.col("basis") == "apk") & ((F.col("value") == "yes") | ((F.col("fact") == "google_services") & (F.col("value") == "no"))))
    line = F.concat(F.lit("- "), F.col("fact"), F.lit(": "), F.col("text"), F.lit("\n"))
    said = said.withColumn("text", describe(F.col("fact"), F.col("value"), F.col("evidence"))).filter("text <> ''").select(*keys, F.struct("fact", "evidence", line.alias("line")).alias("s"))
    return said.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["line"]), "").alias("prose"))


def needs_reason(fact: Column, value: Column, evidence: Column) -> Column:
    """Facts whose purpose is to be put in words."""
    return (value == "yes") & F.when(fact.isin("google_services", "ads", "tracking"), ~_blank(evidence)).otherwise(is_permission(fact))


def evidence_parts(evidence: Column, permissions: bool) -> Column:
    """The permission ids among comma-separated findings, or the other findings."""
    parts = F.filter(F.transform(F.split(F.coalesce(evidence, F.lit("")), ","), lambda p: F.trim(p)), lambda p: p != "")
    is_id = lambda p: p.rlike(r"^[A-Z0-9_]+\z")
    return F.filter(parts, is_id if permissions else lambda p: ~is_id(p))


def _generic(name: Column) -> Column:
    return F.lower(F.trim(name)).isin(*GENERIC)


def _findings(phrase: Column, parts: Column) -> Column:
    """Findings by kind, ``Kind: a, b; c``, without what the phrase names already and without generic names beside others."""
    cut = F.transform(parts, lambda p: F.when(F.contains(p, F.lit(": ")), F.struct(F.substring_index(p, ": ", 1).alias("kind"), F.substring(p, F.instr(p, ": ") + 2, F.length(p)).alias("name"))).otherwise(F.struct(F.lit("").alias("kind"), p.alias("name"))))
    named = F.filter(cut, lambda c: (phrase == "") | ~(F.contains(F.lower(phrase), F.lower(c["name"])) | _generic(c["name"])))

    def shown(names: Column) -> Column:
        return let(F.filter(names, lambda n: ~_generic(n)), lambda special: F.when((F.size(names) > 1) & (F.size(special) > 0), special).otherwise(names))

    def text(kept: Column, kind: Column) -> Column:
        names = F.transform(F.filter(kept, lambda c: c["kind"] == kind), lambda c: c["name"])
        return F.concat(F.when(kind != "", F.concat(kind, F.lit(": "))).otherwise(""), F.array_join(let(names, shown), ", "))

    return let(named, lambda kept: F.array_join(F.transform(F.array_distinct(F.transform(kept, lambda c: c["kind"])), lambda kind: text(kept, kind)), "; "))


def reason_text(reason: Column, evidence: Column) -> Column:
    """The phrase given, unless it only repeats permission ids, and the findings that are no ids."""
    return _reason(reason, evidence_parts(evidence, True), evidence_parts(evidence, False))


def _reason(reason: Column, ids: Column, others: Column) -> Column:
    def spoken(said: Column) -> Column:
        bare = F.regexp_replace(F.regexp_replace(F.lower(said), r" permissions\z", ""), r" permission\z", "")
        return F.when((F.size(ids) > 0) & let(bare, lambda b: (b != "") & (b == F.lower(F.array_join(ids, ", ")))), "").otherwise(said)

    def whole(phrase: Column, found: Column) -> Column:
        stop = F.when(phrase.rlike(r"[.!?]\z"), "").otherwise(".")
        return F.when(phrase == "", found).when(found == "", phrase).otherwise(F.concat(phrase, stop, F.lit(" "), F.when(F.contains(found, F.lit(": ")), "").otherwise("Libraries: "), found, F.lit(".")))

    return let(let(F.trim(F.coalesce(reason, F.lit(""))), spoken), lambda phrase: let(_findings(phrase, others), lambda found: whole(phrase, found)))


def notes_text(reason: Column, evidence: Column) -> Column:
    """The note of a fact: permission ids first, unless the text has them, then the reason."""
    parts = F.filter(F.transform(F.split(F.coalesce(evidence, F.lit("")), ","), lambda p: F.trim(p)), lambda p: p != "")
    cut = let(F.transform(parts, lambda p: F.struct(p.alias("p"), p.rlike(r"^[A-Z0-9_]+\z").alias("id"))), lambda all_: F.struct(F.transform(F.filter(all_, lambda x: x["id"]), lambda x: x["p"]).alias("ids"), F.transform(F.filter(all_, lambda x: ~x["id"]), lambda x: x["p"]).alias("others")))

    def note(ids: Column, text: Column) -> Column:
        return F.when((ids == "") | F.contains(text, ids), text).when(text == "", ids).otherwise(F.concat(ids, F.lit(". "), text))

    return let(cut, lambda c: let(F.struct(F.array_join(c["ids"], ",").alias("ids"), _reason(reason, c["ids"], c["others"]).alias("text")), lambda p: note(p["ids"], p["text"])))


def sheet_csv(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, csv): a quoted line of fact, value and note for each fact, merged to one row each, in order of ``pos``."""
    once = facts.one_per_fact(rows, keys)
    line = facts.csv_line(F.col("fact"), F.col("value"), notes_text(F.col("reason"), F.col("evidence")))
    return once.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))), lambda s: F.concat(s["line"], F.lit("\n"))), "").alias("csv"))


# -- the note from the scan alone --------------------------------------------


def _lower_first(x: Column) -> Column:
    return F.concat(F.lower(F.substring(x, 1, 1)), F.substring(x, 2, 1 << 20))


def _and(items: Column) -> Column:
    """``A, b and c``; the last two are joined by and, all but the first begin small."""
    small = F.transform(items, lambda x, i: F.when(i == 0, x).otherwise(_lower_first(x)))
    head = F.array_join(F.slice(small, 1, F.greatest(F.size(small) - 1, F.lit(0))), ", ")
    return F.when(F.size(items) <= 1, F.array_join(items, "")).otherwise(F.concat(head, F.lit(" and "), F.element_at(small, -1)))


def _named(rows: Column, fact: str, none: str, one: str, many: str) -> Column:
    """A sentence of the libraries behind a fact; null if the fact has no row. Names count once, case aside."""

    def distinct(names: Column) -> Column:
        return F.filter(names, lambda n, i: F.array_position(F.transform(names, lambda x: F.lower(x)), F.lower(n)) == i + 1)

    def text(names: Column) -> Column:
        listed = F.concat(F.array_join(F.slice(names, 1, F.greatest(F.size(names) - 1, F.lit(0))), ", "), F.lit(" and "), F.element_at(names, -1))
        return F.when(F.size(names) == 0, none).when(F.size(names) == 1, F.concat(F.lit(one), F.element_at(names, 1))).otherwise(F.concat(F.lit(many), listed))

    mine = F.filter(rows, lambda r: r["fact"] == fact)
    names = F.filter(F.flatten(F.transform(mine, lambda r: F.transform(F.split(r["evidence"], ","), lambda n: F.trim(n)))), lambda n: n != "")
    return F.when(F.exists(rows, lambda r: r["fact"] == fact), F.concat(F.lit("Includes "), let(let(names, distinct), text), F.lit(".")))


def security_template(rows: Column, quoted: Column, stated: Column) -> Column:
    """Struct (security, reasons) from an app's scan rows in sheet order.

    ``rows`` is an array of (fact, value, basis, evidence), ``quoted`` the facts
    that code quotes show, ``stated`` what the developer says. An access is used
    if quoted or stated; what isn't opens the note with a warning.
    """
    nouns = F.create_map(*[F.lit(x) for kv in {k: v[0] for k, v in ACCESS.items()}.items() for x in kv])
    lines = F.create_map(*[F.lit(x) for kv in {k: v[1] for k, v in ACCESS.items()}.items() for x in kv])
    says = F.array_compact(F.array(*[F.when(stated.rlike(java(p)), f) for f, p in STATED.items()]))
    yes = F.filter(rows, lambda r: (r["basis"] == "apk") & (r["value"] == "yes"))

    def access(known: Column) -> Column:
        place = F.array_contains(quoted, LOCATION[0]) | F.array_contains(quoted, LOCATION[1])
        used = lambda fact: F.array_contains(quoted, fact) | (fact.isin(*LOCATION) & place) | F.array_contains(known["says"], fact)
        mine = F.filter(known["yes"], lambda r: is_permission(r["fact"]))
        return F.transform(mine, lambda r: F.struct(r["fact"].alias("fact"), F.when(r["fact"].isin(*LOCATION), "location").otherwise(r["fact"]).alias("key"), used(r["fact"]).alias("used"), F.trim(F.substring_index(r["evidence"], ",", 1)).alias("id")))

    def firsts(own: Column) -> Column:
        keys = F.transform(own, lambda a: a["key"])
        return F.filter(own, lambda a, i: F.array_position(keys, a["key"]) == i + 1)

    def note(f: Column, found: Column, own: Column) -> Column:
        unused = F.transform(F.filter(f, lambda a: ~a["used"]), lambda a: F.element_at(nouns, a["key"]))
        shown = F.transform(F.filter(f, lambda a: a["used"]), lambda a: F.element_at(lines, a["key"]))
        has = lambda fact: F.exists(found, lambda r: r["fact"] == fact)
        said = F.concat(shown, F.when(has("google_services"), F.array(F.lit("Includes Google Play services."))).otherwise(F.array().cast(_NONE)))
        missing = let(unused, lambda u: F.when(F.size(u) > 0, F.concat(_and(u), F.when(F.size(u) > 1, " have no shown use.").otherwise(" has no shown use."))))
        warn = F.array_compact(
            F.array(
                _named(found, "tracking", "a tracker", "the tracker ", "the trackers "),
                _named(found, "ads", "an ad library", "the ad library ", "the ad libraries "),
                missing,
            )
        )

        def whole(p: Column) -> Column:
            rest = F.when(F.size(own) == 0, "It asks for no sensitive access.").when((F.size(p["said"]) == 0) & (F.size(p["warn"]) > 0), "It asks for no other sensitive access.")
            all_ = F.array_compact(F.concat(p["said"], F.array(rest, F.when(has("offline_capable"), "Data stays on the phone."))))
            return F.concat(F.when(F.size(p["warn"]) > 0, F.concat(F.array_join(p["warn"], " "), F.lit("\n\n"))).otherwise(""), F.array_join(all_, " "))

        text = let(F.struct(said.alias("said"), warn.alias("warn")), whole)
        reasons = F.transform(F.filter(own, lambda a: ~a["used"]), lambda a: F.struct(a["fact"].alias("fact"), F.when(a["id"] != "", F.concat(a["id"], F.lit(" has no shown use."))).otherwise("Has no shown use.").alias("reason")))
        return F.struct(text.alias("security"), F.map_from_entries(reasons).alias("reasons"))

    return let(F.struct(yes.alias("yes"), says.alias("says")), lambda known: let(access(known), lambda own: let(firsts(own), lambda f: note(f, known["yes"], own))))


# -- the stored document ------------------------------------------------------


def permission_ids(line: Column) -> Column:
    """Sorted distinct ids of a comma-separated line, without the background rider."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.split(F.coalesce(line, F.lit("")), ","), lambda p: F.trim(p)), lambda p: ~p.isin("", "ACCESS_BACKGROUND_LOCATION"))))


def permission_line(project: Column, rows: Column, previous: Column) -> Column:
    """Ids of the inventory's ``permissions:`` line, else those of permission rows, else what was there."""
    listed = F.get(F.filter(F.transform(F.split(F.coalesce(project, F.lit("")), "\n"), lambda x: F.trim(x)), lambda x: x.startswith("permissions:")), F.lit(0))
    ids = F.flatten(F.transform(F.filter(rows, lambda r: is_permission(r["fact"])), lambda r: F.transform(F.split(r["evidence"], ","), lambda p: F.trim(p))))
    own = F.array_join(F.array_sort(F.array_distinct(F.filter(ids, lambda p: p != ""))), ", ")
    return F.coalesce(F.nullif(F.trim(F.substring(listed, 13, 1 << 20)), F.lit("")), F.nullif(own, F.lit("")), F.trim(F.coalesce(previous, F.lit(""))))


def document_json(records: Column, permissions: Column, text: Column, keywords: Column, flags: Column) -> Column:
    """The stored document: facts and notes by fact, permissions, notice and body, keywords, flags; what is empty is left out.

    ``records`` is an array of (fact, value, notes). Permission facts give notes
    only; of other facts a no is stated for few, and a note needs a yes or the
    fact source_available. Of repeated facts the last counts.
    """
    trim = F.transform(records, lambda r: F.struct(F.trim(r["fact"]).alias("fact"), F.trim(r["value"]).alias("value"), F.trim(F.coalesce(r["notes"], F.lit(""))).alias("notes")))
    usable = F.filter(trim, lambda r: (r["fact"] != "") & r["value"].isin("yes", "no"))
    stated = F.filter(usable, lambda r: r["fact"].isin(*PILLS) & ((r["value"] == "yes") | r["fact"].isin(*FALSE_PILLS)))
    noted = F.filter(usable, lambda r: (r["notes"] != "") & (is_permission(r["fact"]) | (r["fact"].isin(*PILLS) & ((r["value"] == "yes") | (r["fact"] == "source_available")))))

    def last(rows: Column, value) -> Column:
        names = F.transform(rows, lambda r: r["fact"])
        once = F.filter(rows, lambda r, i: ~F.array_contains(F.slice(names, i + 2, 1 << 20), r["fact"]))
        return F.when(F.size(rows) > 0, F.map_from_entries(F.array_sort(F.transform(once, lambda r: F.struct(r["fact"].alias("fact"), value(r).alias("v"))))))

    parts = facts.split_notice(F.when(F.lower(F.trim(text)) == "no-change", "").otherwise(F.trim(text)))
    full = lambda x: F.when(F.size(x) > 0, x)
    return F.to_json(F.struct(last(stated, lambda r: r["value"] == "yes").alias("facts"), last(noted, lambda r: r["notes"]).alias("notes"), full(permission_ids(permissions)).alias("permissions"), parts["notice"].alias("notice"), parts["body"].alias("body"), full(keywords).alias("keywords"), full(flags).alias("flags")))


def document_text(notice: Column, body: Column) -> Column:
    """The paragraph back from notice and body."""
    return F.array_join(F.filter(F.array(F.trim(notice), F.trim(body)), lambda x: x != ""), "\n\n")


def split_old_document(text: Column) -> Column:
    """Struct (csv, perms, prose) of the older form, three parts between lines of dashes; null if it isn't one."""
    lines = F.split(F.trim(text), "\n")
    marks = F.filter(F.transform(lines, lambda x, i: F.when(F.trim(x) == "---", i)), lambda i: i.isNotNull())
    part = lambda a, b: F.trim(F.array_join(F.slice(lines, a + 1, F.greatest(b - a, F.lit(0))), "\n"))
    one, two = F.get(marks, F.lit(0)), F.get(marks, F.lit(1))
    return F.when((F.size(marks) >= 2) & F.trim(lines[0]).startswith('"'), F.struct(part(F.lit(0), one).alias("csv"), part(one + 1, two).alias("perms"), part(two + 1, F.size(lines)).alias("prose")))


def facts_ready(csv: Column) -> Column:
    """Does a sheet have the facts that every app must have?"""
    return F.contains(csv, F.lit('"google_services"')) & F.contains(csv, F.lit('"offline_capable"'))

