"""Checks of a model's replies, each the reason why one can't be used or null, and what is used where none can.

Every check is a Column over the reply and what is known of its app, so a table
of replies is judged in one projection; the ladders are one window over a
listing's attempts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions import text as tx
from shelfspark.functions.regex import EDGE, literal, re2_to_java
from shelfspark.operators import scan

# Patterns of what a reply must not say (RE2).
LINK = r"\S*(?:://|www\.|\.com/|\.org/)\S*"
LOWER_START = r"(\S*)[.!?]\s+[a-z]"
ABBREVIATION = r"(?i)^(?:e\.g|i\.e|etc|vs|approx|incl)[.!?]\s+[a-z]$"
STRAY = r"\s[,.;:!?]|,\s*,|\(\s*\)"
OTHER_BUILD = tx.OTHER_BUILD
PITCH = r"(?i)\b(?:allows?|lets|enables?|helps?) (?:users|people|anyone)\b|\bdecentrali[sz]ed\b|\bbuilt (?:on|with|using)\b|\bwithout relying on\b|\bintermediar(?:y|ies)\b|(?:\b(?:is|as) |(?:^|[.!?]\s+))an? (?:[\w-]+ ){0,3}(?:app|application|platform|client|tool|game|network|service)\b"
GOOGLE = r"(?i)\bgoogle\b|firebase|play[- ]services|\bfcm\b|\bgms\b"
TRACKER = r"(?i)analytics|telemetry|crash report|tracking (?:library|libraries|sdk|code)|(?:third-party|usage) trackers?"
ADS = r"(?i)\bads\b|\bad (?:library|libraries|sdk|network)|advertis"
NO_USE = r"(?i)\bno (?:shown )?use\b|\bno use is shown\b|\bnot used\b"
NO_ACCESS = r"(?i)\basks for no sensitive access\b"
PERMISSION_ID = r"\b[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)+\b|android\.permission"
CODE_TALK = r"(?i)\b(?:the scan|source code|the code|provided code|code snippets?|quoted code|the manifest)\b"
ON_PHONE = r"(?i)\bstays? (?:on|in) (?:the|your) (?:phone|device)\b"
# Least and most characters of an about text, keywords, queries.
LEAST_ABOUT, MOST_ABOUT = tx.ABOUT_LENGTH
MOST_KEYWORDS, LEAST_QUERIES, MOST_QUERIES = 8, 5, 10
#: Distinct stems of a corpus under which nothing is compared with it.
LEAST_CORPUS = 40


def hit(text: Column, pattern: str) -> Column:
    """What an RE2 pattern finds first; null if nothing."""
    return F.nullif(F.regexp_extract(text, re2_to_java(pattern), 0), F.lit(""))


def quote(x: Column) -> Column:
    return F.concat(F.lit('"'), x, F.lit('"'))


def no_change(x: Column) -> Column:
    return F.lower(F.trim(x)) == "no-change"


# -- names, terms, wording ----------------------------------------------------


def developer_text(content: Column, summary: Column, readme: Column) -> Column:
    return F.concat_ws(" ", F.coalesce(content, F.lit("")), F.coalesce(summary, F.lit("")), F.coalesce(readme, F.lit("")))


def ordinary_name(name: Column, dev: Column) -> Column:
    """Are all words of the name also written small by the developer, links aside?"""
    words = tx.fields(F.trim(name))
    bare = F.regexp_replace(dev, re2_to_java(LINK), " ")
    return (F.size(words) > 0) & F.forall(words, lambda w: (w == F.lower(w)) | F.regexp_like(bare, F.concat(F.lit(EDGE), literal(F.lower(w)))))


def names_app(name: Column, dev: Column, text: Column) -> Column:
    """Does the text have the exact name, of three characters or more, as a word, unless it is ordinary words?"""
    n = F.trim(F.coalesce(name, F.lit("")))
    return (F.length(n) >= 3) & F.regexp_like(text, F.concat(F.lit(EDGE), literal(n), F.lit(EDGE))) & ~ordinary_name(n, dev)


def brand_name(name: Column, dev: Column) -> Column:
    """The small name if it is one word and reads as a brand, else empty."""
    low = F.lower(F.trim(F.coalesce(name, F.lit(""))))
    return F.when(F.contains(low, F.lit(" ")) | ordinary_name(F.trim(F.coalesce(name, F.lit(""))), dev), "").otherwise(low)


def garbled(text: Column) -> Column:
    """Why a text reads as damaged: a doubled word, a sentence that begins small, stray punctuation."""

    def doubles(w: Column, bare: Column) -> Column:
        at = F.when(F.size(w) > 1, F.sequence(F.lit(1), F.size(w) - 1)).otherwise(F.array().cast("array<int>"))
        twice = F.filter(at, lambda i: (F.element_at(bare, i) != "") & (F.element_at(bare, i) == F.element_at(bare, i + 1)) & ~F.element_at(bare, i).rlike("[0-9]"))
        return tx.let(F.get(twice, F.lit(0)), lambda i: F.concat(F.lit("doubled word "), quote(F.concat(F.get(w, i - 1), F.lit(" "), F.get(w, i)))))

    return tx.let(text, lambda t: _garbled(t, tx.let(tx.fields(t), lambda w: tx.let(F.transform(w, lambda x: F.btrim(F.lower(x), F.lit("\"'(),.;:!?"))), lambda bare: doubles(w, bare)))))


def _garbled(text: Column, doubled: Column) -> Column:
    starts = F.filter(F.regexp_extract_all(text, F.lit(re2_to_java(LOWER_START)), 0), lambda m: ~m.rlike(re2_to_java(ABBREVIATION)))
    small = F.concat(F.lit("sentence starts lowercase: "), quote(F.get(starts, F.lit(0))))
    stray = F.concat(F.lit("stray punctuation "), quote(hit(text, STRAY)))
    return F.coalesce(doubled, small, stray)


def _term_count(x: Column) -> Column:
    return F.size(tx.fields(x))


def keyword_fails(k: Column) -> Column:
    return F.when(~k.rlike(r"^[a-z0-9 -]+\z") | (_term_count(k) > 3), F.concat(F.lit("keyword "), quote(k), F.lit(" is not one to three lowercase words")))


def keywords_fail(keywords: Column) -> Column:
    """Why keywords can't be used: too many, or the first that is no one to three small words."""
    return F.coalesce(F.when(F.size(keywords) > MOST_KEYWORDS, F.concat(F.size(keywords).cast("string"), F.lit(f" keywords, want at most {MOST_KEYWORDS}"))), F.get(F.filter(F.transform(keywords, keyword_fails), lambda r: r.isNotNull()), F.lit(0)))


def query_fails(q: Column, brand: Column) -> Column:
    return F.coalesce(
        F.when(q != F.lower(q), F.concat(F.lit("query "), quote(q), F.lit(" is not lowercase"))),
        F.when(~_term_count(q).between(2, 6), F.concat(F.lit("query "), quote(q), F.lit(" has "), _term_count(q).cast("string"), F.lit(" words, want 2 to 6"))),
        F.when((F.octet_length(brand) >= 4) & F.contains(q, brand), F.concat(F.lit("query "), quote(q), F.lit(" names the app"))),
    )


def queries_fail(queries: Column, brand: Column) -> Column:
    """Why queries can't be used: too few, too many, or the first that breaks a rule."""
    n = F.size(queries)
    return F.coalesce(F.when(~n.between(LEAST_QUERIES, MOST_QUERIES), F.concat(n.cast("string"), F.lit(f" queries, want {LEAST_QUERIES} to {MOST_QUERIES}"))), F.get(F.filter(F.transform(queries, lambda q: query_fails(q, brand)), lambda r: r.isNotNull()), F.lit(0)))


def clean_terms(keywords: Column, queries: Column, brand: Column) -> Column:
    """Struct (keywords, queries) of those that break no rule, as many as are allowed."""
    return F.struct(F.slice(F.filter(keywords, lambda k: keyword_fails(k).isNull()), 1, MOST_KEYWORDS).alias("keywords"), F.slice(F.filter(queries, lambda q: query_fails(q, brand).isNull()), 1, MOST_QUERIES).alias("queries"))


# -- the about reply ----------------------------------------------------------


def english(text: Column) -> Column:
    """English, not English, or null where there is too little to say."""
    return tx.let(tx.let(text, tx.language_stats), tx.prose)


def about_rules(about: Column, keywords: Column, queries: Column, name: Column, dev: Column) -> Column:
    """Why a reply breaks a rule that holds for every app; an empty about keeps the description and is not looked at."""
    n = F.length(about)
    written = F.when(
        about != "",
        F.coalesce(
            F.when(~n.between(LEAST_ABOUT, MOST_ABOUT), F.concat(F.lit("about is "), n.cast("string"), F.lit(f" characters, want {LEAST_ABOUT} to {MOST_ABOUT}"))),
            F.when(~F.coalesce(english(about), F.lit(True)), "about is not English"),
            F.when(names_app(name, dev, about), F.concat(F.lit("about names the app "), quote(name))),
            F.concat(F.lit("about has "), garbled(about)),
        ),
    )
    return F.coalesce(written, keywords_fail(keywords), queries_fail(queries, brand_name(name, dev)))


def other_build(field: str, text: Column) -> Column:
    """Why a text is about another build or a store."""
    return F.when((F.trim(text) != "") & ~no_change(text), F.concat(F.lit(f"{field} describes another build: "), quote(hit(F.trim(text), OTHER_BUILD))))


def reply_about(verdict: Column, about: Column, description: Column) -> Column:
    """What a reply writes, empty if it keeps the description."""
    keeps = F.lower(F.trim(F.coalesce(verdict, F.lit("")))).startswith("keep") & (F.trim(F.coalesce(description, F.lit(""))) != "")
    text = F.trim(F.coalesce(about, F.lit("")))
    return F.when(no_change(text) | keeps, "").otherwise(text)


def verdict_fails(verdict: Column, about: Column) -> Column:
    return F.when(F.lower(F.trim(F.coalesce(verdict, F.lit("")))).startswith("write") & (about == ""), "verdict write, but about is empty")


def usable_about(about: Column, description: Column, most: int = 320) -> Column:
    """Why a page can't show an about: nothing to keep, too long, or another build."""
    return F.when(about == "", F.when(F.trim(F.coalesce(description, F.lit(""))) == "", "empty about, and the description is not usable")).otherwise(F.coalesce(F.when(F.length(about) > most, F.concat(F.lit("about is "), F.length(about).cast("string"), F.lit(" characters"))), other_build("about", about)))


def unbacked_words(about: Column, corpus: Column) -> Column:
    """Why an about isn't in the developer's words: more than two, and a quarter, of its content words are not in the corpus.

    A corpus that is not English, or of fewer than LEAST_CORPUS stems, backs
    everything. Words are given in the form and order in which they stand.
    """
    own = F.filter(tx.words(about), lambda w: (F.octet_length(w) >= 4) & ~w.isin(*tx.STOP_WORDS))
    pairs = F.transform(own, lambda w: F.struct(w.alias("w"), tx.stem(w).alias("s")))
    firsts = tx.let(pairs, lambda all_: tx.let(F.transform(all_, lambda p: p["s"]), lambda stems: F.filter(all_, lambda p, i: F.array_position(stems, p["s"]) == i + 1)))

    # Stems of the corpus are formed once, not for each word that is looked up in them.
    def judge(have: Column, first: Column) -> Column:
        missing = F.filter(first, lambda p: ~F.array_contains(have, p["s"]))
        reason = tx.let(missing, lambda m: F.when(F.size(m) > F.greatest(F.lit(2), F.floor(F.size(first) / 4)), F.concat(F.lit("about uses words the developer did not: "), F.array_join(F.transform(m, lambda p: p["w"]), ", "))))
        return F.when(F.size(have) >= LEAST_CORPUS, reason)

    why = tx.let(tx.content_stems(corpus), lambda have: tx.let(firsts, lambda first: judge(have, first)))
    return F.when(F.coalesce(english(corpus), F.lit(True)), why)


def about_ladder(replies: DataFrame, listing: str = "app_id") -> DataFrame:
    """(listing, about, keywords, queries, kept, degraded, model, error): what a listing shows after all its attempts.

    ``replies`` has (listing, attempt, model, replied, about, keywords, queries,
    clean, unusable, broken, unverified, description): ``about`` after
    ``reply_about``, the three reasons from the checks, and ``clean`` from
    ``clean_terms``. The first reply without a reason is used; else the first
    that only isn't verified; else the description is kept if there is one; else
    the first that only breaks a rule, its terms cleaned; else an error.
    """
    kind = F.when(~F.col("replied") | F.col("unusable").isNotNull(), F.lit(3)).when(F.col("broken").isNotNull(), F.lit(2)).when(F.col("unverified").isNotNull(), F.lit(1)).otherwise(F.lit(0))
    r = replies.withColumn("kind", kind)
    pick = lambda k: F.min_by(F.struct("about", "keywords", "queries", "clean", "model"), F.when(F.col("kind") == k, F.col("attempt"))).alias(f"k{k}")
    any_ = lambda k: F.bool_or(F.col("kind") == k).alias(f"has{k}")
    g = r.groupBy(listing).agg(*[pick(k) for k in (0, 1, 2)], *[any_(k) for k in (0, 1, 2)], F.bool_or("replied").alias("replied"), F.trim(F.coalesce(F.max("description"), F.lit(""))).alias("description"), F.max_by(F.coalesce("unusable", "broken", "unverified", F.lit("no reply")), "attempt").alias("last"))
    step = F.when(F.col("has0"), 0).when(F.col("has1"), 1).when(F.col("replied") & (F.col("description") != ""), 2).when(F.col("has2"), 3).otherwise(4)
    g = g.withColumn("step", step)
    none = F.array().cast("array<string>")
    got = F.when(F.col("step") == 0, F.col("k0")).when(F.col("step") == 1, F.col("k1")).when(F.col("step") == 3, F.col("k2"))
    g = g.withColumn("got", got)
    keeps = (F.col("step") == 2) | (F.col("got.about") == "")
    degraded = F.when(F.col("step") == 1, "no model's paragraph was verified against the developer text").when(F.col("step") == 2, "every model reply was unusable, kept the listing description").when(F.col("step") == 3, "no model's reply followed every about rule")
    terms = lambda name: F.when(F.col("step") == 3, F.col(f"got.clean.{name}")).otherwise(F.coalesce(F.col(f"got.{name}"), none)).alias(name)
    return g.select(listing, F.when(F.col("step") == 4, None).when(keeps, F.col("description")).otherwise(F.col("got.about")).alias("about"), terms("keywords"), terms("queries"), F.coalesce(keeps, F.lit(False)).alias("kept"), degraded.alias("degraded"), F.when(F.col("step") == 0, F.col("got.model")).alias("model"), F.when(F.col("step") == 4, F.col("last")).alias("error"))


# -- the security reply -------------------------------------------------------


def pitch(security: Column, name: Column, summary: Column) -> Column:
    """Why a note describes the app instead of its access and data."""
    text = F.trim(security)
    low = F.lower(tx.one_line(text))
    said = F.lower(tx.one_line(F.coalesce(summary, F.lit(""))))
    own = F.lower(F.trim(F.coalesce(name, F.lit(""))))
    return F.when(
        (text != "") & ~no_change(text),
        F.coalesce(
            F.concat(F.lit("security describes the app: "), quote(hit(text, PITCH))),
            F.when((own != "") & low.startswith(F.concat(own, F.lit(" "))), F.concat(F.lit("security starts with the app name "), quote(name))),
            F.when((F.octet_length(said) >= 20) & F.contains(low, F.rtrim(said, F.lit("."))), "security repeats the listing summary"),
        ),
    )


def _yes(rows: Column, fact: str) -> Column:
    return F.exists(rows, lambda r: (r["basis"] == "apk") & (r["fact"] == fact) & (r["value"] == "yes"))


def warning_fits(rows: Column, security: Column, notes: Column) -> Column:
    """Why a note's warning, or lack of one, doesn't fit the scan rows and the fact notes."""
    mine = F.filter(rows, lambda r: (r["basis"] == "apk") & (r["value"] == "yes"))
    access = F.exists(mine, lambda r: scan.is_permission(r["fact"]))
    unused = F.exists(mine, lambda r: scan.is_permission(r["fact"]) & F.coalesce(F.try_element_at(notes, r["fact"]), F.lit("")).rlike(re2_to_java(NO_USE)))
    risk = unused | F.exists(mine, lambda r: r["fact"].isin("tracking", "ads"))
    warned = F.contains(F.trim(security), F.lit("\n\n"))
    return F.coalesce(
        F.concat(F.lit("mentions "), quote(hit(security, CODE_TALK)), F.lit("; say what the app does, not what the code shows")),
        F.concat(F.lit("names the permission id "), quote(hit(security, PERMISSION_ID)), F.lit("; say what it allows in words")),
        F.when(~_yes(rows, "offline_capable") & hit(security, ON_PHONE).isNotNull(), "says data stays on the phone, but the app can use the internet"),
        F.when(access & hit(security, NO_ACCESS).isNotNull(), "says no sensitive access, but the scan has an access"),
        F.when(risk & ~warned & unused, "an access has no shown use, but the note opens with no warning"),
        F.when(risk & ~warned, "the scan has a tracking or ads library, but the note opens with no warning"),
        F.when(~risk & warned, "the note opens with a warning, but nothing in the scan or fact notes calls for one"),
    )


def against_scan(rows: Column, security: Column, notes: Column) -> Column:
    """Why a note says what the scan doesn't; of fact notes only Google's services are looked for, in order of facts."""
    texts = F.concat(F.array(security), F.transform(F.array_sort(F.map_entries(notes)), lambda e: e["value"]))
    google = F.get(F.filter(F.transform(texts, lambda t: hit(t, GOOGLE)), lambda h: h.isNotNull()), F.lit(0))
    says = lambda found, what: F.concat(F.lit("mentions "), quote(found), F.lit(f", but the scan found no {what}"))
    return F.coalesce(
        warning_fits(rows, security, notes),
        F.when(~_yes(rows, "google_services"), says(google, "Google services")),
        F.when(~_yes(rows, "tracking"), says(hit(security, TRACKER), "tracking library")),
        F.when(~_yes(rows, "ads"), says(hit(security, ADS), "ad library")),
    )


def uses_shown(rows: Column, notes: Column, source: Column, quoted: Column, stated: Column) -> Column:
    """Why a permission's note gives a use that no code quote, listing or readme shows; with no source nothing is checked."""
    all_ = F.when(F.arrays_overlap(quoted, F.array(*map(F.lit, scan.LOCATION))), F.array_union(quoted, F.array(*map(F.lit, scan.LOCATION)))).otherwise(quoted)
    says = F.map_from_entries(F.array(*[F.struct(F.lit(f).alias("k"), stated.rlike(re2_to_java(p)).alias("v")) for f, p in scan.STATED.items()]))
    note = lambda r: F.coalesce(F.try_element_at(notes, r["fact"]), F.lit(""))
    bad = F.filter(rows, lambda r: (r["basis"] == "apk") & (r["value"] == "yes") & F.coalesce(~F.try_element_at(says, r["fact"]), F.lit(False)) & ~F.array_contains(all_, r["fact"]) & (note(r) != "") & ~note(r).rlike(re2_to_java(NO_USE)))
    return F.when((F.trim(source) != "") & (F.size(bad) > 0), F.concat(F.get(bad, F.lit(0))["fact"], F.lit(" note gives a use, but no code or listing shows one; say it has no shown use")))


def security_reply_fails(text: Column, current: Column, rows: Column, notes: Column, name: Column, summary: Column, source: Column, quoted: Column, stated: Column) -> Column:
    """Why a security reply would not be stored: the first reason of all checks. ``notes`` are the reply's by fact."""

    def read(k: Column) -> Column:
        return F.struct(k["t"].alias("t"), k["now"].alias("now"), F.when(no_change(k["t"]), k["now"]).otherwise(k["t"]).alias("kept"), k["rows"].alias("rows"), k["notes"].alias("notes"))

    def judge(k: Column) -> Column:
        return F.coalesce(
            F.when(k["t"] == "", "empty security"),
            F.when(no_change(k["t"]) & (k["now"] == ""), "security no-change with no stored text"),
            other_build("security", k["t"]),
            pitch(k["kept"], name, summary),
            against_scan(k["rows"], k["kept"], k["notes"]),
            uses_shown(k["rows"], k["notes"], source, quoted, stated),
        )

    known = F.struct(F.trim(F.coalesce(text, F.lit(""))).alias("t"), F.trim(F.coalesce(current, F.lit(""))).alias("now"), rows.alias("rows"), notes.alias("notes"))
    return tx.let(tx.let(known, read), judge)


def truth(x: Column) -> Column:
    low = F.lower(F.trim(F.coalesce(x, F.lit(""))))
    return F.when(low.isin("yes", "true"), "yes").when(low.isin("no", "false"), "no").otherwise("unknown")


def lock_facts(facts: dict[str, Column], rows: Column) -> Column:
    """Struct of the five facts: the scan's findings stand, whatever the reply says; offline and open source never come from a reply."""
    said = F.filter(rows, lambda r: (r["basis"] == "apk") & (r["fact"] == "google_services") & r["value"].isin("yes", "no"))
    some = F.try_element_at(said, F.lit(-1))["value"]
    told = lambda name: F.when(_yes(rows, name), "yes").otherwise(truth(facts[name])).alias(name)
    return F.struct(F.coalesce(some, truth(facts["google_services"])).alias("google_services"), told("ads"), told("tracking"), F.when(_yes(rows, "offline_capable"), "yes").otherwise("unknown").alias("offline_capable"), F.lit("unknown").alias("open_source"))


def security_fallback(reply: Column, replied: Column, current: Column, template: Column) -> Column:
    """The reply's note; without one, the note from the scan if a reply came and none is stored; else null, an error."""
    return F.coalesce(F.nullif(F.trim(reply), F.lit("")), F.when(replied & (F.trim(F.coalesce(current, F.lit(""))) == ""), template))


def parse_sheet(raw: Column, records: Column) -> Column:
    """Struct (no_change, facts, reasons) of a reply's sheet, ``records`` its rows as arrays of strings."""
    rows = F.filter(F.transform(F.filter(records, lambda r: F.size(r) >= 2), lambda r: F.struct(F.trim(r[0]).alias("fact"), truth(r[1]).alias("value"), F.trim(F.coalesce(F.get(r, F.lit(2)), F.lit(""))).alias("note"))), lambda r: (r["fact"] != "") & (r["value"] != "unknown"))

    def last(some: Column, value: str) -> Column:
        names = F.transform(some, lambda r: r["fact"])
        return F.map_from_entries(F.transform(F.filter(some, lambda r, i: ~F.array_contains(F.slice(names, i + 2, 1 << 20), r["fact"])), lambda r: F.struct(r["fact"], r[value])))

    return F.struct(no_change(raw).alias("no_change"), last(rows, "value").alias("facts"), last(F.filter(rows, lambda r: r["note"] != ""), "note").alias("reasons"))
