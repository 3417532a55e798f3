"""Text rules as Column expressions: white space, clips, words, stems, language, wording."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfspark.functions.regex import re2_to_java

# Words that are frequent in English prose and interface labels.
COMMON_WORDS = "a about above account add after again all also an and any app are as at back be because been before being below between both but by can cancel change clear close connect copy could create delete did do does done down download each edit enable enter error every file find first for from get go has have help here his how if in into is it its keep last let like list load loading login logout make many may me more most move my name new next no not now of off on once one only open or other our out over password please privacy profile remove reply retry save search see select send set settings share show sign so some start stop such than that the their them then there these they this those through to try under up update use user using very view want was we were what when where which while who will with without would yes you your".split()
# Words that carry no claim.
STOP_WORDS = "about after also among and another any around away back been before being both each even ever every from further have here into just like made make many more most much must need only other over same should since some such than that their them then there these they this those though through under until upon very want well what when where which while will with within without would your yours you can lets helps allows people person user users phone device android app apps application".split()
# Suffixes in the order in which the first that fits is dropped.
SUFFIXES = ("ations", "ation", "ings", "ing", "ies", "ers", "er", "es", "ed", "ly", "s")
# Wording -> licence, first match wins; all parts must occur.
LICENSES = (
    (("business source license",), "BUSL-1.1", False),
    (("functional source license",), "FSL-1.1", False),
    (("polyform",), "PolyForm", False),
    (("commons clause",), "Commons-Clause", False),
    (("server side public license",), "SSPL-1.0", False),
    (("elastic license",), "Elastic-2.0", False),
    (("gnu affero general public license",), "AGPL-3.0", True),
    (("gnu lesser general public license",), "LGPL", True),
    (("gnu general public license", "version 3"), "GPL-3.0", True),
    (("gnu general public license", "version 2"), "GPL-2.0", True),
    (("gnu general public license",), "GPL", True),
    (("mozilla public license",), "MPL-2.0", True),
    (("european union public licen",), "EUPL-1.2", True),
    (("apache license", "version 2.0"), "Apache-2.0", True),
    (("permission is hereby granted, free of charge",), "MIT", True),
    (("redistribution and use in source and binary forms",), "BSD", True),
    (("permission to use, copy, modify, and/or distribute",), "ISC", True),
    (("permission to use, copy, modify, and distribute",), "ISC", True),
    (("this is free and unencumbered software",), "Unlicense", True),
    (("creative commons zero",), "CC0-1.0", True),
    (("cc0 1.0",), "CC0-1.0", True),
    (("do what the fuck you want",), "WTFPL", True),
)
LICENSE_HEAD_BYTES = 400
PROSE_WORDS, PROSE_PERCENT = 6, 15
#: Characters of an about text.
ABOUT_LENGTH = (100, 300)


def fields(x: Column) -> Column:
    """Words between runs of Unicode white space."""
    return F.filter(F.split(x, r"(?U)\s+"), lambda w: w != "")


def one_line(x: Column) -> Column:
    """White space collapsed, ends trimmed."""
    return F.array_join(fields(x), " ")


def fold_line(x: Column) -> Column:
    return F.lower(F.when(x.rlike(r"(?U)\s"), one_line(x)).otherwise(x))


def visible(x: Column) -> Column:
    """Without soft hyphens and zero-width characters."""
    return F.translate(x, "\u00ad\u200b\u200c\u200d\u2060\ufeff", "")


#: Other symbols of Unicode 14 and 15, which Java 17 does not know yet.
_NEW_SYMBOLS = r"\x{FD40}-\x{FD4F}\x{FDCF}\x{FDFE}-\x{FDFF}\x{1CF50}-\x{1CFC3}\x{1D1E9}-\x{1D1EA}\x{1F6DC}-\x{1F6DF}\x{1F774}-\x{1F776}\x{1F77B}-\x{1F77F}\x{1F7D9}\x{1F7F0}\x{1F979}\x{1F9CC}\x{1FA75}-\x{1FA77}\x{1FA7B}-\x{1FA7C}\x{1FA87}-\x{1FA88}\x{1FAA9}-\x{1FAAF}\x{1FAB7}-\x{1FABD}\x{1FABF}\x{1FAC3}-\x{1FAC5}\x{1FACE}-\x{1FACF}\x{1FAD7}-\x{1FADB}\x{1FAE0}-\x{1FAE8}\x{1FAF0}-\x{1FAF8}"


def drop_symbols(x: Column) -> Column:
    """Pictographs and variation selectors become spaces."""
    return F.regexp_replace(x, r"[\p{So}\x{FE0F}" + _NEW_SYMBOLS + "]", " ")


def sentences(x: Column) -> Column:
    """Parts after ``.``, ``!`` or ``?`` and a space; empty ones dropped."""
    return F.filter(F.transform(F.split(x, r"(?<=[.!?])(?= )"), lambda s: F.trim(s)), lambda s: s != "")


# Letters that upper() turns into several characters, and what each is as one: itself where there is no such capital.
_SEVERAL = {c: t if len(t := c.title()) == 1 else c for c in map(chr, range(0x80, 0x10000)) if len(c.upper()) > 1} | {"ß": "ẞ"}


def capitalize(x: Column) -> Column:
    """The first character as a capital, one for one: a text keeps its length."""
    first = F.substring(x, 1, 1)
    one = F.when(F.length(F.upper(first)) > 1, F.translate(first, "".join(_SEVERAL), "".join(_SEVERAL.values()))).otherwise(F.upper(first))
    return F.concat(one, F.substring(x, 2, 1 << 30))


def clip_chars(x: Column, n: int) -> Column:
    return F.substring(x, 1, n)


def clip_bytes(x: Column, n: int) -> Column:
    """At most n bytes of UTF-8, cut before a character that would go over."""
    return F.when(F.octet_length(x) <= n, x).otherwise(F.substring(x, F.lit(1), F.length(F.regexp_replace(F.make_valid_utf8(F.substring(F.encode(x, "UTF-8"), 1, n).cast("string")), "\ufffd+$", ""))))


def clip_bytes_valid(x: Column, n: int) -> Column:
    """``clip_bytes`` for bytes that may hold broken characters anywhere: those go."""
    return F.replace(clip_bytes(x, n), F.lit("\ufffd"), F.lit(""))


def words(x: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(x), r"[^\p{L}\p{Nd}]+"), lambda w: w != "")


def stem(w: Column) -> Column:
    """A word without the first suffix that leaves over three bytes, and without a last e beyond four."""
    cut = F.coalesce(*[F.when((F.octet_length(w) > len(s) + 3) & w.endswith(s), F.concat(F.substring(w, F.lit(1), F.length(w) - len(s)), F.lit("y" if s == "ies" else ""))) for s in SUFFIXES], w)
    return F.when((F.octet_length(cut) > 4) & cut.endswith("e"), F.substring(cut, F.lit(1), F.length(cut) - 1)).otherwise(cut)


def content_stems(x: Column) -> Column:
    """Distinct stems of words of four bytes or more that carry a claim, in order of appearance."""
    # A word that comes again is not judged and cut again.
    return F.array_distinct(F.transform(F.filter(F.array_distinct(words(x)), lambda w: (F.octet_length(w) >= 4) & ~w.isin(*STOP_WORDS)), stem))


def language_stats(x: Column) -> Column:
    """Struct of words, common (frequent English words), latin (ASCII letters) and other (letters of other scripts)."""
    parts = F.filter(F.split(F.lower(x), r"[^\p{L}']+"), lambda w: w != "")
    counts = let(parts, lambda p: F.struct(F.size(p).cast("long").alias("words"), F.size(F.filter(p, lambda w: w.isin(*COMMON_WORDS))).cast("long").alias("common")))
    return let(counts, lambda n: F.struct(
        n["words"].alias("words"),
        n["common"].alias("common"),
        F.length(F.regexp_replace(x, "[^A-Za-z]", "")).cast("long").alias("latin"),
        F.length(F.regexp_replace(x, r"[\P{L}\p{IsLatin}]", "")).cast("long").alias("other"),
    ))


def prose(stats: Column) -> Column:
    """English or not; null where there are too few words to say."""
    return F.when(stats["other"] > stats["latin"], False).when(stats["words"] < PROSE_WORDS, None).otherwise(stats["common"] * 100 >= stats["words"] * PROSE_PERCENT)


def english_ui(strings: Column) -> Column:
    """Do interface strings read as English? Null for fewer than eight usable ones."""
    trimmed = F.transform(strings, lambda t: F.trim(t))
    usable = F.filter(trimmed, lambda t: (t != "") & ~(t.rlike(r"[%{}<>]") & (F.octet_length(t) < 4)))
    stats = F.filter(F.transform(usable, language_stats), lambda s: s["latin"] + s["other"] >= 2)
    total = lambda name: F.aggregate(stats, F.lit(0).cast("long"), lambda n, s: n + s[name])
    hits = F.size(F.filter(stats, lambda s: s["common"] > 0))
    return F.when(F.size(stats) < 8, None).when(total("other") > total("latin"), False).otherwise(hits * 100 >= F.size(stats) * 25)


_TRIM = "\"'(),.;:!?"


def doubled_word(x: Column) -> Column:
    """Does a word follow itself, but for case and punctuation? Numbers may."""
    bare = F.transform(fields(x), lambda w: F.btrim(F.lower(w), F.lit(_TRIM)))
    pairs = F.zip_with(F.slice(bare, 1, F.greatest(F.size(bare) - 1, F.lit(0))), F.slice(bare, 2, F.greatest(F.size(bare) - 1, F.lit(0))), lambda a, b: (a != "") & (a == b) & ~a.rlike("[0-9]"))
    return F.exists(pairs, lambda p: p)


def _telling(part: str) -> str:
    """A word that every text with this wording has."""
    return "licen" if "licen" in part else max(part.replace(",", "").split(), key=len)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def license_of(x: Column) -> Column:
    """Struct (id, free) of a licence text; its title, the first 400 bytes, decides before the rest.

    Texts without any of the words that the wordings need are not put in one line.
    """
    none = F.lit(None).cast("struct<id:string,free:boolean>")

    def found(text: Column) -> Column:
        out = none
        for parts, name, free in reversed(LICENSES):
            hit = F.lit(True)
            for part in parts:
                hit = hit & text.contains(part)
            out = F.when(hit, F.struct(F.lit(name).alias("id"), F.lit(free).alias("free"))).otherwise(out)
        return out

    def judge(low: Column) -> Column:
        maybe = F.lit(False)
        for word in sorted({_telling(parts[0]) for parts, _, _ in LICENSES}):
            maybe = maybe | low.contains(word)
        line = let(F.array_join(fields(low), " "), lambda full: F.coalesce(found(clip_bytes(full, LICENSE_HEAD_BYTES)), found(full)))
        return F.when(maybe, line).otherwise(none)

    return let(F.lower(x), judge)


def at_boundary(corpus: Column, phrase: Column) -> Column:
    """Does ``phrase`` stand in ``corpus`` with no ASCII letter or digit beside it? Both lower-case."""
    return F.regexp_like(corpus, F.concat(F.lit(r"(?<![a-z0-9])\Q"), phrase, F.lit(r"\E(?![a-z0-9])")))


# Keywords that say nothing.
DROPPED_KEYWORDS = ("app", "android", "free", "open source", "privacy", "secure")


def keyword_ok(k: Column) -> Column:
    """One to three words of a-z, 0-9 and hyphens, none of hyphens only, and not one that says nothing."""
    return ~k.isin(*DROPPED_KEYWORDS) & k.rlike(r"^(?!-+(?: |\z))[a-z0-9-]+(?: (?!-+(?: |\z))[a-z0-9-]+){0,2}\z")


def accept_keywords(raw: Column, corpus: Column, most: int = 8) -> Column:
    """Proposed keywords that are well formed and stand in the corpus: sorted, distinct, the first ``most``."""
    formed = F.sort_array(F.array_distinct(F.filter(F.transform(raw, fold_line), keyword_ok)))
    none = F.array().cast("array<string>")
    # The corpus is searched until there are enough, not once per proposal.
    found = lambda low: F.aggregate(formed, none, lambda got, k: F.when((F.size(got) < most) & at_boundary(low, k), F.concat(got, F.array(k))).otherwise(got))
    return let(F.lower(corpus), found)


def accept_queries(lines: Column, app_name: Column, least: int = 5, most: int = 10) -> Column:
    """Lines of two to six words without the app's name: distinct, the first ``most``; null under ``least``."""
    name = F.coalesce(fold_line(app_name), F.lit(""))
    kept = F.filter(F.transform(lines, fold_line), lambda q: (F.size(F.split(q, " ")).between(2, 6)) & ((name == "") | ~at_boundary(q, name)))
    kept = F.slice(F.array_distinct(kept), 1, most)
    return F.when(F.size(kept) >= least, kept)


# Fixed values (RE2): talk of another build or store, and what is a list, a heading, a link or a quote rather than a paragraph.
OTHER_BUILD = r"(?i)\b(?:foss|variant|flavou?r)\b|standard builds?|open[- ]source|f-droid|obtainium|play store"
NOT_PROSE = r"•|(?:^|\s)\d+\.(?:\s|$).*\s\d+\.(?:\s|$)|\b[A-Z]{2,}(?:[\s-]+[A-Z]{2,}){2,}\b|(?:^|\s)@\w|https?://|^[^.!?]{1,40}:\s"


def fits_about(x: Column) -> Column:
    """Is the one-lined text a paragraph of English, as long as an about text, about this build?"""
    line = one_line(visible(x))
    paragraph = ~line.rlike(re2_to_java(OTHER_BUILD)) & ~line.rlike(re2_to_java(NOT_PROSE))
    return F.when(F.length(line).between(*ABOUT_LENGTH), paragraph & F.coalesce(prose(language_stats(line)), F.lit(False))).otherwise(F.lit(False))


def longest_lead(x: Column, most: int = ABOUT_LENGTH[1]) -> Column:
    """Struct (k, lead) of the most leading sentences that fit in ``most`` characters; null if not even one does."""
    start = F.struct(F.lit(0).alias("k"), F.lit(-1).alias("len"))

    def add(got: Column, part: Column) -> Column:
        n = got["len"] + 1 + F.length(part)
        return F.when(got["len"] <= most, F.struct((got["k"] + F.when(n <= most, 1).otherwise(0)).alias("k"), n.alias("len"))).otherwise(got)

    def lead(parts: Column) -> Column:
        k = F.aggregate(parts, start, add, lambda got: got["k"])
        return let(k, lambda k: F.when(k > 0, F.struct(k.alias("k"), F.array_join(F.slice(parts, 1, k), " ").alias("lead"))))

    return let(sentences(one_line(x)), lead)


def contains_all_groups(text: Column, groups: Column) -> Column:
    """Every group of phrases has one that occurs in the text, case aside."""
    low = F.lower(text)
    return F.forall(groups, lambda g: F.exists(g, lambda p: F.contains(low, F.lower(p))))
