"""Licence scans by a trained paragraph classifier, in DataFrame functions only.

A multinomial logistic model over sparse word n-grams tells licence families and
an unknown class; its temperature is set on held-out samples, so its
probabilities mean something, and a family counts only where the paragraph also
holds most of one of the family's templates. The model is fitted on the driver
from fixed texts and a bounded sample of corpus paragraphs; scoring is a
projection of the table as it is read, with no shuffle.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Wording of licence notices by family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.', "This project is licensed under the terms of the Apache 2.0 license", "Apache License Version 2.0, January 2004"),
    "MIT": ("Released under the MIT License", "This project is licensed under the MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction", "Distributed under the terms of the MIT license"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    "LGPL": ("Licensed under the GNU Lesser General Public License", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    "AGPL-3.0": ("Licensed under the GNU Affero General Public License, version 3", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    "BSD": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Released under the BSD 3-Clause License", "This software is distributed under the BSD license"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License, version 2.0"),
    "CC-BY": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC0": ("Dedicated to the public domain under CC0 1.0 Universal", "Creative Commons Zero CC0 1.0 license"),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "Licensed under the ISC License"),
    "Unlicense": ("This is free and unencumbered software released into the public domain", "Released under the Unlicense"),
}
# Talk of licences that names none.
NO_FAMILY = ("All rights reserved", "See the license file for details", "No license is granted by this text", "A driving license is required", "Copyright by the authors", "Please ask for permission before you copy this", "Licensed under the terms of the agreement", "This work is licensed under special terms", "Released under a private license", "The warranty is void", "Version 2.0 of this work was released", "The general public may use this")
#: Words that are not looked for, the commonest first, as far as a template's other words suffice. Fixed values.
COMMON = "the of a to and in is v into for this with or any by it not you that are may from be as use except work person 3 2 29 4.0 1.0 2.0 project june january under version following terms conditions free public published charge copy purpose general files form forms without source code file hereby either associated deal met software subject provided documentation fee compliance dedicated domain".split()
#: Names and words for licences that no template needs. Fixed values.
STEMS = ("licens", "licenc", "lizenz", "licença")
NAMES = ("apache", "gpl", "gplv2", "gplv3", "lgpl", "lgplv2", "lgplv3", "agpl", "agplv3", "bsd", "mit", "mozilla", "mpl", "cc", "cc0", "cc-by", "isc", "gnu", "creative", "copyleft", "domain")
UNKNOWN = "unknown"
#: Windows of corpus lines that the unknown class is learnt from at most: the first by a hash.
SAMPLE = 300
#: Words of an n-gram at most; a family counts from this probability and this part of a template's words on.
GRAMS, LEAST_PROBABILITY, LEAST_OVERLAP = 3, 0.5, 0.6
#: Small maps that the weights are dealt to.
BUCKETS = 256
#: Wrapped lines are one piece up to a blank line or a line that ends with a sentence.
PIECES = r"(?<=[\p{L}\p{N}][.!?])[^\p{L}\p{N}\n]*+\n|\n[^\p{L}\p{N}\n]*+(?=\n)"
#: Words of a piece that are judged at once, and from one such window to the next: every run of STEP words is in one, and no template is longer.
WINDOW, STEP = 60, 30


def words_of(text: str) -> list[str]:
    return re.findall(r"[a-z0-9.\-]*[a-z0-9]", text.lower())


def grams_of(text: str) -> set[str]:
    w = words_of(text)
    return {" ".join(w[i : i + n]) for n in range(1, GRAMS + 1) for i in range(len(w) - n + 1)}


class Model:
    """n-gram weights per class (families, then unknown), biases, temperature, and the probability under which a family is unknown."""

    def __init__(self, grams: dict[str, list[float]], bias: list[float], temperature: float, reject: float = 0.0):
        self.grams, self.bias, self.temperature, self.reject = grams, bias, temperature, reject
        self.classes = [*TEMPLATES, UNKNOWN]

    def probabilities(self, text: str) -> list[float]:
        """Plain Python twin of the column expression, for tests."""
        z = [b + sum(self.grams[g][k] for g in grams_of(text) if g in self.grams) for k, b in enumerate(self.bias)]
        e = [math.exp((x - max(z)) / self.temperature) for x in z]
        return [x / sum(e) for x in e]


def _samples(corpus: list[str]) -> tuple[list[str], list[int], list[bool]]:
    """Texts, their classes, and which are held out: every second template of a family with all its forms, and every fifth text of no family."""
    classes = [*TEMPLATES, UNKNOWN]
    texts, labels, held = [], [], []
    for family, templates in TEMPLATES.items():
        for nth, t in enumerate(templates):
            w = t.split()
            forms = [t, t.upper(), t + ".", "We note: " + t, *[f"{c} {t} {c}" for c in corpus[:3]]]
            forms += [" ".join(w[:k]) for k in range(max(6, len(w) - 4), len(w))]
            texts += forms
            labels += [classes.index(family)] * len(forms)
            held += [nth % 2 == 1] * len(forms)
    for nth, t in enumerate((*NO_FAMILY, *corpus)):
        texts.append(t)
        labels.append(len(classes) - 1)
        held.append(nth % 5 == 4)
    return texts, labels, held


def _cues() -> tuple[str, ...]:
    """NAMES and so many words of each template that the rest of it is less than LEAST_OVERLAP: what holds none, nor a stem, can't be confirmed."""
    out = set(NAMES)
    for t in [t for ts in TEMPLATES.values() for t in ts]:
        w = sorted(set(words_of(t)), key=lambda x: COMMON.index(x) if x in COMMON else len(COMMON))
        out |= set(w[math.ceil(LEAST_OVERLAP * len(w)) - 1 :])
    return tuple(sorted(c for c in out if not any(s in c for s in STEMS)))


#: A paragraph without any of these as a word, and without any of STEMS, is not scored: no family could be confirmed.
CUES = _cues()


def _any_word(words: tuple[str, ...]) -> str:
    """A pattern of any of the words at a word's start, grouped by first letter so that most places fail at once."""
    first: dict[str, list[str]] = {}
    for w in words:
        first.setdefault(w[0], []).append(re.escape(w[1:]))
    return "(?<![a-z0-9])(?:" + "|".join(re.escape(c) + "(?:" + "|".join(rest) + ")" for c, rest in first.items()) + ")(?![a-z])"


def _descend(x: np.ndarray, y: np.ndarray, rounds: int, l2: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases of a softmax regression by gradient descent; classes count alike."""
    k = y.shape[1]
    weight = (y @ (1 / np.maximum(1, y.sum(0))))[:, None]
    w, b = np.zeros((x.shape[1], k)), np.zeros(k)
    for _ in range(rounds):
        z = x @ w + b
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = (p - y) * weight
        w -= 2.0 * (x.T @ g / k * 4 + l2 * w)
        b -= 2.0 * g.sum(0) / k
    return w, b


@lru_cache(8)
def fit(corpus: tuple[str, ...], rounds: int = 300, l2: float = 1e-3) -> Model:
    """Softmax regression by gradient descent, temperature and rejection set on templates that it has not seen.

    A first model learns without the held-out templates and corpus windows; the
    temperature is that under which it gives those the highest likelihood, and
    ``reject`` the least probability above which at most one in a hundred of the
    held-out texts without a licence is given a family. The model that is used
    learns from all.
    """
    texts, labels, out = _samples(list(corpus))
    known = sorted(set().union(*[grams_of(t) for ts in TEMPLATES.values() for t in ts], *[grams_of(t) for t in NO_FAMILY]))
    place = {g: k for k, g in enumerate(known)}
    x = np.zeros((len(texts), len(known)))
    for r, t in enumerate(texts):
        for g in grams_of(t):
            if g in place:
                x[r, place[g]] = 1
    y, held = np.eye(len(TEMPLATES) + 1)[labels], np.array(out)
    w, b = _descend(x[~held], y[~held], rounds, l2)
    z = x[held] @ w + b

    def chances(t: float) -> np.ndarray:
        e = np.exp((z - z.max(1, keepdims=True)) / t)
        return e / e.sum(1, keepdims=True)

    temperature = min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0), key=lambda t: -np.log(np.maximum(chances(t)[y[held] > 0], 1e-12)).mean())
    none = chances(temperature)[y[held][:, -1] > 0, :-1].max(1)
    reject = float(np.clip(np.quantile(none, 0.99), 1 / (len(TEMPLATES) + 1), LEAST_PROBABILITY)) if len(none) else LEAST_PROBABILITY
    w, b = _descend(x, y, rounds, l2)
    used = np.flatnonzero(np.abs(w).max(1) > 1e-3)
    return Model({known[i]: [round(float(v), 6) for v in w[i]] for i in used}, [round(float(v), 6) for v in b], temperature, round(reject, 6))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def cued(x: Column) -> Column:
    out = F.rlike(x, F.lit(_any_word(CUES)))
    for c in STEMS:
        out = out | F.contains(x, F.lit(c))
    return out


def names_a_licence(x: Column) -> Column:
    """Does a lower-case line hold a template, as far as words go? Other talk of licences is of the unknown class."""

    def held(w: Column) -> Column:
        out = F.lit(False)
        for t in [t for ts in TEMPLATES.values() for t in ts]:
            parts = sorted(set(words_of(t)))
            out = out | (F.size(F.array_intersect(w, F.array(*[F.lit(p) for p in parts]))) >= LEAST_OVERLAP * len(parts))
        return out

    return cued(x) & let(F.regexp_extract_all(x, F.lit(r"[a-z0-9.\-]*[a-z0-9]"), 0), held)


def _pieces(text: Column) -> Column:
    """Lower-case pieces that hold a cue; texts without any are not taken apart."""
    parts = lambda low: F.when(cued(low), F.filter(F.split(F.regexp_replace(low, "\r\n?", "\n"), PIECES), cued)).otherwise(F.array().cast("array<string>"))
    return let(F.lower(F.coalesce(text, F.lit(""))), parts)


def corpus_sample(docs: DataFrame, text: str = "text", most: int = SAMPLE) -> list[str]:
    """Windows of at most WINDOW words from lines of all texts, ``most`` of them: those of least hash, the same however the table is split.

    Lines are drawn by a hash of theirs, from all lines of more than twenty
    signs that name no licence of ours; the window starts at a word that the
    hash says. What is drawn first is so many lines by a bound on the hash that
    ``most`` are among them, so no task or driver sees more than some of them.
    """
    rows = docs.count()
    bound = min((1 << 63) - 1, (20 * most << 63) // max(1, rows))
    lines = docs.select(F.explode(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "\n+")).alias("p")).filter(F.length("p") > 20)
    drawn = lines.select("p", F.abs(F.xxhash64("p").bitwiseOR(F.lit(1))).alias("h")).filter((F.col("h") <= bound) & ~names_a_licence(F.col("p")))
    w = F.regexp_extract_all("p", F.lit(r"[a-z0-9.\-]*[a-z0-9]"), 0)
    at = F.pmod(F.col("h"), F.greatest(F.size("w") - WINDOW, F.lit(0)) + 1).cast("int") + 1
    windows = drawn.select("h", w.alias("w")).select("h", F.array_join(F.slice("w", at, WINDOW), " ").alias("p")).distinct()
    return sorted({r.p for r in windows.orderBy("h", "p").limit(most).collect() if r.p})


def scan_licenses(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), model: Model | None = None) -> DataFrame:
    """``keep`` columns, and ``paragraphs``: (paragraph, family, probability, overlap, confirmed) of all that speaks of licences.

    A piece of wrapped lines is judged joined, by windows of WINDOW words, and
    line by line. Windows that confirm a family are given, the best of those
    that overlap, and lines beside them only where they confirm another family
    no worse. Where no window does, all lines with a cue are given.

    A family that has LEAST_PROBABILITY but less than LEAST_OVERLAP of the words
    of every template of its is not confirmed; lines whose best class is unknown,
    or has less than the model's ``reject``, are of the family unknown. Null and
    empty texts have no such lines. Repeated rows are kept as they are, and of
    classes of equal score the first named is given. Lines are scored whole,
    whatever their length; an empty table gives no rows. Columns other than
    ``keep`` go, and one of ``keep`` called ``paragraphs`` is replaced.
    """
    model = model or fit(tuple(corpus_sample(docs, text)))
    k = len(model.classes)
    # Weights by a hash of the n-gram: a map is searched from its start, so there are many small ones.
    buckets: list[list[tuple[str, list[float]]]] = [[("", [0.0] * k)] for _ in range(BUCKETS)]
    for g, w in model.grams.items():
        buckets[zlib.crc32(g.encode()) % BUCKETS].append((g, w))
    weights = F.array(*[F.create_map(*[x for g, w in b for x in (F.lit(g), F.array(*[F.lit(v) for v in w]))]) for b in buckets])
    words = lambda p: F.regexp_extract_all(p, F.lit(r"[a-z0-9.\-]*[a-z0-9]"), 0)

    def grams(w: Column) -> Column:
        def runs(n: int) -> Column:
            return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(F.array().cast("array<string>"))

        return F.array_distinct(F.concat(*[runs(n) for n in range(1, GRAMS + 1)]))

    zero = F.array(*[F.lit(b) for b in model.bias])

    def scores(w: Column) -> Column:
        lookup = lambda g: F.try_element_at(F.element_at(weights, (F.crc32(g.cast("binary")) % BUCKETS + 1).cast("int")), g)
        known = F.filter(F.transform(grams(w), lookup), lambda v: v.isNotNull())
        return F.aggregate(known, zero, lambda z, v: F.zip_with(z, v, lambda a, b: a + b))

    def overlap(w: Column, family: Column) -> Column:
        out = F.lit(0.0)
        for name, templates in TEMPLATES.items():
            parts = [sorted(set(words_of(t))) for t in templates]
            best = F.greatest(*[F.size(F.array_intersect(w, F.array(*[F.lit(x) for x in p]))) / F.lit(float(len(p))) for p in parts])
            out = F.when(family == name, best).otherwise(out)
        return out

    def judge(p: Column) -> Column:
        return let(words(p), lambda w: F.struct(p.alias("paragraph"), F.array_distinct(w).alias("w"), scores(w).alias("z")))

    def windows(p: Column) -> Column:
        last = F.ceil(F.greatest(F.size(p) - WINDOW, F.lit(0)) / F.lit(STEP)).cast("int")
        return F.filter(F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(p, i * STEP + 1, WINDOW), " ")), cued)

    def readings(p: Column) -> Column:
        several = F.contains(F.btrim(p, F.lit(" \t\n")), F.lit("\n"))
        joined = F.when(several, F.flatten(F.transform(F.array(words(p)), windows))).otherwise(F.array().cast("array<string>"))
        return F.struct(F.transform(joined, judge).alias("windows"), F.transform(F.filter(F.split(p, "\n+"), cued), judge).alias("lines"))

    names = F.array(*[F.lit(c) for c in model.classes])

    def result(s: Column) -> Column:
        top = F.array_max(s["z"])
        total = F.aggregate(s["z"], F.lit(0.0), lambda acc, z: acc + F.exp((z - top) / F.lit(model.temperature)))
        family = F.when(F.lit(1.0) / total < F.lit(model.reject), F.lit(UNKNOWN)).otherwise(F.element_at(names, F.array_position(s["z"], top).cast("int")))
        return F.struct(s["paragraph"].alias("paragraph"), family.alias("family"), (F.lit(1.0) / total).alias("probability"), s["w"].alias("w"))

    def confirm(s: Column) -> Column:
        share = overlap(s["w"], s["family"])
        sure = (s["family"] != UNKNOWN) & (s["probability"] >= LEAST_PROBABILITY) & (share >= LEAST_OVERLAP)
        return F.struct(s["paragraph"].alias("paragraph"), s["family"].alias("family"), s["probability"].alias("probability"), share.alias("overlap"), sure.alias("confirmed"))

    def best_windows(u: Column) -> Column:
        def stays(x: Column, i: Column) -> Column:
            before, after = F.get(u["windows"], i - 1), F.get(u["windows"], i + 1)
            worse = (before["confirmed"] & ((before["overlap"] > x["overlap"]) | ((before["overlap"] == x["overlap"]) & (before["family"] == x["family"])))) | (after["confirmed"] & (after["overlap"] > x["overlap"]))
            return x["confirmed"] & ~F.coalesce(worse, F.lit(False))

        return F.struct(F.filter(u["windows"], stays).alias("windows"), u["lines"].alias("lines"))

    def known(u: Column) -> Column:
        return F.struct(u["windows"].alias("windows"), u["lines"].alias("lines"), F.array_max(F.transform(u["windows"], lambda x: x["overlap"])).alias("best"), F.transform(u["windows"], lambda x: x["family"]).alias("families"))

    def given(u: Column) -> Column:
        own = F.filter(u["lines"], lambda x: u["best"].isNull() | (x["confirmed"] & (x["overlap"] >= u["best"]) & ~F.array_contains(u["families"], x["family"])))
        return F.concat(u["windows"], own)

    if k < 2:
        raise ValueError("a model needs families")
    found = F.transform(_pieces(F.col(text)), readings)
    both = lambda step: lambda u: F.struct(*[F.transform(u[x], step).alias(x) for x in ("windows", "lines")])
    for step in (both(result), both(confirm), best_windows, known, given):
        found = F.transform(found, step)
    return docs.select(*[F.col(f"`{c}`") for c in keep if c != "paragraphs"], F.flatten(found).alias("paragraphs"))
