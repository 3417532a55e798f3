"""Text rules over whole Arrow batches: language figures and RE2 patterns, without a loop over rows.

For long texts; short ones in expressions use the Column rules of ``text``.
"""

from __future__ import annotations

import re
from functools import lru_cache
from re import _constants as sre
from re import _parser as sre_parse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.functions.text import COMMON_WORDS

#: Signs that are looked at together.
SLICE = 1 << 21
_STATS = pa.struct([("words", pa.int64()), ("common", pa.int64()), ("latin", pa.int64()), ("other", pa.int64())])


@lru_cache(1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: is it a letter, and is it one of another script than Latin?"""
    all_ = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    letter, other = np.zeros(0x110000, bool), np.zeros(0x110000, bool)
    for pattern, table in ((r"\p{L}", letter), (r"[\p{L}--\p{Latin}]", other)):
        found = "".join(regex.findall(pattern, all_, regex.V1))
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = True
    return letter, other


@lru_cache(1)
def _common() -> np.ndarray:
    return np.sort(np.array([int.from_bytes(w.encode(), "little") for w in COMMON_WORDS], np.uint64))


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by a 0, and where each begins (one more than texts)."""
    points = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])


def _per_text(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[at])


def language_figures(texts: list[str]) -> tuple[np.ndarray, ...]:
    """words, common, latin and other of each text, as the Column rule has them."""
    letter, foreign = _letters()
    points, at = _points(texts)
    upper = points & ~np.uint32(32)
    latin = (upper >= 65) & (upper <= 90)
    other = foreign[points]
    low, low_at = _points([t.lower() for t in texts])
    inside = letter[low] | (low == 39)
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    size = stop - start
    short = size <= 8
    packed = np.zeros(int(short.sum()), np.uint64)
    begin, length = start[short], size[short]
    plain = np.ones(len(packed), bool)
    for k in range(8):
        on = length > k
        c = low[np.minimum(begin + k, len(low) - 1)]
        plain &= ~on | (c < 128)
        packed |= np.where(on, c, 0).astype(np.uint64) << np.uint64(8 * k)
    hit = np.zeros(len(start), bool)
    hit[np.flatnonzero(short)] = plain & np.isin(packed, _common())
    of = np.searchsorted(low_at, start, "right") - 1
    count = lambda w: np.bincount(of, w, len(texts)).astype(np.int64)
    return count(None), count(hit), _per_text(latin, at), _per_text(other, at)


@F.arrow_udf(T.StructType([T.StructField(f.name, T.LongType()) for f in _STATS]))
def _language(x: pa.Array) -> pa.Array:
    got: list[list[np.ndarray]] = [[], [], [], []]
    texts, held = [], 0
    for k, t in enumerate(x.to_pylist()):
        texts.append(t or "")
        held += len(texts[-1])
        if held > SLICE or k == len(x) - 1:
            for column, figures in zip(got, language_figures(texts), strict=True):
                column.append(figures)
            texts, held = [], 0
    columns = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in got]
    return pa.StructArray.from_arrays(columns, fields=list(_STATS))


def language_stats(x: Column) -> Column:
    """Struct of words, common, latin and other of long texts, in one pass; null texts are empty."""
    return _language(x)


def matches(x: Column, pattern: str) -> Column:
    """Does an RE2 pattern find something? By RE2 itself, over whole batches; null for null."""

    @F.arrow_udf(T.BooleanType())
    def run(texts: pa.Array) -> pa.Array:
        return pc.match_substring_regex(texts, pattern)

    return run(x)


#: So few patterns are each run over all texts, which costs less than looking for their literals.
FEW_RULES = 12
#: Shorter literals rule out too little to be looked for.
LEAST_FACTOR = 3


def _factors(parts) -> list[set[str]]:
    """Sets of small-letter literals of which a match of the parsed pattern holds one each; none where it may hold anything."""
    out: list[set[str]] = []
    run = ""
    for op, value in [*parts, (None, None)]:
        if op is sre.LITERAL:
            run += chr(value).casefold()
            continue
        if len(run) >= LEAST_FACTOR:
            out.append({run})
        run = ""
        if op is sre.SUBPATTERN:
            out += _factors(value[3])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT) and value[0] > 0:
            out += _factors(value[2])
        elif op is sre.BRANCH:
            each = [max(_factors(b), key=lambda s: min(map(len, s)), default=None) for b in value[1]]
            if all(each):
                out.append(set().union(*each))
    return out


def required(pattern: str) -> set[str] | None:
    """Small-letter literals of which every text that the RE2 pattern finds something in holds one; None if that can't be told.

    Of the sets a match must meet, the one whose shortest literal is longest. A
    pattern that Python reads in another way than RE2 (or not at all) gives None.
    """
    if re.search(r"\\[^dDsSwWbB.\\/()\[\]{}*+?|^$-]|\[:|\(\?[^:i)]", pattern):
        return None
    try:
        parts = sre_parse.parse(pattern)
    except (re.error, OverflowError):
        return None
    return max(_factors(parts), key=lambda s: min(map(len, s)), default=None)


def first_match(x: Column, rules: list[tuple[str, str]]) -> Column:
    """The first by name of the rules (name, RE2 pattern) that find something, or null.

    Literals that a match must hold are taken from the patterns and looked for
    in all texts at once by one automaton; a pattern is run over the texts that
    hold one of its literals, and only patterns without any over all of them.
    Texts that have their rule are not searched again.
    """
    ordered = sorted(rules)
    needed = [required(p) if len(ordered) > FEW_RULES else None for _, p in ordered]

    @F.arrow_udf(T.StringType())
    def run(texts: pa.Array) -> pa.Array:
        import ahocorasick

        machine, by_literal = ahocorasick.Automaton(), {}
        for k, literals in enumerate(needed):
            for literal in literals or ():
                by_literal.setdefault(literal, []).append(k)
        for literal, ks in by_literal.items():
            machine.add_word(literal, ks)
        candidates: dict[int, list[int]] = {}
        if by_literal:
            machine.make_automaton()
            for row, text in enumerate(texts.to_pylist()):
                if text:
                    met = {id(ks): ks for _, ks in machine.iter(text.casefold())}
                    for k in set().union(*met.values()) if met else ():
                        candidates.setdefault(k, []).append(row)
        found = np.full(len(texts), None, object)
        open_ = np.ones(len(texts), bool)
        for k, (name, pattern) in enumerate(ordered):
            rows = np.flatnonzero(open_) if needed[k] is None else np.array([r for r in candidates.get(k, ()) if open_[r]], np.int64)
            if len(rows):
                hit = pc.fill_null(pc.match_substring_regex(texts.take(pa.array(rows)), pattern), False).to_numpy(zero_copy_only=False)
                found[rows[hit]] = name
                open_[rows[hit]] = False
        return pa.array(found, pa.string())

    return run(x)
