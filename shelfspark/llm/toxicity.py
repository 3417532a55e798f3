"""Toxicity scoring of texts restored through a noisy channel.

A writer's word passes a channel that swaps letters for look-alike signs,
repeats letters and puts separators between them. What looks disturbed becomes
a lattice of readings; Viterbi decoding under a character trigram model of the
whole corpus picks the likeliest, and a sparse logistic model of words and word
beginnings, fitted on a bounded sample of labelled rows, scores the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm import text as tx

#: Look-alike signs and the letters they stand for. Fixed values.
SIGNS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c"}
#: Signs that may have been put between letters.
SEPARATORS = " .-_*/,"
#: Costs of the channel, in nats: a look-alike, a dropped separator, a separator kept as a word break, a dropped repeat, a dropped sign of two alike, a dropped look-alike, any other dropped sign.
SWAP, DROP_SEPARATOR, BREAK, DROP_REPEAT, DROP_DOUBLE, DROP_SIGN, DROP = 0.7, 0.5, 2.0, 0.3, 2.0, 9.0, 4.0

_S, _LETTER, _SPACES = "[0-9@$!|+(<]", "[a-z0-9@$!|+(<]", r"\s\v\pZ\x{85}\x1c-\x1f"
#: What makes a text worth a closer look (RE2, over a whole Arrow batch).
DISTURBED = "|".join([*(c * 2 for c in "abcdefghijklmnopqrstuvwxyz"), f"[a-z]{_S}", f"{_S}[a-z]", r"[a-z][-._*/,]+[a-z]", rf"(^|[^a-z0-9]){_LETTER}([-._*/,{_SPACES}]+{_LETTER}){{2}}"])
#: The spans then decoded: single letters with separators between them, and words with two letters alike, look-alikes or separators.
_SPACED = re.compile(rf"(?<![a-z0-9]){_LETTER}(?:[-._*/,\s]+{_LETTER}){{2,}}(?![a-z0-9])")
_ODD = re.compile(rf"(?<!\S)\S*?(?:([a-z])\1|[a-z]{_S}|(?<![a-z0-9@$!|+(<]){_S}+[a-z]|[a-z][-._*/,]+[a-z])\S*")
_GAP, _STOP = re.compile(r"[-._*/,\s]+"), re.compile(r"[.,/]\s+")

_CODE = {chr(97 + k): k + 1 for k in range(26)}
_CODES = np.zeros(256, np.int32)
_CODES[97:123] = np.arange(1, 27)
_CODES[65:91] = np.arange(1, 27)
_CODES[128:] = 27

#: Labelled rows learnt from at most, by label; the sample is the first by a hash of the id.
TRAIN_TOXIC, TRAIN_CLEAN = 2_000, 4_000
#: Bytes of word beginnings that are features beside whole words.
BEGINNINGS = (4, 5, 6)
#: What a feature proves alone: its toxic rows, less so many for each clean one, over its toxic rows and so many more.
DOUBT = 10
#: Features considered at most, by evidence.
MODEL_FEATURES = 20_000


def trigram_counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Counts of character trigrams within rows; signs and digits count as breaks."""
    codes = np.zeros(len(data) + 2 * len(at), np.int32)
    codes[np.arange(len(data)) + 2 * np.repeat(np.arange(len(at) - 1), np.diff(at)) + 2] = _CODES[data]
    return np.bincount((codes[:-2] << 10) + (codes[1:-1] << 5) + codes[2:], minlength=1 << 15)


def corpus_trigrams(docs: DataFrame, text: str = "text") -> DataFrame:
    """(trigram, n) over all rows: at most 2^15 rows per task are shuffled, and as many come out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 15, np.int64)
        for batch in batches:
            for _, data, at in tx.slices(batch, "t"):
                total += trigram_counts(data, at)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["trigram", "n"])

    return docs.select(F.col(text).cast("string").alias("t")).mapInArrow(run, "trigram int, n long").groupBy("trigram").agg(F.sum("n").alias("n"))


class CharModel:
    """Character trigrams, smoothed by bigrams and those by single characters; costs are negative logs."""

    def __init__(self, counts: np.ndarray):
        n = counts.reshape(32, 32, 32).astype(float)
        n[:, :, 28:] = 0
        one = n.sum((0, 1)) + 1.0
        one[28:] = 0
        one /= one.sum()
        two = n.sum(0) + 20 * one
        two /= two.sum(1, keepdims=True)
        three = n + 20 * two
        three /= three.sum(2, keepdims=True)
        self.cost = (-np.log(np.maximum(three, 1e-12))).tolist()

    @staticmethod
    def _repeat(token: str, k: int) -> float | None:
        """What it costs to drop the k-th sign as a repeat of the one before: less where three or more are alike."""
        if not k or token[k - 1] != token[k]:
            return None
        return DROP_REPEAT if token[k] in (token[k - 2 : k - 1], token[k + 1 : k + 2]) else DROP_DOUBLE

    def options(self, token: str, k: int) -> list[tuple[str, float]]:
        """Readings of the k-th sign: what it stands for ('' for nothing, ' ' for a break), and the channel's cost."""
        ch, again = token[k], self._repeat(token, k)
        if ch in _CODE or ch > "\x7f":
            return [(ch, 0.0)] if again is None else [(ch, 0.0), ("", again)]
        read = [(letter, SWAP * len(SIGNS[ch])) for letter in SIGNS.get(ch, "")]
        if ch in SEPARATORS:
            return [("", DROP_SEPARATOR), (" ", BREAK)]
        if read:
            return [*read, ("", DROP_SIGN if again is None else again)]
        return [("", DROP), (" ", DROP)]

    def restore(self, token: str) -> str:
        """The likeliest reading of a lower-case token: Viterbi over states of the last two characters."""
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for k in range(len(token)):
            ahead: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for emit, channel in self.options(token, k):
                code = _CODE.get(emit, 0 if emit == " " else 27)
                for (a, b), (cost, trail) in states.items():
                    if emit:
                        to, cost, trail = (b, code), cost + channel + self.cost[a][b][code], (trail, emit)
                    else:
                        to, cost = (a, b), cost + channel
                    if to not in ahead or cost < ahead[to][0]:
                        ahead[to] = (cost, trail)
            states = ahead
        _, trail = min(((cost + self.cost[a][b][0], trail) for (a, b), (cost, trail) in states.items()), key=lambda x: x[0])
        out = []
        while trail:
            trail, emit = trail
            out.append(emit)
        return "".join(reversed(out))


def _forms(token: str) -> set[str]:
    """A token with and without the signs at its ends, which may be letters or marks."""
    left = token.lstrip("!$|(<+ ")
    return {token, left, token.rstrip("!$|(< "), left.rstrip("!$|(< ")} - {""}


def _spans(lower: str) -> Iterator[str]:
    for m in _ODD.finditer(lower):
        yield from _forms(m.group().strip("?.,;:\"'%&*#)>[]{}=/\\"))
    for m in _SPACED.finditer(lower):
        for part in {m.group(), *_STOP.split(m.group())}:
            for token in _forms(_GAP.sub(" ", part)):
                yield token
                # A word of one letter may stand beside a spaced one.
                if token[:2] in ("a ", "i "):
                    yield token[2:]
                if token[-2:] in (" a", " i"):
                    yield token[:-2]


def restored_words(lower: str, model: CharModel, memo: dict[str, str]) -> str:
    """Restored readings of all disturbed spans of a lower-case text, joined by spaces."""
    out = []
    for token in _spans(lower):
        if token not in memo:
            if len(memo) > 50_000:
                memo.clear()
            memo[token] = model.restore(token)
        if memo[token] != token:
            out.append(memo[token])
    return " ".join(out)


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of words and word beginnings, repeated ones included; features have 30 bits."""
    starts, ends, first = tx.word_bounds(data, at, tx.BY_SIGN)
    rows = tx.row_of(first)
    values = tx.byte_values(True, 7)
    out_rows, out = [rows], [tx.span_hashes(data, starts, ends, values)]
    for n in BEGINNINGS:
        some = np.flatnonzero(ends - starts > n)
        out_rows.append(rows[some])
        out.append(tx.mix(tx.span_hashes(data, starts[some], starts[some] + n, values) + np.uint64(n)))
    return np.concatenate(out_rows), (np.concatenate(out) >> np.uint64(34)).astype(np.int64)


def _all_features(part: pa.RecordBatch, model: CharModel, memo: dict[str, str]) -> tuple[np.ndarray, np.ndarray]:
    texts = pc.utf8_lower(pc.fill_null(tx.as_array(part.column(part.num_columns - 1)), ""))
    rows, found = features(*tx.string_parts(texts))
    odd = pc.indices_nonzero(pc.match_substring_regex(texts, DISTURBED)).to_numpy().astype(np.int64)
    if len(odd):
        restored = pa.array([restored_words(texts[int(k)].as_py(), model, memo) for k in odd], pa.string())
        more_rows, more = features(*tx.string_parts(restored))
        rows, found = np.concatenate([rows, odd[more_rows]]), np.concatenate([found, more])
    return rows, found


class Scorer:
    """Feature weights, what each feature proves alone, and a bias.

    A text's score is the logistic of the sum over its distinct features, or
    what its strongest feature proves alone, whichever is higher: toxic rows
    often hold several such words, so their weights alone undervalue a single one.
    """

    def __init__(self, feature: np.ndarray, weight: np.ndarray, alone: np.ndarray, bias: float):
        order = np.argsort(feature)
        self.feature, self.weight, self.alone, self.bias = feature[order].astype(np.uint64), weight[order], alone[order], bias

    def scores(self, rows: np.ndarray, found: np.ndarray, n: int) -> np.ndarray:
        wide = found.astype(np.uint64)
        hit = tx.member(wide, self.feature, tx.front(self.feature)) if len(self.feature) else np.zeros(0, np.int64)
        both = np.unique(rows[hit] * (1 << 31) + np.searchsorted(self.feature, wide[hit]))
        row, which = (both >> 31).astype(np.int64), (both & ((1 << 31) - 1)).astype(np.int64)
        out = 1 / (1 + np.exp(-(np.bincount(row, self.weight[which], n) + self.bias))) if len(both) else np.full(n, 1 / (1 + np.exp(-self.bias)))
        np.maximum.at(out, row, self.alone[which])
        return out


def fit(sets: list[np.ndarray], toxic: np.ndarray, rounds: int = 4000, l1: float = 2e-5) -> Scorer:
    """Sparse logistic regression by accelerated proximal gradient; only features that speak for toxicity get weight.

    ``sets`` are distinct features per row. Candidates are features of at least
    three toxic rows that are commoner there than elsewhere.
    """
    base = float(toxic.mean()) if len(toxic) else 0.0
    if not 0 < base < 1:
        return Scorer(np.zeros(0), np.zeros(0), np.zeros(0), 6.0 if base == 1 else -6.0)
    lengths = np.fromiter(map(len, sets), np.int64, len(sets))
    rows, found = np.repeat(np.arange(len(sets)), lengths), np.concatenate(sets)
    names, which = np.unique(found, return_inverse=True)
    yes = np.bincount(which, toxic[rows], len(names))
    no = np.bincount(which, 1 - toxic[rows], len(names))
    rate = (yes + base) / (yes + no + 1)
    proof = yes * np.log(rate / base)
    some = np.flatnonzero((yes >= 3) & (rate > 1.5 * base))
    some = some[np.argsort(-proof[some], kind="stable")][:MODEL_FEATURES]
    place = np.full(len(names), -1)
    place[some] = np.arange(len(some))
    keep = place[which] >= 0
    r, c = rows[keep], place[which[keep]]
    if not len(some):
        return Scorer(np.zeros(0), np.zeros(0), np.zeros(0), -6.0)
    n, k = len(sets), len(some)
    # One step size per feature, from how often it occurs; the logistic loss bends by a quarter at most.
    most = np.bincount(r, minlength=n).max() + 1
    step = 4.0 * n / (most * np.maximum(np.bincount(c, minlength=k), 1.0))
    bias_step = 4.0 / most
    w, b = np.zeros(k), float(np.log(base / (1 - base)))
    v, vb, t = w, b, 1.0
    for _ in range(rounds):
        z = np.bincount(r, v[c], n) + vb
        gap = 1 / (1 + np.exp(-z)) - toxic
        nw = np.maximum(v - step * (np.bincount(c, gap[r], k) / n + l1), 0.0)
        nb = vb - bias_step * gap.mean()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    used = np.flatnonzero(w > 0.02)
    mine = some[used]
    return Scorer(names[mine], w[used], np.maximum(0, yes[mine] - DOUBT * no[mine]) / (yes[mine] + DOUBT), b)


def _training(model: CharModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, str] = {}
        for batch in batches:
            for part, _, _ in tx.slices(batch, "t"):
                rows, found = _all_features(part, model, memo)
                both = np.unique(rows * (1 << 31) + found)
                at = np.searchsorted(both, np.arange(part.num_rows + 1) * (1 << 31))
                packed = (both & ((1 << 31) - 1)).astype(np.int32)
                sets = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer((at * 4).astype(np.int32)), pa.py_buffer(packed.tobytes())])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), sets], names=["toxic", "sha", "features"])

    return run


def _scoring(model: CharModel, scorer: Scorer, keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, str] = {}
        for batch in batches:
            for part, _, _ in tx.slices(batch, "t"):
                score = scorer.scores(*_all_features(part, model, memo), part.num_rows)
                yield pa.RecordBatch.from_arrays([*[part.column(k) for k in range(keep)], pa.array(score)], names=[*part.schema.names[:keep], "score"])

    return run


def held_out(key: str = "doc_id") -> Column:
    """True for rows whose labels are never learnt: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, counts: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", most_toxic: int = TRAIN_TOXIC, most_clean: int = TRAIN_CLEAN) -> tuple[CharModel, Scorer]:
    """Character model from ``counts`` and scorer from a bounded sample of the labels that may be learnt.

    The sample is the first ``most_toxic`` and ``most_clean`` labelled ids by a
    hash of the id, so it is the same on every run. An id that occurs more than
    once gives one of its texts, the first by SHA-256, picked where rows are
    read; equal texts count once.
    """
    tri = counts.toPandas()
    table = np.zeros(1 << 15)
    table[tri["trigram"].to_numpy(np.int64)] = tri["n"].to_numpy(float)
    model = CharModel(table)
    known = labels.filter(F.col(key).isNotNull() & ~held_out(key)).groupBy(F.col(key).alias("__id")).agg(F.max(F.col(label)).cast("int").alias("toxic"))
    pick = lambda value, most: known.filter(F.col("toxic") == value).orderBy(F.xxhash64("__id"), "__id").limit(most)
    sample = pick(1, most_toxic).unionByName(pick(0, most_clean))
    texts = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("t")).join(F.broadcast(sample), F.col("id") == F.col("__id"))
    rows = texts.groupBy("id").agg(F.max("toxic").alias("toxic"), F.min(F.struct(F.sha2(F.coalesce("t", F.lit("")), 256).alias("sha"), "t")).alias("one")).select("toxic", "one.sha", "one.t")
    got = rows.mapInArrow(_training(model), "toxic int, sha string, features binary").toPandas().sort_values(["sha", "toxic"]).drop_duplicates("sha", keep="last")
    return model, fit([np.frombuffer(x, np.int32).astype(np.int64) for x in got["features"]], got["toxic"].to_numpy(float))


def score_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score`` (0 to 1) of each row of ``docs``.

    Null and empty texts score by the bias alone, which is low. Without labels
    of both kinds to learn from, every row gets the same score: high if all are
    toxic, else low. Repeated rows score alike, and an id with several labels
    is toxic if one of them says so. Texts and words of any length are read and
    decoded whole, in time that grows with their length. An empty table gives
    no rows. Columns of ``docs`` other than ``keep`` go; one of ``keep`` that is
    called ``score`` is replaced by the score.
    """
    model, scorer = train(docs, labels, corpus_trigrams(docs, text), key, text, label)
    source = docs.select(*[F.col(f"`{k}`") for k in keep if k != "score"], F.col(text).cast("string").alias("t"))
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    return source.mapInArrow(_scoring(model, scorer, len(schema)), ", ".join([*schema, "score double"]))
