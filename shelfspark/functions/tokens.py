"""BERT-style word pieces, batched through Arrow; the vocabulary is a parameter.

Accents stay, words of any length are looked up, every punctuation sign and
symbol stands alone, and so does every ideograph and kana.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_TOKENS = 512
#: Ideographs and kana (a token each), any other punctuation sign or symbol, or a run of what is neither; control signs are gone before.
_TOKEN = regex.compile(r"[\p{Han}぀-ヿ㐀-䶿\U00020000-\U0002a6df]|[\p{P}\p{S}]|[^\s\p{P}\p{S}\p{Han}぀-ヿ㐀-䶿\U00020000-\U0002a6df]+")
_CONTROL = regex.compile(r"[\p{Cc}--[\t-\r\x85]]", regex.V1)


def basic_tokens(text: str) -> list[str]:
    """Lower-case words; punctuation, symbols, ideographs and kana stand alone."""
    return list(_each_token(text))


def _each_token(text: str) -> Iterator[str]:
    return (m[0] for m in _TOKEN.finditer(_CONTROL.sub("", text.lower())))


def pieces(word: str, vocabulary: dict[str, int]) -> list[str]:
    """Greedy longest pieces from the left; [UNK] if some part has none. No piece is longer than the vocabulary's longest."""
    if word in vocabulary:
        return [word]
    longest = _longest(vocabulary)
    out, at = [], 0
    while at < len(word):
        mark = "##" if at else ""
        end = next((e for e in range(min(len(word), at + longest), at, -1) if mark + word[at:e] in vocabulary), None)
        if end is None:
            return ["[UNK]"]
        out.append(mark + word[at:end])
        at = end
    return out


_LONGEST: dict[int, tuple[int, int]] = {}


def _longest(vocabulary: dict[str, int]) -> int:
    known = _LONGEST.get(id(vocabulary))
    if known is None or known[0] != len(vocabulary):
        _LONGEST[id(vocabulary)] = known = (len(vocabulary), max(map(len, vocabulary), default=1))
    return known[1]


def encode(text: str | None, vocabulary: dict[str, int], most: int = MOST_TOKENS) -> list[int]:
    """Ids from [CLS] to [SEP], ``most`` of them at most; words beyond are not looked up."""
    body: list[int] = []
    for w in _each_token(text or ""):
        body += [vocabulary[p] for p in pieces(w, vocabulary)]
        if len(body) >= most - 2:
            break
    return [vocabulary["[CLS]"], *body[: most - 2], vocabulary["[SEP]"]]


def wordpiece(x: Column, vocabulary: dict[str, int], most: int = MOST_TOKENS) -> Column:
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            # Few texts and their ids are Python's own at a time.
            parts = [pa.array([encode(t.as_py(), vocabulary, most) for t in texts.slice(lo, 64)], pa.list_(pa.int32())) for lo in range(0, len(texts), 64)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return run(x)


def token_counts(text: str | None) -> tuple[int, int]:
    """How many basic tokens a text has, and how many signs they have together."""
    found = basic_tokens(text or "")
    return len(found), sum(map(len, found))


@F.pandas_udf(T.StructType([T.StructField("tokens", T.LongType()), T.StructField("signs", T.LongType())]))
def basic_token_counts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for s in batches:
        yield pd.DataFrame([token_counts(t) for t in s], columns=["tokens", "signs"])


def load_vocabulary(lines: list[str]) -> dict[str, int]:
    return {w.rstrip("\n"): k for k, w in enumerate(lines)}
