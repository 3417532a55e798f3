"""Benchmark decontamination by winnowing (Schleimer, Wilkerson and Aiken, 2003).

From the hashes of all k-grams of words the least one of every w that follow
each other is kept. Any shared run of w + k - 1 words then has a fingerprint in
common, so with w + k - 1 = the window asked for nothing is missed. Fingerprints
that meet are extended to the windows around them, which must agree as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm import text as tx

WINDOW, GRAM = 10, 5
#: An index is built of so many benchmark words at most; a larger benchmark goes through in several blocks of items.
BLOCK_WORDS = 1_000_000


def _words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = tx.word_bounds(data, at, tx.BY_SIGN)
    return tx.span_hashes(data, starts, ends, tx.byte_values(True)), first


def winnow(words: np.ndarray, first: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window that lies in one row: its first word and its fingerprint, the least hash of its k-grams."""
    rows = tx.row_of(first)
    if len(words) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    starts = np.flatnonzero(rows[: len(rows) - window + 1] == rows[window - 1 :])
    grams = tx.run_hashes(words, gram)
    span, least = 1, grams
    while span * 2 <= window - gram + 1:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = window - gram + 1 - span
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    return starts, least[starts]


class Index:
    """Fingerprints and windows of some benchmark items; items shorter than a window are one window of their own length."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int = WINDOW, gram: int = GRAM):
        data, at = tx.string_parts(pa.array(texts, pa.string()))
        words, first = _words(data, at)
        self.ids, self.window, self.gram = ids, window, gram
        starts, prints = winnow(words, first, window, gram)
        rows = tx.row_of(first)
        self.prints = np.unique(prints)
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        if len(starts):
            self._put(window, tx.run_hashes(words, window)[starts], rows[starts])
        length = np.diff(first)
        for n in np.unique(length[(length > 0) & (length < window)]):
            short = np.flatnonzero(length == n)
            self._put(int(n), tx.run_hashes(words, int(n))[first[short]], short)

    def _put(self, size: int, hashes: np.ndarray, items: np.ndarray) -> None:
        both = np.unique(np.stack([hashes, items.astype(np.uint64)], 1), axis=0)
        self.tables[size] = (both[:, 0].copy(), both[:, 1].astype(np.int64))

    def find(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows that occur: first word, number of words, and the first entry of the window's table."""
        rows = tx.row_of(first)
        found: list[tuple[np.ndarray, int]] = []
        if self.window in self.tables:
            starts, prints = winnow(words, first, self.window, self.gram)
            met = starts[tx.member(prints, self.prints, self._front())]
            found.append((met, self.window))
        found += [(np.flatnonzero(rows[: max(0, len(rows) - n + 1)] == rows[n - 1 :]), n) for n in self.tables if n != self.window and len(words) >= n]
        at, size, entry = [], [], []
        for starts, n in found:
            table = self.tables[n][0]
            hashes = _runs_at(words, starts, n)
            hit = tx.member(hashes, table)
            at.append(starts[hit])
            size.append(np.full(len(hit), n))
            entry.append(np.searchsorted(table, hashes[hit]))
        if not at:
            return (np.zeros(0, np.int64),) * 3
        return np.concatenate(at), np.concatenate(size), np.concatenate(entry)

    def owners(self, size: int, entry: int) -> np.ndarray:
        """Items that hold the window at ``entry``, the first of its hash."""
        hashes, items = self.tables[size]
        return items[entry : np.searchsorted(hashes, hashes[entry], "right")]

    def _front(self) -> np.ndarray:
        if not hasattr(self, "_bits"):
            self._bits = tx.front(self.prints)
        return self._bits


def _runs_at(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """run_hashes at the given starts only."""
    out = np.zeros(len(starts), np.uint64)
    for k in range(size):
        out = out * np.uint64(0xFF51AFD7ED558CCD) + words[starts + k]
        out ^= out >> np.uint64(29)
    return tx.mix(out)


def _scan(index: Index, keep: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, at in tx.slices(batch, "__text"):
                words, first = _words(data, at)
                starts, sizes, entries = index.find(words, first)
                row = np.searchsorted(first, starts, "right") - 1
                order = np.argsort(row, kind="stable")
                starts, sizes, entries, row = starts[order], sizes[order], entries[order], row[order]
                hits: list[list[int]] = [[] for _ in range(part.num_rows)]
                items: list[list[str]] = [[] for _ in range(part.num_rows)]
                edges = np.flatnonzero(np.diff(row, prepend=-1, append=-1))
                for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                    r = row[lo]
                    hits[r] = (np.unique(tx.ranges(starts[lo:hi], sizes[lo:hi])) - first[r]).tolist()
                    met = np.unique(np.stack([sizes[lo:hi], entries[lo:hi]], 1), axis=0)
                    items[r] = sorted({index.ids[o] for n, e in met.tolist() for o in index.owners(n, e)})
                yield pa.RecordBatch.from_arrays([*[part.column(k) for k in range(keep)], pa.array(np.diff(first).astype(np.int64)), pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))], names=names)

    return run


def find_benchmark(docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), item: str = "item_id", item_text: str = "text", window: int = WINDOW, gram: int = GRAM, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``keep`` columns of each row of ``docs``, n_words, hit_words (positions of the words in an occurring window) and items.

    A word is a run of ASCII letters and digits and all non-ASCII, A-Z lowered.
    A window is ``window`` following words of an item; an item of fewer, but not
    none, is one window. Null and empty texts have no words; items without words
    or id never occur. Equality is that of 64-bit hashes of whole windows.

    The benchmark is a stated set that is small beside the corpus. Its size is
    counted first: up to ``block_words`` words its index (8 bytes a word and
    fingerprint) goes to every task; beyond, it goes through in blocks of items,
    each read against all rows, and the hits of a text are united. Texts of any
    length are read whole, repeated rows get equal results, and an empty table
    gives no rows. Columns of ``keep`` called like one of the results are
    replaced, other columns go.
    """
    items = benchmark.select(F.col(item).cast("string").alias("id"), F.col(item_text).cast("string").alias("text")).filter("id IS NOT NULL AND text IS NOT NULL")
    n = items.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0
    blocks = int(n // block_words) + 1
    keep = tuple(k for k in keep if k not in ("n_words", "hit_words", "items"))
    source = docs.select(*[F.col(f"`{k}`") for k in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    found = "n_words long, hit_words array<int>, items array<string>"

    def scan(rows: DataFrame, block: DataFrame) -> DataFrame:
        stated = block.collect()
        index = Index([r.id for r in stated], [r.text for r in stated], window, gram)
        held = rows.schema.fields[:-1]
        return rows.mapInArrow(_scan(index, len(held), [*[f.name for f in held], "n_words", "hit_words", "items"]), ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in held], found]))

    if blocks == 1:
        return scan(source, items)
    # Hits depend on the text alone, so blocks meet again by its digest; only texts with a hit are sent.
    named = source.select(*[F.col(f"`{k}`") for k in keep], F.sha2(F.coalesce("__text", F.lit("")), 256).alias("__digest"), "__text")
    block = [items.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b) for b in range(blocks)]
    first = scan(named, block[0])
    more = None
    for b in block[1:]:
        got = scan(named.select("__digest", "__text"), b).filter(F.size("hit_words") > 0).drop("n_words")
        more = got if more is None else more.unionByName(got)
    each = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(f"__{c}")
    others = more.groupBy(F.col("__digest").alias("__other")).agg(each("hit_words"), each("items"))
    both = first.join(others, F.col("__digest") == F.col("__other"), "left")
    united = lambda c: F.when(F.col(f"__{c}").isNull(), F.col(c)).otherwise(F.array_sort(F.array_union(c, f"__{c}"))).alias(c)
    return both.select(*[F.col(f"`{k}`") for k in keep], "n_words", united("hit_words"), united("items"))
