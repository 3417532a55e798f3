"""Vectorised reading of text columns for the Arrow-backed operators.

Works on the UTF-8 bytes of an Arrow string array as they are: a batch is one
byte buffer and row offsets, words are runs of bytes of a class, and a word's
hash is taken from a running polynomial sum. All arrays are bounded by the
bytes handled at once (``slices``), never by the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Rows are handled in slices of about so many bytes; a longer single text is a slice of its own.
SLICE_BYTES = 4 << 20
#: Hashing walks a slice in pieces of about so many bytes.
PIECE_BYTES = 1 << 20

_P = np.uint64(0x9E3779B97F4A7C15 | 1)


def _classes(spaces: bool) -> np.ndarray:
    table = np.ones(256, bool)
    if spaces:  # words are runs of anything but space and \t..\r
        table[[0x20, *range(0x09, 0x0E)]] = False
    else:  # words are runs of digits, letters and non-ASCII
        table[0x00:0x30] = table[0x3A:0x41] = table[0x5B:0x61] = table[0x7B:0x80] = False
    return table


#: Word bytes: everything but ASCII white space / only digits, letters and all non-ASCII.
BY_SPACE, BY_SIGN = _classes(True), _classes(False)
#: Lower-cases A-Z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(4)
def byte_values(lower: bool = True, seed: int = 1) -> np.ndarray:
    """A 64-bit value for each byte; A-Z share theirs with a-z where ``lower``."""
    values = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(2 * seed + 1) * _P)
    return values[LOWER] if lower else values


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^0..P^(n-1) and their inverses modulo 2^64."""
    if len(_powers[0]) < n:
        inverse = np.uint64(pow(int(_P), -1, 1 << 64))
        for k, base in enumerate((_P, inverse)):
            out = np.full(max(n, PIECE_BYTES * 2), base, np.uint64)
            out[0] = 1
            _powers[k] = np.multiply.accumulate(out)
    return _powers[0][:n], _powers[1][:n]


def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (one more than rows) of a string or binary array; null rows are empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def as_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows of a batch whose texts have about ``most`` bytes, with bytes and offsets."""
    data, at = string_parts(batch.column(batch.schema.get_field_index(column)))
    n, lo = batch.num_rows, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, "right")) - 1)
        hi = min(hi, n)
        yield batch.slice(lo, hi - lo), data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def word_bounds(data: np.ndarray, at: np.ndarray, kind: np.ndarray = BY_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in ``data``, and for each row (offsets ``at``) the index of its first word (one more than rows)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(at), np.int64)
    inside = kind[data]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    edges = at[1:-1]
    edges = edges[edges < len(data)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, at)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans are in order and don't overlap."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        first = starts[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, first + PIECE_BYTES, "right")))
        piece = data[first : ends[hi - 1]]
        up, down = powers(len(piece) + 1)
        sums = np.empty(len(piece) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values[piece] * up[: len(piece)], out=sums[1:])
        s, e = starts[lo:hi] - first, ends[lo:hi] - first
        out[lo:hi] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        lo = hi
    return out


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` following words, from the words' hashes (runs over row ends included)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(0xFF51AFD7ED558CCD) + words[k : k + n]
        out ^= out >> np.uint64(29)
    return mix(out)


def row_of(first: np.ndarray) -> np.ndarray:
    """For each word the row that it is in, from ``first`` of word_bounds."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start+1, ... for each start, ``length`` of them, one after another."""
    if not len(lengths) or not (total := int(lengths.sum())):
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)


def member(hashes: np.ndarray, sorted_set: np.ndarray, bits: np.ndarray | None = None) -> np.ndarray:
    """Positions in ``hashes`` whose value is in ``sorted_set``; ``bits`` from ``front`` rules most out first."""
    if not len(sorted_set) or not len(hashes):
        return np.zeros(0, np.int64)
    maybe = np.arange(len(hashes)) if bits is None else np.flatnonzero(bits[(hashes & np.uint64(len(bits) - 1)).astype(np.int64)])
    near = np.searchsorted(sorted_set, hashes[maybe])
    near[near == len(sorted_set)] = 0
    return maybe[sorted_set[near] == hashes[maybe]]


def front(values: np.ndarray) -> np.ndarray:
    """A table of low hash bits that occur, to be asked before the sorted set."""
    bits = np.zeros(1 << max(16, min(24, int(len(values)).bit_length() + 5)), bool)
    bits[(values & np.uint64(len(bits) - 1)).astype(np.int64)] = True
    return bits


def binary16(a: np.ndarray, b: np.ndarray) -> pa.Array:
    """Two columns of 64 bits as one binary column of 16 bytes."""
    both = np.empty((len(a), 2), ">u8")
    both[:, 0], both[:, 1] = a, b
    return pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(np.arange(len(a) + 1, dtype=np.int32) * 16), pa.py_buffer(both.tobytes())])
