"""Exact removal of repeated byte strings with a sparse suffix array sorted deep-shallow (Manzini and Ferragina, 2004).

Suffixes are not sorted all over the corpus. Winnowing gives every string of
``span`` bytes an anchor inside it that depends on the string alone, so equal
strings meet under the hash of their anchor, and anchors that occur once are
left behind. The suffixes that start in the reach of one anchor are sorted to
the depth of ``span``: by multikey quicksort on letters of 8 bytes to a shallow
depth, then, where long common prefixes remain, by blind tries that compare each
suffix with one leaf only. Neighbours that agree to the full depth are repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm import text as tx
from shelfspark.plans.lineage import cut

SPAN, GRAM = 200, 32
#: Letters of 8 bytes that the shallow phase sorts by.
SHALLOW = 2
#: Bytes of a text whose strings are anchored at once.
SEGMENT = 1 << 20
#: Texts whose facts one task writes.
TASK_ROWS = 25_000
#: Anchors with more occurrences are counted by digests of whole strings, spread over all tasks.
HOT = 4096
#: Suffixes sorted at once, about.
SORT_AT_ONCE = 500_000
#: Runs of repeats are broadcast to the last scan up to this many numbers; beyond, texts meet their runs by shuffle.
BROADCAST_NUMBERS = 1_000_000

_LOW = np.uint64((1 << 24) - 1)


def _prefix_sums(data: np.ndarray, seed: int) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(tx.byte_values(False, seed)[data] * tx.powers(len(data) + 1)[0][: len(data)], out=sums[1:])
    return sums


def rolling(data: np.ndarray, size: int, seed: int = 11) -> np.ndarray:
    """A 64-bit hash of each string of ``size`` bytes."""
    if len(data) < size:
        return np.zeros(0, np.uint64)
    sums = _prefix_sums(data, seed)
    return tx.mix((sums[size:] - sums[:-size]) * tx.powers(len(data) + 1)[1][: len(data) - size + 1])


def anchors(data: np.ndarray, at: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """Row, anchor hash, anchor position, first and last-plus-one start of the strings that it anchors (positions in ``data``).

    The anchor of a string is the leftmost of its grams with the least hash;
    strings cross no row end, and each string's start is in exactly one interval.
    """
    hashes = rolling(data, gram)
    lengths = np.maximum(0, np.diff(at) - span + 1)
    starts = tx.ranges(at[:-1], lengths)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 5
    packed = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
    wide, reach = span - gram + 1, 1
    while reach * 2 <= wide:
        packed = np.minimum(packed[:-reach], packed[reach:])
        reach *= 2
    if rest := wide - reach:
        packed = np.minimum(packed[:-rest], packed[rest:])
    where = (packed[starts] & _LOW).astype(np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    new = np.ones(len(starts), bool)
    new[1:] = (where[1:] != where[:-1]) | (rows[1:] != rows[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return rows[first], hashes[where[first]], where[first], starts[first], starts[last] + 1


def _segments(batch: pa.RecordBatch, span: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, offsets, rows of the batch and where in its text each piece begins; long texts come in overlapping pieces."""
    done = 0
    for part, data, at in tx.slices(batch, "text", SEGMENT):
        if part.num_rows == 1 and len(data) > 2 * SEGMENT:
            for lo in range(0, len(data), SEGMENT):
                piece = data[lo : lo + SEGMENT + span - 1]
                yield piece, np.array([0, len(piece)]), np.array([done]), np.array([lo])
        else:
            yield data, at, done + np.arange(part.num_rows), np.zeros(part.num_rows, np.int64)
        done += part.num_rows


_FOUND = pa.schema([("anchor", pa.int64()), ("occurrence", pa.int64()), ("ref", pa.int64()), ("pos", pa.int64()), ("begin", pa.int64()), ("stop", pa.int64())])


def _anchor_rows(span: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            refs = batch.column(0).to_numpy()
            fresh = np.zeros(len(refs), bool)
            for k, r in enumerate(refs.tolist()):
                fresh[k] = r not in seen
                seen.add(r)
            for data, at, rows, base in _segments(batch, span):
                row, anchor, pos, begin, stop = anchors(data, at, span, gram)
                keep = fresh[rows[row]]
                row, anchor, pos, begin, stop = (x[keep] for x in (row, anchor, pos, begin, stop))
                shift, ref = base[row] - at[row], refs[rows[row]]
                pos, begin, stop = pos + shift, begin + shift, stop + shift
                occurrence = tx.mix(ref.view(np.uint64) ^ (pos.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(occurrence.view(np.int64)), pa.array(ref), pa.array(pos), pa.array(begin), pa.array(stop)], schema=_FOUND)

    return run


def _contexts(span: int):
    """Rows (ref, text, list of anchors) -> the bytes of all strings that an anchor reaches, once per text with all their begins."""
    schema = pa.schema([("anchor", pa.int64()), ("hot", pa.bool_()), ("ref", pa.int64()), ("ahead", pa.int64()), ("begins", pa.list_(pa.int64())), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, at in tx.slices(batch, "text"):
                lists = tx.as_array(part.column(2))
                flat, rows = lists.flatten(), np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
                get = lambda name, flat=flat: flat.field(name).to_numpy(zero_copy_only=False)
                begin, stop, pos, anchor, hot = (get(k) for k in ("begin", "stop", "pos", "anchor", "hot"))
                fit = (begin >= 0) & (stop + span - 1 <= np.diff(at)[rows])
                begin, stop, pos, anchor, hot, rows = (x[fit] for x in (begin, stop, pos, anchor, hot, rows))
                lo, hi = at[rows] + begin, at[rows] + stop + span - 1
                inverse = tx.powers(len(data) + 1)[1]
                one, two = (tx.mix((sums[hi] - sums[lo]) * inverse[lo]) for sums in (_prefix_sums(data, 31), _prefix_sums(data, 32)))
                order = np.lexsort((begin, two, one, hi - lo, pos - begin, anchor, rows))
                new = np.ones(len(order), bool)
                same = np.ones(max(0, len(order) - 1), bool)
                for k in (two, one, hi - lo, pos - begin, anchor, rows):
                    same &= k[order][1:] == k[order][:-1]
                new[1:] = ~same
                first = np.flatnonzero(new)
                ends = np.append(first, len(order))
                sorted_begins = begin[order]
                for k in range(0, len(first), 20_000):
                    mine = order[first[k : k + 20_000]]
                    raw = data[tx.ranges(lo[mine], hi[mine] - lo[mine])]
                    offsets = np.concatenate([[0], np.cumsum(hi[mine] - lo[mine])]).astype(np.int32)
                    bytes_ = pa.Array.from_buffers(pa.binary(), len(mine), [None, pa.py_buffer(offsets), pa.py_buffer(raw.tobytes())])
                    edge = ends[k : k + len(mine) + 1]
                    begins = pa.ListArray.from_arrays(pa.array((edge - edge[0]).astype(np.int32)), pa.array(sorted_begins[edge[0] : edge[-1]]))
                    yield pa.RecordBatch.from_arrays([pa.array(anchor[mine]), pa.array(hot[mine]), pa.array(part.column(0).to_numpy()[rows[mine]]), pa.array(pos[mine] - begin[mine]), begins, bytes_], schema=schema)

    return run


def deep_shallow(data: np.ndarray, starts: np.ndarray, span: int, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings data[s : s + span] inside their groups, and for each a class that equal ones of a group share.

    ``data`` needs 8 bytes of padding. Every step works on all groups at once.
    Shallow: multikey quicksort; a group is parted by its next letter of 8 bytes,
    and what stands alone is done. Deep: a blind trie per remaining group; the
    first member is the leaf, the others branch off its path where they first
    differ, and members that branch at one place with one letter form the next
    group, to be sorted from there on.
    """
    word = np.zeros(len(data) - 7, np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | data[k : len(data) - 7 + k]
    letters = -(-span // 8)
    spare = np.uint64(8 * (8 * letters - span))

    def letter(at: np.ndarray, k) -> np.ndarray:
        got = word[np.minimum(at + 8 * k, len(word) - 1)]
        return np.where(np.asarray(k) == letters - 1, got >> spare, got) if spare else got

    # rank: place of the string's class in the order so far; equal ranks are one class.
    order = np.argsort(groups, kind="stable")
    rank = np.empty(len(starts), np.int64)
    sorted_groups = groups[order]
    heads = np.flatnonzero(np.concatenate([[True], sorted_groups[1:] != sorted_groups[:-1]])) if len(order) else np.zeros(0, np.int64)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, len(order))))

    def crowded(some: np.ndarray) -> np.ndarray:
        """Of some strings those whose rank another one shares."""
        values, back, counts = np.unique(rank[some], return_inverse=True, return_counts=True)
        return some[counts[back] > 1]

    def split(some: np.ndarray, keys: tuple[np.ndarray, ...]) -> None:
        """Give the members of each class new ranks by ``keys`` (most significant first), ties together."""
        by = np.lexsort((*keys[::-1], rank[some]))
        s, old = some[by], rank[some][by]
        first = np.flatnonzero(np.concatenate([[True], old[1:] != old[:-1]]))
        place = old + np.arange(len(s)) - np.repeat(first, np.diff(np.append(first, len(s))))
        new = np.concatenate([[True], old[1:] != old[:-1]])
        for k in keys:
            new[1:] |= k[by][1:] != k[by][:-1]
        head = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
        rank[s] = place[head]

    active = crowded(np.arange(len(starts)))
    for k in range(min(SHALLOW, letters)):
        if not len(active):
            break
        split(active, (letter(starts[active], k),))
        active = crowded(active)
    depth = np.full(len(starts), min(SHALLOW, letters))
    while len(active):
        by = active[np.argsort(rank[active], kind="stable")]
        head = np.flatnonzero(np.concatenate([[True], rank[by][1:] != rank[by][:-1]]))
        leaf = np.repeat(by[head], np.diff(np.append(head, len(by))))
        branch = np.full(len(by), letters)
        going = np.arange(len(by))
        for k in range(int(depth[by].min()), letters):
            mine = going[depth[by[going]] <= k]
            differ = mine[letter(starts[by[mine]], k) != letter(starts[leaf[mine]], k)]
            branch[differ] = k
            going = going[branch[going] == letters]
            if not len(going):
                break
        own, other = letter(starts[by], np.minimum(branch, letters - 1)), letter(starts[leaf], np.minimum(branch, letters - 1))
        whole = branch == letters
        side = np.where(whole, 1, np.where(own < other, 0, 2))
        # Below the leaf's path: shallow branches first; above it: deep branches first.
        split(by, (side, np.where(side == 0, branch, letters - branch), np.where(whole, 0, own)))
        depth[by] = branch + 1
        active = crowded(by[~whole]) if (~whole).any() else by[:0]
    return np.argsort(rank, kind="stable"), rank


def repeated_starts(data: np.ndarray, offsets: np.ndarray, ahead: np.ndarray, group: np.ndarray, span: int) -> np.ndarray:
    """For every string start of the given contexts (in turn): does the string occur under the same anchor again?"""
    counts = np.diff(offsets) - span + 1
    starts = tx.ranges(offsets[:-1], counts)
    which = np.repeat(np.arange(len(counts)), counts)
    to_anchor = ahead[which] - (starts - offsets[:-1][which])
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    _, rank = deep_shallow(padded, starts, span, group[which] * 1024 + to_anchor)
    _, back, times = np.unique(rank, return_inverse=True, return_counts=True)
    return times[back] > 1


def runs_of(flags: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True inside consecutive blocks of ``counts`` flags: block, first and last-plus-one place in it."""
    block = np.repeat(np.arange(len(counts)), counts)
    place = tx.ranges(np.zeros(len(counts), np.int64), counts)
    begins = flags.copy()
    begins[1:] &= ~(flags[:-1] & (block[1:] == block[:-1]))
    ends = flags.copy()
    ends[:-1] &= ~(flags[1:] & (block[1:] == block[:-1]))
    return block[begins], place[begins], place[ends] + 1


_RUNS = pa.schema([("ref", pa.int64()), ("begins", pa.list_(pa.int64())), ("los", pa.list_(pa.int64())), ("his", pa.list_(pa.int64()))])


def _sort_groups(span: int):
    """Contexts sorted by anchor -> per context its runs of repeated bytes, from each of its begins on."""

    def solve(batch: pa.RecordBatch) -> pa.RecordBatch:
        anchor, ref, ahead = (batch.column(k).to_numpy() for k in range(3))
        lists = tx.as_array(batch.column(3))
        at = lists.offsets.to_numpy()
        begin, times = lists.values.to_numpy()[at[:-1]], np.diff(at)
        data, offsets = tx.string_parts(tx.as_array(batch.column(4)))
        order = np.lexsort((ahead, begin, ref, anchor))
        same = np.zeros(len(order), bool)  # an occurrence that came twice counts once
        same[1:] = (anchor[order][1:] == anchor[order][:-1]) & (ref[order][1:] == ref[order][:-1]) & (begin[order][1:] == begin[order][:-1]) & (ahead[order][1:] == ahead[order][:-1])
        keep = np.sort(order[~same])
        lengths = np.diff(offsets)[keep]
        data = data[tx.ranges(offsets[keep], lengths)]
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        _, group = np.unique(anchor[keep], return_inverse=True)
        counts = lengths - span + 1
        flags = repeated_starts(data, offsets, ahead[keep], group, span) | np.repeat(times[keep] > 1, counts)
        block, lo, hi = runs_of(flags, counts)
        some, edge = np.unique(block, return_index=True)
        edge = pa.array(np.append(edge, len(block)).astype(np.int32))
        mine = pa.array(keep[some])
        return pa.RecordBatch.from_arrays([batch.column(1).take(mine), lists.take(mine), pa.ListArray.from_arrays(edge, pa.array(lo.astype(np.int64))), pa.ListArray.from_arrays(edge, pa.array((hi - 1 + span).astype(np.int64)))], schema=_RUNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += int(tx.string_parts(batch.column(4))[1][-1])
            if size > 3 * SORT_AT_ONCE:
                whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                anchor = whole.column(0).to_numpy()
                # Groups that may go on in the next batch wait; the others are sorted in shares.
                last = int(np.searchsorted(anchor, anchor[-1]))
                yield from shares(whole.slice(0, last))
                rest = whole.slice(last)
                held, size = [rest], 0
        if held:
            yield from shares(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    def shares(whole: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not whole.num_rows:
            return
        anchor = whole.column(0).to_numpy()
        _, offsets = tx.string_parts(tx.as_array(whole.column(4)))
        strings = np.cumsum(np.diff(offsets) - span + 1)
        lo = 0
        while lo < len(anchor):
            hi = int(np.searchsorted(strings, (strings[lo - 1] if lo else 0) + SORT_AT_ONCE, "right"))
            hi = max(hi, lo + 1)
            if hi < len(anchor):
                edge = int(np.searchsorted(anchor, anchor[hi]))
                hi = edge if edge > lo else int(np.searchsorted(anchor, anchor[lo], "right"))
            yield solve(whole.slice(lo, hi - lo))
            lo = hi

    return run


def _string_digests(span: int):
    """Distinct contexts of hot anchors -> (w1, w2, context, place): 128 bits of each string."""
    schema = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("context", pa.int64()), ("place", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, at in tx.slices(batch, "bytes", 1 << 18):
                counts = np.diff(at) - span + 1
                starts = tx.ranges(at[:-1], counts)
                which = np.repeat(np.arange(len(counts)), counts)
                one, two = rolling(data, span, 21)[starts], rolling(data, span, 22)[starts]
                context = part.column(0).to_numpy()[which]
                yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(context), pa.array(starts - at[:-1][which])], schema=schema)

    return run


def _hot_runs(hot: DataFrame, span: int) -> DataFrame:
    """Runs of repeated bytes under hot anchors: equal contexts meet first, then the strings of different ones."""
    named = hot.withColumn("context", F.xxhash64("anchor", "ahead", "bytes")).withColumn("occurrence", F.xxhash64("ref", F.col("begins")[0]))
    strings = (F.octet_length("bytes") - (span - 1)).cast("long")
    facts = named.groupBy("context").agg(F.min("occurrence").alias("o1"), F.max("occurrence").alias("o2"), F.max(F.size("begins")).alias("times"))
    seen = named.groupBy("context").agg(F.min("bytes").alias("bytes"))
    digests = seen.mapInArrow(_string_digests(span), "w1 long, w2 long, context long, place long")
    met = digests.groupBy("w1", "w2").agg(F.min("context").alias("c1"), F.max("context").alias("c2"), F.min("place").alias("p1"), F.max("place").alias("p2")).filter("c1 <> c2 OR p1 <> p2").select(F.col("w1").alias("x1"), F.col("w2").alias("x2"))
    places = digests.join(met, (F.col("w1") == F.col("x1")) & (F.col("w2") == F.col("x2"))).groupBy("context").agg(F.array_sort(F.collect_set("place")).alias("places"))
    whole = facts.filter("o1 <> o2 OR times > 1").select(F.col("context").alias("c"))
    full = named.join(whole, F.col("context") == F.col("c")).select("ref", "begins", F.array(F.lit(0).cast("long")).alias("los"), F.array(strings - 1 + span).alias("his"))
    part = named.join(whole, F.col("context") == F.col("c"), "left_anti").join(places.withColumnRenamed("context", "c"), F.col("context") == F.col("c"))
    return full.unionByName(part.select("ref", "begins", F.col("places").alias("los"), F.transform("places", lambda p: p + span).alias("his")))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of a list of (begin, stop); runs that touch are one."""
    out: list[list[int]] = []
    for begin, stop in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([begin, stop])
    return [(a, b) for a, b in out]


def _remove(keep: int, span: int, with_kept: bool = True):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, at in tx.slices(batch, "text"):
                copied, runs = part.column(keep).to_pylist(), part.column(keep + 1)
                n, removed, left_over, shas = [], [], [], []
                for k in range(part.num_rows):
                    raw = data[at[k] : at[k + 1]]
                    if copied[k] and len(raw) >= span:
                        cuts = [(0, len(raw))]
                    else:
                        got = runs[k].as_py()
                        cuts = merged([(b + lo, b + hi) for r in got for b in r["begins"] for lo, hi in zip(r["los"], r["his"], strict=True)]) if got else []
                    edges = [0, *[x for c in cuts for x in c], len(raw)]
                    left = b"".join(raw[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2], strict=True))
                    n.append(len(raw))
                    removed.append([{"begin": a, "stop": b} for a, b in cuts])
                    left_over.append(left if with_kept else None)
                    shas.append(hashlib.sha256(left).hexdigest())
                yield pa.RecordBatch.from_arrays([*[part.column(k) for k in range(keep)], pa.array(n, pa.int64()), pa.array(removed, pa.list_(pa.struct([("begin", pa.int64()), ("stop", pa.int64())]))), pa.array(left_over, pa.binary()), pa.array(shas, pa.string())], names=[*part.schema.names[:keep], "n_bytes", "removed", "kept", "kept_sha256"])

    return run


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, text: str = "text", keep: tuple[str, ...] = ("doc_id",), hot: int = HOT, with_kept: bool = True) -> DataFrame:
    """``keep`` columns of each row, n_bytes, removed (maximal runs of bytes), kept (bytes left) and kept_sha256.

    Removed is every byte covered by a string of ``span`` bytes that starts
    anywhere else as well, in the same text or another; strings are judged on
    the input and cross no text. Null texts are empty. A text that occurs twice
    or more is removed whole if it has ``span`` bytes. Kept bytes can end inside
    a UTF-8 character, as strings are bytes.

    Equal texts are known by 128 bits; strings under
    anchors of up to ``hot`` occurrences are compared byte by byte, under hotter
    ones by 128 bits, as those are spread over all tasks. Without ``with_kept``
    the bytes left are null, their hash is given all the same. Texts of any
    length are read whole, repeated rows get equal results, and an empty table
    gives no rows. Columns of ``keep`` called like one of the results are
    replaced, other columns go.
    """
    if not gram < span <= 1000:
        raise ValueError("gram < span <= 1000 is needed")
    keep = tuple(k for k in keep if k not in ("n_bytes", "removed", "kept", "kept_sha256"))
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    source = docs.select(*[F.col(f"`{k}`") for k in keep], body.alias("text")).withColumn("ref", F.xxhash64("text", F.octet_length("text")))
    row_key = F.unhex(F.md5(F.concat_ws(":", F.col("ref").cast("string"), *[F.col(f"`{k}`").cast("string") for k in keep[:1]])))

    tasks = 8 + docs.count() // TASK_ROWS

    def known(rows: DataFrame) -> DataFrame:
        # Few files for few rows: a table of facts is written by so many tasks as its rows need.
        return rows.select("ref", row_key.alias("row_key"), F.octet_length("text").alias("size"), F.md5("text").alias("digest")).groupBy("ref").agg(F.count(F.lit(1)).alias("copies"), F.min("row_key").alias("row_key"), F.max("size").alias("size"), F.min("digest").alias("d1"), F.max("digest").alias("d2")).coalesce(tasks)

    texts = cut(known(source), "repeats-texts")
    # Different texts under one 64-bit name are few, if any; they get names from their 128-bit digest.
    odd = texts.filter("d1 <> d2").select(F.col("ref").alias("odd"))
    if odd.limit(1).count():
        source = source.join(odd, F.col("ref") == F.col("odd"), "left").withColumn("ref", F.when(F.col("odd").isNull(), F.col("ref")).otherwise(F.xxhash64(F.lit("again"), F.md5("text")))).drop("odd")
        texts = cut(known(source), "repeats-texts")

    found = source.select("ref", "text").filter(F.octet_length("text") >= span).mapInArrow(_anchor_rows(span, gram), "anchor long, occurrence long, ref long, pos long, begin long, stop long")
    repeated = cut(found.select("anchor", "occurrence").groupBy("anchor").agg(F.min("occurrence").alias("o1"), F.max("occurrence").alias("o2"), F.count(F.lit(1)).alias("n")).filter("o1 <> o2").select(F.col("anchor").alias("again"), (F.col("n") > hot).alias("hot")).coalesce(tasks), "repeats-anchors")
    mine = found.select("anchor", "ref", "pos", "begin", "stop").join(repeated, F.col("anchor") == F.col("again"))
    lists = mine.groupBy("ref").agg(F.collect_list(F.struct("anchor", "hot", "pos", "begin", "stop")).alias("anchors"))
    wanted = lists.join(texts.select(F.col("ref").alias("r"), "row_key"), F.col("ref") == F.col("r")).select(F.col("row_key").alias("k"), "anchors").hint("shuffle_hash")
    located = source.select("ref", "text", row_key.alias("row_key")).filter(F.octet_length("text") >= span).join(wanted, F.col("row_key") == F.col("k")).select("ref", "text", "anchors")
    contexts = cut(located.mapInArrow(_contexts(span), "anchor long, hot boolean, ref long, ahead long, begins array<long>, bytes binary"), "repeats-contexts")

    cold = contexts.filter("NOT hot").select("anchor", "ref", "ahead", "begins", "bytes").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_sort_groups(span), "ref long, begins array<long>, los array<long>, his array<long>")
    runs = cold.unionByName(_hot_runs(contexts.filter("hot"), span))
    per_text = runs.groupBy("ref").agg(F.collect_list(F.struct("begins", "los", "his")).alias("runs"))
    facts = texts.filter(F.col("copies") > 1).select(F.col("ref").alias("r"), F.lit(True).alias("copied"))
    per_text = cut(per_text.join(facts, F.col("ref") == F.col("r"), "full").select(F.coalesce("ref", "r").alias("r"), F.coalesce("copied", F.lit(False)).alias("copied"), F.when(F.col("copied"), None).otherwise(F.col("runs")).alias("runs")).coalesce(tasks), "repeats-runs")
    side = per_text
    numbers = F.coalesce(F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + F.size(r["begins"]) + 2 * F.size(r["los"])), F.lit(0).cast("long")) + 1
    if (per_text.agg(F.sum(numbers)).first()[0] or 0) <= BROADCAST_NUMBERS:
        side = F.broadcast(per_text)
    joined = source.join(side, F.col("ref") == F.col("r"), "left").select(*[F.col(f"`{k}`") for k in keep], F.coalesce("copied", F.lit(False)).alias("copied"), "runs", "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields[: len(keep)])
    return joined.mapInArrow(_remove(len(keep), span, with_kept), ", ".join([*([schema] if schema else []), "n_bytes long, removed array<struct<begin:bigint,stop:bigint>>, kept binary, kept_sha256 string"]))
