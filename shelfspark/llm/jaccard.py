"""Exact set-similarity self-join on word shingles by T-occurrence search (DivideSkip: Li, Lu and Lu, 2008).

1. Each text becomes its set of shingle hashes; equal sets are one class. The
   same pass counts shingles: hashes go to 2^32 cells, each task sends the cells
   of its sets as sorted 16-bit offsets, and each range of cells is added up on
   its own. The most frequent cells come last in the order of prefixes.
2. Classes that link share at least ``common`` shingles among the first
   n - ceil(t n) + common of each. A short list of postings gives its pairs,
   which are counted; in a long one every class is tied to the head of its run
   of fitting sizes, already where it is read, so ties never outgrow postings.
   Both bring classes together in coarse groups.
3. Inside a group, in cells of bounded size, each class looks up its inverted
   lists: the short ones are heap-merged with skips, the long ones are probed by
   binary search for what the merge left, and classes that reach the required
   overlap are links.
4. Links are counted; their spanning edges give the components.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm import text as tx
from shelfspark.llm.components import FILE_EDGES, components
from shelfspark.plans.lineage import cut

#: Cells that come last in the order of prefixes, at most: what is broadcast. Only the order depends on them, never the result.
FREQUENT = 1 << 22
#: Sets that hold a cell before it counts as frequent.
LEAST_FREQUENT = 20
#: Ranges into which the 2^32 cells are dealt for counting; 2^20 cells each.
RANGES = 1 << 12
#: Cells that a task sorts, or that are added up, at once.
CELLS = 1 << 22
#: Shingles that two linked sets share in their prefixes at least (fewer where the smaller one's overlap is less).
COMMON = 4
#: Postings lists of up to so many classes give their pairs.
SHORT = 64
#: Shingles of a block; a cell holds two blocks at most.
BLOCK = 1 << 18
#: Row keys of classes to be fetched are broadcast up to this many; beyond, texts meet them by shuffle.
BROADCAST_KEYS = 1_000_000


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each row, one after another, and row offsets into them."""
    starts, ends, first = tx.word_bounds(data, at)
    words = tx.span_hashes(data, starts, ends, tx.byte_values(True))
    runs = tx.run_hashes(words, size)
    sets: list[np.ndarray] = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            s = np.sort(runs[a : b - size + 1])
            new = np.empty(len(s), bool)
            new[0] = True
            np.not_equal(s[1:], s[:-1], out=new[1:])
            sets.append(s[new])
        else:
            sets.append(tx.run_hashes(words[a:b], b - a) if b > a else words[:0])
    lengths = np.fromiter(map(len, sets), np.int64, len(sets))
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(lengths)])


def _sums(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]


def set_digests(shingles: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits per set, the same for equal sets."""
    return tx.mix(_sums(tx.mix(shingles ^ np.uint64(0xA5A5A5A55A5A5A5A)), at)), tx.mix(_sums(tx.mix(shingles + np.uint64(0x632BE59BD9B4E019)), at))


def _new_sets(node: np.ndarray, n: np.ndarray, seen: set[int]) -> np.ndarray:
    """Which rows hold a set, not empty, that this task has not met before."""
    new = np.zeros(len(n), bool)
    for k, c in enumerate(node.tolist()):
        new[k] = n[k] > 0 and c not in seen
        seen.add(c)
    return new


def pack_cells(cells: np.ndarray) -> list[tuple[int, bytes]]:
    """(range, sixteen counts and the low 16 bits of its cells) for each range that has any."""
    cells = np.sort(cells)
    low = (cells & np.uint32(0xFFFF)).astype(np.uint16)
    counts = np.bincount((cells >> np.uint32(16)).astype(np.int64), minlength=RANGES * 16).astype(np.uint32).reshape(RANGES, 16)
    ends = np.cumsum(counts.sum(1, dtype=np.int64))
    return [(r, counts[r].tobytes() + low[end - total : end].tobytes()) for r, (end, total) in enumerate(zip(ends.tolist(), counts.sum(1, dtype=np.int64).tolist(), strict=True)) if total]


def unpack_cells(packed: bytes) -> np.ndarray:
    """The cells of one range, by their place in it."""
    return (np.repeat(np.arange(16, dtype=np.int64), np.frombuffer(packed, np.uint32, 16)) << 16) + np.frombuffer(packed, np.uint16, offset=64)


def _signatures(size: int, schema: pa.Schema):
    """Per row its class; per task and range of cells, the cells of its sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()

        def flush() -> pa.RecordBatch:
            packed = pack_cells(np.concatenate(held))
            held.clear()
            none = [pa.nulls(len(packed), f.type) for f in schema]
            return pa.RecordBatch.from_arrays([pa.array([r for r, _ in packed], pa.int32()), *none[1:5], pa.array([b for _, b in packed], pa.binary())], schema=schema)

        for batch in batches:
            for part, data, at in tx.slices(batch, "text"):
                shingles, offsets = shingle_sets(data, at, size)
                n = np.diff(offsets)
                one, two = set_digests(shingles, offsets)
                yield pa.RecordBatch.from_arrays([pa.array((one % np.uint64(RANGES)).astype(np.int32)), part.column(0).cast(schema.field(1).type), part.column(1), pa.array(n), tx.binary16(one, two), pa.nulls(len(n), pa.binary())], schema=schema)
                new = _new_sets(one, n, seen)
                if new.any():
                    held.append((shingles[np.repeat(new, n)] >> np.uint64(32)).astype(np.uint32))
                if sum(map(len, held)) > CELLS:
                    yield flush()
        if held:
            yield flush()

    return run


def _add_cells(schema: pa.Schema):
    """Rows sorted by range: those of texts go on as they are, cells are counted, and frequent ones come out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, dense = None, [], None

        def add() -> np.ndarray:
            counts = np.bincount(np.concatenate(held), minlength=1 << 20) if held else np.zeros(1 << 20, np.int64)
            held.clear()
            return counts if dense is None else dense + counts

        def done() -> pa.RecordBatch:
            if dense is None and sum(map(len, held)) < 1 << 18:
                cells, times = np.unique(np.concatenate(held), return_counts=True)
                held.clear()
            else:
                times = add()
                cells = np.arange(1 << 20)
            often = times >= LEAST_FREQUENT
            level = np.minimum(8 * np.log2(times[often]), 255).astype(np.int32)
            none = [pa.nulls(len(level), f.type) for f in schema]
            return pa.RecordBatch.from_arrays([*none[:4], pa.array(cells[often] + (at << 20), pa.int64()), pa.array(level)], schema=schema)

        for batch in batches:
            texts = batch.column(5).is_null()
            some = batch.filter(texts)
            if some.num_rows:
                yield pa.RecordBatch.from_arrays([*some.columns[1:5], pa.nulls(some.num_rows, pa.int64()), pa.nulls(some.num_rows, pa.int32())], schema=schema)
            counted = batch.filter(pc.invert(texts))
            for r, packed in zip(counted.column(0).to_pylist(), counted.column(5), strict=True):
                if r != at:
                    if at is not None:
                        yield done()
                    at, dense = r, None
                held.append(unpack_cells(packed.as_py()))
                if sum(map(len, held)) > CELLS:
                    dense = add()
        if at is not None:
            yield done()

    return run


def frequent_cells(counted: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """The sorted cells of the highest levels, ``most`` at most, and their levels, from rows (cell, level)."""
    levels = sorted(((r["level"], r["n"]) for r in counted.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    least, total = 256, 0
    for level, n in levels:
        if (total := total + n) > most:
            break
        least = level
    got = counted.filter(F.col("level") >= least).select("cell", "level").toPandas()
    order = np.argsort(got["cell"].to_numpy(np.int64))
    return got["cell"].to_numpy(np.int64)[order].astype(np.uint64), got["level"].to_numpy(np.int64)[order].astype(np.uint8)


def least_overlap(n, percent: int):
    """The fewest common shingles of a set of n with any set it links to."""
    return (percent * n + 99) // 100


def common_in_prefixes(n, percent: int):
    """How many shingles a set of n shares, within prefixes, with any set it links to."""
    return np.minimum(COMMON, least_overlap(n, percent))


def span_of(lo: np.ndarray, hi: np.ndarray, run: np.ndarray | int) -> np.ndarray:
    """Sizes lo to hi in one number that sorts by lo; ``run`` is 1 where it stands for classes tied already."""
    return (lo.astype(np.int64) << 32) | (hi.astype(np.int64) << 1) | run


def gather(shingle: np.ndarray, node: np.ndarray, span: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """Postings sorted by shingle and span -> (a, b) ties, and postings in which each long list is a few runs.

    A list is long if it has more than SHORT postings, or a run. Sorted by
    size, it falls into runs within which each class fits some before it; all of
    a run are tied to its first, so two classes that fit are never parted.
    """
    new = np.concatenate([[True], shingle[1:] != shingle[:-1]]) if len(shingle) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    length = np.diff(np.append(head, len(shingle)))
    runs = np.add.reduceat(span & 1, head) if len(head) else head
    long = np.repeat((length > SHORT) | (runs > 0), length)
    if not long.any():
        return node[:0], node[:0], shingle, node, span
    s, v, p, first = shingle[long], node[long], span[long], new[long]
    lo, hi = p >> 32, (p & 0xFFFFFFFF) >> 1
    which = np.cumsum(first)
    reach = np.maximum.accumulate((which << 32) | hi) & 0xFFFFFFFF
    apart = first.copy()
    apart[1:] |= 100 * reach[:-1] < percent * lo[1:]
    begin = np.flatnonzero(apart)
    heads = np.repeat(begin, np.diff(np.append(begin, len(s))))
    tie = (v != v[heads])
    last = np.append(begin[1:], len(s)) - 1
    runs = span_of(lo[begin], reach[last], 1)
    keep = ~long
    return v[tie], v[heads][tie], np.concatenate([shingle[keep], s[begin]]), np.concatenate([node[keep], v[begin]]), np.concatenate([span[keep], runs])


_POSTINGS = ["shingle", "node", "span"]


def _rows_of(columns: tuple[np.ndarray, ...], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _prefixes(size: int, percent: int, cells: np.ndarray, levels: np.ndarray):
    """Postings (shingle, node, span) of each class's prefix, long lists gathered to runs; their ties as (a, b, -1)."""

    def order_of(shingles: np.ndarray, offsets: np.ndarray, bits: np.ndarray) -> np.ndarray:
        cell = shingles >> np.uint64(32)
        known = tx.member(cell, cells, bits)
        rank = np.zeros(len(shingles), np.uint8)
        rank[known] = levels[np.searchsorted(cells, cell[known])]
        order = np.arange(len(shingles))
        for r in np.unique(np.searchsorted(offsets, known, "right") - 1).tolist():
            lo, hi = offsets[r], offsets[r + 1]
            order[lo:hi] = lo + np.argsort(rank[lo:hi], kind="stable")
        return order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = tx.front(cells)
        seen: set[int] = set()
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            shingle, node, span = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((span, shingle))
            a, b, *rest = gather(shingle[order], node[order], span[order], percent)
            if len(a):
                a, b = np.unique(np.stack([a, b], 1), axis=0).T
                yield _rows_of((a.copy(), b.copy(), np.full(len(a), -1, np.int64)), _POSTINGS)
            for k in range(0, len(rest[0]), 1 << 18):
                yield _rows_of(tuple(c[k : k + (1 << 18)] for c in rest), _POSTINGS)

        for batch in batches:
            for _, data, at in tx.slices(batch, "text"):
                shingles, offsets = shingle_sets(data, at, size)
                n = np.diff(offsets)
                node = set_digests(shingles, offsets)[0].view(np.int64)
                take = np.where(_new_sets(node, n, seen), n - least_overlap(n, percent) + common_in_prefixes(n, percent), 0)
                chosen = order_of(shingles, offsets, bits)[tx.ranges(offsets[:-1], take)]
                rows = np.repeat(np.arange(len(n)), take)
                if len(rows):
                    held.append((shingles[chosen].view(np.int64), node[rows], span_of(n[rows], n[rows], 0)))
                if sum(len(h[0]) for h in held) > CELLS:
                    yield from flush()
        if held:
            yield from flush()

    return run


def list_pairs(shingle: np.ndarray, node: np.ndarray, span: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """(a, b, times, least) of the pairs of fitting sizes in short lists, sorted by shingle and span, and how often they must meet."""
    head = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]])) if len(shingle) else np.zeros(0, np.int64)
    place = np.arange(len(shingle)) - np.repeat(head, np.diff(np.append(head, len(shingle))))
    n = span >> 32
    a, b = [], []
    mine = np.flatnonzero(place)
    for back in range(1, SHORT):
        mine = mine[place[mine] >= back]
        if not len(mine):
            break
        fit = mine[(100 * n[mine - back] >= percent * n[mine]) & (node[mine] != node[mine - back])]
        a.append(fit)
        b.append(fit - back)
    if not a:
        return node[:0], node[:0], node[:0], node[:0]
    a, b = np.concatenate(a), np.concatenate(b)
    least = common_in_prefixes(np.minimum(n[a], n[b]), percent)
    one, two = np.maximum(node[a], node[b]), np.minimum(node[a], node[b])
    order = np.lexsort((two, one))
    one, two, least = one[order], two[order], least[order]
    first = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])) if len(one) else np.zeros(0, np.int64)
    return one[first], two[first], np.diff(np.append(first, len(one))), least[first]


_TIES = ["a", "b", "times", "least"]


def _ties(percent: int):
    """Postings sorted by shingle and span -> ties (a, b, times 0, least 0) and pairs of short lists (a, b, times, least).

    A list that goes on in the next batch is held, gathered to runs as soon as it is long.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3

        def solve(whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            shingle, node, span = held
            told = span < 0
            ties = [(shingle[told], node[told])]
            shingle, node, span = shingle[~told], node[~told], span[~told]
            # A class that several tasks read is one posting.
            order = np.lexsort((node, span, shingle))
            shingle, node, span = shingle[order], node[order], span[order]
            again = np.zeros(len(shingle), bool)
            again[1:] = (shingle[1:] == shingle[:-1]) & (node[1:] == node[:-1]) & (span[1:] == span[:-1])
            a, b, shingle, node, span = gather(shingle[~again], node[~again], span[~again], percent)
            ties.append((a, b))
            order = np.lexsort((span, shingle))
            shingle, node, span = shingle[order], node[order], span[order]
            end = len(shingle) if whole or not len(shingle) else int(np.searchsorted(shingle, shingle[-1]))
            held = [c[end:] for c in (shingle, node, span)]
            short = (span[:end] & 1) == 0
            pairs = list_pairs(shingle[:end][short], node[:end][short], span[:end][short], percent)
            a, b = (np.concatenate([t[k] for t in ties]) for k in range(2))
            if len(a):
                a, b = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], 1), axis=0).T
                yield _rows_of((a.copy(), b.copy(), np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)), _TIES)
            if len(pairs[0]):
                yield _rows_of(pairs, _TIES)

        more: list[pa.RecordBatch] = []
        for batch in batches:
            more.append(batch)
            if sum(b.num_rows for b in more) > 200_000:
                held = [np.concatenate([held[k], *[b.column(k).to_numpy() for b in more]]) for k in range(3)]
                more = []
                yield from solve(False)
        held = [np.concatenate([held[k], *[b.column(k).to_numpy() for b in more]]) for k in range(3)]
        yield from solve(True)

    return run


def half_of(cls: Column) -> Column:
    """The node of a class: the first half of its digest as a number."""
    return F.conv(F.hex(F.substring(cls, 1, 8)), 16, -10).cast("long")


def _fetch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, at in tx.slices(batch, "text"):
                shingles, offsets = shingle_sets(data, at, size)
                sets = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(offsets * 8), pa.py_buffer(shingles.tobytes())])
                yield pa.RecordBatch.from_arrays([tx.binary16(*set_digests(shingles, offsets)), sets.cast(pa.binary())], names=["cls", "shingles"])

    return run


def merge_skip(lists: list[list[int]], least: int) -> list[tuple[int, int]]:
    """(value, count) of the values on at least ``least`` of the sorted lists, by a heap of their fronts.

    Where a value is on too few, the least - 1 smallest fronts jump to the next
    front by binary search: nothing they pass can reach ``least``.
    """
    at = [0] * len(lists)
    heap = [(x[0], k) for k, x in enumerate(lists) if x]
    heapq.heapify(heap)
    found = []
    while len(heap) >= least:
        value = heap[0][0]
        popped = []
        while heap and heap[0][0] == value:
            popped.append(heapq.heappop(heap)[1])
        if len(popped) >= least:
            found.append((value, len(popped)))
            to = value + 1
        else:
            while heap and len(popped) < least - 1:
                popped.append(heapq.heappop(heap)[1])
            if not heap:
                break
            to = max(value + 1, heap[0][0])
        for k in popped:
            x = lists[k]
            at[k] = at[k] + 1 if to == value + 1 and x[at[k]] == value else bisect_left(x, to, at[k])
            if at[k] < len(x):
                heapq.heappush(heap, (x[at[k]], k))
    return found


def t_occurrence(lists: list[np.ndarray], least: int, n_sets: int) -> tuple[np.ndarray, np.ndarray]:
    """Sets that are on at least ``least`` of the sorted lists, and on how many: DivideSkip.

    The longest lists, fewer than ``least`` of them, are set aside. The short
    ones are heap-merged; what reaches ``least`` less the number set aside is
    then looked up in the long ones by binary search, and dropped as soon as
    those left can't bring it to ``least``. ``n_sets`` bounds the values.
    """
    order = sorted(range(len(lists)), key=lambda k: len(lists[k]))
    aside = least - 1
    # Lists as short as the merged ones gain nothing from a probe.
    while aside and len(lists[order[len(lists) - aside]]) <= 1:
        aside -= 1
    merged = merge_skip([lists[k].tolist() for k in order[: len(lists) - aside]], max(1, least - aside))
    found = np.array([v for v, _ in merged], np.int64)
    counts = np.array([c for _, c in merged], np.int64)
    for step, k in enumerate(order[len(lists) - aside :]):
        if not len(found):
            break
        near = np.searchsorted(lists[k], found)
        near[near == len(lists[k])] = 0
        counts = counts + (lists[k][near] == found)
        alive = counts >= least - (aside - step - 1)
        if not alive.all():
            found, counts = found[alive], counts[alive]
    return found[counts >= least], counts[counts >= least]


def join_cell(sets: list[np.ndarray], percent: int, sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """All links between the sets of a cell; where it has sides, only those across."""
    order = sorted(range(len(sets)), key=lambda k: len(sets[k]))
    sizes = np.array([len(sets[k]) for k in order], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(len(order)), sizes)
    tokens, which = np.unique(np.concatenate([sets[k] for k in order]), return_inverse=True)
    by_token = np.argsort(which, kind="stable")
    posts = owner[by_token]
    starts = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(tokens)))])
    place = np.empty(len(which), np.int64)
    place[by_token] = np.arange(len(which))
    side = None if sides is None else sides[order]
    links = []
    for q in range(len(order)):
        n = int(sizes[q])
        if not n:
            continue
        # Of each list only the smaller sets, which come before this one.
        begin = starts[which[offsets[q] : offsets[q + 1]]]
        end = place[offsets[q] : offsets[q + 1]]
        shared = np.flatnonzero(end > begin)
        least = int(least_overlap(n, percent))
        if len(shared) < least:
            continue
        found, counts = t_occurrence([posts[b:e] for b, e in zip(begin[shared].tolist(), end[shared].tolist(), strict=True)], least, q)
        fit = 100 * counts >= percent * (n + sizes[found] - counts)
        if side is not None:
            fit &= side[found] != side[q]
        links += [(order[q], order[f]) for f in found[fit].tolist()]
    return links


_CELL = pa.schema([("cls", pa.binary()), ("other", pa.binary()), ("links", pa.int64())])


def _cells(percent: int):
    """Rows sorted by cell -> per class its links in the cell (other null), and spanning edges (links null)."""

    def solve(cell: tuple, rows: list[tuple]) -> pa.RecordBatch | None:
        unique = list({r[0]: r for r in rows}.values())
        if len(unique) < 2:
            return None
        links = join_cell([np.frombuffer(r[1], np.uint64) for r in unique], percent, np.array([r[3] for r in unique]) if cell[1] != cell[2] else None)
        root = list(range(len(unique)))

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        degree = [0] * len(unique)
        edges = []
        for x, y in links:
            degree[x] += unique[y][2]
            degree[y] += unique[x][2]
            if (a := top(x)) != (b := top(y)):
                root[a] = b
                edges.append((unique[x][0], unique[y][0], None))
        out = edges + [(unique[k][0], None, d) for k, d in enumerate(degree) if d]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _CELL, strict=True)], schema=_CELL) if out else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows = None, []
        for batch in batches:
            columns = [batch.column(k) for k in range(batch.num_columns)]
            cells = list(zip(columns[0].to_pylist(), columns[1].to_pylist(), columns[2].to_pylist(), strict=True))
            for k, key in enumerate(cells):
                if key != cell:
                    if rows and (done := solve(cell, rows)) is not None:
                        yield done
                    cell, rows = key, []
                rows.append((columns[3][k].as_py(), columns[4][k].as_py(), columns[5][k].as_py(), columns[6][k].as_py()))
        if rows and (done := solve(cell, rows)) is not None:
            yield done

    return run


def row_key(key: Column, text: Column) -> Column:
    """A 128-bit name of a row: repeated rows share it, and no others."""
    told = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.when(key.isNull(), "-").otherwise("+"), F.when(text.isNull(), "-").otherwise("+"), F.coalesce(text.cast("string"), F.lit("")))
    return F.unhex(F.md5(told.cast("binary")))


def jaccard_components(docs: DataFrame, size: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """Per row of ``docs``: doc_id (the key), n_shingles, component_id, n_links, row_key, stays.

    Rows link where 100 x |intersection| >= ``percent`` x |union| of their sets
    of distinct ``size``-word shingles, A-Z lowered; a text of fewer words is
    one shingle, one without words (or null) links with nothing.
    ``component_id`` is the least key reachable by links, the row's own
    included, and ``n_links`` the number of rows it links to directly. Rows
    with equal sets are one class, so copies never become pairs. A null key
    never names a component that has another key. Keys can be of any orderable
    type; other columns of ``docs`` are not looked at. Shingles are compared by
    64-bit hashes, classes and rows by 128 bits. ``stays`` is true for the one
    row of each component that names it (keyless rows come last) and for rows
    without words; repeated rows share their ``row_key`` and stay or go
    together. Texts of any length are read whole; an empty table gives no rows.

    A coarse group of any size is worked on in cells of two blocks of about
    ``block`` shingles, which bounds what a task holds; counting the links of
    each class within a very large group takes the square of its blocks.
    """
    docs = docs.select(F.col(f"`{key}`").alias("doc_id"), row_key(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("row_key"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow = docs.select("doc_id").limit(0).toArrow().schema.field(0).type
    first = pa.schema([("range", pa.int32()), ("doc_id", arrow), ("row_key", pa.binary()), ("n", pa.int64()), ("cls", pa.binary()), ("cells", pa.binary())])
    second = pa.schema([*[f for f in first][1:5], ("cell", pa.int64()), ("level", pa.int32())])
    signed = f"doc_id {kind}, row_key binary, n long, cls binary"
    dealt = docs.mapInArrow(_signatures(size, first), f"range int, {signed}, cells binary").repartition("range").sortWithinPartitions("range")
    both = cut(dealt.mapInArrow(_add_cells(second), f"{signed}, cell long, level int"), "jaccard-signatures")
    signed = both.filter("n IS NOT NULL").drop("cell", "level")
    cells, levels = frequent_cells(both.filter("cell IS NOT NULL").select("cell", "level"))
    classes = signed.filter("n > 0").groupBy("cls").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct(F.col("doc_id").isNull().alias("keyless"), "doc_id", "row_key")).alias("least"), F.min("row_key").alias("row_key"), F.max("n").alias("n")).withColumn("half", half_of(F.col("cls")))

    postings = docs.select("text").mapInArrow(_prefixes(size, percent, cells, levels), "shingle long, node long, span long")
    met = postings.repartition("shingle").sortWithinPartitions("shingle", "span").mapInArrow(_ties(percent), "a long, b long, times long, least long")
    coarse = components(met.groupBy("a", "b").agg(F.sum("times").alias("times"), F.min("least").alias("least")).filter("times >= least").select("a", "b"), signed.count())
    several = coarse.count()
    grouped = cut(classes.join(coarse, F.col("half") == F.col("node")).select("cls", "root", "copies", "row_key", "n").coalesce(8 + several // FILE_EDGES), "jaccard-grouped")
    blocks = grouped.groupBy(F.col("root").alias("r")).agg(F.ceil(F.sum("n") / block).cast("int").alias("blocks"))
    members = grouped.join(blocks, F.col("root") == F.col("r")).select("cls", "root", "blocks", "copies", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int").alias("block"))
    wanted = grouped.select(F.col("row_key").alias("__wanted")).distinct()
    if several <= BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    sets = docs.join(wanted, F.col("row_key") == F.col("__wanted"), "left_semi").select("text").mapInArrow(_fetch(size), "cls binary, shingles binary")
    placed = sets.withColumnRenamed("cls", "c").join(members, F.col("c") == F.col("cls")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    in_cells = placed.select("root", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "cls", "shingles", "copies", "block")
    found = cut(in_cells.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(_cells(percent), "cls binary, other binary, links long"), "jaccard-links")

    linked = components(found.filter("other IS NOT NULL").select(F.col("cls").alias("a"), F.col("other").alias("b")), several)
    degrees = found.filter("links IS NOT NULL").groupBy(F.col("cls").alias("d")).agg(F.sum("links").alias("links"))
    named = classes.select("cls", "copies", "least").join(linked, F.col("cls") == F.col("node"), "left").join(degrees, F.col("cls") == F.col("d"), "left").select("cls", "copies", "least", F.coalesce("root", "cls").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    names = named.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("first"))
    named = named.join(names, F.col("root") == F.col("r")).select(F.col("cls").alias("c"), F.col("first.doc_id").alias("component_id"), F.col("first.row_key").alias("first_key"), (F.col("links") + F.col("copies") - 1).alias("n_links"))
    some = signed.filter("n > 0").join(named, F.col("cls") == F.col("c")).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links", "row_key", (F.col("row_key") == F.col("first_key")).alias("stays"))
    return some.unionByName(signed.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"), "row_key", F.lit(True).alias("stays")))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component of near duplicates, columns untouched whatever they are called.

    The rows that go are told by their row keys, which are broadcast up to
    BROADCAST_KEYS; texts that stay are not shuffled then. Of repeated rows
    (equal key and text) one stays, the least by all columns as JSON; it is
    picked where rows are read before rows are sent anywhere.
    """
    found = cut(jaccard_components(docs, size, percent, key, text).select("row_key", "stays"), "jaccard-keep")
    gone = cut(found.filter("NOT stays").select(F.col("row_key").alias("__gone")).distinct(), "jaccard-gone")
    again = cut(found.filter("stays").groupBy(F.col("row_key").alias("__again")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__again"), "jaccard-again")
    side = lambda t: F.broadcast(t) if t.count() <= BROADCAST_KEYS else t
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), row_key(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("__key"))
    kept = rows.join(side(gone), F.col("__key") == F.col("__gone"), "left_anti")
    once = kept.join(side(again), F.col("__key") == F.col("__again"), "left_anti").select("__row")
    repeated = kept.join(side(again), F.col("__key") == F.col("__again"), "left_semi")
    first = repeated.groupBy("__key").agg(F.min_by("__row", F.to_json(F.struct("__row"))).alias("__row")).select("__row")
    return once.unionByName(first).select("__row.*")
