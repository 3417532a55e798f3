"""Operator 8 against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from shelfspark.llm import jaccard, queries
from shelfspark.llm.components import components

from .conftest import edge_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(t, k):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, k=4, percent=85):
    sets = [shingles(t, k) for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if sets[x] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                links[x] += 1
                links[y] += 1
                root[top(x)] = top(y)
    least = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            least[top(x)] = min(i, least.get(top(x), i))
    return Counter((i, len(sets[x]), least.get(top(x)), links[x]) for x, (i, _) in enumerate(rows))


def near_copies(seed, n=120, words=40):
    rnd = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(60)]
    bases = [[rnd.choice(vocabulary) for _ in range(rnd.choice((3, 8, 12, words)))] for _ in range(12)]
    rows = []
    for i in range(n):
        w = list(rnd.choice(bases))
        for _ in range(rnd.randrange(0, 3)):
            at = rnd.randrange(len(w))
            w[at : at + rnd.randrange(2)] = [rnd.choice(vocabulary)]
        rows.append((i * 7 % n, " ".join(w)))
    return rows


@pytest.mark.parametrize("seed,percent,size,block", [(1, 85, 4, 1_000_000), (2, 80, 5, 100), (3, 60, 2, 60), (4, 95, 3, 500)])
def test_links_and_components(spark, seed, percent, size, block):
    rows = near_copies(seed)
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), size, percent, block=block).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got) == brute(rows, size, percent)


def test_op8_edges(edge, empty, store, spark):
    got = queries.op8_jaccard_join(spark, store(documents=edge)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got) == brute([r[:2] for r in edge_rows()])
    assert queries.op8_jaccard_join(spark, store(documents=empty)).count() == 0


def test_t_occurrence_probes_long_lists():
    rnd = np.random.default_rng(5)
    for _ in range(200):
        lists = [np.unique(rnd.integers(0, 50, rnd.choice([2, 3, 40, 120]))) for _ in range(rnd.integers(1, 12))]
        least = int(rnd.integers(1, len(lists) + 1))
        count = Counter(x for xs in lists for x in xs.tolist())
        found, counts = jaccard.t_occurrence(lists, least, 50)
        assert dict(zip(found.tolist(), counts.tolist(), strict=True)) == {x: n for x, n in count.items() if n >= least}


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 201), (201, 202), (202, 200), (5, 5), (300, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_lists_keep_every_fitting_pair_together():
    rnd = np.random.default_rng(7)
    for percent, shingles in ((60, 30), (85, 30), (85, 3), (60, 2)):
        n, shingle, node = rnd.integers(5, 200, 400), rnd.integers(0, shingles, 400), np.arange(400)
        span = jaccard.span_of(n, n, 0)
        root = list(range(400))

        def top(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        # Two tasks gather what they read, a third joins what they send.
        held, ties = [], []
        for half in (slice(0, 250), slice(250, 400)):
            order = np.lexsort((span[half], shingle[half]))
            a, b, *rest = jaccard.gather(shingle[half][order], node[half][order], span[half][order], percent)
            ties.append((a, b))
            held.append(rest)
        s, v, p = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((p, s))
        a, b, s, v, p = jaccard.gather(s[order], v[order], p[order], percent)
        ties.append((a, b))
        plain = np.flatnonzero((p & 1) == 0)
        a, b, times, _ = jaccard.list_pairs(s[plain], v[plain], p[plain], percent)
        assert (times >= 1).all()
        ties.append((a, b))
        for a, b in ties:
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                root[top(x)] = top(y)
        for x in range(400):
            for y in range(x):
                if shingle[x] == shingle[y] and 100 * min(n[x], n[y]) >= percent * max(n[x], n[y]):
                    assert top(x) == top(y)


def test_cells_survive_packing():
    cells = np.random.default_rng(3).integers(0, 1 << 32, 20_000).astype(np.uint32)
    cells = np.concatenate([cells, cells[:50], np.array([0, (1 << 32) - 1], np.uint32)])
    back = np.concatenate([jaccard.unpack_cells(b) + (r << 20) for r, b in jaccard.pack_cells(cells)])
    assert np.array_equal(back, np.sort(cells).astype(np.int64))


def test_frequent_cells_come_last_and_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LEAST_FREQUENT", 2)
    monkeypatch.setattr(jaccard, "SHORT", 3)
    monkeypatch.setattr(jaccard, "CELLS", 200)
    rows = near_copies(9) + [(None, "a b c d e f"), (None, None), (500, ""), (500, "")]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 3, 70, block=90).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got) == brute(rows, 3, 70)


def test_keep_one_by_text_keys_and_any_column_names(spark):
    rows = [("b", "x y z w v u t", "1"), ("a", "x y z w v u t", "2"), ("a", "x y z w v u t", "1"), ("c", None, "3"), ("d", "q", "4")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, __key string").withColumnRenamed("doc_id", "__row")
    got = jaccard.keep_one(docs, key="__row").collect()
    assert sorted((r["__row"], r["__key"]) for r in got) == [("a", "1"), ("c", "3"), ("d", "4")]
