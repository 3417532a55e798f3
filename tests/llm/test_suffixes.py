"""Operator 7 against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import queries, suffixes

from .conftest import edge_rows


def brute(rows, span):
    raws = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(r[k : k + span] for _, r in raws for k in range(len(r) - span + 1))
    out = Counter()
    for i, r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for k in range(len(r) - span + 1):
            if seen[r[k : k + span]] > 1:
                gone[k : k + span] = True
        gone = gone[: len(r)]
        edges = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        out[(i, len(r), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest())] += 1
    return out


def digest(df):
    return Counter((r.doc_id, r.n_bytes, sum(x.stop - x.begin for x in r.removed), len(r.removed), r.kept_sha256) for r in df.collect())


def shared_passages(seed, n=60, span=200):
    rnd = random.Random(seed)
    alphabet = "abcdefgh é\n"
    passages = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(span // 2, span * 3))) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rnd.randrange(1, 5)):
            p = rnd.choice(passages)
            a = rnd.randrange(0, max(1, len(p) // 3))
            parts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(0, 40))), p[a : len(p) - rnd.randrange(0, max(1, len(p) // 3))]]
        rows.append((i, "".join(parts)))
    return rows + [(n, "ab" * 300), (n + 1, "x" * (span + 5)), (n + 2, rows[0][1]), (n + 2, rows[0][1]), (None, rows[1][1])]


@pytest.mark.parametrize("seed,span,gram,hot", [(1, 200, 32, 4096), (2, 30, 8, 4096), (3, 30, 8, 3), (4, 50, 5, 0)])
def test_removes_what_brute_force_removes(spark, seed, span, gram, hot):
    rows = shared_passages(seed, span=span)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert digest(suffixes.remove_repeats(df, span, gram, hot=hot)) == brute(rows, span)


def test_segments_of_long_texts_meet(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SEGMENT", 300)
    rnd = random.Random(9)
    text = "".join(rnd.choice("abcdef") for _ in range(2000))
    rows = [(1, text + "!" + text[500:1500]), (2, text[100:900])]
    batch = suffixes.pa.RecordBatch.from_arrays([suffixes.pa.array([1, 2]), suffixes.pa.array([t for _, t in rows])], names=["ref", "text"])
    found = [x for b in suffixes._anchor_rows(60, 10)(iter([batch])) for x in b.to_pylist()]
    covered = Counter((x["ref"], s) for x in found for s in range(x["begin"], x["stop"]))
    assert covered == Counter((i, s) for i, t in rows for s in range(len(t) - 59))
    assert all(x["begin"] <= x["pos"] + 0 and x["pos"] + 10 <= x["begin"] + 60 + (x["stop"] - 1 - x["begin"]) for x in found)


def test_deep_shallow_order_is_the_sorted_order():
    rnd = np.random.default_rng(2)
    for span in (8, 13, 24, 200):
        base = rnd.integers(97, 99, 400).astype(np.uint8)
        data = np.concatenate([base, base[: 400 - span], base, np.full(300, 97, np.uint8), np.zeros(8, np.uint8)])
        starts = rnd.permutation(len(data) - 8 - span)[:700]
        groups = rnd.integers(0, 3, len(starts))
        order, rank = suffixes.deep_shallow(data, starts, span, groups)
        key = [(int(groups[k]), data[starts[k] : starts[k] + span].tobytes()) for k in range(len(starts))]
        assert [key[k] for k in order] == sorted(key)
        classes = {}
        for k, c in enumerate(rank.tolist()):
            assert classes.setdefault(c, key[k]) == key[k]
        assert len(classes) == len(set(key))


def test_op7_edges(edge, empty, store, spark):
    rows = [r[:2] for r in edge_rows() if r[0] != 6] + [(6, "w" + edge_rows()[6][1][:3000])]
    small = edge.withColumn("text", F.when(F.col("doc_id") == 6, F.concat(F.lit("w"), F.substring("text", 1, 3000))).otherwise(F.col("text")))
    got = queries.op7_suffix_repeats(spark, store(documents=small)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute([r for r in rows if r[0] != 10], 200) + Counter([(10, 70_000, 70_000, 1, hashlib.sha256(b"").hexdigest())])
    assert queries.op7_suffix_repeats(spark, store(documents=empty)).count() == 0


def test_texts_under_one_name_stay_apart(spark, monkeypatch):
    real = F.xxhash64
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(7).cast("long") if isinstance(c[0], str) and c[0] == "text" else real(*c))
    rows = shared_passages(6, n=12, span=30)
    assert digest(suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 30, 8)) == brute(rows, 30)


def test_without_kept_bytes(spark):
    df = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    row = suffixes.remove_repeats(df, with_kept=False).first()
    assert row.kept is None and row.kept_sha256 == hashlib.sha256(b"abc").hexdigest()
