"""Delta Lloyd against plain rounds over whole integers."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import centroids as ce

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k, rounds, dims, scale=64):
    kept = [(i, [int(np.floor(float(np.float32(x)) * scale)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in order[:k]]

    def assign():
        out = []
        for i, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in cents]
            out.append((i, far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        owner = [c for _, c, _ in assign()]
        for c in range(len(cents)):
            mine = [v for (_, v), o in zip(kept, owner, strict=True) if o == c]
            if mine:
                cents[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return assign(), cents


def key(r):
    return str(tuple(r))


@pytest.mark.parametrize(("seed", "n", "k", "rounds", "spread"), [(1, 300, 16, 3, 1.0), (2, 200, 5, 12, 0.05), (3, 7, 16, 3, 1.0), (4, 150, 16, 3, 40000.0)])
def test_rounds_equal_plain_ones(spark, seed, n, k, rounds, spread):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(size=4) * spread).tolist()) for i in range(n)]
    rows += [(i, rows[i][1]) for i in range(0, n, 9)]  # repeated rows
    rows += [(1000 + i, rows[0][1]) for i in range(20)]  # copies
    assigned, cents = ce.delta_lloyd(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(5), k=k, rounds=rounds, dims=4)
    want, want_cents = plain(rows, k, rounds, 4)
    assert cents == want_cents
    assert sorted(map(key, assigned.collect())) == sorted(map(key, want))


def test_only_what_can_have_changed_is_compared():
    rng = np.random.default_rng(7)
    v, old = rng.integers(-50, 50, (500, 6)), rng.integers(-50, 50, (9, 6))
    distance, owner = ce.nearest(v, old)
    new = old.copy()
    moved = np.array([2, 5, 6])
    new[moved] += rng.integers(-20, 20, (3, 6))
    got = ce.reassign(v, owner, distance, new, moved)
    far, which = ce.nearest(v, new)
    assert (got[0] == which).all() and (got[1] == far).all()


def test_large_components_are_exact():
    v = np.array([[ce.LIMIT - 1, -ce.LIMIT + 1], [3, 4]])
    far, which = ce.nearest(v, np.array([[-ce.LIMIT + 1, ce.LIMIT - 1], [0, 0]]))
    assert far.tolist() == [2 * (ce.LIMIT - 1) ** 2, 25] and which.tolist() == [1, 1]


def test_what_is_no_vector_is_left_out_and_names_may_clash(spark):
    rows = [(1, [0.5, 1.0]), (2, None), (3, [1.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 0.0]), (None, [2.0, -1.0]), (7, []), (8, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).withColumn("cluster", F.lit("x")).withColumn("key", F.lit(3)).withColumn("v", F.lit(None).cast("int"))
    assigned, cents = ce.delta_lloyd(df, k=2, rounds=2, dims=2)
    want, want_cents = plain(rows, 2, 2, 2)
    assert sorted(map(key, assigned.collect())) == sorted(map(key, want)) and cents == want_cents
    facts = ce.cluster_facts(assigned, cents).collect()
    assert {r.inertia for r in facts} == {sum(d for _, _, d in want)}


def test_beyond_what_a_long_holds_is_an_error(spark):
    with pytest.raises(Exception, match="no squared distance"):
        ce.delta_lloyd(spark.createDataFrame([(1, [1e9, 1.0], 0)], SCHEMA), dims=2)[0].collect()


def test_empty_table(spark):
    assigned, cents = ce.delta_lloyd(spark.createDataFrame([], SCHEMA))
    assert cents == [] and assigned.collect() == [] and ce.cluster_facts(assigned, cents).collect() == []
