"""Centroid clustering by delta Lloyd: rounds of k-means that redo only what can have changed.

Assignments are kept in a table and the integer sums of each cluster beside
them. A centroid that stayed where it was keeps its distance to every vector, so
a round compares a vector with the centroids that moved, and with all of them
only where its own centroid moved. Vectors that change their owner send their
components as signed integers, minus to the old cluster and plus to the new
one; adding those up brings the global sums up to date without reading the rest.
All arithmetic is on integers, so rounds agree to the last bit however the rows
are dealt out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm import text as tx
from shelfspark.plans.lineage import cut, drop

#: Components from here on have squares that sum up to more than a long holds.
LIMIT = 1 << 27
#: Products of components up to here sum up without loss in a double, where matrix products are fast.
_IN_DOUBLE = 1 << 22


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distance to, and number of, the nearest of ``centroids``; the smaller number wins ties."""
    kind = np.float64 if max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0)) <= _IN_DOUBLE else np.int64
    v, c = vectors.astype(kind), centroids.astype(kind)
    far = ((v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)[None, :]).astype(np.int64)
    best = far.argmin(1)
    return far[np.arange(len(far)), best], best


def reassign(vectors: np.ndarray, owner: np.ndarray, distance: np.ndarray, centroids: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owners and distances after the centroids ``moved`` (numbers, rising) have changed."""
    owner, distance = owner.copy(), distance.copy()
    lost = np.flatnonzero(np.isin(owner, moved))
    held = np.flatnonzero(~np.isin(owner, moved))
    if len(lost):
        distance[lost], owner[lost] = nearest(vectors[lost], centroids)
    if len(held) and len(moved):
        far, which = nearest(vectors[held], centroids[moved])
        which = moved[which]
        better = (far < distance[held]) | ((far == distance[held]) & (which < owner[held]))
        owner[held[better]], distance[held[better]] = which[better], far[better]
    return owner, distance


def _packed(vectors: np.ndarray) -> pa.Array:
    width = vectors.shape[1] * 4
    return pa.Array.from_buffers(pa.binary(), len(vectors), [None, pa.py_buffer((np.arange(len(vectors) + 1) * width).astype(np.int32).tobytes()), pa.py_buffer(vectors.astype("<i4").tobytes())])


def _unpacked(column: pa.Array, dims: int) -> np.ndarray:
    data, _ = tx.string_parts(column)
    return np.frombuffer(data.tobytes(), "<i4").reshape(-1, dims).astype(np.int64)


def _state(key: pa.Array, packed: pa.Array, owner: np.ndarray, distance: np.ndarray, was: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([key, packed, pa.array(owner.astype(np.int32)), pa.array(distance), pa.array(was.astype(np.int32)), pa.array(owner != was)], names=["key", "v", "cluster", "distance", "was", "moved"])


def _first_round(centroids: np.ndarray, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.floor(batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
                if np.abs(x).max() >= LIMIT:
                    raise ValueError(f"a component beyond {LIMIT / scale:g} has no squared distance that a long holds")
                v = x.astype(np.int64).reshape(batch.num_rows, -1)
                distance, owner = nearest(v, centroids)
                yield _state(batch.column(0), _packed(v), owner, distance, np.full(len(v), -1))

    return run


def _next_round(centroids: np.ndarray, moved: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = _unpacked(batch.column(1), centroids.shape[1])
                was = batch.column(2).to_numpy().astype(np.int64)
                owner, distance = reassign(v, was, batch.column(3).to_numpy(), centroids, moved)
                yield _state(batch.column(0), batch.column(1), owner, distance, was)

    return run


def _transfers(k: int, dims: int):
    """Signed sums a batch: (cluster, component, amount); component ``dims`` counts vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            v = np.concatenate([_unpacked(batch.column(0), dims), np.ones((batch.num_rows, 1), np.int64)], 1)
            to, was = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for c in range(k):
                total[c] += v[to == c].sum(0) - v[was == c].sum(0)
        cluster, component = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cluster.astype(np.int32)), pa.array(component.astype(np.int32)), pa.array(total[cluster, component])], names=["cluster", "component", "amount"])

    return run


def kept_vectors(table: DataFrame, key: str, vector: str, dims: int) -> DataFrame:
    """(key, x): the rows whose vector has exactly ``dims`` components, all of them finite numbers."""
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return table.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("x")).filter((F.size("x") == dims) & finite)


def seed_hash(key: Column, seed: int) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit(""))), 256)


def delta_lloyd(table: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """(key, cluster, distance) of every kept vector after ``rounds`` rounds, and the centroids.

    Kept are vectors of exactly ``dims`` components, none null or non-finite;
    others give no row. A component x counts as the integer floor(scale * x);
    where one reaches 2^27, no squared distance fits a long and the job fails
    saying so. The first centroids are the kept vectors with the least SHA-256
    of ``seed:key`` (a null key is an empty text; ties by components), fewer
    than ``k`` if there are fewer vectors. A round assigns every vector to the
    nearest centroid, ties to the smaller number, and replaces the centroids
    that have vectors by floor(sum / count) of each component; the others stay.
    At the end all are assigned once more. Repeated rows and keys are vectors
    of their own, an empty table gives no rows and no centroids, and other
    columns are not looked at.

    To the driver go k centroids and k * (dims + 1) sums, nothing that grows
    with the rows. A round reads the table of assignments once, writes the next
    and drops it before; the sums are read from the rows that moved. A lost
    executor costs its tasks, as every round starts from a written table. Once
    no centroid moves, the rounds left would change nothing and are not run.
    """
    kept = kept_vectors(table, key, vector, dims)
    first = kept.select("x", seed_hash(F.col("key"), seed).alias("h")).orderBy("h", "x").limit(k).collect()
    centroids = np.array([[int(np.floor(float(c) * scale)) for c in r.x] for r in first], np.int64).reshape(-1, dims)
    named = kept.schema["key"].dataType.simpleString()
    layout = f"key {named}, v binary, cluster int, distance long, was int, moved boolean"
    if np.abs(centroids).max(initial=0) >= LIMIT:
        raise ValueError(f"a component beyond {LIMIT / scale:g} has no squared distance that a long holds")
    if not len(centroids):
        return kept.select("key", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance")).limit(0), []
    sums = np.zeros((len(centroids), dims + 1), object)
    state = cut(kept.mapInArrow(_first_round(centroids, scale), layout), "lloyd")
    for _ in range(rounds):
        sent = state.filter("moved").select("v", "cluster", "was").mapInArrow(_transfers(len(centroids), dims), "cluster int, component int, amount long")
        for r in sent.groupBy("cluster", "component").agg(F.sum("amount").alias("amount")).collect():
            sums[r.cluster, r.component] += r.amount
        then = centroids
        centroids = np.array([[int(s) // int(row[-1]) for s in row[:-1]] if row[-1] else list(old) for row, old in zip(sums, then, strict=True)], np.int64).reshape(-1, dims)
        moved = np.flatnonzero((centroids != then).any(1))
        if not len(moved):
            break
        before, state = state, cut(state.select("key", "v", "cluster", "distance").mapInArrow(_next_round(centroids, moved), layout), "lloyd")
        drop(before)
    return state.select("key", "cluster", "distance"), centroids.tolist()


def cluster_facts(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``assigned`` with cluster_inertia, inertia and centroid_sha256; one row per centroid is sent to all tasks."""
    spark = assigned.sparkSession
    found = {r.cluster: int(r.far) for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("far")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    facts = spark.createDataFrame([(n, found.get(n, 0), sum(found.values()), d) for n, d in enumerate(digest)], "__n int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), F.col("cluster") == F.col("__n")).drop("__n")
