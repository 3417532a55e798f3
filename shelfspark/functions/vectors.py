"""Vector math on array columns: quantise, normalise, pool, dot product, keys."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.plans.lineage import cut, scratch_path

# One quantisation step is LIMIT / STEPS.
LIMIT, STEPS = 0.3, 127
MODEL = "leaf-ir-v1"


def quantize(v: Column) -> Column:
    """Signed bytes: round half away from zero after division by the step, held within -127 and 127."""
    return F.transform(v, lambda x: F.greatest(F.lit(-STEPS), F.least(F.lit(STEPS), F.round(x.cast("double") / F.lit(LIMIT / STEPS)).cast("int"))).cast("tinyint"))


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def l2(v: Column) -> Column:
    """Unit length; a zero vector stays as it is."""
    n = norm(v)
    return F.when(n > 0, F.transform(v, lambda x: (x / n.cast("float")).cast("float"))).otherwise(v)


def dot(a: Column, b: Column) -> Column:
    """Exact dot product of two byte vectors."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("int") * y.cast("int")), F.lit(0), lambda s, x: s + x)


def project(v: Column, weights: list[list[float]], bias: list[float]) -> Column:
    """W v + b, row by row."""
    rows = [F.aggregate(F.zip_with(v, F.array(*[F.lit(float(x)) for x in row]), lambda a, w: a.cast("double") * w), F.lit(float(b)), lambda s, x: s + x) for row, b in zip(weights, bias, strict=True)]
    return F.array(*[r.cast("float") for r in rows])


def mean_pool(df: DataFrame, key: str, vector: str, mask: str | None = None) -> DataFrame:
    """(key, pos, mean) over the vectors of a key; rows whose mask is 0 don't count."""
    rows = df if mask is None else df.filter(F.col(mask) != 0)
    return rows.select(key, F.posexplode(vector).alias("pos", "x")).groupBy(key, "pos").agg(F.avg(F.col("x").cast("double")).alias("mean"))


def masked_mean(hidden: Column, mask: Column) -> Column:
    """Mean of the token vectors whose mask isn't 0, as 32-bit floats; zeros of the same length if none is."""
    kept = F.filter(F.arrays_zip(hidden.alias("v"), mask.alias("m")), lambda t: t["m"] != 0)
    zero = F.transform(F.get(hidden, F.lit(0)), lambda x: F.lit(0.0).cast("float"))
    total = F.aggregate(kept, zero, lambda acc, t: F.zip_with(acc, t["v"], lambda a, b: (a + b).cast("float")))
    n = F.size(kept).cast("float")
    return F.when(F.size(kept) > 0, F.transform(total, lambda x: (x / n).cast("float"))).otherwise(total)


def vector_key(document: Column, model: str = MODEL) -> Column:
    """Hex key of a document's vector: SHA-256 over the document's SHA-256 and the model's name."""
    return F.sha2(F.concat(F.unhex(F.sha2(document, 256)), F.encode(F.lit(model), "UTF-8")), 256)


#: Query vectors that meet all items at once; more of them go through block by block.
QUERY_BLOCK = 4096
#: Items that meet a block of queries in one product: at first, and at most.
FEWEST, MOST = 16, 1024


def _best_of_block(queries: np.ndarray, k: int):
    """Batches of (vec_id, v) -> the best k items of each query that this task has seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = queries.shape[1]
        # Products of bytes add up exactly in 32-bit floats up to 1,040 of them; beyond, 64 bits do.
        kind = np.float32 if width <= 1040 else np.float64
        matrix = queries.astype(kind)
        q, dots, ids = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)
        least = np.full(len(queries), np.iinfo(np.int32).min, np.int32)
        seen = 0
        for batch in batches:
            flat = np.asarray(batch.column(1).flatten().to_numpy(zero_copy_only=False)).astype(kind)
            if len(flat) != width * batch.num_rows:
                raise ValueError(f"vectors of other lengths than {width}")
            names = batch.column(0).to_numpy()
            lo = 0
            while lo < batch.num_rows:
                # As many as were seen before: about k of a query's are better then, so the first ones don't all come in at once.
                n = min(FEWEST if not seen else seen, MOST, batch.num_rows - lo)
                got = (matrix @ flat[lo * width : (lo + n) * width].reshape(-1, width).T).astype(np.int32)
                new, which = np.nonzero(got >= least[:, None])
                q, dots, ids = np.concatenate([q, new]), np.concatenate([dots, got[new, which]]), np.concatenate([ids, names[lo + which]])
                order = np.lexsort((ids, -dots, q))
                q, dots, ids = q[order], dots[order], ids[order]
                place = np.arange(len(q)) - np.searchsorted(q, q)
                last = place == k - 1
                least[q[last]] = dots[last]
                q, dots, ids = q[place < k], dots[place < k], ids[place < k]
                lo, seen = lo + n, seen + n
        if len(q):
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(ids), pa.array(dots)], names=["q", "vec_id", "dot"])

    return run


def top_k(queries: DataFrame, items: DataFrame, k: int, block: int = QUERY_BLOCK) -> DataFrame:
    """Exact (query, rank, vec_id, dot) by byte dot product, ties by id, of (query, q) against (vec_id, v).

    Queries go to the tasks in blocks of about ``block`` that a hash deals out;
    each task keeps its best k per query, so k rows per query and task are
    shuffled. One block is a part of the plan; of several, each is a job whose
    rows are written, and each reads all items: ``inverted_lists`` is for many.
    """
    spark = items.sparkSession
    n = queries.count()
    blocks = max(1, -(-n // block))

    def part(b: int) -> DataFrame:
        mine = queries if blocks == 1 else queries.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b)
        rows = mine.select("query", "q").toPandas().sort_values("query")
        if not len(rows):
            return spark.createDataFrame([], "query long, rank int, vec_id long, dot int")
        matrix = np.array(rows["q"].tolist(), np.int8)
        names = spark.createDataFrame([(k_, int(q)) for k_, q in enumerate(rows["query"])], "q long, query long")
        found = items.select("vec_id", "v").mapInArrow(_best_of_block(matrix, k), "q long, vec_id long, dot int")
        best = found.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("dot"), "vec_id"))).filter(F.col("rank") <= k)
        return best.join(F.broadcast(names), "q").select("query", "rank", "vec_id", "dot")  # a block of names

    if blocks == 1:
        return part(0)
    path = scratch_path(spark, "top-k")
    for b in range(blocks):
        part(b).write.mode("append").parquet(path)
    return spark.read.schema("query long, rank int, vec_id long, dot int").parquet(path)


# -- inverted lists ---------------------------------------------------------------------

#: Lists are fitted on so many vectors at most, and probes are chosen by so many of them.
SAMPLE, TRIALS = 16_384, 256
#: Vectors of a list, and queries that probe it, meet in pieces of about so many.
PIECE = 8_192


@dataclass(frozen=True)
class Lists:
    """Centres of inverted lists, how many a query probes, and the share of true neighbours that found on the sample."""

    centres: np.ndarray
    probes: int
    recall: float


def fit_lists(items: DataFrame, lists: int = 64, k: int = 10, recall: float = 0.95, rounds: int = 8) -> Lists:
    """Centres by k-means over directions of SAMPLE vectors, those of the least hash of their id, which one task holds easily.

    Probes are the fewest that find ``recall`` of the true neighbours of TRIALS
    sample vectors within the sample.
    """
    sample = items.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    if not len(sample):
        return Lists(np.zeros((1, 0), np.float32), 1, 1.0)
    raw = np.array(sample["v"].tolist(), np.float32)
    unit = raw / np.maximum(np.linalg.norm(raw, axis=1, keepdims=True), 1e-9)
    centres = unit[: max(1, min(lists, len(unit) // 8 or 1))].copy()
    for _ in range(rounds):
        own = (unit @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, unit)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), centres)
    own = (unit @ centres.T).argmax(1)
    asked = raw[:TRIALS]
    best = np.argpartition(-(asked @ raw.T), min(k, len(raw) - 1), axis=1)[:, :k]
    order = np.argsort(-(asked @ centres.T), axis=1, kind="stable")
    place = np.argsort(order, axis=1, kind="stable")  # when a query comes to a list
    needed = np.take_along_axis(place, own[best], 1)
    found = np.array([(needed < n).mean() for n in range(1, len(centres) + 1)])
    probes = int(np.argmax(found >= recall)) + 1
    return Lists(centres, probes, float(found[probes - 1]))


def _nearest_lists(centres: np.ndarray, probes: int):
    """Batches of (id, v) -> (id, v, list): the list of each vector, or the ``probes`` ones that it asks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                v = np.asarray(part.column(1).flatten().to_numpy(zero_copy_only=False)).astype(np.float32).reshape(part.num_rows, -1)
                far = v @ centres.T
                which = np.argsort(-far, axis=1, kind="stable")[:, :probes]
                row = np.repeat(np.arange(part.num_rows), which.shape[1])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)), pa.array(which.ravel().astype(np.int32))], names=["id", "v", "list"])

    return run


def _best_of_piece(k: int):
    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "dot": pa.array([], pa.int32())})
        kind = lambda c: np.asarray(c.combine_chunks().flatten().to_numpy(zero_copy_only=False)).astype(np.float64).reshape(len(c), -1)
        q, v, ids, names = kind(asked["v"]), kind(held["v"]), held["id"].to_numpy(), asked["id"].to_numpy()
        order = np.argsort(ids, kind="stable")  # ties go to the smaller id
        v, ids, out = v[order], ids[order], []
        for lo in range(0, len(q), 256):
            dots = (q[lo : lo + 256] @ v.T).astype(np.int32)
            best = np.argsort(-dots, axis=1, kind="stable")[:, :k]
            row = np.repeat(np.arange(len(dots)), best.shape[1])
            out.append((names[lo + row], ids[best.ravel()], dots[row, best.ravel()]))
        a, b, c = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table({"query": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "dot": pa.array(c, pa.int32())})

    return run


def inverted_lists(queries: DataFrame, items: DataFrame, k: int, index: Lists | None = None, lists: int = 64, recall: float = 0.95) -> DataFrame:
    """(query, rank, vec_id, dot) by byte dot product of (query, q) against (vec_id, v), looked for in the lists nearest to each query.

    Every item lies in the list of its nearest centre, every query goes to as
    many lists as ``fit_lists`` found to be enough, and what meets there is
    ranked exactly; a neighbour in another list is missed. ``top_k`` misses none.
    Lists are cut into pieces by a hash, so none grows with the items, and the
    sizes of lists, a row each, say into how many.
    """
    index = index or fit_lists(items, lists, k, recall)
    width = items.schema["v"].dataType.simpleString()
    held = items.select(F.col("vec_id").cast("long").alias("id"), "v").mapInArrow(_nearest_lists(index.centres, 1), f"id long, v {width}, list int")
    asked = queries.select(F.col("query").cast("long").alias("id"), F.col("q").alias("v")).mapInArrow(_nearest_lists(index.centres, index.probes), f"id long, v {width}, list int")
    sizes = held.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / PIECE).cast("int").alias("pieces"))
    turns = asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / PIECE).cast("int").alias("turns"))
    shape = F.broadcast(cut(sizes.join(turns, "list"), "list-sizes"))  # a row per list
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    there = held.join(shape, "list").select("id", "v", "list", part("pieces").alias("piece"), every("turns").alias("turn"))
    comes = asked.join(shape, "list").select("id", "v", "list", every("pieces").alias("piece"), part("turns").alias("turn"))
    keys = ["list", "piece", "turn"]
    met = comes.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInArrow(_best_of_piece(k), "query long, vec_id long, dot int")
    best = Window.partitionBy("query").orderBy(F.desc("dot"), "vec_id")
    return met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query", "rank", "vec_id", "dot")
