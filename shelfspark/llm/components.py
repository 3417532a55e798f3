"""Connected components of an edge table by alternating stars (Kiveris et al., 2014), all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.plans.lineage import cut, drop


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is joined to the node's least neighbour, or the node itself."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return both.filter(F.col("b") > F.col("a")).join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are joined to the least of them; edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
    smaller = edges.join(least, F.col("a") == F.col("u")).filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return smaller.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


#: Edges of a file of a round's table, about: a table is written in no more files than its edges need.
FILE_EDGES = 25_000


def components(edges: DataFrame, about: int | None = None, most_rounds: int = 60) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b): root is the component's least node, itself included.

    Self-loops and repeated edges do no harm; an empty table gives no rows. Node
    ids can be of any orderable type. Each round is cut in the shared folder;
    rounds grow with the logarithm of the longest path. ``about`` is how many
    edges there may be, if that is known: files are few where edges are few.
    """
    first = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(F.col("a") != F.col("b")).distinct()
    at = cut(first if about is None else first.coalesce(8 + about // FILE_EDGES), "edges")
    state = _state(at)
    for _ in range(most_rounds):
        if not state[0]:
            break
        small = _small_star(_large_star(at).filter(F.col("a") != F.col("b")).distinct()).filter(F.col("a") != F.col("b")).distinct()
        old, at = at, cut(small.coalesce(8 + state[0] // FILE_EDGES), "edges")
        now = _state(at)
        drop(old)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return at.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(at.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
