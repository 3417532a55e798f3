"""Sharding by jump consistent hashing (Lamping and Veach, 2014), in DataFrame functions only.

The shard is a function of key and shard count alone: no ring table is kept or
shipped, and going from n to n + 1 shards moves 1 / (n + 1) of the keys, all of
them into the new shard. Slots number the rows of a shard from 0 without gaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The generator of the published algorithm: key = key * MULTIPLIER + 1 modulo 2^64.
MULTIPLIER = 2862933555777941757
_LOW, _HIGH = MULTIPLIER & 0xFFFFFFFF, MULTIPLIER >> 32
#: Steps of the first run of a walk.
FIRST_STEPS = 32
#: Rows of a shard are numbered in this many blocks side by side.
BLOCKS = 1024


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def jump_hash(key: Column, shards: int) -> Column:
    """The shard, 0 to ``shards`` - 1, of a 64-bit integer key.

    The walk of the algorithm visits rising bucket numbers, on average ln
    ``shards`` of them, ``shards`` at most. Steps come in runs of FIRST_STEPS,
    twice as many, and so on; a run is not begun once the walk is through, so
    keys cost what their walks do, whatever ``shards``. The 64-bit product is
    formed from halves that never overflow, as integer arithmetic is checked
    under ANSI mode. A null key gives null.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    mask = _long(0xFFFFFFFF)
    start = F.struct(
        F.shiftrightunsigned(key.cast("long"), 32).alias("hi"),
        key.cast("long").bitwiseAND(mask).alias("lo"),
        _long(-1).alias("shard"),
        _long(0).alias("next"),
    )

    def step(s: Column, _: Column) -> Column:
        lo, hi = s["lo"], s["hi"]
        upper = F.shiftright(lo, 16) * _long(_LOW)
        low = lo.bitwiseAND(_long(0xFFFF)) * _long(_LOW) + F.shiftleft(upper.bitwiseAND(_long(0xFFFF)), 16) + _long(1)
        cross = F.shiftleft((F.shiftright(hi, 16) * _long(_LOW & 0xFFFF)).bitwiseAND(_long(0xFFFF)), 16) + hi.bitwiseAND(_long(0xFFFF)) * _long(_LOW)
        high = (F.shiftright(low, 32) + F.shiftright(upper, 16) + (lo * _long(_HIGH)).bitwiseAND(mask) + cross).bitwiseAND(mask)
        ahead = ((s["next"] + _long(1)).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(high, 1) + _long(1)).cast("double"))).cast("long")
        moved = F.struct(high.alias("hi"), low.bitwiseAND(mask).alias("lo"), s["next"].alias("shard"), ahead.alias("next"))
        return F.when(s["next"] < _long(shards), moved).otherwise(s)

    runs = [min(FIRST_STEPS, shards + 1)]
    while sum(runs) <= shards:
        runs.append(min(2 * runs[-1], shards + 1 - sum(runs)))
    going = lambda s, n: F.when(s["next"] < _long(shards), F.aggregate(F.sequence(F.lit(1), n), s, step)).otherwise(s)
    return F.when(key.isNotNull(), F.aggregate(F.array(*map(F.lit, runs)), start, going, lambda s: s["shard"])).cast("int")


def stable_key(key: Column, kind: str) -> Column:
    """Integers are keys themselves; anything else is hashed from its text. Null goes with key 0."""
    whole = kind in ("tinyint", "smallint", "int", "bigint")
    return F.coalesce(key.cast("long") if whole else F.xxhash64(key.cast("string")), _long(0))


def shard(docs: DataFrame, shards: int, key: str = "doc_id", text: str | None = "text", blocks: int = BLOCKS) -> DataFrame:
    """Every row of ``docs`` with ``shard``, ``grown_shard`` (with one shard more) and ``slot``.

    Slots are gapless from 0 in each shard. They are numbered in ``blocks`` that
    a hash of key and text deals out: the counts of the blocks (shards x blocks
    rows at most, so their broadcast is bounded) give each block its first slot,
    and no task gets a whole shard. Inside a block the order is by key, then
    text; wholly equal rows get following slots. A null key is shard key 0. An
    empty table gives an empty result. Other columns pass through untouched,
    also if they bear the names used here: inputs named ``shard``,
    ``grown_shard`` or ``slot`` are replaced.
    """
    docs = docs.drop("shard", "grown_shard", "slot")
    number = stable_key(F.col(key), dict(docs.dtypes)[key])
    parts = [F.col(key), *([F.col(text)] if text else [])]
    placed = docs.withColumn("__shard", jump_hash(number, shards)).withColumn("__grown", jump_hash(number, shards + 1)).withColumn("__block", F.pmod(F.xxhash64(*parts), F.lit(blocks)).cast("int"))
    counts = placed.groupBy("__shard", "__block").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy("__shard").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(F.col("__shard").alias("__s"), F.col("__block").alias("__b"), F.coalesce(F.sum("__rows").over(before), _long(0)).alias("__first"))
    order = Window.partitionBy("__shard", "__block").orderBy(*[p.asc_nulls_first() for p in parts])
    numbered = placed.withColumn("__at", F.row_number().over(order).cast("long") - _long(1))
    joined = numbered.join(F.broadcast(firsts), (F.col("__shard") == F.col("__s")) & (F.col("__block") == F.col("__b")))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("__shard").alias("shard"), (F.col("__at") + F.col("__first")).alias("slot"), F.col("__grown").alias("grown_shard"))
