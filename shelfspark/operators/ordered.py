"""Operators that hang on an order: keep-first, latest, budgets, caps, frames, islands, eviction, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """The row of least ``pos`` of each key, by one aggregate instead of a sort per key."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min(F.struct(F.col(pos).alias("__pos"), *[F.col(c) for c in rest])).alias("__best"))
    return best.select(*[F.col(k) if k in keys else F.col(f"__best.{k}") for k in df.columns])


def latest(df: DataFrame, key: str, at: str, pos: str) -> DataFrame:
    """The newest row of each key; of equally new ones the first by ``pos``."""
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct((-F.unix_micros(F.col(at).cast("timestamp"))).alias("a"), F.col(pos))).alias("b"))
    return best.select(key, *[F.col(f"b.{c}") for c in rest])


def content_hash(*columns: str) -> Column:
    """SHA-256 over byte length, NUL and bytes of each column in turn; null is empty."""
    parts = []
    for c in columns:
        x = F.coalesce(F.col(c), F.lit(""))
        parts += [F.octet_length(x).cast("string"), F.lit("\0"), x]
    return F.sha2(F.concat(*parts), 256)


def budget_prefix(df: DataFrame, keys: list[str], order: list, size: Column, most: int, including: bool = False, first_anyway: bool = False) -> DataFrame:
    """Rows of each key in order while the sizes before them (or with them, ``including``) don't exceed the budget."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if including else -1)
    used = F.coalesce(F.sum(size).over(w), F.lit(0))
    keep = used <= most
    if first_anyway:
        keep = keep | (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1)
    return df.withColumn("__keep", keep).filter("__keep").drop("__keep")


def cap_then_limit(df: DataFrame, keys: list[str], order: list[str], per_key: int, overall: int) -> DataFrame:
    """The first ``per_key`` of each key, and of those the first ``overall``."""
    capped = df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("__n") <= per_key).drop("__n")
    return capped.orderBy(*order).limit(overall)


def frame(df: DataFrame, keys: list[str], line: str, value: str, before: int, after: int, name: str = "context", only: Column | None = None) -> DataFrame:
    """Each row with the values of the rows around it; of those only where ``only`` holds, the frame counts all."""
    w = Window.partitionBy(*keys).orderBy(line).rowsBetween(-before, after)
    pair = F.struct(line, value)
    return df.withColumn(name, F.collect_list(pair if only is None else F.when(only, pair)).over(w))


def islands(df: DataFrame, keys: list[str], begin: str, stop: str, most: int | None = None) -> DataFrame:
    """Overlapping or touching spans of a key as one: (keys, begin, stop), spans kept under ``most`` long where given."""
    w = Window.partitionBy(*keys).orderBy(begin, stop)
    reach = F.max(stop).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = df.withColumn("__new", F.when(reach.isNull() | (F.col(begin) > reach), 1).otherwise(0)).withColumn("__island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = new.groupBy(*keys, "__island").agg(F.min(begin).alias(begin), F.max(stop).alias(stop)).drop("__island")
    return out if most is None else out.withColumn(stop, F.least(F.col(stop), F.col(begin) + most))


def evict(df: DataFrame, keys: list[str], used: str, size: str, most_bytes: int, oldest: int, tie: str | None = None, broken: str | None = None, grace: int | None = None) -> DataFrame:
    """``evicted``: last used before ``oldest``, or beyond the budget when counted from the most recently used.

    Of rows used at once those of lesser ``tie`` go first. Rows that are
    ``broken`` have no size; they go if last used before ``grace``.
    """
    bad = F.coalesce(F.col(broken), F.lit(False)) if broken else F.lit(False)
    order = [F.col(used).desc(), *([F.col(tie).desc()] if tie else [])]
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(F.when(bad, 0).otherwise(F.col(size))).over(w)
    whole = (F.col(used) < oldest) | (total > most_bytes)
    return df.withColumn("evicted", F.when(bad, F.col(used) < (oldest if grace is None else grace)).otherwise(whole))


def spread_sample(df: DataFrame, key: str, n: int, salt: str = "") -> DataFrame:
    """The n rows whose salted SHA-256 is least, ranked: the same on every run, and a larger n keeps the smaller's rows."""
    h = F.sha2(F.concat(F.lit(salt), F.col(key).cast("string")), 256)
    top = df.withColumn("__h", h).orderBy("__h").limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy("__h"))).drop("__h")


def nearest_within(left: DataFrame, right: DataFrame, keys: list[str], at: str, reach: int, id_col: str) -> DataFrame:
    """For each left row the nearest right row of its key within ``reach``, on a tie the earlier, of equally early ones the least id.

    ``at`` is a whole number; null keys meet nothing. One sort of both sides together instead of a range
    join: the nearest is the last one before or the first one after.
    """
    both = left.select(*keys, at, F.col(id_col).alias("l"), F.lit(None).cast("long").alias("r")).unionByName(right.select(*keys, at, F.lit(None).cast("long").alias("l"), F.col(id_col).alias("r")).na.drop(subset=[*keys, at]))
    s = F.when(F.col("r").isNotNull(), F.struct(F.col(at).alias("t"), F.col("r").alias("id")))
    back = F.last(s, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(at, F.col("r").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(s, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(at, F.col("r").asc_nulls_first()).rowsBetween(0, Window.unboundedFollowing))
    found = both.withColumn("b", back).withColumn("f", ahead).filter("l IS NOT NULL")
    to_b, to_f = F.col(at) - F.col("b.t"), F.col("f.t") - F.col(at)
    use_b = F.col("b").isNotNull() & (F.col("f").isNull() | (to_b <= to_f))
    best, gap = F.when(use_b, F.col("b.id")).otherwise(F.col("f.id")), F.when(use_b, to_b).otherwise(to_f)
    return found.select(*keys, F.col("l").alias(id_col), F.when(gap <= reach, best).alias("match"))


def asof(left: DataFrame, right: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """Each left row with the last right value at or before it: union and one window, no range join."""
    names = left.columns
    both = left.withColumn("__v", F.lit(None).cast(right.schema[value].dataType)).withColumn("__side", F.lit(1)).unionByName(right.select(*keys, at, F.col(value).alias("__v")).withColumn("__side", F.lit(0)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(at, "__side").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value, F.last("__v", ignorenulls=True).over(w)).filter("__side = 1").select(*names, value)
