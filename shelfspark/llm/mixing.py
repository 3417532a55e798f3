"""Mixing sources to target weights with whole repeats and one hash-seeded copy.

Sizes are added up per source, each source gets a target by water-filling, the
target over the source's size is its repetition rate, and every document is
taken floor(rate) times plus once more with probability rate - floor(rate),
decided by a hash of seed and document. So that a source of few, unequal
documents meets its target too, the hash below which a copy is taken is the one
up to which sizes add up to what is wanted; it differs from the probability by
chance only. No state, no order: reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.plans.lineage import cut

#: A word is a run of anything but space and the ASCII controls \t to \r.
WORD = r"[^\x20\x09-\x0D]+"
#: The source table is broadcast up to this many sources; beyond, Spark joins as it sees fit.
BROADCAST_SOURCES = 20_000


def word_count(text: Column) -> Column:
    """Number of words of a whole text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


#: A draw has so many digits of so many bits.
DIGITS, DIGIT_BITS = 3, 16


def draw(seed: str, key: Column, text: Column) -> Column:
    """A number below 2^48 from a SHA-256 of seed and key (of the text where there is no key); equal inputs draw equally."""
    who = F.coalesce(key.cast("string"), F.sha2(text.cast("string"), 256), F.lit(""))
    return F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(seed), who), 256), 1, 12), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """(source, source_size, target) from (source, source_size): water-filling in closed form.

    Sources by code point (null last) weigh ``weights`` in turn and share
    ``share`` of all sizes; a target stops at ``most`` times its source's size
    and the excess goes to the others by weight until none is above. With the
    sources by size over weight, the ones that stop are a prefix: the first
    source whose cap exceeds its share of what the prefix before it leaves ends
    the prefix. One row per source passes here, never documents.
    """
    nth = Window.orderBy(F.col("source").asc_nulls_last())
    kinds = F.array(*[F.lit(w).cast("long") for w in weights])
    ranked = sizes.withColumn("weight", F.element_at(kinds, (F.pmod(F.row_number().over(nth) - 1, F.lit(len(weights))) + 1).cast("int")))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).partitionBy(F.lit(0))
    ranked = ranked.withColumn("total", F.sum("source_size").over(everything)).withColumn("all_weight", F.sum("weight").over(everything))
    by_fill = Window.orderBy((F.col("source_size").cast("double") / F.col("weight")).asc(), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("size_before", F.coalesce(F.sum("source_size").over(by_fill), F.lit(0).cast("long"))).withColumn("weight_before", F.coalesce(F.sum("weight").over(by_fill), F.lit(0).cast("long")))
    left = F.lit(share) * F.col("total") - F.lit(most) * F.col("size_before")
    level = left / (F.col("all_weight") - F.col("weight_before"))
    ranked = ranked.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") < F.lit(most) * F.col("source_size"))
    ranked = ranked.withColumn("fill", F.min(F.when(F.col("open"), F.struct((F.col("source_size").cast("double") / F.col("weight")).alias("a"), F.coalesce(F.col("source"), F.lit("\U0010ffff")).alias("b"), F.col("level").alias("level")))).over(everything)["level"])
    cap = (F.lit(most) * F.col("source_size")).cast("double")
    return ranked.select("source", "source_size", F.coalesce(F.least(F.col("fill") * F.col("weight"), cap), cap).alias("target"))


def _side(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_SOURCES else df


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with whole (copies that every row of the source gets) and below (rows that draw less get one more).

    ``sizes`` has (source, size, draw). A digit of the threshold at a time:
    sizes are added up by digit, and the digit in which the running sum reaches
    what is wanted is looked into. The rows of the last draw are taken if that
    brings the sum nearer. At most 2^16 sums a source pass here, no documents.
    """
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at = targets.withColumn("whole", F.floor(rate)).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")).withColumn("below", F.lit(0).cast("long"))
    for digit in range(DIGITS):
        shift = DIGIT_BITS * (DIGITS - 1 - digit)
        side = _side(at.select(F.col("source").alias("__source"), "rest", "below").filter("rest > 0"))
        inside = F.shiftright("draw", shift + DIGIT_BITS) == F.shiftright("below", shift + DIGIT_BITS)
        sums = sizes.join(side, F.col("source").eqNullSafe(F.col("__source")) & inside).groupBy("source", F.shiftright("draw", shift).alias("d")).agg(F.sum("size").alias("w"), F.first("rest").alias("rest"))
        so_far = Window.partitionBy("source").orderBy("d")
        met = sums.withColumn("upto", F.sum("w").over(so_far)).filter(F.col("upto") >= F.col("rest")).groupBy("source").agg(F.min_by(F.struct("d", "w", (F.col("rest") - F.col("upto") + F.col("w")).alias("rest")), "d").alias("m"))
        last = digit == DIGITS - 1
        begin = F.shiftleft("m.d", shift)
        found = met.select(F.col("source").alias("__source"), F.when(F.lit(last) & (2 * F.col("m.rest") >= F.col("m.w")), begin + 1).otherwise(begin).alias("__below"), F.when(F.lit(last), F.lit(0.0)).otherwise(F.col("m.rest")).alias("__rest"))
        at = cut(at.join(found, F.col("source").eqNullSafe(F.col("__source")), "left").select("source", "source_size", "target", "whole", F.coalesce("__rest", F.lit(0.0)).alias("rest"), F.when(F.col("__below").isNotNull(), F.col("__below")).when(F.col("rest") > 0, F.lit(1 << 48)).otherwise(F.col("below")).alias("below")), "mix-thresholds")
    return at.drop("rest")


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: str = "mix-1", key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per row of ``docs``: key, size, source, source_size, target, rate, copies, taken.

    ``copies`` is how often the mix has the row and ``taken`` is copies x size.
    No row is taken more than ``most`` times; the words taken of a source miss
    its target by no more than half the size of one document (or of those that
    share its key). Words are counted once, whatever the length of a text, and
    the narrow table of sizes is cut there, so sources are weighed and rows
    drawn without reading texts again. The draw hashes the key; a row without a
    key draws by its text. Null sources are one source, null and empty texts
    have size 0, sources of size 0 get target 0 and rate 0. Rows of equal keys,
    repeated ones too, draw equally. An empty table gives no rows, and other
    columns of ``docs`` are not looked at.
    """
    sizes = cut(docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").cast("string").alias("source"), word_count(F.col(f"`{text}`")).alias("size"), draw(seed, F.col(f"`{key}`"), F.col(f"`{text}`")).alias("draw")), "mix-sizes")
    targets = cut(source_targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "mix-targets")
    side = _side(thresholds(sizes, targets).withColumnRenamed("source", "__source"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = sizes.join(side, F.col("source").eqNullSafe(F.col("__source")), "left").withColumn("rate", rate)
    copies = (F.col("whole") + F.when(F.col("draw") < F.col("below"), 1).otherwise(0)).cast("long")
    return joined.withColumn("copies", copies).select(F.col("key").alias(key), "size", "source", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: str = "mix-1", key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: rows of ``docs`` with their own columns, whatever they are called, each as often as ``mix`` says.

    Targets and thresholds come from a narrow table of sizes and draws; each row
    then draws again where it is read, so texts are never shuffled to be
    repeated. Nulls, empty texts, ties and empty tables are as in ``mix``.
    """
    who, from_, words = F.col(f"`{key}`"), F.col(f"`{source}`").cast("string"), F.col(f"`{text}`")
    sizes = cut(docs.select(from_.alias("source"), word_count(words).alias("size"), draw(seed, who, words).alias("draw")), "mix-sizes")
    targets = cut(source_targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "mix-targets")
    side = _side(thresholds(sizes, targets).select(F.col("source").alias("__source"), "whole", "below"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), from_.alias("source"), draw(seed, who, words).alias("draw"))
    joined = rows.join(side, F.col("source").eqNullSafe(F.col("__source")), "left")
    copies = (F.col("whole") + F.when(F.col("draw") < F.col("below"), 1).otherwise(0)).cast("int")
    return joined.select("__row", F.explode(F.array_repeat(F.lit(1), copies)).alias("__copy")).select("__row.*")
