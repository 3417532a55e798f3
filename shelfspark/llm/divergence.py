"""Source divergence audit: how far the word shares of sources lie apart, and which words set one off.

Words are counted per language and source, and each language keeps the terms
that enough of its documents hold. The term counts of a group (a source in a
language) are cut by term into pieces of a bounded size, since a divergence is a
sum over terms. Pieces of some groups form a block that stays in its partition.
In a round-robin tournament each block meets every other one once: per round one
of the two travels, compressed, to where the other lies, and a meeting gives the
divergence both ways. Terms are ranked by a heap in each piece.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm import text as tx
from shelfspark.plans.lineage import cut, scratch_path

LEAST_DOCUMENTS, TOP = 10, 10
#: Shares are whole billionths.
UNIT = 1_000_000_000
#: Terms a piece holds, and groups a block holds, on average.
PIECE_TERMS, BLOCK_GROUPS = 1 << 16, 16
#: Words are counted in slices of about so many bytes.
COUNT_BYTES = 16 << 20

#: Term bytes: ASCII letters and all non-ASCII.
LETTERS = np.ones(256, bool)
LETTERS[0x00:0x41] = LETTERS[0x5B:0x61] = LETTERS[0x7B:0x80] = False


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    spread = tx.LOWER[data[tx.ranges(starts, ends - starts)]]
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(spread.tobytes())]).cast(pa.string())


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) a slice of rows, and (lang, source, null, 0, rows) for each group in it."""
    names = ["lang", "source", "term", "n", "docs"]
    for batch in batches:
        for part, data, at in tx.slices(batch, "text", COUNT_BYTES):
            lang, source = (tx.as_array(part.column(k)).dictionary_encode() for k in (0, 1))
            group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
            there, rows = np.unique(group, return_counts=True)
            say = lambda codes: [lang.dictionary.take(pa.array(codes // len(source.dictionary))), source.dictionary.take(pa.array(codes % len(source.dictionary)))]  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([*say(there), pa.nulls(len(there), pa.string()), pa.array(np.zeros(len(there), np.int64)), pa.array(rows)], names=names)
            starts, ends, first = tx.word_bounds(data, at, LETTERS)
            word, row = tx.span_hashes(data, starts, ends, tx.byte_values(True)), tx.row_of(first)
            mine = tx.mix(word ^ tx.mix(group[row].astype(np.uint64) + np.uint64(1)))
            keys, at_first, n = np.unique(mine, return_index=True, return_counts=True)
            _, once = np.unique(tx.mix(word ^ tx.mix(row.astype(np.uint64) + np.uint64(1))), return_index=True)
            docs = np.bincount(np.searchsorted(keys, mine[once]), minlength=len(keys))
            yield pa.RecordBatch.from_arrays([*say(group[row[at_first]]), _strings(data, starts[at_first], ends[at_first]), pa.array(n), pa.array(docs)], names=names)


def shares(counts: np.ndarray, whole: int) -> np.ndarray:
    """1 + floor(UNIT * (count + 2) / whole), exactly: three decimal digits of the quotient at a time."""
    rest = counts.astype(np.int64) + 2
    out = rest // whole
    for _ in range(3):
        rest = rest % whole * 1000
        out = out * 1000 + rest // whole
    return out + 1


def apart(p: np.ndarray | int, q: np.ndarray | int) -> np.ndarray | int:
    return (p - q) * (p - q) // (p + q)


def _packed(index: np.ndarray, counts: np.ndarray) -> bytes:
    return zlib.compress(np.diff(index, prepend=0).astype("<i4").tobytes() + counts.astype("<i8").tobytes(), 1)


class Piece:
    """Shares of the terms of a group that lie in one piece; the rest of the piece's terms have share ``none``."""

    def __init__(self, row: dict):
        raw = zlib.decompress(row["packed"])
        n = len(raw) // 12
        whole = row["words"] + 2 * row["terms"]
        self.source = row["source"]
        self.index = np.cumsum(np.frombuffer(raw, "<i4", n).astype(np.int64))
        self.p = shares(np.frombuffer(raw, "<i8", n, n * 4), whole) if whole else np.zeros(0, np.int64)
        self.none = int(shares(np.zeros(1, np.int64), whole)[0]) if whole else 1


def _meet(stay: list[Piece], come: list[Piece] | None, size: int) -> Iterator[tuple[str, str, int]]:
    """(source, item, value) of all pairs, both ways; without ``come``, of the pairs among ``stay``."""
    here, held = np.zeros(size, np.int64), np.zeros(size, bool)
    for k, a in enumerate(stay):
        here[:] = a.none
        here[a.index], held[a.index] = a.p, True
        for b in stay[k + 1 :] if come is None else come:
            shared = b.index[held[b.index]]
            value = int(apart(here[b.index], b.p).sum()) + int(apart(a.p, b.none).sum()) - int(apart(here[shared], b.none).sum())
            value += (size - len(a.index) - len(b.index) + len(shared)) * int(apart(a.none, b.none))
            yield a.source, b.source, value
            yield b.source, a.source, value
        held[a.index] = False


_PAIRS = "lang string, source string, item string, value long"


def _pairs(stay: pa.Table, come: pa.Table | None) -> pa.Table:
    rows = stay.to_pylist()
    peers = None if come is None else [Piece(r) for r in come.to_pylist()]
    found = list(_meet([Piece(r) for r in rows], peers, rows[0]["size"])) if rows and peers != [] else []
    source, item, value = zip(*found, strict=True) if found else ((), (), ())
    return pa.table({"lang": pa.array([rows[0]["lang"]] * len(found) if rows else [], pa.string()), "source": pa.array(source, pa.string()), "item": pa.array(item, pa.string()), "value": pa.array(value, pa.int64())})


def _pack(top: int):
    """Packed counts of each piece, and its best terms by a heap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed, best = [], []
            for r in batch.select(["held", "words", "terms", "lang_words"]).to_pylist():
                held = sorted(r["held"] or [], key=lambda h: h["index"])
                counts = np.array([h["n"] for h in held], np.int64)
                packed.append(_packed(np.array([h["index"] for h in held], np.int64), counts))
                if held:
                    p = shares(counts, r["words"] + 2 * r["terms"])
                    q = shares(np.array([h["lang_n"] for h in held], np.int64), r["lang_words"] + 2 * r["terms"])
                    above = np.flatnonzero(p > q).tolist()
                    value = apart(p, q).tolist()
                    best.append([{"value": value[k], "term": held[k]["term"]} for k in heapq.nsmallest(top, above, key=lambda k: (-value[k], held[k]["term"].encode()))])  # noqa: B023
                else:
                    best.append([])
            keep = [batch.schema.get_field_index(c) for c in ("lang", "source", "piece", "block", "blocks", "words", "terms", "size")]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], pa.array(packed, pa.binary()), pa.array(best, pa.list_(pa.struct([("value", pa.int64()), ("term", pa.string())])))], names=["lang", "source", "piece", "block", "blocks", "words", "terms", "size", "packed", "best"])

    return run


def peer(block: Column, blocks: Column, turn: int) -> Column:
    """The block met in round ``turn`` of a tournament by the circle method; with an odd number one block meets none (null)."""
    last = blocks + F.pmod(blocks, F.lit(2)) - 1
    across = F.pmod(F.lit(2 * turn) - block, last)
    met = F.when(block == last, F.lit(turn)).when(across == block, last).otherwise(across)
    return F.when((met < blocks) & (F.lit(turn) < last), met)


def _tournament(pieces: DataFrame) -> DataFrame:
    """(lang, source, item, value) a piece and pair, one written table after all rounds."""
    spark = pieces.sparkSession
    path = scratch_path(spark, "divergence-pairs")
    place = ["lang", "piece", "block"]
    lying = pieces.drop("best").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *place).persist()
    try:
        lying.groupBy(*place).applyInArrow(lambda t: _pairs(t, None), _PAIRS).write.parquet(path)
        most = pieces.agg(F.max("blocks")).first()[0] or 0
        for turn in range(most + most % 2 - 1 if most > 1 else 0):
            met = lying.withColumn("__met", peer(F.col("block"), F.col("blocks"), turn)).filter("__met IS NOT NULL")
            lower = F.least("block", "__met")
            met = met.withColumn("__host", F.when(F.pmod(F.col("block") + F.col("__met"), F.lit(2)) == 0, lower).otherwise(F.greatest("block", "__met")))
            stay = met.filter("block = __host").drop("__met", "__host")
            come = met.filter("block <> __host").withColumn("block", F.col("__host")).drop("__met", "__host")
            stay.groupBy(*place).cogroup(come.groupBy(*place)).applyInArrow(_pairs, _PAIRS).write.mode("append").parquet(path)
    finally:
        lying.unpersist()
    return spark.read.schema(_PAIRS).parquet(path)


def audit_sources(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCUMENTS, top: int = TOP, piece_terms: int = PIECE_TERMS, block_groups: int = BLOCK_GROUPS) -> DataFrame:
    """(lang, source, part, item, value, rank): every other source of a language, and the terms a source has most above it.

    A term is a run of ASCII letters and non-ASCII, A-Z lowered. A language
    keeps the terms that ``least`` or more of its rows hold, V of them; N is the
    sum of a group's counts over those, its share of a term
    p = 1 + floor(10^9 (count + 2) / (N + 2 V)), and two shares are
    floor((p - q)^2 / (p + q)) apart. Part ``pair`` has the sum over all kept
    terms to each other source of the language (0 where V is 0), part ``term``
    the ``top`` terms of the group whose share exceeds the language's. Ranks go
    by value, falling, then item by bytes.

    Null text, lang and source are empty; a group without terms takes part like
    any other. Texts are read whole, a repeated row counts again, an empty table
    gives no rows, other columns are not looked at. Integers are exact while the
    words of a group number less than 9 * 10^15. Words are told apart by their
    bytes; only inside one slice of rows by 64-bit hashes. What grows with the
    corpus goes through Spark's aggregates: words are summed where they are
    read, so a source that holds a third of all rows sends no more than any
    other; no piece holds more than about ``piece_terms`` terms, no block more
    than about ``block_groups`` groups. One job a round, its results written, so
    that the disk holds one travelling copy at a time.
    """
    plain = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))]
    read = docs.select(*plain).mapInArrow(_count_words, "lang string, source string, term string, n long, docs long")
    counts = cut(read.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-counts")
    kept = cut(counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= least).drop("docs"), "divergence-terms")
    groups = counts.filter("term IS NULL").select("lang", "source")
    size = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_words"))
    many = lambda n, each: F.greatest(F.ceil(n / F.lit(each)), F.lit(1)).cast("int")
    langs = cut(groups.groupBy("lang").agg(many(F.count(F.lit(1)), block_groups).alias("blocks")).join(size, "lang", "left").select("lang", "blocks", F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("lang_words", F.lit(0)).alias("lang_words")).withColumn("pieces", many(F.col("terms"), piece_terms)), "divergence-langs")
    nth = Window.partitionBy("lang", "piece").orderBy("term")
    placed = kept.join(langs.select("lang", "pieces"), "lang").withColumn("piece", F.pmod(F.xxhash64("term"), F.col("pieces")).cast("int")).drop("pieces").withColumn("index", (F.row_number().over(nth) - 1))
    placed = cut(placed, "divergence-places")
    held = cut(counts.select("lang", "source", "term", "n").join(placed, ["lang", "term"]), "divergence-held")
    words = held.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    sizes = placed.groupBy("lang", "piece").agg(F.count(F.lit(1)).cast("int").alias("size"))
    frame = groups.join(langs, "lang").join(words, ["lang", "source"], "left").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    frame = frame.withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")).join(sizes, ["lang", "piece"], "left")
    gathered = held.groupBy("lang", "source", "piece").agg(F.collect_list(F.struct("index", "n", "lang_n", "term")).alias("held"))
    full = frame.join(gathered, ["lang", "source", "piece"], "left").select("lang", "source", "piece", "block", "blocks", F.coalesce("words", F.lit(0)).cast("long").alias("words"), "terms", F.coalesce("size", F.lit(0)).alias("size"), "lang_words", "held")
    pieces = cut(full.mapInArrow(_pack(top), "lang string, source string, piece int, block int, blocks int, words long, terms long, size int, packed binary, best array<struct<value: long, term: string>>"), "divergence-pieces")
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = _tournament(pieces).groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(by_value))
    best = pieces.select("lang", "source", F.inline("best")).withColumnRenamed("term", "item").withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)
    say = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
    return say(pairs, "pair").unionByName(say(best, "term"))
