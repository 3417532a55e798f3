"""A training corpus from documents: quality rules, near duplicates, benchmark leaks, source weights, shards.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; ``run`` writes every stage's result to the shared folder and reads it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import decontaminate, jaccard, mixing, quality, sharding
from shelfspark.plans.lineage import cut
from shelfspark.registry import table

SHARDS = 8


def _rows(docs: DataFrame) -> DataFrame:
    """The rows as they are in one column, beside their text: whatever their columns are called, nothing clashes."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("text"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the default policy rejects, columns untouched whatever they are called.

    Null and empty texts have no words and go. Repeated rows stay or go
    together, each counted as a row; texts of any length are measured whole. An
    empty table gives an empty one.
    """
    return quality.ledger(_rows(docs), keep=("__row",)).filter(quality.verdict()).select("__row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a Jaccard similarity of 0.8 or more, columns untouched.

    Of a group the least doc_id stays, rows without one come last; of rows equal
    in doc_id and text one stays, the least by its columns. Documents without
    words link with nothing and stay. Texts of any length are read whole; an
    empty table gives an empty one.
    """
    return jaccard.keep_one(docs, size=5, percent=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item, columns untouched.

    Null and empty texts hold none and stay; repeated rows stay or go together.
    An empty benchmark takes nothing away, an empty table gives an empty one.
    """
    found = decontaminate.find_benchmark(_rows(docs), table(spark, sf_dir, "benchmark"), keep=("__row",))
    return found.filter(F.size("hit_words") == 0).select("__row.*")


def source_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, none, once or twice, columns untouched.

    Null sources are one source. Documents without words have size 0; they are
    taken as their draw says, and count for nothing. Repeated rows draw equally.
    An empty table gives an empty one.
    """
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard, slot, and the shard it would be in with one more; columns of those names are replaced.

    A null doc_id is key 0. Copies of a document follow each other in one
    shard's slots. An empty table gives an empty one.
    """
    return sharding.shard(docs, SHARDS, text=None)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("mixing to target weights", source_weights),
    ("sharding", shards),
]

#: Components of a similarity graph and its hashes don't go into one SQL statement; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
