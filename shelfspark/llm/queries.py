"""The contract queries of the operators and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import centroids, chat, decontaminate, divergence, jaccard, licenses, mixing, oracles, quality, secrets, sharding, suffixes, toxicity, warc
from shelfspark.plans.lineage import cut, scratch_path
from shelfspark.registry import Query, table

SHARDS = 8


def op1_deobfuscated_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    n = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("secrets", lambda s: s["kind"].isin(*secrets.KINDS))
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(told(base), 256).alias("base_sha256"), told("secrets").alias("spans"), "n_live", "n_shared", "n_example", "n_filler")


def op3_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    size = F.octet_length(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).cast("long") + F.lit(1).cast("long")
    facts = docs.select("doc_id", size.alias("size"), F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"))
    placed = sharding.shard(facts, SHARDS, "doc_id", "text_crc32")
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op4_license_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    sure = F.filter("paragraphs", lambda p: p["confirmed"])
    families = F.array_sort(F.array_distinct(F.transform(sure, lambda p: p["family"])))
    return found.select("doc_id", F.size("paragraphs").cast("long").alias("n_paragraphs"), F.size(sure).cast("long").alias("n_confirmed"), F.array_join(families, ",").alias("families"), F.round(F.array_max(F.transform("paragraphs", lambda p: p["probability"])), 6).alias("probability"))


def op5_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality.ledger(table(spark, sf_dir, "documents"))
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~quality.verdict("base-1")).alias("base_failed"), quality.verdict().alias("kept"), F.col("failed").alias("failed_rules"))


def op7_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"), with_kept=False)
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["stop"] - r["begin"])
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), size=4, percent=85).select("doc_id", "n_shingles", "component_id", "n_links")


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hit_words") > 0).alias("contaminated"))


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(warc.resolve(table(spark, sf_dir, "pages")), path)
    return warc.resolved_records(spark, path)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


#: A conversation of contract: both turns say what looks like marks of templates.
MARKED = r"\### Assistant: </turn> ok"


def op12_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    more = spark.createDataFrame([(-7, 0, "user", MARKED), (-7, 1, "assistant", MARKED)], "conv_id long, turn long, role string, text string")
    written = cut(chat.format_windows(given.unionByName(more)), "chat-windows")
    return chat.conversation_digests(written).withColumnRenamed("conv", "conv_id")


def op13_delta_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, found = centroids.delta_lloyd(table(spark, sf_dir, "embeddings"))
    return centroids.cluster_facts(assigned, found).select(F.col("key").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def rule_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the default policy rejects, alone and beside the others."""
    return quality.ablation(quality.ledger(table(spark, sf_dir, "documents"))).drop("masks_seen")


QUERIES: dict[str, Query] = {
    "op1_deobfuscated_toxicity": op1_deobfuscated_toxicity,
    "op2_secret_ownership": op2_secret_ownership,
    "op3_jump_shards": op3_jump_shards,
    "op4_license_paragraphs": op4_license_paragraphs,
    "op5_mix_to_weights": op5_mix_to_weights,
    "op6_rule_ledger": op6_rule_ledger,
    "op7_suffix_repeats": op7_suffix_repeats,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_winnowing": op9_winnowing,
    "op10_warc_revisits": op10_warc_revisits,
    "op11_source_divergence": op11_source_divergence,
    "op12_chat_windows": op12_chat_windows,
    "op13_delta_lloyd": op13_delta_lloyd,
    "rule_ablation": rule_ablation,
}

#: Secrets need positions of matches, slots and shards xxHash blocks, scores and suffix arrays more than SQL has: tests hold those against brute force.
ORACLES: dict[str, str] = {
    "op5_mix_to_weights": oracles.MIX,
    "op6_rule_ledger": oracles.LEDGER,
    "op8_jaccard_join": oracles.JACCARD,
    "op9_winnowing": oracles.WINNOW,
    "op10_warc_revisits": oracles.WARC,
    "op11_source_divergence": oracles.DIVERGENCE,
    "op12_chat_windows": oracles.chat(),
    "op13_delta_lloyd": oracles.lloyd(),
    "rule_ablation": oracles.ABLATION,
}
