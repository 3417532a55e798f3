"""Scoring of labelled cases: check maps, tallies, rates, export, samples and strict case files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.functions.formats import fixed1


def fails(checks: dict[str, Column]) -> Column:
    """Map of check -> reason of the checks that fail; a check is a reason or null."""
    return F.map_from_entries(failed(checks))


def failed(checks: dict[str, Column]) -> Column:
    """Array of (check, reason) of the checks that fail, by check."""
    pairs = F.array(*[F.struct(F.lit(n).alias("check"), c.cast("string").alias("reason")) for n, c in sorted(checks.items())])
    return F.filter(pairs, lambda p: p["reason"].isNotNull())


def passed(fail_map: Column) -> Column:
    return F.size(fail_map) == 0


def first_failure(fail_map: Column) -> Column:
    """All reasons in order of checks, joined; null if there are none."""
    return F.when(F.size(fail_map) > 0, F.array_join(F.transform(F.map_entries(fail_map), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "; "))


def check_counts(results: DataFrame, column: str = "fails") -> DataFrame:
    """(check, n): how many results fail each check."""
    return results.select(F.explode(F.map_keys(column)).alias("check")).groupBy("check").agg(F.count(F.lit(1)).alias("n"))


def by_tag(results: DataFrame, tags: str, passes: Column) -> DataFrame:
    """(tag, pass, total), a result once per distinct tag; no tag counts as untagged."""
    tagged = F.when(F.size(F.coalesce(F.col(tags), F.array().cast("array<string>"))) == 0, F.array(F.lit("untagged"))).otherwise(F.array_distinct(tags))
    return results.select(F.explode(tagged).alias("tag"), passes.alias("p")).groupBy("tag").agg(F.count_if(F.col("p")).alias("pass"), F.count(F.lit(1)).alias("total"))


def rate_text(n: Column, total: Column) -> Column:
    """`` 50.0% (1/2)``, or a dash without any."""
    return F.when(total == 0, "   -   (0)").otherwise(F.concat(F.lpad(fixed1(n * 100.0 / total), 5, " "), F.format_string("%% (%d/%d)", n, total)))


def trap_rewrite(results: DataFrame, replied: Column, wrong: Column, want_keep: Column, kept: Column) -> DataFrame:
    """Counts of wrong descriptions that were offered (traps) and kept, and of cases labelled keep (good) that were rewritten; missing replies don't count."""
    return results.agg(F.count_if(replied & wrong & kept).alias("trapped"), F.count_if(replied & wrong).alias("traps"), F.count_if(replied & want_keep & ~kept).alias("rewritten"), F.count_if(replied & want_keep).alias("good"))


def missed_extra(results: DataFrame, replied: Column, wanted: Column, given: Column) -> DataFrame:
    """Counts of warnings missed and of needless ones; results without a reply or without a label (``wanted`` null) don't count."""
    said = F.coalesce(given, F.lit(False))
    return results.agg(F.count_if(replied & wanted & ~said).alias("missed"), F.count_if(replied & wanted).alias("wanted"), F.count_if(replied & ~wanted & said).alias("extra"), F.count_if(replied & ~wanted).alias("unwanted"))


def repeats(cases: DataFrame, n: int) -> DataFrame:
    """Each case n times, with its run."""
    return cases.withColumn("run", F.explode(F.sequence(F.lit(1), F.lit(n))))


def chat_json(turns: DataFrame, key: str, order: str, system: str) -> DataFrame:
    """(key, json): one chat example per key with its turns in order."""
    turn = F.struct(order, F.struct("role", F.col("text").alias("content")).alias("m"))
    got = turns.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(turn)), lambda t: t["m"]).alias("messages"))
    return got.select(key, F.to_json(F.struct(F.concat(F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content"))), "messages").alias("messages"))).alias("json"))


def unknown_keys(raw: Column, allowed: list[str], path: str = "$") -> Column:
    """Keys of a JSON object that aren't allowed; reading JSON alone drops them without a word."""
    inner = raw if path == "$" else F.get_json_object(raw, path)
    return F.array_except(F.coalesce(F.json_object_keys(inner), F.array().cast("array<string>")), F.array(*[F.lit(a) for a in allowed]))


def read_cases(spark: SparkSession, paths: list[str], schema: T.StructType, key: str = "id", strict: bool = True) -> DataFrame:
    """JSON lines of one or more files, empty and // lines skipped.

    ``strict`` fails the job on a line that is no JSON object, on an unknown key
    and on an id that isn't unique over all files.
    """
    lines = spark.read.text(paths).select(F.trim("value").alias("raw"), F.col("_metadata.file_path").alias("file")).filter("raw <> '' AND NOT startswith(raw, '//')")
    got = lines.select("raw", "file", F.from_json("raw", schema, {"mode": "PERMISSIVE"}).alias("c"), unknown_keys(F.col("raw"), schema.fieldNames()).alias("odd"))
    if not strict:
        return got.filter(f"c.{key} IS NOT NULL").select("c.*")
    bad = F.when(F.json_object_keys("raw").isNull(), F.concat(F.lit("not a JSON object: "), F.left("raw", F.lit(80)))).when(F.size("odd") > 0, F.concat(F.lit("unknown key "), F.col("odd")[0])).when(F.col(f"c.{key}").isNull(), F.lit(f"no {key}"))
    n = got.groupBy(F.col(f"c.{key}").alias("__id")).agg(F.count(F.lit(1)).alias("__n"))
    checked = got.withColumn("c", F.when(bad.isNotNull(), F.raise_error(bad)).otherwise(F.col("c"))).join(n, F.col(f"c.{key}").eqNullSafe(F.col("__id")))
    return checked.select(F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit("id not unique: "), F.col(f"c.{key}")))).otherwise(F.col("c")).alias("c")).select("c.*")


def json_from_reply(reply: Column, schema: str) -> Column:
    """The JSON object inside a model's reply, fences and prose around it dropped; null if there is none."""
    return F.from_json(F.nullif(F.regexp_extract(reply, r"(?s)\{.*\}", 0), F.lit("")), schema, {"mode": "PERMISSIVE"})
