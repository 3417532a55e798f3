"""Library corpora and tracker rules from JSON, line by line or in one document.

A line that is no object, or has another kind of value where a text, a number or
a list of texts is asked for, is left out and counted. Names of fields are told
without regard to case. Where two lines say the same path, the later one holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.operators import packages

#: Kinds of values, by what Spark calls the schema of one.
_KINDS = {"string": "STRING", "int": "BIGINT", "array<string>": "ARRAY<STRING>"}


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, begin, nth, line): ``(file, begin, nth)`` orders the lines as they stand, however files are cut into partitions."""
    text = spark.read.text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), F.monotonically_increasing_id().alias("nth"), F.col("value").alias("line"))


def _called(name: str) -> Callable[[Column], Column]:
    return lambda e: e["name"] == name


def parsed_lines(lines: DataFrame, fields: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of JSON lines (file, begin, nth, line): the fields by name, and (reason, n).

    A field that is missing or null is empty. ``rejected`` counts lines that are
    no JSON object and lines with a value of another kind; empty lines are
    neither read nor counted. Of fields whose names differ by case the last by
    name is taken.
    """
    parsed = lines.filter(F.trim("line") != "").withColumn("__v", F.try_parse_json("line"))
    members = F.from_json(F.when(F.schema_of_variant("__v").startswith("OBJECT"), F.to_json("__v")), "map<string, variant>")
    named = F.transform(F.map_entries(members), lambda e: F.struct(F.lower(e["key"]).alias("name"), e["value"].alias("value")))
    parsed = parsed.withColumn("__f", named)
    for name in fields:
        held = F.filter("__f", _called(name))
        parsed = parsed.withColumn(f"__{name}", F.when(F.size(held) > 0, F.element_at(held, -1)["value"]))
    told = lambda name: F.coalesce(F.schema_of_variant(f"__{name}"), F.lit("VOID"))
    right = F.lit(True)
    for name, kind in fields.items():
        right = right & told(name).isin(_KINDS[kind], "VOID", *(["ARRAY<VOID>"] if kind.startswith("array") else []))
    judged = parsed.withColumn("reason", F.when(F.col("__f").isNull(), "no object").when(~right, "other kind of value"))
    empty = {"string": F.lit(""), "int": F.lit(0), "array<string>": F.array().cast("array<string>")}
    rows = judged.filter("reason IS NULL").select("file", "begin", "nth", *[F.coalesce(F.try_variant_get(f"__{n}", "$", kind), empty[kind]).alias(n) for n, kind in fields.items()])
    return rows, judged.filter("reason IS NOT NULL").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def library_corpus(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """((id, path, name, type), rejected) of a corpus of library paths; paths without a leading slash, and the one of the template, are left out."""
    rows, rejected = parsed_lines(numbered_lines(spark, path), {"id": "string", "path": "string", "name": "string", "type": "string"})
    usable = rows.filter(F.col("path").startswith("/") & (F.col("path") != "/PathToLookFor"))
    last = usable.groupBy("path").agg(F.max_by(F.struct("id", "name", "type"), F.struct("file", "begin", "nth")).alias("l"))
    return last.select("l.id", "path", "l.name", "l.type"), rejected


def library_details(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """((id, emphasize, anti), rejected) of what is said of libraries; lines without an id are left out, the last of an id holds."""
    rows, rejected = parsed_lines(numbered_lines(spark, path), {"id": "string", "emphasize": "int", "anti": "array<string>"})
    last = rows.filter("id <> ''").groupBy("id").agg(F.max_by(F.struct("emphasize", "anti"), F.struct("file", "begin", "nth")).alias("l"))
    return last.select("id", F.col("l.emphasize").cast("int").alias("emphasize"), "l.anti"), rejected


@F.pandas_udf(T.BooleanType())
def _compiles(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    nothing = pa.array([""])
    for patterns in batches:
        found = []
        for p in patterns:
            try:
                pc.match_substring_regex(nothing, p)
                found.append(True)
            except (pa.ArrowInvalid, TypeError):
                found.append(False)
        yield pd.Series(found, dtype=bool)


def compiles(pattern: Column) -> Column:
    """Is this a pattern that RE2 takes?"""
    return _compiles(pattern)


def tracker_rules(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """((name, code, path, type, anti), rejected) of a document of trackers, by name: ``trackers`` has an object for each.

    Signatures of three bytes or fewer say too little and are left out;
    ``rejected`` has (name, code) of those that do not compile. Two rules of one
    name are both kept. A document that is no JSON has no rules.
    """
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "trackers map<string, struct<name: string, code_signature: string, categories: array<string>>>").alias("d"))
    each = whole.select(F.explode("d.trackers").alias("id", "t")).select(F.coalesce("t.name", F.lit("")).alias("name"), F.trim(F.coalesce("t.code_signature", F.lit(""))).alias("code"), F.coalesce("t.categories", F.array().cast("array<string>")).alias("categories"))
    judged = each.filter(F.octet_length("code") > 3).withColumn("good", compiles(F.col("code")))
    rules = judged.filter("good").select("name", "code", packages.signature_path(F.col("code")).alias("path"), packages.tracker_type(F.col("categories")).alias("type"), packages.tracker_anti(F.col("categories")).alias("anti"))
    return rules, judged.filter("NOT good").select("name", "code")
