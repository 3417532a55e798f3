"""Queries of the readers and writers: files made from the tables are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.functions import text as tx
from shelfspark.operators import evals, facts, store
from shelfspark.plans.lineage import scratch_path
from shelfspark.registry import query, table
from shelfspark.sources import files, sqlite


def _lines(rows: DataFrame, name: str) -> str:
    """A text table of ``rows`` (value)."""
    path = scratch_path(rows.sparkSession, name)
    rows.select("value").write.text(path)
    return path


@query("relay_events_read", "SELECT event_id, user_id, event_type AS content, 'p' || user_id AS tag FROM events WHERE event_id % 3 = 1 AND event_type <> 'view'")
def relay_events_read(spark, sf_dir):
    """Events of one kind that say something, from JSON lines; tags are read by name, the first of a name."""
    e = table(spark, sf_dir, "events")
    text = lambda c: F.col(c).cast("string")
    tags = F.array(F.array(F.lit("e"), text("event_id")), F.array(F.lit("p"), F.concat(F.lit("p"), text("user_id"))), F.array(F.lit("p"), F.lit("second")))
    raw = F.to_json(F.struct((F.col("event_id") % 3).alias("kind"), text("user_id").alias("pubkey"), F.col("event_id").alias("created_at"), F.when(F.col("event_type") == "view", "  ").otherwise(F.col("event_type")).alias("content"), tags.alias("tags"), F.lit(1).alias("sig")))
    got = files.events(spark, _lines(e.select(raw.alias("value")), "relay"), 1)
    return got.select(F.col("created_at").alias("event_id"), F.col("pubkey").cast("long").alias("user_id"), "content", files.tag("p").alias("tag"))


# Fields hold commas, quotes and line ends; an order's lines are one text.
@query("csv_read_back", """WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'a, "' || l_partkey || '"' || chr(10) || 'b' AS a, l_returnflag AS b FROM lineitem)
SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS INTEGER) AS pos, a || '|' || b || '|' || CAST(l_suppkey AS VARCHAR) AS fields FROM f""")
def csv_read_back(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    first = F.concat(F.lit('a, "'), F.col("l_partkey").cast("string"), F.lit('"\nb'))
    line = facts.csv_minimal(first, F.col("l_returnflag"), F.col("l_suppkey").cast("string"))
    texts = li.select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", line.alias("line")).alias("r")).groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["line"]), "\n").alias("csv"))
    return files.csv_records(texts, "csv", "l_orderkey").select("l_orderkey", F.col("pos").cast("int").alias("pos"), F.array_join("record", "|").alias("fields"))


@query("git_refs_read", """SELECT l_orderkey AS repo, 'refs/tags/v' || l_linenumber AS ref, arg_max(CASE WHEN l_returnflag = 'R' THEN 'peeled' || l_partkey ELSE 'plain' || l_partkey END, (CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END, l_partkey)) AS sha FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_returnflag = 'R' ORDER BY l_partkey, l_suppkey) = 1) GROUP BY 1, 2""")
def git_refs_read(spark, sf_dir):
    """Listings of refs, a tag per line number, some of them peeled; a peeled tag's commit wins."""
    peeled = F.col("l_returnflag") == "R"
    li = table(spark, sf_dir, "lineitem").withColumn("n", F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber", peeled).orderBy("l_partkey", "l_suppkey"))).filter("n = 1")
    sha = F.concat(F.when(peeled, "peeled").otherwise("plain"), F.col("l_partkey").cast("string"))
    line = F.concat(sha, F.lit("\trefs/tags/v"), F.col("l_linenumber").cast("string"), F.when(peeled, "^{}").otherwise(""))
    raw = li.groupBy(F.col("l_orderkey").alias("repo")).agg(F.concat(F.array_join(F.collect_list(line), "\n"), F.lit("\nbroken\n")).alias("raw"))
    return files.git_refs(raw, "repo", "raw")


@query("sqlite_round_trip", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_mktsegment LIKE '%U%' AND c_custkey > 100")
def sqlite_round_trip(spark, sf_dir):
    """Customers written to an SQLite file in two writes, the second an upsert, and read with conditions that the database judges."""
    path = scratch_path(spark, "customers").removeprefix("file:")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("c_custkey"), F.col("c_mktsegment").cast("string").alias("c_mktsegment"), F.col("c_acctbal").cast("double").alias("c_acctbal"))
    sqlite.register(spark)
    store.make_folder(spark, path)
    for rows in (customers.withColumn("c_mktsegment", F.lit("NONE YET")), customers):
        rows.write.format("sqlite").mode("append").options(path=f"{path}/t.db", table="customer", key="c_custkey").save()
    return sqlite.read_table(spark, f"{path}/t.db", "customer", where=[("c_mktsegment", "contains", "U"), ("c_custkey", ">", 100)])


CASES = T.StructType([T.StructField("id", T.StringType()), T.StructField("split", T.StringType()), T.StructField("note", T.StringType())])


@query("eval_cases_read", "SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'dev' ELSE 'train' END AS split, o_orderpriority || ' // \"x\"' AS note FROM orders")
def eval_cases_read(spark, sf_dir):
    """Cases from two files with notes and empty lines between, every line checked and ids unique over both."""
    o = table(spark, sf_dir, "orders")
    split = F.when(F.col("o_orderkey") % 2 == 0, "dev").otherwise("train")
    raw = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("id"), split.alias("split"), F.concat("o_orderpriority", F.lit(' // "x"')).alias("note")))
    paths = [_lines(o.filter(F.col("o_orderkey") % 2 == k).select(F.explode(F.array(F.lit("// a note"), F.lit("  "), F.concat(F.lit(" "), raw))).alias("value")), "cases") for k in (0, 1)]
    return evals.read_cases(spark, paths, CASES)


@query("json_lines_written", "SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderstatus <> 'F'")
def json_lines_written(spark, sf_dir):
    """Distinct ids of JSON lines as the library writes them; lines without an id, or that are none, are passed over."""
    o = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "lines")
    rows = o.select(F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey").cast("string")).alias("id"), F.lit("<&> é").alias("text"))
    store.write_json_lines(rows.unionByName(rows.limit(50)), path)
    broken = spark.createDataFrame([("{",), ("no json",), ('{"id": ""}',), ("",)], "value string")
    return store.json_ids(store.read_lines(spark, path).unionByName(broken))


# What is not seen in a text, symbols in it, and its first bytes: whole documents.
_SEEN = "chr(173) || chr(8203) || chr(8204) || chr(8205) || chr(8288) || chr(65279)"


@query("text_rules", f"""WITH d AS (SELECT doc_id, coalesce(text, '') || chr(173) || ' x' || chr(8203) || 'y ' || chr(9731) || source AS t FROM documents)
SELECT doc_id, sha256(translate(t, {_SEEN}, '')) AS seen, sha256(regexp_replace(t, '[\\p{{So}}\\x{{FE0F}}]', ' ', 'g')) AS plain, CAST(len(list_filter(list_transform(regexp_split_to_array(regexp_replace(t, '([.!?]) ', '\\1' || chr(1) || ' ', 'g'), chr(1)), lambda s: trim(s, ' ')), lambda s: s <> '')) AS INTEGER) AS sentences, upper(substring(t, 1, 1)) || substring(t, 2, 9) AS head FROM d""")
def text_rules(spark, sf_dir):
    t = F.concat(F.coalesce("text", F.lit("")), F.lit("­ x​y ☃"), "source")
    d = table(spark, sf_dir, "documents").select("doc_id", t.alias("t"))
    return d.select("doc_id", F.sha2(tx.visible(F.col("t")), 256).alias("seen"), F.sha2(tx.drop_symbols(F.col("t")), 256).alias("plain"), F.size(tx.sentences(F.col("t"))).alias("sentences"), F.substring(tx.capitalize(F.col("t")), 1, 10).alias("head"))
