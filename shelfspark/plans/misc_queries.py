"""Queries over smaller rules: keys in order, path ranks, carried flags, masked means, evictions with broken trees, frames of code, clips, old documents, equality, case selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.functions import formats, vectors
from shelfspark.operators import digest, listing, ordered, quotes, scan, scoring, store, trees
from shelfspark.plans.quote_queries import _ROWS, _rows
from shelfspark.plans.reply_queries import _pick
from shelfspark.plans.scan_queries import _list
from shelfspark.functions import table_functions
from shelfspark.registry import query, table


@query("keys_in_order", "SELECT c_custkey AS id FROM customer WHERE c_custkey % 2 = 0 ORDER BY id")
def keys_in_order(spark, sf_dir):
    return store.all_keys(table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id")), "id")


RANKED = ["LICENSE", "app/build.gradle", "app/src/main/A.kt", "src/main/B.kt", "x/src/main/C.kt", "lib/d.dart", "docs/e.md", "tools/pubspec.yaml"]


@query("path_ranks", f"SELECT doc_id, [0, 0, 1, 2, 1, 1, 2, 0][doc_id % 8 + 1] AS rank FROM (SELECT doc_id, {_list(RANKED)}[doc_id % 8 + 1] AS path FROM documents)")
def path_ranks(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", digest.path_rank(_pick(RANKED, F.col("doc_id") % 8)).alias("rank"))


@query("first_tree_files", f"WITH f AS (SELECT doc_id, source AS tree_id, {_list(RANKED)}[doc_id % 8 + 1] || lpad(CAST(doc_id AS VARCHAR), 8, '0') AS path, [0, 2, 1, 2, 1, 1, 2, 2][doc_id % 8 + 1] AS rank FROM documents) SELECT doc_id FROM (SELECT *, row_number() OVER (PARTITION BY tree_id ORDER BY rank, path) AS n FROM f) WHERE n <= 20")
def first_tree_files(spark, sf_dir):
    """Names are made longer than those of build files and endings, so only the root's count first."""
    path = F.concat(_pick(RANKED, F.col("doc_id") % 8), F.lpad(F.col("doc_id").cast("string"), 8, "0"))
    f = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("tree_id"), path.alias("path"), F.when(F.col("doc_id") % 8 == 1, 2).otherwise(digest.path_rank(path)).alias("r"))
    return trees.first_files(f, F.col("r"), most=20).select("doc_id")


@query("carried_flags", "WITH now AS (SELECT DISTINCT user_id AS app_id, 'no_english' AS id FROM events WHERE user_id % 2 = 0), old AS (SELECT DISTINCT user_id AS app_id, ['source_mismatch', 'no_english'][event_id % 2 + 1] AS id FROM events) SELECT * FROM now UNION SELECT * FROM old WHERE id = 'source_mismatch' AND app_id % 3 <> 0")
def carried_flags(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    u = F.col("user_id")
    now = e.filter(u % 2 == 0).select(u.alias("app_id"), F.lit("no_english").alias("id")).distinct()
    old = e.select(u.alias("app_id"), _pick(["source_mismatch", "no_english"], F.col("event_id") % 2).alias("id")).distinct()
    return listing.carry_flags(now, old, e.filter(u % 3 == 0).select(u.alias("app_id")).distinct())


@query("masked_means", "WITH q AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(greatest(-127, least(127, round(CAST(x AS DOUBLE) / (0.3::DOUBLE / 127)))) AS INTEGER)) AS v FROM embeddings) SELECT vec_id % 50 AS label, CAST(pos AS INTEGER) AS pos, round(avg(CAST(e AS DOUBLE)) FILTER (m), 3) AS mean FROM (SELECT vec_id, unnest(v) AS e, unnest(range(0, 64)) AS pos, (vec_id // 50) % 3 <> 0 AS m FROM q) GROUP BY 1, 2")
def masked_means(spark, sf_dir):
    """Over byte vectors, whose sums are exact."""
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.transform(vectors.quantize(F.col("embedding")), lambda x: x.cast("float")).alias("v"))
    g = v.groupBy((F.col("vec_id") % 50).alias("label")).agg(F.array_sort(F.collect_list(F.struct("vec_id", "v"))).alias("t"))
    mean = vectors.masked_mean(F.transform("t", lambda t: t["v"]), F.transform("t", lambda t: F.when(F.floor(t["vec_id"] / 50) % 3 != 0, 1).otherwise(0)))
    return g.select("label", F.posexplode(mean).alias("pos", "x")).select("label", "pos", F.round(F.col("x").cast("double"), 3).alias("mean"))


@query("tree_evictions", "WITH t AS (SELECT doc_id, source, n_chars, doc_id // 5 AS used, doc_id % 7 = 0 AS broken FROM documents) SELECT doc_id, CASE WHEN broken THEN used < 20 ELSE used < 4 OR sum(CASE WHEN broken THEN 0 ELSE n_chars END) OVER (PARTITION BY source ORDER BY used DESC, doc_id DESC ROWS UNBOUNDED PRECEDING) > 40000 END AS evicted FROM t")
def tree_evictions(spark, sf_dir):
    k = F.col("doc_id")
    t = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", F.floor(k / 5).alias("used"), (k % 7 == 0).alias("broken"))
    return ordered.evict(t, ["source"], "used", "n_chars", 40_000, 4, "doc_id", "broken", 20).select("doc_id", "evicted")


@query("code_frames", f"WITH {_ROWS}, l AS (SELECT tree_id, line, text, regexp_matches(text, '[^\\x00-\\x20{{}}()\\[\\],;:]') AS code FROM r) SELECT tree_id, line, CAST(sum(CASE WHEN code THEN 1 ELSE 0 END) OVER (PARTITION BY tree_id ORDER BY line ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING) AS BIGINT) AS n FROM l")
def code_frames(spark, sf_dir):
    f = ordered.frame(_rows(spark, sf_dir), ["tree_id"], "line", "text", 1, 2, only=quotes.is_code(F.col("text")))
    return f.select("tree_id", "line", F.size("context").cast("long").alias("n"))


@query("clipped_notes", "SELECT doc_id, CASE WHEN strlen(text) <= 90 THEN text ELSE '' END AS short, strlen(text) > 90 AS clipped FROM documents")
def clipped_notes(spark, sf_dir):
    note = formats.clip_note(F.array("text"), 90)
    whole = F.octet_length("text") <= 90
    return table(spark, sf_dir, "documents").select("doc_id", F.when(whole, note).otherwise(F.when(F.col("text").startswith(note) & F.octet_length(note).between(87, 90), "").otherwise("wrong")).alias("short"), (note != F.col("text")).alias("clipped"))


OLD = ['"ads","yes",""\n---\nCAMERA, READ_SMS\n---\nA note.\n\nMore.', 'no document\n---\nx\n---\ny', '"ads","no",""\n---\n', '  "google_services","no",""\n"offline_capable","yes",""\n---\n\n---\n']


@query("old_documents", """SELECT o_orderkey, ['"ads","yes",""', NULL, NULL, '"google_services","no",""' || chr(10) || '"offline_capable","yes",""'][o_orderkey % 4 + 1] AS csv, ['CAMERA, READ_SMS', NULL, NULL, ''][o_orderkey % 4 + 1] AS perms, ['A note.' || chr(10) || chr(10) || 'More.', NULL, NULL, ''][o_orderkey % 4 + 1] AS prose, o_orderkey % 4 = 3 AS ready FROM orders""")
def old_documents(spark, sf_dir):
    d = scan.split_old_document(_pick(OLD, F.col("o_orderkey") % 4))
    return table(spark, sf_dir, "orders").select("o_orderkey", d.alias("d")).select("o_orderkey", "d.csv", "d.perms", "d.prose", F.coalesce(scan.facts_ready(F.col("d.csv")), F.lit(False)).alias("ready"))


PROJECTS = ["package: a\npermissions: CAMERA, x.Y\nhosts: b", "package: a", ""]


@query("permission_lines", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'CAMERA, x.Y' WHEN o_orderkey % 2 = 0 THEN 'CAMERA, READ_SMS' ELSE 'OLD' END AS line, CASE WHEN o_orderkey % 2 = 0 THEN 'A,B' ELSE '' END AS ids FROM orders")
def permission_lines(spark, sf_dir):
    k = F.col("o_orderkey")
    row = lambda f, e: F.struct(F.lit(f).alias("fact"), F.lit(e).alias("evidence"))
    rows = F.when(k % 2 == 0, F.array(row("read_sms", "READ_SMS"), row("ads", "Acme"), row("camera", "CAMERA, READ_SMS"))).otherwise(F.array(row("ads", "Acme")))
    ids = F.array_join(scan.permission_ids(F.when(k % 2 == 0, "B, A,,ACCESS_BACKGROUND_LOCATION,A").otherwise(None)), ",")
    return table(spark, sf_dir, "orders").select("o_orderkey", scan.permission_line(_pick(PROJECTS, k % 3), rows, F.lit(" OLD ")).alias("line"), ids.alias("ids"))


@query("equal_words", "SELECT o_orderkey, o_orderkey % 3 = 0 AS same, o_orderkey % 2 = 0 AS json FROM orders")
def equal_words(spark, sf_dir):
    k = F.col("o_orderkey")
    a = F.array(F.lit("a"), F.lit("b"))
    b = F.when(k % 3 == 0, a).when(k % 3 == 1, F.array(F.lit("b"), F.lit("a"))).otherwise(F.array(F.lit("a")))
    return table(spark, sf_dir, "orders").select("o_orderkey", store.same_values(a, b).alias("same"), formats.valid_json(F.when(k % 2 == 0, '{"a": [1]}').otherwise('{"a": ')).alias("json"))


@query("selected_cases", "SELECT doc_id AS id FROM labels WHERE doc_id % 3 = 0 AND toxic = 1 AND doc_id % 5 <> 0")
def selected_cases(spark, sf_dir):
    k = F.col("doc_id")
    cases = table(spark, sf_dir, "labels").select(k.alias("id"), _pick(["train", "dev", "test"], k % 3).alias("split"), F.when(F.col("toxic") == 1, F.array(F.lit("t"))).otherwise(F.array().cast("array<string>")).alias("tags"))
    return scoring.select_cases(cases, "train", "t", cases.filter("id % 5 = 0")).select("id")


@query("mined_cases", "SELECT 'd' || doc_id AS id, 'App' AS name, doc_id AS n FROM documents WHERE doc_id % 4 <> 0 AND trim(text) <> ''")
def mined_cases(spark, sf_dir):
    k = F.col("doc_id")
    tag = lambda *x: F.array(*[F.lit(i) if isinstance(i, str) else i for i in x])
    events = table(spark, sf_dir, "documents").select(k, F.when(k % 4 == 0, 1).otherwise(32267).alias("kind"), F.col("text").alias("content"), F.array(tag("d", "x"), tag("name", "App"), tag("d", F.concat(F.lit("d"), k))).alias("tags"))
    got = scoring.mined_cases(events)
    return got.select("id", "listing.name", F.substring("id", 2, 20).cast("long").alias("n"))


@query("shortest_manifests", "WITH f AS (SELECT source AS tree_id, repeat('a/', CAST(doc_id % 5 AS INTEGER)) || CASE WHEN doc_id % 2 = 0 THEN 'README.md' ELSE 'x.kt' END AS path, doc_id FROM documents) SELECT tree_id, path FROM (SELECT *, row_number() OVER (PARTITION BY tree_id ORDER BY strlen(path), path) AS n FROM f WHERE ends_with(path, 'README.md')) WHERE n = 1")
def shortest_manifests(spark, sf_dir):
    k = F.col("doc_id")
    f = table(spark, sf_dir, "documents").select(F.col("source").alias("tree_id"), F.concat(F.repeat(F.lit("a/"), (k % 5).cast("int")), F.when(k % 2 == 0, "README.md").otherwise("x.kt")).alias("path"), F.col("text").alias("body"))
    return digest.shortest_path(f, "readme.md").select("tree_id", "path")


#: Orders are dealt to so many partitions of the table function: enough for all tasks, with many orders in each.
BUCKETS = 4096


@query("table_function_budget", "WITH b AS (SELECT l_orderkey, l_linenumber, l_suppkey, CAST(coalesce(sum(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM lineitem) SELECT l_orderkey, l_linenumber, l_suppkey, before FROM b WHERE before <= 60")
def table_function_budget(spark, sf_dir):
    """Lines of an order until sizes have gone over a budget, by a table function over Arrow batches called from SQL."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    spark.udtf.register("lines_within", table_functions.take_within_runs(rows.schema, ["l_orderkey"], "l_suppkey", 60))
    return spark.sql(f"SELECT l_orderkey, l_linenumber, l_suppkey, before FROM lines_within(TABLE({{rows}}) PARTITION BY (pmod(xxhash64(l_orderkey), {BUCKETS})) ORDER BY (l_orderkey, l_linenumber, l_partkey, l_suppkey))", rows=rows)


@query("set_hashes", "SELECT lang, sha256(string_agg(strlen(source) || chr(0) || source, '' ORDER BY encode(source))) AS hash FROM (SELECT DISTINCT lang, source FROM documents WHERE source IS NOT NULL) GROUP BY lang")
def set_hashes(spark, sf_dir):
    """One hash per language over its sources, by an aggregate over Arrow arrays called from SQL."""
    table_functions.register(spark)
    return spark.sql("SELECT lang, set_hash(source) AS hash FROM {docs} GROUP BY lang", docs=table(spark, sf_dir, "documents").select("lang", "source").distinct())
