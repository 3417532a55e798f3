"""Queries over documents read as files of source trees, and over inline corpora."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.functions import markdown, tokens
from shelfspark.operators import digest, facts, joins
from shelfspark.plans.lineage import scratch_path
from shelfspark.registry import query, table
from shelfspark.sources import corpora


@query("markdown_paragraphs")
def markdown_paragraphs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(markdown.paragraphs_of(F.col("text"))).alias("n"))


#: Letters and their continuations: whatever is Latin has pieces.
LETTERS = {w: k for k, w in enumerate(["[PAD]", "[UNK]", "[CLS]", "[SEP]", "the", "of", "and", "##tion", "##ing", *"abcdefghijklmnopqrstuvwxyz0123456789.,!?%&*#$|", *[f"##{c}" for c in "abcdefghijklmnopqrstuvwxyz0123456789"]])}


@query("wordpiece_lengths")
def wordpiece_lengths(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(tokens.wordpiece(F.col("text"), LETTERS)).alias("n_tokens"))


_TOKENS = "regexp_extract_all(lower(regexp_replace(text, '[\\x00-\\x08\\x0e-\\x1f\\x7f-\\x84\\x86-\\x9f]', '', 'g')), '[\\p{Han}\\x{3040}-\\x{30ff}]|[\\p{P}\\p{S}]|[^\\s\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x0b\\p{P}\\p{S}\\p{Han}\\x{3040}-\\x{30ff}]+')"


@query("basic_token_counts", f"WITH t AS (SELECT doc_id, {_TOKENS} AS ts FROM documents) SELECT doc_id, CAST(len(ts) AS BIGINT) AS tokens, CAST(coalesce(list_sum(list_transform(ts, lambda x: len(x))), 0) AS BIGINT) AS signs FROM t")
def basic_token_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tokens.basic_token_counts(F.col("text")).alias("c")).select("doc_id", "c.tokens", "c.signs")


NEEDLES = [("privacy", "secret", "password="), ("privacy", "key", "akia"), ("legal", "license", "license"), ("legal", "license", "gnu general")]


@query("needle_hits", """WITH l AS (SELECT source AS tree_id, CAST(doc_id AS VARCHAR) AS path, string_split(text, chr(10)) AS ls FROM documents WHERE strlen(text) <= 262144),
x AS (SELECT tree_id, path, unnest(range(1, len(ls) + 1)) AS line, unnest(ls) AS text FROM l),
h AS (SELECT *, CASE WHEN contains(lower(text), 'password=') THEN 'secret' WHEN contains(lower(text), 'akia') THEN 'key' WHEN contains(lower(text), 'license') OR contains(lower(text), 'gnu general') THEN 'license' END AS fact FROM x),
o AS (SELECT tree_id, path, fact, min(line) AS line FROM h WHERE fact IS NOT NULL GROUP BY 1, 2, 3),
c AS (SELECT *, row_number() OVER (PARTITION BY tree_id, fact ORDER BY path, line) AS n FROM o)
SELECT tree_id, path, line, fact FROM (SELECT *, row_number() OVER (PARTITION BY tree_id ORDER BY path, line, fact) AS k FROM c WHERE n <= 6) WHERE k <= 48""")
def needle_hits(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("tree_id"), F.col("doc_id").cast("string").alias("path"), F.col("text").alias("body"))
    return digest.needle_hits(digest.tree_lines(d), NEEDLES).select("tree_id", "path", F.col("line").cast("long").alias("line"), "fact")


_CORPUS_SQL = """p AS (SELECT p_partkey, '/lib/' || p_brand AS id, p_name AS name, p_type AS type, '/' || lower(p_type) || '/' || split_part(p_name, ' ', 1) || CASE WHEN p_size > 25 THEN '/' || split_part(p_name, ' ', 2) ELSE '' END AS path FROM part),
bad AS (SELECT p_partkey, CASE WHEN p_partkey % 37 = 0 THEN 'no object' WHEN p_partkey % 41 = 0 THEN 'other kind of value' END AS reason FROM part),
corpus AS (SELECT path, arg_max(id, p_partkey) AS id, arg_max(name, p_partkey) AS name, arg_max(type, p_partkey) AS type FROM p JOIN bad USING (p_partkey) WHERE reason IS NULL GROUP BY path)"""


def _corpus(spark, sf_dir):
    """A corpus of libraries as JSON lines, a part each: some are cut off, some have a number for a name, some spell fields in capitals."""
    p = table(spark, sf_dir, "part")
    word = lambda k: F.get(F.split("p_name", " "), F.lit(k))
    path = F.concat(F.lit("/"), F.lower("p_type"), F.lit("/"), word(0), F.when(F.col("p_size") > 25, F.concat(F.lit("/"), word(1))).otherwise(""))
    key, id_ = F.col("p_partkey"), F.concat(F.lit("/lib/"), "p_brand")
    good = F.when(key % 2 == 0, F.to_json(F.struct(id_.alias("id"), path.alias("path"), F.col("p_name").alias("name"), F.col("p_type").alias("type")))).otherwise(F.to_json(F.struct(id_.alias("ID"), path.alias("Path"), F.col("p_name").alias("Name"), F.col("p_type").alias("Type"))))
    odd = F.to_json(F.struct(id_.alias("id"), path.alias("path"), key.alias("name")))
    line = F.when(key % 37 == 0, F.substring(good, F.lit(1), F.length(good) - 5)).when(key % 41 == 0, odd).otherwise(good)
    folder = scratch_path(spark, "corpus")
    p.select(key.alias("k"), line.alias("value")).repartitionByRange("k").sortWithinPartitions("k").select("value").write.text(folder)  # files are numbered by their ranges
    return corpora.library_corpus(spark, folder)


@query("corpus_rejected", f"WITH {_CORPUS_SQL} SELECT reason, CAST(count(*) AS BIGINT) AS n FROM bad WHERE reason IS NOT NULL GROUP BY reason")
def corpus_rejected(spark, sf_dir):
    return _corpus(spark, sf_dir)[1]


# Apps are orders; their classes lie in folders of the part's type and words.
@query("library_detection", f"""WITH {_CORPUS_SQL}, c AS (SELECT DISTINCT l_orderkey AS app_id, '/' || lower(p_type) || '/' || split_part(p_name, ' ', 1) AS p1, '/' || lower(p_type) || '/' || replace(p_name, ' ', '/') AS p2 FROM lineitem JOIN part ON l_partkey = p_partkey),
m AS (SELECT app_id, coalesce(b.path, a.path) AS path, CASE WHEN b.path IS NOT NULL THEN b.id ELSE a.id END AS id, CASE WHEN b.path IS NOT NULL THEN b.name ELSE a.name END AS name, CASE WHEN b.path IS NOT NULL THEN b.type ELSE a.type END AS type FROM c LEFT JOIN corpus a ON a.path = p1 LEFT JOIN corpus b ON b.path = p2)
SELECT app_id, id, min((path, name, type))[1] AS path, min((path, name, type))[2] AS name, min((path, name, type))[3] AS type FROM m WHERE path IS NOT NULL GROUP BY app_id, id""")
def library_detection(spark, sf_dir):
    corpus, _ = _corpus(spark, sf_dir)
    part = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("/"), F.lower("p_type"), F.lit("/"), F.replace("p_name", F.lit(" "), F.lit("/"))).alias("folder"))
    item = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("app_id"), "l_partkey", "l_linenumber")
    classes = item.join(part, F.col("l_partkey") == F.col("p_partkey")).select("app_id", F.concat("folder", F.lit("/C"), F.col("l_linenumber").cast("string")).alias("path"))
    info = spark.createDataFrame([], "id string, emphasize int, anti array<string>")
    return digest.detect_libraries(classes, corpus, info).select("app_id", "id", "path", "name", "type")


#: Permissions that facts know, and some that they don't, as lineitems ask for them.
ASKED = [*facts.PERMISSION_FACTS, facts.BACKGROUND, facts.INTERNET, "android.permission.vibrate", "com.other.permission.x"]
_ASKED_SQL = f"""k(n, p, fact) AS (VALUES {", ".join(f"({n}, '{p}', " + (f"'{facts.PERMISSION_FACTS[p]}'" if p in facts.PERMISSION_FACTS else "NULL") + ")" for n, p in enumerate(ASKED))}),
a AS (SELECT DISTINCT l_orderkey AS app_id, p, fact FROM lineitem JOIN k ON n = l_partkey % {len(ASKED)})"""


def _asked(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    name = F.element_at(F.array(*map(F.lit, ASKED)), (F.col("l_partkey") % len(ASKED) + 1).cast("int"))
    return li.select(F.col("l_orderkey").alias("app_id"), F.when(F.col("l_linenumber") % 2 == 0, F.upper(name)).otherwise(F.concat(name, F.lit(" "))).alias("p"), "l_linenumber", "l_suppkey", "l_returnflag")


@query("permission_facts", f"""WITH {_ASKED_SQL}, b AS (SELECT app_id, bool_or(p = '{facts.BACKGROUND}') AS back, bool_or(p = '{facts.INTERNET}') AS net FROM a GROUP BY app_id),
e AS (SELECT app_id, fact, upper(regexp_replace(p, '^android[.]permission[.]', '')) AS e FROM a WHERE fact IS NOT NULL UNION SELECT app_id, fact, 'ACCESS_BACKGROUND_LOCATION' FROM a JOIN b USING (app_id) WHERE back AND fact IN ('coarse_location', 'fine_location'))
SELECT app_id, fact, string_agg(e, ', ' ORDER BY e) AS evidence FROM e GROUP BY app_id, fact UNION ALL SELECT app_id, 'offline_capable', 'No INTERNET' FROM b WHERE NOT net""")
def permission_facts(spark, sf_dir):
    """Facts of the permissions that the lineitems of an order ask for, spelt in small and capital letters."""
    apps = _asked(spark, sf_dir).groupBy("app_id").agg(F.collect_list("p").alias("perms"))
    return facts.permission_rows(apps, "app_id", "perms").select("app_id", "fact", "evidence")


@query("manifest_parts", f"""WITH {_ASKED_SQL.replace("SELECT DISTINCT l_orderkey AS app_id, p, fact", "SELECT l_orderkey AS app_id, l_linenumber, l_suppkey, l_returnflag, p")}
SELECT app_id, CAST(least(count(*), 24) AS INTEGER) AS permissions, CAST(least(count_if(l_linenumber % 2 = 1), 15) AS INTEGER) AS components, bool_or(l_returnflag = 'R') AS cleartext FROM a GROUP BY app_id""")
def manifest_parts(spark, sf_dir):
    """Manifests written as XML from the lineitems of an order, and read again."""
    li = _asked(spark, sf_dir)
    kind = F.element_at(F.array(*map(F.lit, ("activity", "service", "receiver", "provider"))), (F.col("l_suppkey") % 4 + 1).cast("int"))
    line = F.concat(F.lit('<uses-permission\n  android:maxSdkVersion="30" android:name="'), "p", F.lit('"/>'), F.when(F.col("l_linenumber") % 2 == 1, F.concat(F.lit("<"), kind, F.lit(' android:exported="false" android:name=".C'), F.col("l_suppkey").cast("string"), F.lit('"/>'))).otherwise(""))
    clear = F.when(F.bool_or(F.col("l_returnflag") == "R"), '<application android:usesCleartextTraffic="true"/>').otherwise("<application/>")
    body = li.groupBy("app_id").agg(F.concat(F.lit("<manifest>"), F.array_join(F.collect_list(line), ""), clear, F.lit("</manifest>")).alias("body"))
    got = body.select("app_id", digest.manifest(F.col("body")).alias("m"))
    return got.select("app_id", F.size("m.permissions").alias("permissions"), F.size("m.components").alias("components"), "m.cleartext")


@query("duplicate_lines_islands", "WITH c AS (SELECT conv_id, turn, role, turn - row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS g FROM conversations) SELECT conv_id, role, min(turn) AS first_turn, CAST(count(*) AS BIGINT) AS n FROM c GROUP BY conv_id, role, g")
def duplicate_lines_islands(spark, sf_dir):
    """Runs of following turns of one role: consecutive equal values as groups."""
    from pyspark.sql import Window

    c = table(spark, sf_dir, "conversations").withColumn("g", F.col("turn") - F.row_number().over(Window.partitionBy("conv_id", "role").orderBy("turn")))
    return c.groupBy("conv_id", "role", "g").agg(F.min("turn").alias("first_turn"), F.count(F.lit(1)).alias("n")).drop("g")


@query("exclusive_joins_small", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def exclusive_joins_small(spark, sf_dir):
    return table(spark, sf_dir, "nation").join(joins.small(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")
