"""Queries over source code: whole documents stand in comments, raw strings and templates of files in two languages.

Twenty documents that follow each other are a tree. What a file holds and where
follows from the lines of its text, which is what the SQL twins count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.operators import digest_text, quotes, sinks, source_code
from shelfspark.plans.scan_queries import _quoted
from shelfspark.plans.lineage import cut
from shelfspark.registry import query, table

_SQL_FILES = r"""d AS (SELECT doc_id, coalesce(text, '') AS t, CAST(floor(doc_id / 20) AS BIGINT) AS tree_id, CAST(doc_id AS VARCHAR) AS n, doc_id % 2 = 0 AS kt FROM documents),
p AS (SELECT *, replace(replace(t, '*/', ' '), '/*', ' ') AS c, CASE WHEN kt THEN replace(replace(t, '"', ''''), '$', 'S') ELSE replace(replace(replace(t, '`', ''''), '$', 'S'), '\', '/') END AS r FROM d),
f AS (SELECT *, 'src/d' || n || CASE WHEN kt THEN '.kt' ELSE '.ts' END AS path, length(c) - length(replace(c, chr(10), '')) AS n1, length(c) - length(replace(c, chr(10), '')) + length(r) - length(replace(r, chr(10), '')) AS n2,
    CASE WHEN kt THEN '/* ' || c || ' */' || chr(10) || 'fun send_' || n || '(a: Int) {' || chr(10) || '  val s = \"\"\"' || r || '\"\"\"' || chr(10) || '  client.post(s.toRequestBody())' || chr(10) || '  fun inner' || n || '() = http.get(lm.getLastLocation())' || chr(10) || '}' || chr(10) || 'fetch(1)' || chr(10)
    ELSE '/* ' || c || ' */' || chr(10) || 'export const x = (v) => {' || chr(10) || '  const s = `' || r || '`;' || chr(10) || '  api.put(s);' || chr(10) || '  function deep' || n || '() { socket.send(send_' || CAST(doc_id - 1 AS VARCHAR) || '(s)) }' || chr(10) || '}' || chr(10) END AS body FROM p)""".replace('\\"', '"')


def code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, tree_id, path, body): a file of Kotlin for even documents, of TypeScript for odd ones."""
    t, n, even = F.coalesce("text", F.lit("")), F.col("doc_id").cast("string"), F.col("doc_id") % 2 == 0
    swap = lambda x, was, to: F.replace(x, F.lit(was), F.lit(to))
    said = swap(swap(t, "*/", " "), "/*", " ")
    raw = swap(swap(t, '"', "'"), "$", "S")
    template = swap(swap(swap(t, "`", "'"), "$", "S"), "\\", "/")
    kotlin = F.concat(F.lit("/* "), said, F.lit(" */\nfun send_"), n, F.lit('(a: Int) {\n  val s = """'), raw, F.lit('"""\n  client.post(s.toRequestBody())\n  fun inner'), n, F.lit("() = http.get(lm.getLastLocation())\n}\nfetch(1)\n"))
    script = F.concat(F.lit("/* "), said, F.lit(" */\nexport const x = (v) => {\n  const s = `"), template, F.lit("`;\n  api.put(s);\n  function deep"), n, F.lit("() { socket.send(send_"), (F.col("doc_id") - 1).cast("string"), F.lit("(s)) }\n}\n"))
    path = F.concat(F.lit("src/d"), n, F.when(even, ".kt").otherwise(".ts"))
    return table(spark, sf_dir, "documents").select("doc_id", F.floor(F.col("doc_id") / 20).cast("long").alias("tree_id"), path.alias("path"), F.when(even, kotlin).otherwise(script).alias("body"))


def _id(path: Column) -> Column:
    return F.regexp_extract(path, r"d(\d+)", 1).cast("long")


_SQL_FUNCTIONS = """g AS (SELECT tree_id, doc_id, path, CASE WHEN kt THEN 'send_' || n ELSE '' END AS name, 2 + n1 AS begin, 6 + n2 AS stop, 4 + n2 AS focus, false AS device, 0 AS k FROM f
    UNION ALL SELECT tree_id, doc_id, path, CASE WHEN kt THEN 'inner' ELSE 'deep' END || n, 5 + n2, 5 + n2, 5 + n2, kt, 1 FROM f)"""


@query("code_functions", f"WITH {_SQL_FILES}, {_SQL_FUNCTIONS} SELECT doc_id, name, CAST(begin AS INTEGER) AS begin, CAST(stop AS INTEGER) AS stop FROM g")
def code_functions(spark, sf_dir):
    code = source_code.parsed(code_files(spark, sf_dir))
    return source_code.functions_of(code).select(_id(F.col("path")).alias("doc_id"), "name", "begin", "stop")


@query("code_calls", f"""WITH {_SQL_FILES}, {_SQL_FUNCTIONS},
c AS (SELECT doc_id, 4 + n2 AS line, unnest(CASE WHEN kt THEN ['client.post', 's.toRequestBody'] ELSE ['api.put'] END) AS callee, 0 AS k FROM f
    UNION ALL SELECT doc_id, 5 + n2, unnest(CASE WHEN kt THEN ['http.get', 'lm.getLastLocation'] ELSE ['socket.send', 'send_' || CAST(doc_id - 1 AS VARCHAR)] END), 1 FROM f
    UNION ALL SELECT doc_id, 7 + n2, 'fetch', 2 FROM f WHERE kt)
SELECT c.doc_id, CAST(line AS INTEGER) AS line, callee, name AS function, CAST(begin AS INTEGER) AS begin FROM c LEFT JOIN g USING (doc_id, k)""")
def code_calls(spark, sf_dir):
    code = cut(source_code.parsed(code_files(spark, sf_dir)), "code")  # calls and functions come from one reading
    met = source_code.enclosing(source_code.calls_of(code), source_code.functions_of(code), ["tree_id", "path"])
    return met.select(_id(F.col("path")).alias("doc_id"), "line", "callee", F.col("span.name").alias("function"), F.col("span.begin").alias("begin"))


_any = lambda x, parts: "(" + " OR ".join(f"contains({x}, {_quoted(p)})" for p in parts) + ")"
_CODE_LINE = "regexp_matches(x, '[^\\x00-\\x20{}()\\[\\],;:]')"
_TRIM = "trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_LINES = lambda body, a, b: f"list_transform(list_filter(list_transform(list_slice(string_split({body}, chr(10)), greatest({a}, 1), greatest({b}, 0)), lambda x: {_TRIM}), lambda x: {_CODE_LINE}), lambda x: substring(x, 1, 320))"


#: A function inside another is quoted with the line in which the other one declares it.
@query("sink_quotes", f"""WITH {_SQL_FILES}, {_SQL_FUNCTIONS},
s AS (SELECT * FROM g UNION ALL SELECT tree_id, doc_id, path, NULL, NULL, NULL, 7 + n2, false, 2 FROM f WHERE kt),
w AS (SELECT s.*, CASE WHEN begin IS NULL THEN focus - 12 WHEN stop - begin > 120 THEN focus - 40 ELSE begin END AS a, CASE WHEN begin IS NULL THEN focus + 8 WHEN stop - begin > 120 THEN focus - 40 + 120 ELSE stop END AS b FROM s),
l AS (SELECT w.*, {_LINES('f.body', 'a', 'b')} AS own, CASE WHEN o.doc_id IS NOT NULL THEN {_LINES('o.body', '3 + o.n2', '7 + o.n2')} WHEN k = 1 THEN {_LINES('f.body', '3 + f.n2', '7 + f.n2')} ELSE [] END AS called, o.path AS caller
    FROM w JOIN f USING (doc_id) LEFT JOIN f o ON w.name = 'send_' || f.n AND o.doc_id = f.doc_id + 1 AND o.tree_id = f.tree_id),
t AS (SELECT *, lower(array_to_string(list_concat(own, called), chr(10))) AS low, list_filter(list_transform(regexp_extract_all(array_to_string(own, chr(10)), 'https?://([A-Za-z0-9._-]+)', 1), lambda x: lower(x)), lambda x: NOT regexp_matches(x, '^(localhost|127.0.0.1|0.0.0.0|github.com|www.github.com|gitlab.com|codeberg.org|xmlpull.org|pub.dev|golang.org|proxy.golang.org|schema.org)$|(^|[.])(schemas.android.com|xml.org|xmlns.jcp.org|apache.org|w3.org|example.com|example.org)$')) AS hosts FROM l)
SELECT tree_id, path, CAST(begin AS INTEGER) AS begin, CAST(stop AS INTEGER) AS stop, CAST(CASE WHEN {_any('low', quotes.BODIES)} AND {_any('low', quotes.USER_DATA)} THEN 3 WHEN {_any('low', quotes.BODIES)} THEN 2 WHEN len(hosts) > 0 THEN 1 ELSE 0 END + CASE WHEN device OR {_any('low', quotes.DEVICE_TOKENS)} THEN 3 ELSE 0 END AS INTEGER) AS score,
    caller, CAST(len(own) + len(called) AS INTEGER) AS n_lines, sha256(array_to_string(list_concat(own, called), chr(10))) AS quote FROM t""")
def sink_quotes(spark, sf_dir):
    files = code_files(spark, sf_dir)
    groups = sinks.sink_groups(files, cut(source_code.parsed(files), "code"))
    texts = F.array_join(F.transform("lines", lambda x: x["text"]), "\n")
    caller = F.array_max(F.filter(F.transform("lines", lambda x: x["path"]), lambda p: p != F.col("path")))
    return groups.select("tree_id", "path", "begin", "stop", "score", caller.alias("caller"), F.size("lines").alias("n_lines"), F.sha2(texts, 256).alias("quote"))


@query("digest_round_trip", f"""WITH {_SQL_FILES},
q AS (SELECT tree_id, count(*) AS n, bool_or(kt) AS kotlin, bool_or(len(list_filter(string_split(lower(body), chr(10)), lambda x: NOT regexp_matches({_TRIM}, '^(import |package )') AND regexp_matches(x, '(^|[^a-z0-9])password([^a-z0-9]|$)'))) > 0) AS said FROM f WHERE octet_length(encode(body)) <= 262144 GROUP BY tree_id),
a AS (SELECT tree_id, count(*) AS n FROM f GROUP BY tree_id)
SELECT tree_id, CAST(a.n + 1 AS BIGINT) AS files, concat_ws(',', CASE WHEN said THEN 'a_password' END, CASE WHEN kotlin THEN 'fine_location' END) AS quoted, 'Tree ' || CAST(tree_id AS VARCHAR) || ' sends notes.' AS readme FROM a LEFT JOIN q USING (tree_id)""")
def digest_round_trip(spark, sf_dir):
    """Digests of whole trees, read back: files counted, facts quoted, the readme."""
    files = code_files(spark, sf_dir).select("tree_id", "path", "body")
    trees = files.select("tree_id").distinct()
    readme = trees.select("tree_id", F.lit("README.md").alias("path"), F.concat(F.lit("Tree "), F.col("tree_id").cast("string"), F.lit(" sends notes.\n")).alias("body"))
    asked = trees.select("tree_id", F.explode(F.array(*[F.struct(F.lit(f).alias("fact"), F.lit(h).alias("hint")) for f, h in (("fine_location", ""), ("camera", ""), ("a_password", "the password"))])).alias("a")).select("tree_id", "a.*")
    written = digest_text.write_digests(files.unionByName(readme), asked)
    d = F.col("digest")
    return written.select("tree_id", F.regexp_extract(d, r"^Files: (\d+)", 1).cast("long").alias("files"), F.array_join(quotes.quoted_facts(d), ",").alias("quoted"), quotes.digest_readme(d).alias("readme"))
