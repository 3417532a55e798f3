"""Queries over documents and pages: language, wording, sentences, HTML, hosts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.functions import arrow_text, prompts, urls, vectors
from shelfspark.functions import text as tx
from shelfspark.operators import joins, ordered
from shelfspark.registry import query, table


def _list(words) -> str:
    return "[" + ",".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


_STATS = f"""
stats AS (SELECT doc_id, lang, text,
  len(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS latin,
  len(regexp_replace(text, '[\\P{{L}}\\p{{Latin}}]', '', 'g')) AS other,
  list_filter(string_split_regex(lower(text), '[^\\p{{L}}'']+'), lambda w: w <> '') AS ws FROM documents),
counted AS (SELECT *, len(ws) AS words, len(list_filter(ws, lambda w: list_contains({_list(tx.COMMON_WORDS)}, w))) AS common FROM stats),
judged AS (SELECT *, CASE WHEN other > latin THEN false WHEN words < 6 THEN NULL ELSE common * 100 >= words * 15 END AS english FROM counted)
"""


@query("lang_verdict_by_lang", f"WITH {_STATS} SELECT lang, CAST(count(*) FILTER (english) AS BIGINT) AS english, CAST(count(*) FILTER (english IS NULL) AS BIGINT) AS undecided, CAST(count(*) FILTER (NOT english) AS BIGINT) AS not_english FROM judged GROUP BY lang")
def lang_verdict_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("lang", tx.prose(arrow_text.language_stats(F.col("text"))).alias("e"))
    return d.groupBy("lang").agg(F.count_if(F.col("e")).alias("english"), F.count_if(F.col("e").isNull()).alias("undecided"), F.count_if(~F.col("e")).alias("not_english"))


@query("word_stats", f"WITH {_STATS} SELECT doc_id, CAST(words AS BIGINT) AS words, CAST(common AS BIGINT) AS common, CAST(latin AS BIGINT) AS latin, CAST(other AS BIGINT) AS other FROM counted")
def word_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", arrow_text.language_stats(F.col("text")).alias("s")).select("doc_id", "s.words", "s.common", "s.latin", "s.other")


@query("exact_dedupe_keep_first", "SELECT min(doc_id) AS doc_id, sha256(text) AS sha FROM documents GROUP BY text")
def exact_dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))
    return ordered.keep_first(d, ["sha"], "doc_id")


@query("hash_keys", "SELECT doc_id, sha256(unhex(sha256(text)) || 'leaf-ir-v1'::BLOB) AS key FROM documents")
def hash_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", vectors.vector_key(F.col("text")).alias("key"))


def _license_sql(column: str) -> str:
    return "CASE " + " ".join("WHEN " + " AND ".join(f"contains({column}, '{p}')" for p in parts) + f" THEN '{name}'" for parts, name, _ in tx.LICENSES) + " END"


@query("license_wording", f"WITH f AS (SELECT lower(array_to_string(list_filter(string_split_regex(text, '[\\s\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]+'), lambda w: w <> ''), ' ')) AS t FROM documents), g AS (SELECT coalesce({_license_sql('left(t, 400)')}, {_license_sql('t')}) AS license FROM f) SELECT license, CAST(count(*) AS BIGINT) AS n FROM g WHERE license IS NOT NULL GROUP BY license")
def license_wording(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(tx.license_of(F.col("text"))["id"].alias("license")).filter("license IS NOT NULL")
    return d.groupBy("license").agg(F.count(F.lit(1)).alias("n"))


_LINE = "array_to_string(list_filter(string_split_regex(text, '[\\s\\x{85}\\x{a0}\\x{2028}\\x{2029}\\x{202f}\\x{3000}]+'), lambda w: w <> ''), ' ')"


@query("fits_candidates", f"WITH {_STATS}, l AS (SELECT *, {_LINE} AS line FROM judged) SELECT doc_id, CAST(len(line) AS BIGINT) AS n_chars FROM l WHERE len(line) BETWEEN 100 AND 300 AND english AND NOT regexp_matches(line, '{tx.OTHER_BUILD}') AND NOT regexp_matches(line, '{tx.NOT_PROSE}')")
def fits_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.filter(tx.fits_about(F.col("text"))).select("doc_id", F.length(tx.one_line(F.col("text"))).cast("long").alias("n_chars"))


@query("doubled_words", f"WITH w AS (SELECT doc_id, list_transform(string_split({_LINE}, ' '), lambda x: trim(lower(x), '\"''(),.;:!?')) AS ws FROM documents) SELECT doc_id, len(list_filter(range(1, len(ws)), lambda i: ws[i] <> '' AND ws[i] = ws[i+1] AND NOT regexp_matches(ws[i], '[0-9]'))) > 0 AS flag FROM w")
def doubled_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tx.doubled_word(F.col("text")).alias("flag"))


@query("sentence_split_counts", f"WITH l AS (SELECT doc_id, {_LINE} AS line FROM documents) SELECT doc_id, CAST(len(list_filter(string_split(regexp_replace(line, '([.!?]) ', '\\1' || chr(1), 'g'), chr(1)), lambda s: trim(s) <> '')) AS BIGINT) AS n FROM l")
def sentence_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.size(tx.sentences(tx.one_line(F.col("text")))).cast("long").alias("n"))


@query("longest_fitting_lead", f"WITH l AS (SELECT doc_id, list_filter(string_split(regexp_replace({_LINE}, '([.!?]) ', '\\1' || chr(1), 'g'), chr(1)), lambda s: trim(s) <> '') AS p FROM documents), k AS (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS k FROM l), f AS (SELECT doc_id, k, len(array_to_string(p[1:k], ' ')) AS n FROM k) SELECT doc_id, CAST(max(k) AS BIGINT) AS k, CAST(max(n) AS BIGINT) AS len FROM f WHERE n <= 300 GROUP BY doc_id")
def longest_fitting_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", tx.longest_lead(F.col("text")).alias("s")).filter("s IS NOT NULL")
    return d.select("doc_id", F.col("s.k").cast("long").alias("k"), F.length("s.lead").cast("long").alias("len"))


def _stem_sql(w: str) -> str:
    cut = "CASE " + " ".join(f"WHEN strlen({w}) > {len(s) + 3} AND ends_with({w}, '{s}') THEN left({w}, len({w}) - {len(s)}) || '{'y' if s == 'ies' else ''}'" for s in tx.SUFFIXES) + f" ELSE {w} END"
    return f"regexp_replace({cut}, CASE WHEN strlen({cut}) > 4 THEN 'e$' ELSE '$^x' END, '')"


_STEMS = f"list_distinct(list_transform(list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{Nd}}]+'), lambda w: strlen(w) >= 4 AND NOT list_contains({_list(tx.STOP_WORDS)}, w)), lambda w: {_stem_sql('w')}))"


@query("stem_vocab_coverage", f"WITH b AS (SELECT DISTINCT unnest({_STEMS}) AS s FROM benchmark), d AS (SELECT doc_id, unnest({_STEMS}) AS s FROM documents) SELECT doc_id, CAST(count(*) FILTER (b.s IS NULL) AS BIGINT) AS missing, CAST(count(*) AS BIGINT) AS total FROM d LEFT JOIN b USING (s) GROUP BY doc_id")
def stem_vocab_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = table(spark, sf_dir, "benchmark").select(F.explode(tx.content_stems(F.col("text"))).alias("s")).distinct().withColumn("known", F.lit(True))
    d = table(spark, sf_dir, "documents").select("doc_id", F.explode(tx.content_stems(F.col("text"))).alias("s"))
    return d.join(vocabulary, "s", "left").groupBy("doc_id").agg(F.count_if(F.col("known").isNull()).alias("missing"), F.count(F.lit(1)).alias("total"))


@query("phrase_contamination", "SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def phrase_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.contains_join(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "text", "text", "doc_id", "item_id")


KEYWORDS = ["the", "of", "und", "license", "mit license", "version 2.0", "password", "token", "que", "not-there"]


@query("boundary_keyword_match", f"WITH k AS (SELECT unnest({_list(KEYWORDS)}) AS keyword) SELECT keyword, CAST(count(doc_id) AS BIGINT) AS docs FROM k LEFT JOIN documents d ON regexp_matches(lower(text), '(^|[^a-z0-9])' || regexp_escape(keyword) || '($|[^a-z0-9])') GROUP BY keyword")
def boundary_keyword_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = table(spark, sf_dir, "documents").select(F.lower("text").alias("low"))
    counts = low.agg(*[F.count_if(tx.at_boundary(F.col("low"), F.lit(k))).alias(f"k{n}") for n, k in enumerate(KEYWORDS)])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(k).alias("keyword"), F.col(f"k{n}").alias("docs")) for n, k in enumerate(KEYWORDS)])).alias("r")).select("r.*")


# All words of a text are proposed.
@query("keyword_accept_topk", f"WITH p AS (SELECT doc_id, lower(text) AS low, list_filter(list_distinct(list_transform(list_filter(string_split_regex(text, '[\\s\\x{{85}}\\x{{a0}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{3000}}]+'), lambda w: w <> ''), lambda w: lower(w))), lambda w: regexp_matches(w, '^[a-z0-9-]+$') AND NOT regexp_matches(w, '^-+$') AND w NOT IN ('app', 'android', 'free', 'privacy', 'secure')) AS ks FROM documents) SELECT doc_id, array_to_string(list_sort(list_filter(ks, lambda k: regexp_matches(low, '(^|[^a-z0-9])' || regexp_escape(k) || '($|[^a-z0-9])')))[1:8], ',') AS keywords FROM p")
def keyword_accept_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.array_join(tx.accept_keywords(F.array_distinct(tx.fields(F.col("text"))), F.col("text")), ",").alias("keywords"))


# Whole turns and, as proposals of their own, the sentences of each.
_TURN = "array_to_string(list_filter(string_split_regex(text, '[\\s\\x{85}\\x{a0}\\x{2028}\\x{2029}\\x{202f}\\x{3000}]+'), lambda w: w <> ''), ' ')"


@query("query_lines_accept", f"WITH l AS (SELECT conv_id, turn, unnest(string_split(regexp_replace({_TURN}, '([.!?]) ', '\\1' || chr(1), 'g'), chr(1))) AS q FROM conversations), k AS (SELECT DISTINCT conv_id, lower(q) AS q FROM l WHERE len(string_split(q, ' ')) BETWEEN 2 AND 6 AND NOT regexp_matches(lower(q), '(^|[^a-z0-9])the($|[^a-z0-9])')), n AS (SELECT conv_id, least(count(*), 10) AS n FROM k GROUP BY 1) SELECT DISTINCT c.conv_id, CAST(CASE WHEN n.n >= 2 THEN n.n END AS BIGINT) AS n FROM conversations c LEFT JOIN n USING (conv_id)")
def query_lines_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.split(tx.one_line(F.col("text")), "(?<=[.!?]) ").alias("parts"))
    lines = c.groupBy("conv_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("turn", "parts"))), lambda s: s["parts"])).alias("lines"))
    return lines.select("conv_id", F.size(tx.accept_queries(F.col("lines"), F.lit("The"), least=2)).cast("long").alias("n")).withColumn("n", F.when(F.col("n") >= 0, F.col("n")))


@query("html_title", "SELECT page_id, trim(regexp_extract(string_split_regex(html, '(?i)</head>')[1], '(?is)<title[^>]*>(.*?)</title>', 1)) AS title FROM pages")
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.raw_title(F.col("html")).alias("title"))


@query("html_meta_precedence", "SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'plain' WHEN 1 THEN 'og' WHEN 2 THEN 'tw' END AS description FROM pages")
def html_meta_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages get meta tags by page_id % 4, among them an empty description, one in the body and one out of turn."""
    tags = ['<meta content="og" property="og:description"><meta name="Description" content="plain">', "<meta name='description' content=''><meta property='og:description' content='og'><meta name='twitter:description' content='tw'>", '<meta name="twitter:description" content=" tw ">', '<meta name="keywords" content="x">']
    page = F.replace(F.col("html"), F.lit("<head>"), F.concat(F.lit("<head>"), F.element_at(F.array(*[F.lit(t) for t in tags]), (F.col("page_id") % 4 + 1).cast("int"))))
    page = F.replace(page, F.lit("<body>"), F.lit('<body><meta name="description" content="late">'))
    return table(spark, sf_dir, "pages").select("page_id", urls.first_meta(page, urls.META_KEYS).alias("description"))


@query("url_hosts_top", f"WITH h AS (SELECT unnest(regexp_extract_all(url, '{urls.HOST}', 1)) AS host FROM pages) SELECT host, CAST(count(*) AS BIGINT) AS n FROM h WHERE NOT regexp_matches(lower(host), '(^|\\.)({'|'.join(s.replace('.', chr(92) + '.') for s in urls.SKIPPED_HOSTS)})$') GROUP BY host ORDER BY n DESC, host LIMIT 20")
def url_hosts_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = table(spark, sf_dir, "pages").select(F.explode(urls.hosts(F.col("url"))).alias("host")).filter(~urls.skipped_host(F.col("host")))
    return h.groupBy("host").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "host").limit(20)


SUFFIX_RULES = [("net", "net"), ("example.net", "example-net"), ("example.com", "example-com"), ("org", "org"), ("blog.example.org", "blog")]


@query("host_longest_suffix_join", f"WITH r(suffix, rule) AS (VALUES {', '.join(map(str, SUFFIX_RULES))}), h AS (SELECT page_id, regexp_extract(url, '{urls.HOST}', 1) AS host FROM pages) SELECT page_id, arg_max(rule, len(suffix)) AS rule FROM h JOIN r ON host = suffix OR ends_with(host, '.' || suffix) GROUP BY page_id")
def host_longest_suffix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(SUFFIX_RULES, "suffix string, rule string")
    h = table(spark, sf_dir, "pages").select("page_id", F.array_join(F.reverse(F.split(urls.hosts(F.col("url"))[0], r"\.")), "/").alias("path"))
    by_path = rules.select(F.array_join(F.reverse(F.split("suffix", r"\.")), "/").alias("prefix"), "rule")
    return joins.longest_prefix(h, by_path, "path", "prefix", ["page_id"]).select("page_id", "rule")


REGEX_RULES = [("a-secret", r"(?i)\b(password|token)\b\s*[:=]"), ("b-license", r"(?i)licen[cs]e"), ("c-shout", r"\b[A-Z]{4,}\b"), ("d-pipes", r"\s\|\s")]


@query("regex_theta_first_rule", "WITH r(rule, pattern) AS (VALUES " + ", ".join(f"('{n}', '{p}')" for n, p in REGEX_RULES) + ") SELECT doc_id, min(rule) AS rule FROM documents, r WHERE regexp_matches(text, pattern) GROUP BY doc_id")
def regex_theta_first_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.first_regex_rule(table(spark, sf_dir, "documents"), REGEX_RULES, "text").select("doc_id", "rule").filter("rule IS NOT NULL")


TOKENS = ["firebase", "password", "license", "appsflyer", "lic", "zzzz"]


@query("unmentioned_anti", f"WITH t AS (SELECT unnest({_list(TOKENS)}) AS token) SELECT token, EXISTS (SELECT 1 FROM documents d WHERE contains(lower(d.text), t.token)) AS mentioned FROM t")
def unmentioned_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.mentions(table(spark, sf_dir, "documents"), "text", TOKENS)


@query("files_hash", "SELECT doc_id, sha256(concat_ws('', strlen(text), chr(0), text, strlen(lang), chr(0), lang, strlen(source), chr(0), source)) AS hash FROM documents")
def files_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", ordered.content_hash("text", "lang", "source").alias("hash"))


@query("html_hosts_clipped", "SELECT page_id, CASE WHEN strlen(url) <= 24 THEN url ELSE left(url, 24) END AS clipped, strlen(url) AS n_bytes FROM pages")
def html_hosts_clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", tx.clip_bytes(F.col("url"), 24).alias("clipped"), F.octet_length("url").cast("long").alias("n_bytes"))


_TAGS = ['<meta content="og &amp; co" property="og:description"><meta name="Description" content=" plain  text ">', "<meta name='description' content=''><meta property='og:description' content='og'>", "<meta name=description content=bare><meta name='twitter:description' content='tw'>", '<meta name="keywords" content="x">']


@query("page_metas", "SELECT page_id, ['plain text', 'og', 'tw', ''][page_id % 4 + 1] AS description FROM pages")
def page_metas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages get meta tags by page_id % 4: an order, an empty one, one without quotes, none that counts."""
    page = F.replace(F.col("html"), F.lit("<head>"), F.concat(F.lit("<head>"), F.element_at(F.array(*[F.lit(t) for t in _TAGS]), (F.col("page_id") % 4 + 1).cast("int"))))
    return table(spark, sf_dir, "pages").select("page_id", urls.page_meta(page)["description"].alias("description"))


ADDRESSES = ["https://acme.io/x?y", "http://acme.io", "https://u@acme.io/", "https://172.20.1.1/", "https://[fd00::1]/", "https://172.40.1.1/", "https://[2001:db8::1]:8443/", "https://LOCALHOST", "https://2130706433/", "https://a%2eb/", "https://10.acme.io/"]


@query("public_addresses", "SELECT page_id, [true, false, false, false, false, true, true, false, false, false, false][page_id % 11 + 1] AS public FROM pages")
def public_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.element_at(F.array(*[F.lit(a) for a in ADDRESSES]), (F.col("page_id") % 11 + 1).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", urls.public_https(url).alias("public"))


@query("about_records", f"WITH d AS (SELECT doc_id, source, lang, left({_LINE}, 60) AS line FROM documents) SELECT doc_id, 'Listing:' || chr(10) || '# ' || source || chr(10) || chr(10) || lang || chr(10) || CASE WHEN trim(line) <> '' THEN chr(10) || trim(line) || chr(10) ELSE '' END || 'Tags: a, b' || chr(10) || 'License: MIT' || chr(10) || '---' || chr(10) || 'Description:' || chr(10) || CASE WHEN doc_id % 2 = 0 THEN 'kept' || chr(10) ELSE 'none: the listing description is empty, too short, too long, or not English. Write the about.' || chr(10) END || CASE WHEN doc_id % 3 = 0 THEN '---' || chr(10) || 'Other developer text:' || chr(10) || 'web: x y' || chr(10) ELSE '' END || CASE WHEN doc_id % 5 = 0 THEN '---' || chr(10) || 'README:' || chr(10) || 'read me' || chr(10) ELSE '' END AS record FROM d")
def about_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    app = {"id": F.lit("i"), "name": F.col("source"), "summary": F.col("lang"), "content": F.substring(tx.one_line(F.col("text")), 1, 60), "tags": F.array(F.lit("a"), F.lit("b")), "website": F.lit(""), "license": F.lit(" MIT "), "repository": F.lit(None).cast("string")}
    others = F.when(k % 3 == 0, F.array(F.struct(F.lit("web").alias("source"), F.lit(" x  y ").alias("text")))).otherwise(F.array(F.struct(F.lit("no").alias("source"), F.lit(" ").alias("text"))))
    return table(spark, sf_dir, "documents").select("doc_id", prompts.about_record(app, F.when(k % 2 == 0, " kept ").otherwise(""), others, F.when(k % 5 == 0, " read me ").otherwise("")).alias("record"))


@query("security_records", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'Current:' || chr(10) || '{\"security\":\"old\"}' || chr(10) ELSE 'security: write the summary. no-change is invalid.' || chr(10) END || '---' || chr(10) || 'Scan:' || chr(10) || CASE WHEN doc_id % 3 = 0 THEN '\"camera\",\"yes\",\"\"' || chr(10) ELSE '\"fact\",\"value\",\"notes\"' || chr(10) END || '---' || chr(10) || 'Listing:' || chr(10) || '# ' || source || chr(10) || CASE WHEN doc_id % 5 = 0 THEN '---' || chr(10) || 'Source:' || chr(10) || 'code' || chr(10) ELSE '' END AS record FROM documents")
def security_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, none = F.col("doc_id"), F.lit("")
    app = {"id": none, "name": F.col("source"), "summary": none, "content": none, "tags": F.array(), "website": none, "license": none, "repository": none}
    return table(spark, sf_dir, "documents").select("doc_id", prompts.security_record(app, F.when(k % 2 == 0, "old").otherwise(" "), F.when(k % 3 == 0, '"camera","yes",""\n').otherwise(""), F.when(k % 5 == 0, "code").otherwise("")).alias("record"))
