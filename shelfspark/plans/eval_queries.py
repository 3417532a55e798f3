"""Queries that score, tally, sample and export labelled cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.functions import arrow_text
from shelfspark.functions import text as tx
from shelfspark.operators import evals, ordered
from shelfspark.plans.text_queries import _STATS
from shelfspark.registry import query, table

_SCORED = f"""WITH {_STATS}, j AS (SELECT l.doc_id, l.quality, l.toxic, s.lang, s.english, len(s.text) AS n, s.text, d.source FROM labels l JOIN judged s USING (doc_id) JOIN documents d USING (doc_id)),
x AS (SELECT doc_id, lang, source, quality, toxic, n < 400 AS f_length, NOT coalesce(english, true) AS f_english, NOT (contains(lower(text), 'the') OR contains(lower(text), 'die')) OR NOT contains(lower(text), 'of') AS f_must, regexp_matches(text, '[%#]{{3}}') AS f_banned FROM j)"""


def _scored(spark, sf_dir):
    d = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), "doc_id")
    t = F.col("text")
    groups = F.array(F.array(F.lit("The"), F.lit("die")), F.array(F.lit("of")))
    checks = {
        "length": F.when(F.length(t) < 400, F.concat(F.lit("only "), F.length(t).cast("string"))),
        "english": F.when(~F.coalesce(tx.prose(arrow_text.language_stats(t)), F.lit(True)), "not English"),
        "must": F.when(~tx.contains_all_groups(t, groups), "a phrase is missing"),
        "banned": F.when(t.rlike("[%#]{3}"), "banned signs"),
    }
    return d.withColumn("fails", evals.fails(checks))


_FAILS = "SELECT doc_id, unnest(list_filter([CASE WHEN f_length THEN 'length' END, CASE WHEN f_english THEN 'english' END, CASE WHEN f_must THEN 'must' END, CASE WHEN f_banned THEN 'banned' END], lambda c: c IS NOT NULL)) AS \"check\" FROM x"


@query("eval_fails_map", f"{_SCORED} {_FAILS}")
def eval_fails_map(spark, sf_dir):
    return _scored(spark, sf_dir).select("doc_id", F.explode(F.map_keys("fails")).alias("check"))


@query("eval_check_counts", f"{_SCORED} SELECT \"check\", CAST(count(*) AS BIGINT) AS n FROM ({_FAILS}) GROUP BY 1")
def eval_check_counts(spark, sf_dir):
    return evals.check_counts(_scored(spark, sf_dir))


@query("eval_report_by_tag", f"{_SCORED}, t AS (SELECT unnest(CASE WHEN quality = 0 AND toxic = 0 THEN ['untagged'] ELSE list_filter([CASE WHEN quality = 1 THEN lang END, CASE WHEN toxic = 1 THEN 'toxic' END], lambda c: c IS NOT NULL) END) AS tag, NOT (f_length OR f_english OR f_must OR f_banned) AS p FROM x) SELECT tag, CAST(count(*) FILTER (p) AS BIGINT) AS pass, CAST(count(*) AS BIGINT) AS total FROM t GROUP BY tag")
def eval_report_by_tag(spark, sf_dir):
    tags = F.filter(F.array(F.when(F.col("quality") == 1, F.col("lang")), F.when(F.col("toxic") == 1, F.lit("toxic"))), lambda c: c.isNotNull())
    return evals.by_tag(_scored(spark, sf_dir).withColumn("tags", tags), "tags", evals.passed(F.col("fails")))


@query("eval_trap_rewrite", f"{_SCORED}, r AS (SELECT doc_id % 5 <> 0 AS replied, doc_id % 3 <> 0 AND quality = 0 AS wrong, toxic = 0 AS keep, NOT f_length AS kept FROM x) SELECT CAST(sum(CASE WHEN replied AND wrong AND kept THEN 1 ELSE 0 END) AS BIGINT) AS trapped, CAST(sum(CASE WHEN replied AND wrong THEN 1 ELSE 0 END) AS BIGINT) AS traps, CAST(sum(CASE WHEN replied AND keep AND NOT kept THEN 1 ELSE 0 END) AS BIGINT) AS rewritten, CAST(sum(CASE WHEN replied AND keep THEN 1 ELSE 0 END) AS BIGINT) AS good FROM r")
def eval_trap_rewrite(spark, sf_dir):
    """Cases with a doc_id divisible by 5 got no reply, those divisible by 3 offer no description; the label is keep where toxic is 0."""
    return evals.trap_rewrite(_scored(spark, sf_dir), F.col("doc_id") % 5 != 0, (F.col("doc_id") % 3 != 0) & (F.col("quality") == 0), F.col("toxic") == 0, ~F.array_contains(F.map_keys("fails"), "length"))


@query("eval_missed_extra", "WITH r AS (SELECT CASE WHEN doc_id % 4 <> 0 THEN toxic = 1 END AS want, quality <> 1 AS warned FROM labels WHERE doc_id % 5 <> 0) SELECT CAST(count(*) FILTER (want AND NOT warned) AS BIGINT) AS missed, CAST(count(*) FILTER (want) AS BIGINT) AS wanted, CAST(count(*) FILTER (NOT want AND warned) AS BIGINT) AS extra, CAST(count(*) FILTER (NOT want) AS BIGINT) AS unwanted FROM r")
def eval_missed_extra(spark, sf_dir):
    """Cases with a doc_id divisible by 5 got no reply; those divisible by 4 don't say whether they want a warning."""
    return evals.missed_extra(table(spark, sf_dir, "labels"), F.col("doc_id") % 5 != 0, F.when(F.col("doc_id") % 4 != 0, F.col("toxic") == 1), F.col("quality") != 1)


@query("eval_rate_lines", "SELECT quality, printf('%5.1f%% (%d/%d)', 100.0 * sum(toxic) / count(*), CAST(sum(toxic) AS BIGINT), count(*)) AS line FROM labels GROUP BY quality")
def eval_rate_lines(spark, sf_dir):
    g = table(spark, sf_dir, "labels").groupBy("quality").agg(F.sum("toxic").alias("n"), F.count(F.lit(1)).alias("total"))
    return g.select("quality", evals.rate_text(F.col("n"), F.col("total")).alias("line"))


@query("spread_sample", "SELECT doc_id, CAST(row_number() OVER (ORDER BY h) AS INTEGER) AS rank FROM (SELECT doc_id, sha256('s1' || doc_id) AS h FROM documents ORDER BY h LIMIT 50)")
def spread_sample(spark, sf_dir):
    return ordered.spread_sample(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 50, "s1")


@query("export_chat_jsonl", """SELECT conv_id, '{"messages":[{"role":"system","content":"Be brief."},' || string_agg('{"role":' || to_json(role) || ',"content":' || to_json(text) || '}', ',' ORDER BY turn) || ']}' AS json FROM conversations GROUP BY conv_id""")
def export_chat_jsonl(spark, sf_dir):
    return evals.chat_json(table(spark, sf_dir, "conversations"), "conv_id", "turn", "Be brief.")


@query("unlabeled_anti_join", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unlabeled_anti_join(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query("case_repeats_cross", "SELECT doc_id, CAST(r AS INTEGER) AS run FROM labels, (SELECT unnest([1, 2, 3]) AS r)")
def case_repeats_cross(spark, sf_dir):
    return evals.repeats(table(spark, sf_dir, "labels").select("doc_id"), 3)


@query("id_uniqueness", "SELECT lang || ':' || n_chars AS id, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def id_uniqueness(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.concat("lang", F.lit(":"), F.col("n_chars").cast("string")).alias("id"))
    return d.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
