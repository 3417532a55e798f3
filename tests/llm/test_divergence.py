"""The source audit against plain sums over dictionaries."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import divergence as dv
from tests.llm.conftest import DOCS

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang, source in groups:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        mine = [s for g, s in groups if g == lang]
        every = Counter()
        for s in mine:
            every.update({t: counts[lang, s][t] for t in kept})

        def p(c, t):
            return 1 + 10**9 * (c[t] + 2) // (sum(c[k] for k in kept) + 2 * len(kept))

        f = lambda a, b: (a - b) ** 2 // (a + b)
        own = counts[lang, source]
        pairs = [(s, sum(f(p(own, t), p(counts[lang, s], t)) for t in kept)) for s in mine if s != source]
        terms = [(t, f(p(own, t), p(every, t))) for t in kept if own[t] and p(own, t) > p(every, t)]
        for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, dv.TOP)):
            for rank, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most], 1):
                out.append((lang, source, part, item, value, rank))
    return sorted(out)


def made(n, seed=3):
    rng = np.random.default_rng(seed)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)] + ["Éa", "ÉA", "x\u00a0y", "\U0001f600", "B", "b"]
    rows = []
    for k in range(n):
        picked = rng.choice(words, int(rng.integers(0, 40)))
        rows.append((k, " 9,".join(picked), ["en", "fr", None, "zz"][int(rng.integers(0, 4))], [None, "a", "b", "c", "d", "e", "\U0001f600", "\ufffd"][int(rng.integers(0, 8)) if k % 3 else 1], 1))
    return rows


@pytest.mark.parametrize("sizes", [{}, {"block_groups": 1, "piece_terms": 7}, {"block_groups": 2, "piece_terms": 20}])
def test_audit_equals_plain_sums(spark, sizes):
    rows = [*made(300), (1, None, "en", "none", 1), (2, "", "xx", "lonely", 1), (3, "", "xx", "other", 1), (4, "a b", "yy", "one", 1)]
    got = dv.audit_sources(spark.createDataFrame(rows, DOCS), least=5, **sizes).collect()
    assert sorted(map(tuple, got)) == brute(rows, 5)


def test_edges_and_repeated_rows(spark, edge):
    rows = [tuple(r) for r in edge.collect()]
    named = edge.withColumn("term", F.lit(1)).withColumn("n", F.lit("x")).withColumn("piece", F.lit(0)).withColumn("rank", F.lit(0))
    assert sorted(map(tuple, dv.audit_sources(named, least=2).collect())) == brute(rows, 2)
    assert brute(rows, 2)[0][4] >= 0


def test_empty_table(spark, empty):
    got = dv.audit_sources(empty)
    assert got.collect() == []
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_every_pair_of_blocks_meets_once(spark):
    for blocks in (2, 3, 6, 7):
        df = spark.range(blocks).select(F.col("id").cast("int").alias("b"))
        met = Counter()
        for turn in range(blocks + blocks % 2 - 1):
            for r in df.select("b", dv.peer(F.col("b"), F.lit(blocks), turn).alias("p")).filter("p IS NOT NULL").collect():
                met[min(r.b, r.p), max(r.b, r.p)] += 1
        assert met == {(a, b): 2 for a in range(blocks) for b in range(a + 1, blocks)}
        assert df.select(dv.peer(F.col("b"), F.lit(blocks), blocks + 1).alias("p")).filter("p IS NOT NULL").count() == 0


def test_shares_are_exact_for_large_counts():
    for n, whole in ((0, 7), (10**15, 10**15 + 7), (8 * 10**15, 9 * 10**15), (123456789012, 987654321098)):
        assert dv.shares(np.array([n]), whole).tolist() == [1 + 10**9 * (n + 2) // whole]


def test_words_of_a_batch_are_counted_by_source_and_document(spark):
    rows = [(1, "Aa aA b", "en", "s", 1), (1, "Aa aA b", "en", "s", 1), (2, "aa", "en", "t", 1), (3, "aa", "fr", "s", 1)]
    got = spark.createDataFrame(rows, DOCS).select("lang", "source", "text").mapInArrow(dv._count_words, "lang string, source string, term string, n long, docs long").groupBy("lang", "source", "term").agg(F.sum("n"), F.sum("docs")).collect()
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got if r.term} == {("en", "s", "aa"): (4, 2), ("en", "s", "b"): (2, 2), ("en", "t", "aa"): (1, 1), ("fr", "s", "aa"): (1, 1)}
    assert {tuple(r)[:2]: r[4] for r in got if r.term is None} == {("en", "s"): 2, ("en", "t"): 1, ("fr", "s"): 1}
