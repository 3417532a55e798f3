"""Many rules at once against each on its own, and inverted lists against exact neighbours."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from shelfspark.functions import arrow_text, vectors

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize(
    ("pattern", "literals"),
    [
        ("com/acme/ads", {"com/acme/ads"}), (r"com\.Acme\.ads", {"com.acme.ads"}), ("(?i)Licen[cs]e", {"licen"}), ("(?:tracker|analytics)x?", {"tracker", "analytics"}), ("a(bcd)+e", {"bcd"}), ("(abcd)?efg", {"efg"}),
        ("ab", None), ("x*", None), ("(abc|d)", None), (r"\p{Lu}abcd", None), ("[[:alpha:]]abcd", None), ("(?s)a.bcde", None), ("(", None), ("abc.*longer", {"longer"}), (r"\bfoo\b|barbar", {"foo", "barbar"}), ("com.unity3d|com.unityads", {"unity3d", "unityads"}),
    ],
)
def test_what_a_pattern_must_hold(pattern, literals):
    got = arrow_text.required(pattern)
    if literals is None:
        assert got is None
    else:
        assert got is not None and all(any(x in y for y in literals) or any(y in x for y in literals) for x in got), got


def test_required_literals_stand_in_every_match():
    rnd = random.Random(4)
    alphabet = "abKſsSKkß.é"
    for _ in range(4000):
        parts = [rnd.choice(["abk", "sSk", "(ab|kks)", "[ab]+", "(?:sk.a)?", "éab", ".", "(kab|ssa|abé)+", "ßa"]) for _ in range(rnd.randint(1, 4))]
        pattern = rnd.choice(["", "(?i)"]) + "".join(parts)
        need = arrow_text.required(pattern)
        if need is None:
            continue
        texts = pa.array(["".join(rnd.choice(alphabet) for _ in range(30)) for _ in range(4)] + ["".join(re.sub(r"[()|?+.\[\]:]", "", p) for p in parts)])
        for text, hit in zip(texts.to_pylist(), pc.match_substring_regex(texts, pattern).to_pylist(), strict=True):
            assert not hit or any(x in text.casefold() for x in need), (pattern, text)


def many(n):
    rnd = random.Random(n)
    words = "password token license secret api key street water house river".split()
    rules = [(f"r{k:04d}", rf"com/{rnd.choice(words)}{k}/[a-z]+" if k % 3 else rf"(?i)lib{k}(?:core|base){k}") for k in range(n - 4)]
    return [*rules, ("r0003x", r"(?i)\b(password|token)\b\s*[:=]"), ("r0100x", "(?i)licen[cs]e"), ("zz", r"\s\|\s"), ("r9999", r"\b[A-Z]{4,}\b")]


def test_many_rules_find_what_each_finds_and_cost_little_more(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(-1, "see com/river7/abc LIB6core6"), (-2, None), (-3, "")], "doc_id long, text string")).coalesce(1).cache()
    texts = df.select("doc_id", "text").toPandas().set_index("doc_id")["text"]
    took = {}
    for n in (20, 400):
        rules = many(n)
        once = lambda: {r.doc_id: r.rule for r in df.select("doc_id", arrow_text.first_match(F.col("text"), rules).alias("rule")).collect()}  # noqa: B023, E731
        got = once()
        begun = time.time()
        once()
        took[n] = time.time() - begun
        column = pa.array(texts.tolist(), pa.string())
        want = np.full(len(texts), None, object)
        for name, p in sorted(rules, reverse=True):
            want[pc.fill_null(pc.match_substring_regex(column, p), False).to_numpy(zero_copy_only=False)] = name
        assert got == dict(zip(texts.index.tolist(), want.tolist(), strict=True))
    assert took[400] < 4 * took[20] + 3  # with room for a busy machine


def test_inverted_lists_find_nearly_all(spark):
    v = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", vectors.quantize(F.col("embedding")).alias("v"))
    q = v.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query"), F.col("v").alias("q"))
    exact = {(r.query, r.vec_id): r.dot for r in vectors.top_k(q, v, 10).collect()}
    got = vectors.inverted_lists(q, v, 10).collect()
    assert sum((r.query, r.vec_id) in exact for r in got) >= 0.9 * len(exact)
    assert all(exact.get((r.query, r.vec_id), r.dot) == r.dot for r in got) and sorted({r["rank"] for r in got}) == list(range(1, 11))
    whole = vectors.Lists(vectors.fit_lists(v, lists=8).centres, 8, 1.0)  # all lists probed: exact
    assert {(r.query, r.vec_id): r.dot for r in vectors.inverted_lists(q, v, 10, whole).collect()} == exact


def test_pieces_of_lists_and_blocks_of_queries_change_nothing(spark, monkeypatch):
    v = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", vectors.quantize(F.col("embedding")).alias("v"))
    q = v.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query"), F.col("v").alias("q"))
    exact = sorted(map(tuple, vectors.top_k(q, v, 5).collect()))
    assert sorted(map(tuple, vectors.top_k(q, v, 5, block=7).collect())) == exact
    monkeypatch.setattr(vectors, "PIECE", 9)
    whole = vectors.Lists(vectors.fit_lists(v, lists=4).centres, 4, 1.0)
    assert sorted(map(tuple, vectors.inverted_lists(q, v, 5, whole).collect())) == exact


def test_no_vectors(spark):
    v = spark.createDataFrame([], "vec_id long, v array<tinyint>")
    q = spark.createDataFrame([], "query long, q array<tinyint>")
    assert vectors.top_k(q, v, 3).collect() == [] and vectors.fit_lists(v).probes == 1
    some = spark.createDataFrame([(k, [k, 1, 0]) for k in range(5)], "vec_id long, v array<tinyint>")
    one = spark.createDataFrame([(9, [1, 0, 0])], "query long, q array<tinyint>")
    assert [(r.vec_id, r.dot) for r in vectors.inverted_lists(one, some, 3).orderBy("rank").collect()] == [(4, 4), (3, 3), (2, 2)]
