"""The pipeline against brute force, stage by stage on each stage's own input."""

import random
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from shelfspark.llm import quality

from .conftest import PASSAGE, edge_rows
from .test_jaccard import shingles
from .test_scans_and_laws import BENCH, WORD, brute_hits, brute_quality, fill, jump


def rule_fails(text):
    """Does any of the seven rules fail? By plain counts."""
    words, chars, symbols, dup_lines, repeats = brute_quality(text)
    lines = sum(1 for x in (text or "").split("\n") if WORD.search(x))
    upper, lower = (sum(a <= c <= z for c in text or "") for a, z in ("AZ", "az"))
    return words < 50 or 100 * repeats > 50 * words or 100 * symbols > 25 * words or 100 * dup_lines > 50 * lines or chars < 2 * words or chars > 20 * words or upper > lower


def test_each_rule_rejects(spark, store):
    good = " ".join(f"word{k}" for k in range(60))
    texts = [good, good.upper(), "short", " ".join("abc def ghi".split() * 30), good.replace("w", "%"), "\n".join([good, "a b c d"] + ["x y"] * 200), " ".join("abcdefghij"[k % 10] for k in range(99)), " ".join("x" * 30 + str(k) for k in range(60)), None, ""]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, "").collect()}
    assert kept == {k for k, t in enumerate(texts) if not rule_fails(t)} and 0 in kept and not kept & {1, 2, 6, 7, 8, 9}


def corpus():
    rnd = random.Random(8)
    words = [f"word{k}" for k in range(400)]
    rows = []
    for i in range(150):
        kind = i % 10
        text = [rnd.choice(words) for _ in range(rnd.choice((20, 80, 200)))]
        if kind == 1 and rows:
            text = rows[rnd.randrange(len(rows))][1].split()
        if kind == 2 and rows:
            text = list(rows[rnd.randrange(len(rows))][1].split())
            text[rnd.randrange(len(text))] = "changed"
        if kind == 3:
            text[5:5] = PASSAGE.split()
        if kind == 4:
            text = [w + "%%" for w in text]
        rows.append((i, " ".join(text), "en", rnd.choice(["a", "b", "c", None]), len(text)))
    return rows + [rows[7], rows[7]]


def test_stages_take_effect(spark, store):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, n_chars long")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    d = store(documents=docs, benchmark=bench)
    kept, at = spark.read.parquet(f"{d}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in kept.select("doc_id", "text", "lang", "source", "n_chars").collect()]
        kept = stage(spark, kept, d)
        kept.write.parquet(f"{d}/{name.replace(' ', '_')}")
        kept = spark.read.parquet(f"{d}/{name.replace(' ', '_')}")
        at[name] = (before, [tuple(r) for r in kept.select("doc_id", "text", "lang", "source", "n_chars").collect()])
        if name != "sharding":
            assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    before, after = at["quality rules"]
    good = [r for r in before if not rule_fails(r[1])]
    assert Counter(after) == Counter(good) and len(after) < len(before)

    before, after = at["n-gram Jaccard join"]
    sets = [shingles(r[1], 5) for r in before]
    root = list(range(len(before)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(before)):
        for y in range(x):
            if 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                root[top(x)] = top(y)
    groups = {}
    for x, r in enumerate(before):
        groups.setdefault(top(x), []).append(r[0])
    assert sorted(r[0] for r in after) == sorted(min(g) for g in groups.values()) and len(after) < len(before)

    before, after = at["benchmark decontamination"]
    hit = {k[0] for k in brute_hits(before, BENCH) if k[5]}
    assert Counter(after) == Counter(r for r in before if r[0] not in hit) and hit

    before, after = at["mixing to target weights"]
    sizes = Counter()
    for r in before:
        sizes[r[3]] += len(WORD.findall(r[1]))
    target = fill(sizes, (3, 1, 2), 1.5, 2)
    times = Counter(r[0] for r in after)
    for r in before:
        rate = target[r[3]] / sizes[r[3]]
        assert int(rate) <= times[r[0]] <= int(rate) + (rate > int(rate))

    before, after = at["sharding"]
    assert Counter(before) == Counter(after)
    rows = kept.collect()
    assert all(r.shard == jump(r.doc_id, 8) and r.grown_shard == jump(r.doc_id, 9) for r in rows)
    for s in range(8):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))


def test_edges_and_clashing_columns(spark, store, edge, empty):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    odd = edge.withColumn("n_words", F.lit("mine")).withColumn("failed", F.lit(1)).withColumn("row_key", F.lit("k")).withColumn("copies", F.lit(2))
    for docs in (edge, empty, odd):
        d = store(documents=docs, benchmark=bench)
        got = spark.read.parquet(f"{d}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES:
            got = stage(spark, got, d)
            assert set(docs.columns) <= set(got.columns)
        got.count()
        assert corpus_pipeline.near_duplicates(spark, spark.read.parquet(f"{d}/documents.parquet"), d).count() == (0 if docs is empty else len({(r[0], r[1]) for r in edge_rows()}) - 1)


def test_run_matches_the_stages(spark, store):
    d = store(documents=spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, n_chars long"), benchmark=spark.createDataFrame(BENCH, "item_id long, text string"))
    kept = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept, d).write.parquet(f"{d}/{name.replace(' ', '_')}")
        kept = spark.read.parquet(f"{d}/{name.replace(' ', '_')}")
    rows = corpus_pipeline.run(spark, d)
    assert rows.columns == kept.columns
    assert Counter(map(tuple, rows.collect())) == Counter(map(tuple, kept.collect())) and rows.count() > 0
    assert quality.DEFAULT_POLICY in quality.POLICIES
