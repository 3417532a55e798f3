"""Operators 2, 3, 5, 6, 9 and 10 against brute force on small tables of edge cases."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.llm import decontaminate, mixing, quality, queries, secrets, sharding, warc

from .conftest import PASSAGE, edge_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def jump(key, n):
    key, b, j = key % 2**64, -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_matches_the_published_walk(spark):
    keys = [0, 1, 2, -1, 2**63 - 1, -(2**63), 123456789, *range(1000, 1100)]
    for n in (1, 2, 8, 9, 31, 32, 33, 100, 1000, 20_000):
        got = {r.k: r.s for r in spark.createDataFrame([(k,) for k in keys], "k long").withColumn("s", sharding.jump_hash(F.col("k"), n)).collect()}
        assert got == {k: jump(k, n) for k in keys}


def test_op3(edge, empty, store, spark):
    rows = queries.op3_jump_shards(spark, store(documents=edge)).collect()
    assert len(rows) == len(edge_rows())
    slots = defaultdict(list)
    for r in rows:
        assert (r.shard, r.grown_shard, r.law) == (jump(r.doc_id or 0, 8), jump(r.doc_id or 0, 9), "key")
        assert r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in edge_rows())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert queries.op3_jump_shards(spark, store(documents=empty)).count() == 0


def test_shards_keep_clashing_columns(edge):
    got = sharding.shard(edge.withColumn("slot", F.lit("old")).withColumn("a.b", F.lit(1)), 4)
    assert got.columns.count("slot") == 1 and "a.b" in got.columns and dict(got.dtypes)["slot"] == "bigint"


def fill(sizes, weights, share, most):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        stop = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not stop:
            return out | {s: level * w[s] for s in open_}
        for s in stop:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= stop
    return out


def test_op5(edge, empty, store, spark):
    d = store(documents=edge)
    rows = queries.op5_mix_to_weights(spark, d).collect()
    sizes = defaultdict(int)
    for _, t, _, s, _ in edge_rows():
        sizes[s] += len(WORD.findall(t or ""))
    want = fill(sizes, (3, 1, 2), 1.5, 2)
    assert {round(r.target, 6) for r in rows} == {round(x, 6) for x in want.values()}
    assert all(r.taken % max(r["size"], 1) == 0 and r.taken <= 2 * r["size"] for r in rows)
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((i, len(WORD.findall(t or ""))) for i, t, *_ in edge_rows())
    assert sorted(map(str, rows)) == sorted(map(str, queries.op5_mix_to_weights(spark, d).collect()))
    assert queries.op5_mix_to_weights(spark, store(documents=empty)).count() == 0


def test_mix_meets_targets_and_repeats_rows(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 40).cast("int")).alias("text"), F.concat(F.lit("s"), F.col("id") % 5).alias("source"))
    per = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) < 0.06 * r.target for r in per)
    taken = {r.doc_id: r.copies for r in mixing.mix(docs).collect() if r.copies}
    assert taken == {r.doc_id: r["count"] for r in mixing.mixed_documents(docs).groupBy("doc_id").count().collect()}


def brute_quality(t):
    t = t or ""
    words = WORD.findall(t)
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {r for r, n in Counter(runs).items() if n > 1}
    covered = {i + k for i, r in enumerate(runs) if r in often for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def test_op6(edge, empty, store, spark):
    rows = queries.op6_rule_ledger(spark, store(documents=edge)).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    want = Counter()
    for i, t, *_ in edge_rows():
        m = brute_quality(t)
        want[(i, *m, m[0] < 50 or 100 * m[4] > 50 * m[0])] += 1
    assert got == want
    assert not any(r.kept and r.base_failed for r in rows)
    assert queries.op6_rule_ledger(spark, store(documents=empty)).count() == 0


def test_ablation_from_bits(spark):
    book = spark.createDataFrame([(0,), (0,), (1,), (3,), (4,)], "failed long")
    got = {r.rule: (r.failing, r.rejected_alone, r.kept, r.kept_without) for r in quality.ablation(book).collect()}
    assert got["few_words"] == (2, 1, 2, 3) and got["repeated_windows"] == (1, 0, 2, 2) and got["symbols"] == (1, 1, 2, 3)
    assert quality.ablation(book.limit(0)).count() == 0
    assert [r.failed for r in book.filter(quality.verdict("base-1")).collect()] == [0, 0, 4]


BW = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(t):
    return BW.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute_hits(docs, bench, window=10):
    items = {}
    for i, t in bench:
        w = lowered(t)
        if i is not None and w:
            n = min(window, len(w))
            items.setdefault(str(i), set()).update(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
    out = Counter()
    for i, t, *_ in docs:
        w, hit, ids = lowered(t), set(), set()
        for name, wins in items.items():
            for win in wins:
                for k in range(len(w) - len(win) + 1):
                    if tuple(w[k : k + len(win)]) == win:
                        hit.update(range(k, k + len(win)))
                        ids.add(name)
        out[(i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit))] += 1
    return out


BENCH = [(10, PASSAGE), (9, "so " + PASSAGE + " and"), (3, "one two three"), (4, "one two three"), (5, None), (6, "..."), (None, "eleven"), (7, "É")]


@pytest.mark.parametrize("block", [1_000_000, 60])
def test_op9(edge, empty, store, spark, block):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    short = edge.filter("doc_id is null or doc_id not in (6, 10)")
    found = decontaminate.find_benchmark(short, bench, block_words=block)
    got = Counter((r.doc_id, r.n_words, len(r.hit_words), len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), bool(r.hit_words)) for r in found.collect())
    assert got == brute_hits([r for r in edge_rows() if r[0] not in (6, 10)], BENCH)
    assert queries.op9_winnowing(spark, store(documents=empty, benchmark=bench)).count() == 0
    assert queries.op9_winnowing(spark, store(documents=edge, benchmark=bench.limit(0))).filter("contaminated").count() == 0


def test_winnowing_misses_no_long_run(spark):
    import random

    rnd = random.Random(4)
    docs = [(k, " ".join(rnd.choice("abc") for _ in range(rnd.randrange(0, 80)))) for k in range(60)]
    bench = [(k, " ".join(rnd.choice("abc") for _ in range(rnd.randrange(0, 40)))) for k in range(20)]
    for window, gram in ((10, 5), (6, 4), (4, 4)):
        found = decontaminate.find_benchmark(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"), window=window, gram=gram)
        got = Counter((r.doc_id, r.n_words, len(r.hit_words), len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), bool(r.hit_words)) for r in found.collect())
        assert got == brute_hits(docs, bench, window)


def brute_secrets(t):
    t = t or ""
    kinds = [("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, re.I | re.A), ("access", "AKIA[A-Z0-9]+", 0, 20, 0), ("hex", "[0-9a-f]+", 0, 24, 0)]
    out = []
    for k, (kind, p, g, n, flags) in enumerate(kinds):
        out += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(p, t, flags) if len(m[g]) >= n]
    return [x for *_, x in sorted(out)]


def test_op2(edge, empty, store, spark):
    rows = queries.op2_secret_ownership(spark, store(documents=edge)).collect()
    got = Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.spans, r.base_sha256) for r in rows)
    want = Counter()
    for i, t, *_ in edge_rows():
        s = brute_secrets(t)
        n = Counter(x.split(":")[0] for x in s)
        want[(i, n["assign"], n["access"], n["hex"], ",".join(s), hashlib.sha256(",".join(s).encode()).hexdigest())] += 1
    assert got == want
    assert queries.op2_secret_ownership(spark, store(documents=empty)).count() == 0


def test_ownership_tells_examples_from_live(spark):
    rows = [(k, f"password=copied{'abc'}", f"s{k % 4}") for k in range(8)] + [(50, "token=lonely123", "s1"), (51, "token=lonely123 secret=aaaaaaaa", "s1"), (52, "token=pair45678", "s1"), (53, "token=pair45678", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: (r.n_live, r.n_shared, r.n_example, r.n_filler) for r in secrets.scan_secrets(docs).collect()}
    assert got[0] == (0, 0, 1, 0) and got[50] == (1, 0, 0, 0) and got[51] == (1, 0, 0, 1) and got[53] == (0, 1, 0, 0)
    counts = {r.verdict: (r.owners, r.repositories, r.copies) for r in secrets.ownership(secrets.find_secrets(docs, keep=("doc_id", "source"))).collect()}
    assert counts["example"] == (4, 8, 8) and counts["live"] == (1, 2, 2) and counts["shared"] == (2, 2, 2)


def test_copies_in_many_repositories_of_one_owner_are_not_live(spark):
    rows = [(k, "password=copied123", "hot") for k in range(secrets.WIDE_REPOSITORIES)] + [(90, "token=lonely123", "hot")]
    got = {r.doc_id: (r.n_live, r.n_example) for r in secrets.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0] == (0, 1) and got[90] == (1, 0)


def test_a_full_stop_does_not_make_another_value(spark):
    rows = [(1, "token=lonely123", "a"), (2, "The token=lonely123.", "b"), (3, "token=lonely123...", "c")]
    got = {r.doc_id: (r.n_live, r.n_example) for r in secrets.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert set(got.values()) == {(0, 1)}


def test_values_given_away_elsewhere_and_further_kinds_are_added(spark):
    rows = [
        (1, "password=hunter2x9", "a"),
        (2, "quoted bare: hunter2x9, and hunter2x9.", "b"),
        (3, "nothing like hunter2x8 here", "c"),
        (4, "-----BEGIN RSA PRIVATE KEY-----\nMIIEabcdefghijklmnop\n-----END RSA PRIVATE KEY-----", "d"),
        (5, "see ftp://me:s3cretpw@host/x and ghp_abcdefghijklmnop1234", "e"),
    ]
    got = {r.doc_id: r for r in secrets.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    spans = {k: [(s.kind, rows[k - 1][1][s.start : s.end]) for s in r.secrets] for k, r in got.items()}
    assert spans[1] == [("assign", "password=hunter2x9")] and spans[2] == [("known", "hunter2x9")] * 2 and spans[3] == []
    assert [k for k, _ in spans[4]] == ["block"] and spans[5] == [("login", "ftp://me:s3cretpw@"), ("prefixed", "ghp_abcdefghijklmnop1234")]
    assert (got[1].n_shared, got[2].n_shared) == (1, 2)


def test_few_unequal_documents_meet_their_target(spark):
    rows = [(k, "w " * n, s) for s in "abc" for k, n in enumerate((900, 1, 40, 3, 500, 77, 10, 2, 250, 60), 100 * ord(s))]
    for df in (spark.createDataFrame(rows, "doc_id long, text string, source string"),):
        per = mixing.mix(df).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max(F.col("copies")).alias("c")).collect()
        assert all(abs(r.taken - r.target) <= 450 and r.c <= 2 for r in per)
    clash = spark.createDataFrame([(1, "a b", "s", 7)], "doc_id long, text string, source string, __copy int")
    assert mixing.mixed_documents(clash).columns == clash.columns


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_targets_of_the_tables(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    per = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max(F.col("size")).alias("largest")).collect()
    assert all(abs(r.taken - r.target) <= max(0.05 * r.target, r.largest / 2 + 1) for r in per)


PAGES = [(1, "http://a", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (3, None, None), (4, "u\r\nX: y", ""), (None, "c", "<p>x</p>"), (7, "d", "WARC/1.1\r\nContent-Length: 3\r\n\r\né\r\n\r\n"), (7, "d", "WARC/1.1\r\nContent-Length: 3\r\n\r\né\r\n\r\n"), (8, "e", "z" * 200_000), (9, "f", "z" * 200_000)]


@pytest.mark.parametrize("least", [0, 9])
def test_op10_round_trip(spark, tmp_path, least):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    warc.write_archives(warc.resolve(pages, least), f"{tmp_path}/a", per_file=2)
    got = Counter(tuple(r) for r in warc.resolved_records(spark, f"{tmp_path}/a").collect())
    top = {}
    for i, _, h in PAGES:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    want = Counter()
    for i, _, h in PAGES:
        raw = (h or "").encode()
        again = len(raw) >= least and i != top[h or ""]
        want[(i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", top[h or ""] if again else None)] += 1
    assert got == want


def test_archives_are_cut_by_bytes(spark, tmp_path):
    sizes = {k: 3_000_000 if k < 4 else 50_000 if k < 12 else 100 for k in range(60)}
    pages = spark.createDataFrame([(k, "u", f"{k} " + "z" * n) for k, n in sizes.items()], "page_id long, url string, html string").coalesce(1)
    warc.write_archives(warc.resolve(pages), f"{tmp_path}/a", per_file=40, file_bytes=1 << 20)
    files = sorted(p.stat().st_size for p in (tmp_path / "a").glob("part-*"))
    assert files[-1] < 3_001_000 and files[-5] < 1_500_000 and len(files) >= 6
    got = warc.resolved_records(spark, f"{tmp_path}/a").collect()
    assert {r.page_id: r.payload_bytes for r in got} == {k: len(f"{k} ") + n for k, n in sizes.items()}


def test_op10_empty(spark, store):
    none = spark.createDataFrame([], T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())]))
    assert queries.op10_warc_revisits(spark, store(pages=none)).count() == 0


def test_damaged_archives_are_refused():
    good = b"WARC/1.1\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    assert [bytes(b) for _, b in warc.records(good * 2)] == [b"ab", b"ab"]
    for bad in (good[:-1], good + b"x", good.replace(b": 2", b": 1")):
        with pytest.raises(ValueError):
            list(warc.records(bad))


def test_clashing_names_are_replaced_and_long_texts_read_whole(spark):
    from shelfspark.llm import suffixes, toxicity

    text = " ".join(f"w{k}" for k in range(60_000)) + " password=abcdef123 " + PASSAGE
    names = ["n_words", "hit_words", "items", "secrets", "bare", "score", "removed", "kept", "n_bytes", "kept_sha256", "failed_x", "text"]
    docs = spark.createDataFrame([tuple("v" for _ in names[:-1]) + (text,)], ", ".join(f"`{n}` string" for n in names))
    keep = tuple(n for n in names if n != "text")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    measured = quality.measure(docs, keep=keep).first()
    assert measured.n_words == 60_021 and measured.items == "v"
    found = decontaminate.find_benchmark(docs, bench, keep=keep).first()
    assert found.n_words == 60_022 and len(found.hit_words) == 20 and found.score == "v"
    held = secrets.find_secrets(docs, keep=keep).first()
    assert [s.kind for s in held.secrets] == ["assign"] and held.n_words == "v"
    left = suffixes.remove_repeats(docs, keep=("n_words", "kept", "removed")).first()
    assert left.n_words == "v" and left.n_bytes == len(text) and left.removed == []
    labels = spark.createDataFrame([("v", 1)], "n_words string, toxic int")
    scored = toxicity.score_toxicity(docs, labels, key="n_words", keep=keep).first()
    assert isinstance(scored.score, float) and scored.kept == "v"


def test_ablation_query_equals_its_twin(spark, store, edge):
    import duckdb

    d = store(documents=edge)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{d}/documents.parquet/*.parquet')")
    cursor = con.execute(queries.ORACLES["rule_ablation"])
    names = [c[0] for c in cursor.description]
    assert sorted(cursor.fetchall()) == sorted(tuple(r[n] for n in names) for r in queries.QUERIES["rule_ablation"](spark, d).collect())
