"""Row fixtures of the rules that SQL has no twin for, and of edge cases."""

import struct
import sqlite3
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.functions import about, markdown, tokens, urls, vectors
from shelfspark.functions import text as tx
from shelfspark.functions.regex import quote, re2_to_java
from shelfspark.operators import digest, evals, facts, ordered, quotes, replies, tables, trees
from shelfspark.sources import files, sqlite


def one(spark, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}")


def test_regex_translation(spark):
    rows = [("cafés", r"\bs", True), ("a\n", "a$", False), ("a\rb", "a.b", True), ("É", "(?i)é", True), ("x[$]", r"[$]\]", True)]
    df = spark.createDataFrame([(k, t) for k, (t, _, _) in enumerate(rows)], "k int, x string")
    for k, (_, p, want) in enumerate(rows):
        assert df.filter(F.col("k") == k).select(F.col("x").rlike(re2_to_java(p))).first()[0] is want, p
    for bad in (r"(?=a)", r"\Qa\E", r"a++"):
        with pytest.raises(ValueError):
            re2_to_java(bad)
    assert one(spark, "a.\\Eb").select(F.col("x").rlike(quote("a.\\Eb"))).first()[0]


def test_language(spark):
    rows = ["This is a simple app that you can use to keep your notes in one place.", "这是一个简单的应用程序，可以用来记录你的想法和笔记。", "Dies ist eine einfache Anwendung zum Schreiben von Notizen und Listen", "Nostr"]
    got = [r.e for r in spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "k int, x string").orderBy("k").select(tx.prose(tx.language_stats(F.col("x"))).alias("e")).collect()]
    assert got == [True, False, False, None]
    ui = [["Save", "Cancel", "Open the file", "Delete all", "Share", "Search", "Settings", "Log in to your account"], ["保存", "取消", "打开", "删除", "分享", "搜索", "设置", "登录账户"], ["Save", "Cancel"]]
    got = [r.e for r in spark.createDataFrame([(k, u) for k, u in enumerate(ui)], "k int, x array<string>").orderBy("k").select(tx.english_ui(F.col("x")).alias("e")).collect()]
    assert got == [True, False, None]


def test_text_helpers(spark):
    row = one(spark, "a b  c​").select(tx.one_line(F.col("x")), tx.visible(F.col("x")), tx.clip_bytes(F.lit("aé€b"), 4), tx.clip_bytes(F.lit("aé"), 2), tx.capitalize(F.lit("éa")), tx.drop_symbols(F.lit("a☀b"))).first()
    assert row[0].startswith("a b c") and "​" not in row[1] and row[2:] == ("aé", "a", "Éa", "a b")
    stems = one(spark, "x").select(F.transform(F.array(*[F.lit(w) for w in ("signing", "signs", "stories", "creations", "share", "bee")]), tx.stem)).first()[0]
    assert stems == ["sign", "sign", "story", "creation", "shar", "bee"]
    names = ["ox chat", "box sync tool", "send coins now", "SEND  coins now", "one", "find a quiet place", "relay list sync", "two words"]
    assert one(spark, names, "array<string>").select(tx.accept_queries(F.col("x"), F.lit("Ox"))).first()[0] == ["box sync tool", "send coins now", "find a quiet place", "relay list sync", "two words"]
    assert one(spark, ["Nostr", "-", "wallet app", "not there", "lightning"], "array<string>").select(tx.accept_keywords(F.col("x"), F.lit("a Nostr wallet app. Lightnings"))).first()[0] == ["nostr", "wallet app"]


def test_html_heads(spark):
    page = "<html><head><title>Amber &amp; friends</title><meta content='Nostr event signer for Android.' name=description></head><body><meta name=\"description\" content=\"no\"></body></html>"
    row = one(spark, page).select(urls.unescape(urls.raw_title(F.col("x"))), urls.public_https(F.lit("http://a.b")), urls.public_https(F.lit("https://u@a.b")), urls.public_https(F.lit("https://localhost/x")), urls.public_https(F.lit("https://a.b/c"))).first()
    assert tuple(row) == ("Amber & friends", False, False, False, True)


def test_markdown():
    text = "# Zap\n\n![x](y) Zap is a **fast** [signer](https://z.z).\nIt signs.\n\n## Install\n\nrun it\n\n### Deep\nmore\n\n## Features\n- [x] keeps keys\n- [ ] not yet\n- signs `events`\n\n```\ncode here\n```\n| a | b |\n\nSetext\n------\nLast words here.\n\n## Empty\n"
    assert markdown.paragraphs(text) == ["# Zap", "Zap is a fast signer. It signs.", "# Features", "- keeps keys", "- signs events", "# Setext", "Last words here."]
    assert markdown.lead(text).startswith("Zap is a fast") and markdown.paragraphs(None) == []
    assert markdown.brief("one two three\n\nfour five six\n\nseven", 29) == "one two three\n\nfour five six"


def test_about_editing(spark):
    assert about.edit("com.acme.blue", "Blue", "Blue is a player for music. Get it on F-Droid.") == ("Player for music.", True)
    assert about.edit("com.acme.zap", "Zap", "Zap lets you send coins with the Zap app") == ("Lets you send coins with the app.", True)
    assert about.edit("a.b", "Relagent", "Uses the Relagent Engine to think.")[1] is False
    said = [("Zap", "we say Zap", "Use Zap now"), ("Calendar", "a calendar", "The Calendar shows"), ("Zz", "", "Zz"), ("A\\Eb", "", "an A\\Eb here")]
    got = spark.createDataFrame([(k, *r) for k, r in enumerate(said)], "k int, n string, d string, t string").orderBy("k").select(replies.names_app(F.col("n"), F.col("d"), F.col("t"))).collect()
    assert [r[0] for r in got] == [True, False, False, True]
    odd = spark.createDataFrame([("see 1.2\\E.3 here", "1.2\\E.3")], "t string, v string")
    assert odd.select(trees.has_version(F.col("t"), F.col("v")), digest.token_in(F.col("t"), F.col("v")), quotes.contains_word(F.col("t"), F.col("v"))).first() == (True, True, True)


def test_vectors_and_tokens(spark):
    row = one(spark, [-0.3, 0.0, 0.3, 0.6, -0.6], "array<float>").select(vectors.quantize(F.col("x")), vectors.l2(F.array(F.lit(0.0).cast("float"))), vectors.project(F.col("x"), [[1, 0, 0, 0, 0]], [0.5])).first()
    assert list(row[0]) == [-127, 0, 127, 127, -127] and list(row[1]) == [0.0] and abs(row[2][0] - 0.2) < 1e-6
    vocabulary = tokens.load_vocabulary(["[PAD]", "[unused0]", "[UNK]", "[CLS]", "[SEP]", "zap", "##per", "app"])
    assert tokens.encode("Zapper app!", vocabulary) == [3, 5, 6, 7, 2, 4] and tokens.encode(None, vocabulary) == [3, 4] and len(tokens.encode("app " * 900, vocabulary)) == 512


def test_facts(spark):
    rows = spark.createDataFrame([("a", "ads", "no", "", "x", 1), ("a", "ads", "yes", "", "b, a", 2), ("a", "ads", "no", "why", "a", 3), ("a", "", "yes", "", "", 4), ("a", "cam", "maybe", "", "", 5)], "app string, fact string, value string, reason string, evidence string, pos int")
    got = [tuple(r) for r in facts.one_per_fact(rows, ["app"]).collect()]
    assert got == [("a", "ads", "yes", "why", "a, b, x", 1)]
    line = one(spark, 'say "hi"').select(facts.csv_line(F.col("x"), F.lit("")), facts.csv_minimal(F.col("x"), F.lit("plain"), F.lit("a,b"))).first()
    assert tuple(line) == ('"say ""hi""",""', '"say ""hi""",plain,"a,b"')
    assert tuple(one(spark, "n\n---\nb\nc").select(facts.split_notice(F.col("x"))).first()[0]) == ("n", "b\nc")


def test_plans_and_tables(spark):
    target = spark.createDataFrame([("a", "x\n", "t"), ("b", "y\n", "u")], "id string, about string, trust string")
    updates = spark.createDataFrame([("a", "", ""), ("c", "z\n", "v")], "id string, about string, trust string")
    got = sorted(tuple(r) for r in tables.merge(target, updates, "id", clears=("trust",)).collect())
    assert got == [("a", "x\n", ""), ("b", "y\n", "u"), ("c", "z\n", "v")]
    waits = [r[0] for r in spark.range(1, 9).select(tables.backoff_seconds(F.col("id"))).collect()]
    assert waits[:5] == [86400 * 2**k for k in range(5)] and waits[5:] == [2592000] * 3
    assert one(spark, "HTTPS://A.b/c//").select(tables.remote_key(F.col("x"))).first()[0] == "https://a.b/c"
    assert sorted(r.n for r in ordered.keep_first(spark.createDataFrame([(1, "a", 9), (2, "a", 8), (3, "b", 7)], "p int, k string, n int"), ["k"], "p").collect()) == [7, 9]


def test_strict_cases(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("split", T.StringType())])
    good = tmp_path / "a.jsonl"
    good.write_text('// note\n\n{"id":"1","split":"dev"}\n{"id":"2","split":"train"}\n')
    assert evals.read_cases(spark, [str(good)], schema).count() == 2
    for text in ('{"id":"1","split":"dev","odd":1}\n', "no json\n", '{"split":"dev"}\n', '{"id":"1"}\n{"id":"1"}\n'):
        bad = tmp_path / "b.jsonl"
        bad.write_text(text)
        with pytest.raises(Exception, match="unknown key|not a JSON|no id|not unique"):
            evals.read_cases(spark, [str(bad)], schema).collect()
    assert one(spark, 'Sure:\n```json\n{"a": 1}\n```').select(evals.json_from_reply(F.col("x"), "a int")).first()[0].a == 1


def test_sources(spark, tmp_path):
    db = tmp_path / "t.db"
    with sqlite3.connect(db) as con:
        con.execute("CREATE TABLE app (id TEXT, n INTEGER, b BLOB)")
        con.executemany("INSERT INTO app VALUES (?, ?, ?)", [(f"a{k}", k, b"x") for k in range(10)])
    sqlite.register(spark)
    got = spark.read.format("sqlite").option("path", str(db)).option("table", "app").load()
    assert dict(got.dtypes) == {"id": "string", "n": "bigint", "b": "binary"} and sorted(r.n for r in got.collect()) == list(range(10))
    refs = one(spark, "aaa refs/tags/v1.2.3\nccc refs/tags/v1.2.3^{}\nbbb refs/heads/main\n")
    assert {r.ref: r.sha for r in files.git_refs(refs.withColumn("k", F.lit(1)), "k", "x").collect()} == {"refs/tags/v1.2.3": "ccc", "refs/heads/main": "bbb"}
    csv = one(spark, '"a","b ""q"", c"\nx,,z\n')
    assert [r.record for r in files.csv_records(csv.withColumn("k", F.lit(1)), "x", "k").orderBy("pos").collect()] == [["a", 'b "q", c'], ["x", "", "z"]]


def dex(names):
    body, at, offsets = b"", 0x70 + 4 * len(names) * 2 + 32 * len(names), []
    for n in names:
        offsets.append(at + len(body))
        body += bytes([len(n)]) + n.encode() + b"\0"
    k, strings_at = len(names), 0x70
    types_at, classes_at = strings_at + 4 * k, strings_at + 8 * k
    head = bytearray(0x70)
    head[:8] = b"dex\n035\0"
    struct.pack_into("<4I", head, 56, k, strings_at, k, types_at)
    struct.pack_into("<2I", head, 96, k, classes_at)
    return bytes(head) + struct.pack(f"<{k}I", *offsets) + struct.pack(f"<{k}I", *range(k)) + b"".join(struct.pack("<8I", c, *[0] * 7) for c in range(k)) + body


def test_apk_containers(spark, tmp_path):
    path = tmp_path / "a.apk"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("classes.dex", dex(["Lcom/acme/A;", "Lorg/b/C;"]))
        z.writestr("lib/arm64-v8a/libflutter.so", b"x")
    df = spark.createDataFrame([("a", path.read_bytes()), ("b", b"broken"), ("c", None)], "id string, content binary")
    got = {r.id: (r.classes, r.native) for r in files.apk_parts(df, "id", "content").collect()}
    assert got == {"a": (["/com/acme/A", "/org/b/C"], ["libflutter.so"]), "b": ([], []), "c": ([], [])}


def test_trees(spark):
    paths = {"README.md": True, "lib/hidden/exfil.dart": True, "node_modules/x/index.js": False, "img/a.png": False}
    got = {r.p: r.k for r in spark.createDataFrame([(p,) for p in paths], "p string").select("p", digest.keep_path(F.col("p")).alias("k")).collect()}
    assert got == paths
    tree = spark.createDataFrame([("t", "docs/README.md", "deep"), ("t", "README.md", " top "), ("t", "a.kt", "fun f(x) {\n  if (y) {\n  }\n  send()\n}\nval z")], "tree_id string, path string, body string")
    assert digest.best_readme(tree).first().readme == "top"
    assert [r[0] for r in spark.createDataFrame([("at 1.2.3 out",), ("11.2.3",), ("1.2.3.4",)], "x string").select(digest.token_in(F.col("x"), F.lit("1.2.3"))).collect()] == [True, False, False]


def test_tokens_keep_accents_long_words_and_split_signs():
    assert tokens.basic_tokens("Café naïve—x€y\x07 カナ漢字 a​b") == ["café", "naïve", "—", "x", "€", "y", "カ", "ナ", "漢", "字", "a​b"]
    vocabulary = tokens.load_vocabulary(["[PAD]", "[UNK]", "[CLS]", "[SEP]", "a", "##a", "é"])
    assert tokens.encode("a" * 150, vocabulary) == [2, 4, *[5] * 149, 3] and tokens.encode("É e", vocabulary) == [2, 6, 1, 3]
