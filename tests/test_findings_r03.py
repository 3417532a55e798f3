"""What the findings of round 3 named: ties, exact gaps, letters with several capitals, and work that grew with the square of a text."""

import time

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from shelfspark.functions import text as tx
from shelfspark.functions import tokens, vectors
from shelfspark.operators import digest, digest_text, ordered, quotes, replies, scan, scoring, sinks, source_code
from shelfspark.plans import code_queries, lineage
from shelfspark.streaming import timed
from tests.test_timed_streams import BASE, Feed, at, dt, out, run


def test_keywords_of_a_long_text_search_it_a_few_times(spark):
    df = spark.range(8).select(F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(30_000)), lambda k: F.concat(F.lit("word"), k.cast("string")))).alias("x"))
    start = time.time()
    got = df.select(tx.accept_keywords(tx.fields(F.col("x")), F.col("x")).alias("k")).collect()
    assert time.time() - start < 40
    assert {tuple(r.k) for r in got} == {("word0", "word1", "word10", "word100", "word1000", "word10000", "word10001", "word10002")}


def test_lead_of_a_long_text_is_found_in_one_pass(spark):
    df = spark.range(8).select(F.repeat(F.lit("Ab cd. "), 30_000).alias("x"))
    start = time.time()
    got = df.select(tx.longest_lead(F.col("x")).alias("s")).select("s.*").collect()
    assert time.time() - start < 40
    assert {(r.k, r.lead) for r in got} == {(43, " ".join(["Ab cd."] * 43))}
    edge = spark.createDataFrame([("a" * 300 + ". b",), ("a" * 299 + ". b",), ("",), (None,)], "x string").select(tx.longest_lead(F.col("x")).alias("s"))
    assert [r.s and (r.s.k, len(r.s.lead)) for r in edge.collect()] == [None, (1, 300), None, None]


def test_nearest_takes_the_least_id_of_equal_ones(spark):
    left = spark.createDataFrame([(1, 10, 100), (2, None, 100), (1, 11, 108)], "event_id long, u long, t long").selectExpr("u AS event_id", "event_id AS u", "t").na.drop().unionByName(spark.createDataFrame([(12, None, 100)], "event_id long, u long, t long"))
    right = spark.createDataFrame([(7, 1, 90), (5, 1, 90), (6, 1, 110), (9, None, 100)], "event_id long, u long, t long")
    got = {r.event_id: r.match for r in ordered.nearest_within(left, right, ["u"], "t", 50, "event_id").collect()}
    assert got == {10: 5, 11: 6, 12: None}


def test_events_exactly_a_gap_apart_are_two_sessions(spark, tmp_path):
    feed = Feed(spark, str(tmp_path), "k string, ts timestamp")
    for rows in ([("a", 0), ("a", 59), ("a", 119)], [("z", 2000)], [("z", 2001)]):
        feed.put([(k, at(s)) for k, s in rows])
        run(timed.sessions(feed.stream(), "k", "ts", "60 seconds", "30 seconds"), tmp_path, "append")
    second = lambda t: int(t.replace(tzinfo=dt.UTC).timestamp()) - BASE
    assert sorted((r.k, second(r.start), second(r.stop), r.n) for r in out(spark, tmp_path)) == [("a", 0, 119, 2), ("a", 119, 179, 1)]


def test_capitals_are_one_for_one_and_new_symbols_go(spark):
    words = ["ßheit", "éa", "ŉx", "ᾀb", "ﬁn", "", "a"]
    got = [r.c for r in spark.createDataFrame([(k, w) for k, w in enumerate(words)], "k int, x string").coalesce(1).select(tx.capitalize(F.col("x")).alias("c")).collect()]
    assert got == ["ẞheit", "Éa", "ŉx", "ᾈb", "ﬁn", "", "A"]
    assert spark.range(1).select(tx.drop_symbols(F.lit("a\U0001fae0b☀c\U0001f6dcd"))).first()[0] == "a b c d"


def test_stems_of_a_corpus_are_formed_once(spark):
    words = lambda n: F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(n)), lambda k: F.concat(F.lit("term"), k.cast("string"))))
    corpus = F.concat(F.repeat(F.lit("the app that you use is for all of your "), 4000), words(20_000))
    df = spark.range(4).select(words(20_000).alias("corpus"), F.concat(words(600), F.lit(" other things elsewhere")).alias("about"), corpus.alias("long"))
    start = time.time()
    got = df.select(replies.unbacked_words(F.col("about"), F.col("long")).alias("why")).collect()
    assert time.time() - start < 40
    assert {r.why for r in got} == {None}
    few = df.select(replies.unbacked_words(F.lit("wholly unknown phrases"), F.col("long")).alias("why")).first().why
    assert few == "about uses words the developer did not: wholly, unknown, phrases"


def times_named(df, mark):
    return df._jdf.queryExecution().analyzed().toString().count(mark)


def test_a_note_reads_its_evidence_once(spark):
    df = spark.createDataFrame([("Scans codes", "CAMERA, Sentry")], "reason string, evidence string")
    got = df.select(scan.notes_text(F.concat("reason", F.lit("MARK_R")), F.concat("evidence", F.lit("MARK_E"))).alias("note"))
    assert times_named(got, "MARK_R") == 1 and times_named(got, "MARK_E") == 1
    assert df.select(scan.notes_text(F.col("reason"), F.col("evidence"))).first()[0] == "CAMERA. Scans codes. Libraries: Sentry."


def test_a_security_score_reads_its_reply_once(spark):
    rows = F.array(F.struct(F.lit("ads").alias("fact"), F.lit("yes").alias("value"), F.lit("Acme").alias("evidence")))
    wanted = F.array().cast("array<struct<fact:string,groups:array<array<string>>>>")
    want = {"action": F.lit(""), "warning": F.lit(None).cast("boolean"), "must": F.array().cast("array<array<string>>"), "must_not": F.array().cast("array<string>"), "notes": wanted}
    records = F.array(F.array(F.lit("ads"), F.lit("yes"), F.concat(F.lit("Acme"), F.lit("MARK_N"))))
    fails = scoring.score_security(want, {"rows": rows, "source": F.lit(""), "current": F.lit("")}, {"security": F.concat(F.lit("It may show ads."), F.lit("mark-s"))}, records, F.lit(None), F.lit(None))
    got = spark.range(1).select(fails.alias("f"))
    assert times_named(got, "mark-s") == 1 and times_named(got, "MARK_N") == 1
    assert got.first().f == {"hedge": '"may"'}


def test_a_garbled_text_is_read_once(spark):
    got = spark.range(1).select(replies.garbled(F.concat(F.lit("It is is fine. "), F.lit("MARK_G"))).alias("why"))
    assert times_named(got, "MARK_G") == 1 and got.first().why == 'doubled word "is is"'


def test_a_security_reply_is_read_once(spark):
    rows = F.array(F.struct(F.lit("ads").alias("fact"), F.lit("yes").alias("value"), F.lit("apk").alias("basis")))
    none, quoted = F.create_map().cast("map<string,string>"), F.array().cast("array<string>")
    text = F.concat(F.lit("Shows what others wrote."), F.lit(" mark-s"))
    got = spark.range(1).select(replies.security_reply_fails(text, F.lit(""), rows, none, F.lit("Zap"), F.lit(""), F.lit(""), quoted, F.lit("")).alias("why"))
    assert times_named(got, "mark-s") == 1
    assert got.first().why == "the scan has a tracking or ads library, but the note opens with no warning"


def test_equal_notes_and_sheets_are_judged_once(spark):
    scan_rows = "array<struct<fact:string,value:string,evidence:string>>"
    cases = spark.createDataFrame([(k, [None, "It may show ads. See relay.example.com", "no-change"][k % 3], "Now.", [("ads", "yes", "Acme")], [["ads", "yes", ["Acme", ""][k % 2]]]) for k in range(12)], f"k int, said string, current string, rows {scan_rows}, records array<array<string>>")
    wanted = F.array().cast("array<struct<fact:string,groups:array<array<string>>>>")
    want = {"action": F.lit("write"), "warning": F.col("k") < 6, "must": F.array(F.array(F.lit("ads"))), "must_not": F.array(F.lit("may")), "notes": wanted}
    parts = (want, {"rows": F.col("rows"), "source": F.lit(""), "current": F.col("current")}, {"security": F.col("said")}, F.col("records"), F.lit(None), F.when(F.col("k") == 11, "timeout"))
    each = cases.select("k", scoring.score_security(*parts).alias("fails"))
    scored = scoring.score_security_cases(cases, *parts).select("k", "fails")
    assert {r.k: r.fails for r in scored.collect()} == {r.k: r.fails for r in each.collect()}
    assert "might" in each._jdf.queryExecution().optimizedPlan().toString()
    assert "might" not in scored._jdf.queryExecution().optimizedPlan().toString()


def test_labels_meet_an_equal_note_once(spark):
    cases = spark.createDataFrame([(k, "See api.acme.io. " * (k % 2), ["write", "keep", ""][k % 3], [None, True, False][k % 3], [["gold"], [["ads"], []][k % 2]][: k % 3]) for k in range(24)], "k int, said string, action string, warning boolean, must array<array<string>>")
    rows = F.array().cast("array<struct<fact:string,value:string,evidence:string>>")
    want = {"action": F.col("action"), "warning": F.col("warning"), "must": F.col("must"), "must_not": F.array(F.lit("see")), "notes": F.array().cast("array<struct<fact:string,groups:array<array<string>>>>")}
    parts = (want, {"rows": rows, "source": F.lit(""), "current": F.lit("")}, {"security": F.col("said")}, F.array(F.array(F.lit("odd"))), F.when(F.col("k") % 5 == 0, "refused"), F.when(F.col("k") == 11, "timeout"))
    each = {r.k: r.fails for r in cases.select("k", scoring.score_security(*parts).alias("fails")).collect()}
    scored = scoring.score_security_cases(cases, *parts).select("k", "fails")
    assert {r.k: r.fails for r in scored.collect()} == each
    assert any("missing gold" in f.get("must", "") for f in each.values())
    assert scored.filter(F.map_keys("fails") != F.array_sort(F.map_keys("fails"))).isEmpty()
    assert "missing " not in scored._jdf.queryExecution().optimizedPlan().toString()


def test_code_is_read_a_few_files_at_a_time():
    n = 1000
    files = pa.RecordBatch.from_arrays([pa.array([1] * n), pa.array(["a.kt"] * n), pa.array(["fun f() = g(1)\n"] * n)], names=["tree_id", "path", "body"])
    out = list(source_code._read(["tree_id", "path", "functions", "calls", "mentions"])(iter([files])))
    assert sum(b.num_rows for b in out) == n and max(b.num_rows for b in out) <= 64
    assert [f["name"] for f in out[0].column("functions")[0].as_py()] == ["f"] and [c["callee"] for c in out[0].column("calls")[0].as_py()] == ["g"]


def test_calls_and_functions_come_from_one_reading(spark):
    plan = code_queries.code_calls(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "mapinarrow" not in plan.lower() and "pythonudf" not in plan.lower() and "_read(" not in plan


def test_blanked_text_is_passed_over():
    text = "/* " + "x y. " * 400_000 + '*/\nfun f() {\n  val s = """' + "it's one\n" * 200_000 + '"""\n  g(s)\n}\n'
    start = time.process_time()
    code = source_code.read_code(text, "a.kt")
    assert time.process_time() - start < 0.6
    assert code["functions"][0]["begin"] == 2 and [(c["line"], c["callee"]) for c in code["calls"]] == [(200_004, "g")]


def test_first_items_of_a_search_are_few():
    rng = np.random.default_rng(1)
    items, asked = rng.integers(-127, 128, (3000, 8), np.int8), rng.integers(-127, 128, (50, 8), np.int8)
    rows = pa.RecordBatch.from_arrays([pa.array(np.arange(3000)), pa.array(list(items), pa.list_(pa.int8()))], names=["vec_id", "v"])
    most, plain = [], np.nonzero
    try:
        np.nonzero = lambda x: most.append(x.size) or plain(x)
        got = list(vectors._best_of_block(asked, 10)(iter([rows])))
    finally:
        np.nonzero = plain
    assert most[0] == 50 * 16 and max(most) <= 50 * 1024 and sum(most) == 50 * 3000
    dots = asked.astype(int) @ items.T.astype(int)
    want = {(q, int(k)) for q in range(50) for k in np.lexsort((np.arange(3000), -dots[q]))[:10]}
    assert {(r["q"], r["vec_id"]) for b in got for r in b.to_pylist()} == want


def test_a_stem_of_a_repeated_word_is_formed_once(spark):
    df = spark.createDataFrame([("Sending notes, sending Notes and notebooks. " * 3,)], "x string")
    got = df.select(tx.content_stems(F.col("x")).alias("s"))
    assert got.first().s == ["send", "note", "notebook"] or got.first().s == ["send", "not", "notebook"]
    assert got._jdf.queryExecution().analyzed().toString().count("array_distinct") == 2


def test_ids_of_word_pieces_leave_python_in_parts(spark):
    letters = {"[UNK]": 0, "[CLS]": 1, "[SEP]": 2, "a": 3, "##b": 4}
    df = spark.createDataFrame([(k, ["ab a", None, "x"][k % 3]) for k in range(300)], "k int, x string").coalesce(1)
    got = df.select("k", tokens.wordpiece(F.col("x"), letters).alias("t"))
    assert "ArrowEvalPython" in got._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r.t) for r in got.collect()} == {(1, 3, 4, 3, 2), (1, 2), (1, 0, 2)}
    words = tokens._each_token("a " * 10)
    assert next(words) == "a" and not isinstance(words, list)


def test_lines_are_gone_through_only_where_a_word_occurs(spark):
    body = "val a = 1\n  // login(x)\nimport b.login(\n  auth.signIn(user)\nif (checkSelfPermission(CAMERA)) {\n"
    code = spark.createDataFrame([(1, "a.py", body), (2, "b.py", "x = 1\n")], "tree_id int, path string, body string")
    got = digest_text.account_quotes(code).collect()
    assert [(r.tree_id, r.path) for r in got] == [(1, "a.py")] and got[0].a <= 3 <= got[0].b
    marks = code.select("tree_id", digest_text._choice_lines(F.col("body")).alias("c"))
    assert {r.tree_id: r.c for r in marks.collect()} == {1: [4], 2: []}
    assert times_named(spark.range(1).select(quotes.is_choice(F.concat(F.lit("x"), F.lit("MARK_C"))).alias("c")), "MARK_C") == 1
    assert times_named(spark.range(1).select(quotes.is_account(F.concat(F.lit("x"), F.lit("MARK_A"))).alias("a")), "MARK_A") == 1


def test_a_class_of_many_apps_is_looked_up_once(spark, monkeypatch):
    made = {}
    whole = digest.cut
    monkeypatch.setattr(digest, "cut", lambda df, name="cut": made.setdefault(name, whole(df, name)))
    classes = spark.createDataFrame([(app, path) for app in range(20) for path in ("/com/acme/ads/A", "/com/acme/B", "/org/none/C")], "app_id int, path string")
    corpus = spark.createDataFrame([("a", "/com/acme", "Acme", "x"), ("b", "/com/acme/ads", "Ads", "y")], "id string, path string, name string, type string")
    info = spark.createDataFrame([("b", 1, ["Ads"])], "id string, emphasize int, anti array<string>")
    got = digest.detect_libraries(classes, corpus, info)
    assert sorted(map(tuple, got.collect())) == sorted(x for app in range(20) for x in ((app, "a", "Acme", "x", "/com/acme", 0, []), (app, "b", "Ads", "y", "/com/acme/ads", 1, ["Ads"])))
    assert sorted(r.class_path for r in made["class-paths"].collect()) == ["/com/acme/B", "/com/acme/ads/A"]


def test_cases_stay_where_they_are_while_judged_classes_are_few(spark, monkeypatch):
    cases = spark.createDataFrame([(k, "It may show ads. " * (k % 2), [[["ads"]], []][k % 2]) for k in range(12)], "k int, said string, must array<array<string>>")
    rows = F.array(F.struct(F.lit("ads").alias("fact"), F.lit("yes").alias("value"), F.lit("Acme").alias("evidence")))
    want = {"action": F.lit("write"), "warning": F.col("k") < 6, "must": F.col("must"), "must_not": F.array(F.lit("may")), "notes": F.array().cast("array<struct<fact:string,groups:array<array<string>>>>")}
    parts = (want, {"rows": rows, "source": F.lit(""), "current": F.lit("")}, {"security": F.col("said")}, F.array(F.array(F.lit("ads"), F.lit("yes"), F.lit(""))), F.lit(None), F.lit(None))
    each = {r.k: r.fails for r in cases.select("k", scoring.score_security(*parts).alias("fails")).collect()}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most, joins in ((12, "BroadcastHashJoin"), (0, "SortMergeJoin")):
            monkeypatch.setattr(scoring, "BROADCAST_CLASSES", most)
            scored = scoring.score_security_cases(cases, *parts).select("k", "fails")
            assert {r.k: r.fails for r in scored.collect()} == each
            assert {j for j in ("BroadcastHashJoin", "SortMergeJoin") if j in scored._jdf.queryExecution().executedPlan().toString()} == {joins}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_lines_are_clipped_before_they_travel_and_a_quote_is_scored_once(spark):
    n = quotes.LINE_SIGNS
    texts = ["\t a b \x0b", "{}", "", "x" * n + "  ", "y" * (n - 1) + " z", " " + "z" * (n - 1) + "  ", "é" * (n + 1), "\u00a0", "w" * 400 + " " * 9]
    line = lambda x: x.strip(" \t\n\x0b\f\r")[:n]
    got = spark.createDataFrame([(texts,)], "x array<string>").select(quotes.telling_lines(F.col("x")).alias("t")).first().t
    assert got == [line(x) if x not in ("{}", "") else None for x in texts]
    body = "fun f(a: Int) {\n  val s = \"" + "q" * 5000 + "\"\n\n  http.post(s)\n}\n" + "fun g() = f(1)\n"
    files = spark.createDataFrame([(1, "a.kt", body), (1, "b.kt", "val z = 1\n")], "tree_id int, path string, body string")
    got = sinks.sink_groups(files, source_code.parsed(files)).first()
    assert [(x.line, len(x.text)) for x in got.lines] == [(1, 15), (2, n), (4, 12)]
    lines = F.array(F.struct(F.lit("a").alias("path"), F.concat(F.lit("MARK_T"), F.col("id").cast("string")).alias("text")))
    assert times_named(spark.range(1).select(sinks.score(lines, F.lit("a"), F.lit(False)).alias("s")), "MARK_T") <= 2


def test_scan_rows_go_to_as_many_tasks_as_there_are_rows_for(spark, monkeypatch):
    apps = spark.createDataFrame([(k, f" H{k}", k % 2 == 0, ["android.permission.CAMERA"]) for k in range(40)], "app_id int, hash string, manifest boolean, permissions array<string>")
    libraries = spark.createDataFrame([(k, "/io/sentry", "Sentry", "Mobile Analytics", "/io/sentry", []) for k in range(40)], "app_id int, id string, name string, type string, path string, anti array<string>")
    few = scan.prose(scan.scan_rows(apps, libraries), ["app_id"])
    want = sorted(map(tuple, few.collect()))
    assert "REPARTITION_BY_NUM" not in few._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(lineage, "ROWS_A_TASK", 2)
    many = scan.prose(scan.scan_rows(apps, libraries), ["app_id"])
    assert "REPARTITION_BY_NUM" in many._jdf.queryExecution().executedPlan().toString() and ", 20)" in many._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, many.collect())) == want and len(want) == 40
