"""Corpora with broken lines, later lines of one path, and rules that do not compile."""

import json

from pyspark.sql import functions as F

from shelfspark.operators import joins
from shelfspark.sources import corpora


def lines(tmp_path, name, rows):
    path = tmp_path / name
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))
    return str(path)


def test_lines_are_kept_counted_or_left_out(spark, tmp_path):
    path = lines(tmp_path, "libs.jsonl", [
        {"id": "a", "path": "/a", "name": "first", "type": "x"}, {"ID": "b", "PATH": "/b", "Name": None}, "", "  ", '{"id": "cut', "[1]", "7", '"text"', "null",
        {"id": "c", "path": "/c", "name": 5}, {"id": "d", "path": ["/d"]}, {"id": "e", "path": "e"}, {"id": "t", "path": "/PathToLookFor"}, {"id": "a2", "path": "/a", "extra": {"y": [1]}}, {"path": "/none"},
    ])
    rows, rejected = corpora.library_corpus(spark, path)
    assert sorted(map(tuple, rows.collect())) == [("", "/none", "", ""), ("a2", "/a", "", ""), ("b", "/b", "", "")]
    assert {r.reason: r.n for r in rejected.collect()} == {"no object": 5, "other kind of value": 2}


def test_the_last_line_holds_however_a_file_is_cut(spark, tmp_path):
    path = lines(tmp_path, "big.jsonl", [{"id": f"i{k}", "path": f"/p{k % 50}", "name": "n" * (k % 90)} for k in range(3000)])
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        rows, _ = corpora.library_corpus(spark, path)
        assert rows.select("id").rdd.getNumPartitions() >= 1 and spark.read.text(path).rdd.getNumPartitions() > 10
        assert sorted(r.id for r in rows.collect()) == sorted(f"i{k}" for k in range(2950, 3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_details(spark, tmp_path):
    path = lines(tmp_path, "info.jsonl", [{"id": "a", "emphasize": 1, "anti": ["Ads"]}, {"id": "a", "anti": []}, {"id": "b", "emphasize": "2"}, {"id": "", "emphasize": 3}, {"id": "c", "anti": ["X", 4]}, {"id": "d"}])
    rows, rejected = corpora.library_details(spark, path)
    assert sorted(map(tuple, rows.collect())) == [("a", 0, []), ("d", 0, [])] and rejected.first().n == 2


def test_trackers(spark, tmp_path):
    doc = {"trackers": {"1": {"name": "Beta", "code_signature": r"com.beta.sdk|com\.b2", "categories": ["Advertisement", "Analytics"]}, "2": {"name": "Alpha", "code_signature": " com.alpha. "}, "3": {"name": "Short", "code_signature": "abc"}, "4": {"name": "Wrong", "code_signature": "com.(x"}, "5": {"name": "Look", "code_signature": "a(?=b)cd"}, "6": {"name": "None"}}}
    path = lines(tmp_path, "t.json", [json.dumps(doc, indent=1)])
    rules, rejected = corpora.tracker_rules(spark, path)
    assert sorted((r.name, r.code, r.path, r.anti) for r in rules.collect()) == [("Alpha", "com.alpha.", "/com/alpha", []), ("Beta", r"com.beta.sdk|com\.b2", "/com/beta/sdk", ["Ads", "Tracking"])]
    assert sorted(r.name for r in rejected.collect()) == ["Look", "Wrong"]
    assert corpora.tracker_rules(spark, lines(tmp_path, "no.json", ["no json"]))[0].collect() == []


def test_ties_of_one_prefix_have_an_order(spark):
    df = spark.createDataFrame([(1, "/a/b/c"), (2, "/a/x")], "k int, path string")
    rules = spark.createDataFrame([("/a/b", "one"), ("/a/b", "two"), ("/a", "top")], "prefix string, rule string")
    for r in (rules, rules.orderBy(F.desc("rule"))):
        assert sorted((x.k, x.rule) for x in joins.longest_prefix(df, r, "path", "prefix", ["k"]).collect()) == [(1, "two"), (2, "top")]
