"""Calls of the API, archives, model files, stored trees and lines, drafts and training exports that fail."""

import io
import json
import struct
import tarfile

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from shelfspark import api
from shelfspark.operators import listing, replies, scoring, store, tables
from shelfspark.sources import archives, files


def test_per_row_and_checks(spark):
    rows = spark.range(20).select(F.col("id"), F.concat(F.lit("t"), "id").alias("content"), (F.col("id") % 4).alias("k"))
    got = api.per_row(rows, lambda r: [{"id": r["id"], "n": r["id"] * 2}] * (r["id"] % 3), "id long, n long", 3)
    assert got.rdd.getNumPartitions() == 3 and got.count() == sum(i % 3 for i in range(20))
    judged = api.checked(rows, lambda t: None if t.endswith(("5", "6")) else "no")
    assert sorted((r.k, r.id) for r in api.first_accepted(judged, "k", "id").collect()) == [(0, 16), (1, 5), (2, 6), (3, 15)]
    assert api.checked(rows, F.when(F.col("id") > 3, "big")).filter("why IS NULL").count() == 4


def test_caches_keep_their_generation_and_age(spark):
    empty = spark.createDataFrame([], "kind string, key string, value string, at long")
    new = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string")
    cache = api.TableCache(empty, "site").put(new, "k", "v", 1000).put(new.filter("k = 'a'").withColumn("v", F.lit("3")), "k", "v", 2000)
    hits = lambda c, now: {r.k: (r.value, r.hit) for r in c.get(new.select("k"), "k", now).collect()}
    assert hits(cache, 2000) == {"a": ("3", True), "b": ("2", True)}
    assert hits(cache, 1001 + api.KEEP["site"]) == {"a": ("3", True), "b": (None, False)}
    assert hits(api.TableCache(cache.rows, "site", 5), 2000) == {"a": (None, False), "b": (None, False)} and cache.prune(1500).rows.count() == 1


def test_reviews_and_reports(spark):
    want = "struct<action:string,about:string,must:array<array<string>>,must_not:array<string>>"
    cases = spark.createDataFrame([("a", "train", ["draft"], "", ("write", "", [["x"]], []), "d"), ("b", "odd", [], "", ("", "", [], []), "")], f"id string, split string, tags array<string>, note string, want {want}, description string")
    actions = spark.createDataFrame([("a", 1, "approve", False, ""), ("b", 2, "approve", False, ""), ("b", 3, "reject", False, " bad ")], "id string, at long, action string, forced boolean, reason string")
    got = {r.id: (r.status, list(r.tags), r.note, r.refusals) for r in api.review_items("about", cases, actions).collect()}
    assert got == {"a": ("approved", ["reviewed"], "", 0), "b": ("rejected", [], "rejected: bad", 1)}
    results = spark.createDataFrame([({}, ["t"]), ({"name": "x"}, [])], "fails map<string,string>, tags array<string>")
    assert api.report_lines(results, ["name", "must"]) == ["pass      50.0% (1/2)", "", "failed checks", "  name      1", "", "by tag", "  t                    100.0% (1/1)", "  untagged               0.0% (0/1)"]


def test_command_line(capsys):
    assert api.main(["list"]) == 0 and "scan_rows" in capsys.readouterr().out.split()
    with pytest.raises(SystemExit):
        api.main(["run", "no-such-query", "x"])


def test_snapshots(spark, tmp_path):
    lines = [{"app_id": "a", "tags": [["f", "android-arm64-v8a"]]}, {"app_id": "b", "tags": [["f", "linux"]]}, {"app_id": "c", "tags": []}]
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w") as t:
        for name, body in (("x/l.jsonl", "\n".join(map(json.dumps, lines)).encode()), ("x/readme", b"no")):
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    (tmp_path / "s.tar.zst").write_bytes(zstandard.ZstdCompressor().compress(raw.getvalue()))
    assert archives.archive_entries(spark, str(tmp_path)).count() == 2
    assert [r.app_id for r in archives.snapshot_listings(spark, str(tmp_path), "app_id string, tags array<array<string>>").collect()] == ["a"]


def test_tensors():
    w, b = np.array([[1, 2], [3, 4]], "<f4"), np.array([0.5, -1], "<f4")
    head = json.dumps({"__metadata__": {}, "linear.weight": {"dtype": "F32", "shape": [2, 2], "data_offsets": [0, 16]}, "linear.bias": {"dtype": "F32", "shape": [2], "data_offsets": [16, 24]}}).encode()
    raw = struct.pack("<Q", len(head)) + head + w.tobytes() + b.tobytes()
    assert archives.dense(raw) == ([[1, 2], [3, 4]], [0.5, -1])
    with pytest.raises(ValueError):
        archives.dense(raw[:-4])


def test_verified_files(spark):
    f = spark.createDataFrame([("a", b"x"), ("b", b"y"), ("c", b"z")], "app_id string, content binary")
    want = spark.createDataFrame([("a", " 2D711642B726B04401627CA9FBAC32F5C8530FB1903CC4DB02258717921A4881 "), ("b", "00"), ("c", "")], "app_id string, hash string")
    assert [r.app_id for r in archives.verified(f, want).collect()] == ["a"]


def test_stored_trees_and_lines(spark, tmp_path):
    once = spark.createDataFrame([("a", "x")], "path string, body string")
    assert store.store_tree(spark, str(tmp_path), "c1", once).count() == 1
    assert store.store_tree(spark, str(tmp_path), "c1", once.union(once)).count() == 1
    path = str(tmp_path / "lines")
    assert store.read_lines(spark, path).count() == 0
    store.rewrite(spark, path, lambda old: old.union(spark.createDataFrame([("one",)], "value string")))
    store.rewrite(spark, path, lambda old: old.union(spark.createDataFrame([("two",)], "value string")))
    assert sorted(r.value for r in store.read_lines(spark, path).collect()) == ["one", "two"]
    store.write_json_lines(spark.createDataFrame([(1, None), (2, "<b>")], "a int, b string"), str(tmp_path / "json"))
    assert sorted(r.value for r in store.read_lines(spark, str(tmp_path / "json")).collect()) == ['{"a":1}', '{"a":2,"b":"<b>"}']


def test_sheets_and_drafts(spark):
    raw = '"ads","yes","Acme"\n"ads","no",""\n"camera","TRUE","CAMERA. Scans"\nodd\n"x","maybe",""'
    df = files.csv_records(spark.createDataFrame([(1, raw)], "k int, c string"), "c", "k").groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "record"))), lambda s: s["record"]).alias("r"))
    got = df.select(replies.parse_sheet(F.lit(raw), F.col("r")).alias("s"), replies.parse_sheet(F.lit(" No-Change "), F.col("r")).alias("n")).first()
    assert dict(got.s.facts) == {"ads": "no", "camera": "yes"} and dict(got.s.reasons) == {"ads": "Acme", "camera": "CAMERA. Scans"} and got.n.no_change and not got.s.no_change
    good, bad = store.split_drafts(spark.createDataFrame([(1, None), (2, "x")], "id int, why string"))
    assert good.columns == ["id"] and (good.count(), bad.count()) == (1, 1)
    groups = spark.createDataFrame([('["a","b"]',), ('[["a"],["b"]]',), ("[]",)], "x string").select(scoring.phrase_groups(F.col("x")).alias("g")).collect()
    assert [r.g for r in groups] == [[["a", "b"]], [["a"], ["b"]], []]


def test_exports_refuse_bad_references(spark):
    reply = "struct<verdict:string,about:string,keywords:array<string>,queries:array<string>>"
    row = ("a", "train", "s", "u", ("keep", "", [], ["q"]), {"must": "missing x"})
    cases = spark.createDataFrame([row], f"id string, split string, system string, user string, reply {reply}, fails map<string,string>")
    with pytest.raises(Exception, match="fails its own checks"):
        scoring.export_training(cases).collect()
    assert scoring.export_training(cases.withColumn("split", F.lit("dev"))).count() == 0


def test_names_of_keys_and_repositories(spark):
    key = "7e7e9c42a91bfef19fa929e5fda1b72e0ebc1a4c1141673e2794234d86addf4e"
    got = spark.createDataFrame([(key, f"30617:{key}:repo wss://r"), ("x", "https://git.io/x"), (None, None)], "k string, r string").select(listing.public_names("k").alias("n"), listing.repository_addresses("r").alias("a")).collect()
    assert got[0].n == "npub10elfcs4fr0l0r8af98jlmgdh9c8tcxjvz9qkw038js35mp4dma8qzvjptg" and got[0].a.startswith("naddr1") and got[1].n is None and got[1].a == "https://git.io/x" and got[2].a is None


def test_cases_reports_and_digests_from_the_command_line(spark, tmp_path, capsys):
    event = lambda kind, id_, content: json.dumps({"kind": kind, "tags": [["d", id_], ["name", "App"]], "content": content})
    (tmp_path / "events.jsonl").write_text("\n".join([event(32267, "a.b", "text"), event(1, "c.d", "text"), event(32267, "e.f", "")]))
    assert api.main(["mine", f"{tmp_path}/events.jsonl", f"{tmp_path}/cases"]) == 0
    assert [json.loads(r.value)["id"] for r in spark.read.text(f"{tmp_path}/cases").collect()] == ["a.b"]
    (tmp_path / "r.jsonl").write_text('{"id": "1", "tags": ["x"]}\n{"id": "2", "fails": {"length": "too long"}, "tags": ["x", "y"]}\n')
    assert api.main(["report", f"{tmp_path}/r.jsonl"]) == 0 and api.main(["report", f"{tmp_path}/r.jsonl", "--min", "0.6"]) == 1
    assert "length" in capsys.readouterr().out
    for path, body in (("one/README.md", "# One\n\nCounts."), ("one/src/a.kt", "fun a() {\n  client.post(1)\n}\n"), ("two/x.txt", "x")):
        (tmp_path / "trees" / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "trees" / path).write_text(body)
    assert api.main(["digest", f"{tmp_path}/trees", f"{tmp_path}/digests"]) == 0
    got = {(r := json.loads(x.value))["tree_id"]: r["digest"] for x in spark.read.text(f"{tmp_path}/digests").collect()}
    assert got["two"] == "Files: 1" and "Outbound:\nsrc/a.kt\n1: fun a() {" in got["one"] and "Readme README.md:\n# One" in got["one"]


def test_hashes_of_older_memos(spark):
    df = spark.createDataFrame([("skipped",), ("abc",), (None,)], "h string")
    assert [r[0] for r in df.select(tables.stored_about_hash(F.col("h"))).collect()] == ["e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855", "abc", None]
