"""Digests of small trees: sections, budgets, choice of quotes, and reading back."""

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import digest_text, quotes

FILES = "tree_id string, path string, body string"


def write(spark, trees, asked=None, projects=None, **more):
    files = spark.createDataFrame([(t, p, b) for t, f in trees.items() for p, b in f.items()], FILES)
    asked = asked and spark.createDataFrame(asked, "tree_id string, fact string, hint string")
    projects = projects and spark.createDataFrame(projects, "tree_id string, project string")
    return {r.tree_id: r.digest for r in digest_text.write_digests(files, asked, projects, **more).collect()}


MANIFEST = '<manifest><uses-permission android:name="android.permission.SEND_SMS"/><application><service android:name=".Sync"/><activity android:name=".Main"/></application></manifest>'


def test_whole_digest(spark):
    tree = {
        "README.md": "# Abacus\n\nCounts beads.\n\n## Build\n\n```\nmake\n```\n",
        "docs/README.md": "deeper",
        "app/src/main/AndroidManifest.xml": MANIFEST,
        "lib/net.dart": "void tell() { HttpURLConnection; }\nfinal u = 'https://beads.example.net/v2';\n",
        "src/auth.kt": "fun login(user: String) {\n  session.open()\n}\n",
        "big.txt": "x" * 300_000,
        "none.kt": None,
    }
    got = write(spark, {"t": tree}, projects=[("t", "  package: net.example.abacus\nnative: libx.so\n")])["t"]
    assert got == (
        "Files: 7\n\nPaths:\nREADME.md\napp/src/main/AndroidManifest.xml\n\nReadme README.md:\n# Abacus\n\nCounts beads.\n\nProject:\npackage: net.example.abacus\nnative: libx.so\n"
        "\nOutbound:\ndomains: beads.example.net\nlib/net.dart\n1: void tell() { HttpURLConnection; }\n2: final u = 'https://beads.example.net/v2';\n"
        f"\nManifest app/src/main/AndroidManifest.xml:\npermissions: android.permission.SEND_SMS\ncomponents: service .Sync, activity .Main\n"
        "\nAccount:\nsrc/auth.kt\n1: fun login(user: String) {\n2: session.open()\n"
        "\nSignals:\n- privacy network lib/net.dart:1: void tell() { HttpURLConnection; }\n- privacy network lib/net.dart:2: final u = 'https://beads.example.net/v2';"
    )
    assert "\nManifest " not in write(spark, {"t": tree}, with_manifest=False)["t"]


def test_groups_by_score_and_callers_after_their_function(spark):
    tree = {
        "lib/scores.kt": 'const val BASE_URL = "https://scores.example.net/s"\nfun pull() {\n  client.get(BASE_URL)\n}\n',
        "lib/post.kt": "fun beam() {\n  val body = clipboard.text.toRequestBody()\n  client.post(body)\n}\n",
        "lib/home.kt": "fun refresh() {\n  beam()\n}\n",
        "old/net.go": "http.get(x)\n",
    }
    got = write(spark, {"t": tree})["t"].partition("\nOutbound:\n")[2].partition("\n\nSignals")[0]
    assert got == "payload: clipboard\nlib/post.kt\n1: fun beam() {\n2: val body = clipboard.text.toRequestBody()\n3: client.post(body)\n\nlib/home.kt\n1: fun refresh() {\n2: beam()\n\nold/net.go\n1: http.get(x)\n\nlib/scores.kt\n2: fun pull() {\n3: client.get(BASE_URL)"


def test_device_calls_and_choices_win_quotes(spark):
    tree = {
        "src/a.kt": 'val label = "place of the button"\n',
        "src/map.kt": "val pad = 1\n" * 12 + "fun ask() { requestPermissions(arrayOf(X)) }\nfun onDenied() { finish() }\nfun watch() { geolocator.listen }\n",
        "src/note.kt": "fun note() {\n  // locationmanager\n}\n",
        "src/test/b.kt": "fun t() { packageInstaller.x() }\n",
        "src/inst.kt": "val p = REQUEST_INSTALL_PACKAGES\nfun put() {\n  packageInstaller.createSession(q)\n}\n",
        "README": "camera",
    }
    asked = [("t", "fine_location", "ACCESS_FINE_LOCATION"), ("t", "request_install_packages", None), ("t", "camera", "button"), ("t", "ads", "")]
    got = write(spark, {"t": tree}, asked)["t"]
    assert quotes_of(spark, got) == ["camera", "fine_location", "request_install_packages"]
    uses = got.partition("\nUses:\n")[2].partition("\n\n")[0]
    assert uses == 'camera src/a.kt\n1: val label = "place of the button"\nfine_location src/map.kt\n13: fun ask() { requestPermissions(arrayOf(X)) }\n14: fun onDenied() { finish() }\n15: fun watch() { geolocator.listen }\nrequest_install_packages src/inst.kt\n2: fun put() {\n3: packageInstaller.createSession(q)'
    tree["src/track.kt"] = "fun track() {\n  loc.getLastLocation()\n  client.post(loc)\n}\n"
    assert "fine_location src/track.kt\n1: fun track() {\n2: loc.getLastLocation()\n3: client.post(loc)\n" in write(spark, {"t": tree}, asked)["t"]


def quotes_of(spark, text):
    return spark.createDataFrame([(text,)], "x string").select(quotes.quoted_facts(F.col("x"))).first()[0]


def test_a_line_gives_the_first_fact_that_its_file_has_not_given(spark):
    tree = {"b.py": "firebase okhttpclient\nokhttpclient firebase mediarecorder\nfirebase retrofit camerax\nimport sentry\n", "a/z.py": "firebase\n", "a.py": "firebase\n"}
    files = spark.createDataFrame([("t", p, b) for p, b in tree.items()], FILES)
    got = [(r.path, r.line, r.fact) for r in digest_text.signals(files).orderBy("pos").collect()]
    assert got == [("b.py", 3, "camera"), ("b.py", 2, "microphone"), ("b.py", 1, "network"), ("a.py", 1, "tracker"), ("a/z.py", 1, "tracker")]
    many = spark.createDataFrame([("t", f"f{k:02d}.py", "camerax\n") for k in range(9)] + [("t", "f/x.py", "camerax")], FILES)
    assert [r.path for r in digest_text.signals(many).orderBy("pos").collect()] == ["f/x.py", *[f"f{k:02d}.py" for k in range(5)]]


def test_budgets_end_sections(spark):
    tree = {f"src/f{k:02d}.kt": "fun leak() {\n" + f"  client.post(k{k})\n" + "  val long = 'é'\n" * 100 + "}\n" for k in range(20)}
    tree["a.kt"] = "fun login(x: Int) {\n" + "  padding = 'é and more of it, so that the quote gets long enough'\n" * 150 + "}\n"
    tree |= {f"s/c{k}.py": "\n".join(["value = 'é' * 20 + and_so_on_and_so_on_and_so_on_and_so_on"] * 30 + ["camerax" if k % 2 else "firebase retrofit"]) for k in range(20)}
    got = write(spark, {"t": tree})["t"]
    section = lambda name, end: got.partition(f"\n{name}:\n")[2].partition(end)[0].encode()
    sent = section("Outbound", "\n\nAccount")
    assert quotes.OUTBOUND_BYTES < len(sent) + 1 <= quotes.OUTBOUND_BYTES + 200
    account = section("Account", "\n\nSignals").partition(b"\n")[2]
    assert quotes.QUOTE_BYTES < len(account) + 1 <= quotes.QUOTE_BYTES + 100
    assert len(section("Signals", "\x00")) > quotes.SIGNAL_BYTES and got.count("\n- privacy") >= 6


def test_trees_stay_apart_and_empty_ones_give_little(spark):
    got = write(spark, {"t": {"a.kt": "fun a() {\n  client.post(1)\n}\n"}, "u": {"b.txt": None}, "v": {"README.md": "", "x.kt": ""}})
    assert got["t"] == "Files: 1\n\nOutbound:\na.kt\n1: fun a() {\n2: client.post(1)" and got["u"] == "Files: 1" and got["v"] == "Files: 2\n\nPaths:\nREADME.md"
    assert digest_text.write_digests(spark.createDataFrame([], FILES)).collect() == []


@pytest.mark.parametrize("readme", ["A chat app.\n\nIt sends notes.\n", ""])
def test_what_is_written_is_read_back(spark, readme):
    tree = {"README.md": readme, "m.kt": "fun shot() {\n  camera.takePicture()\n}\n", "s.dart": "SmsManager.x()\n"}
    got = write(spark, {"t": tree}, [("t", "camera", ""), ("t", "send_sms", ""), ("t", "vpn_service", "")])["t"]
    row = spark.createDataFrame([(got,)], "x string").select(quotes.quoted_facts(F.col("x")), quotes.digest_readme(F.col("x"))).first()
    assert row[0] == ["camera", "send_sms"] and row[1] == readme.strip()
