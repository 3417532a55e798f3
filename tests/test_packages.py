"""Binary resources against documents built here, and spans of quotes against a plain walk."""

import random
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import packages, quotes
from shelfspark.sources import resources


def chunk(kind, head, body):
    return struct.pack("<HHI", kind, 8 + len(head), 8 + len(head) + len(body)) + head + body


def string_pool(texts, utf8):
    offsets, data = [], b""
    for t in texts:
        offsets.append(len(data))
        raw = t.encode("utf-8" if utf8 else "utf-16-le")
        size = lambda n: bytes([n]) if n < 128 else bytes([0x80 | n >> 8, n & 255])
        data += size(len(t)) + size(len(raw)) + raw + b"\0" if utf8 else struct.pack("<H", len(t)) + raw + b"\0\0"
    table = struct.pack(f"<{len(texts)}I", *offsets)
    return chunk(1, struct.pack("<5I", len(texts), 0, 256 if utf8 else 0, 28 + len(table), 0), table + data)


def binary_xml(tags, utf8=True):
    names = sorted({t for t, _ in tags} | {x for _, a in tags for kv in a.items() for x in kv if isinstance(x, str)})
    at = {n: k for k, n in enumerate(names)}
    body = string_pool(names, utf8)
    for tag, found in tags:
        attrs = b"".join(struct.pack("<3IHBBI", 0xFFFFFFFF, at[k], at[v] if isinstance(v, str) else 0xFFFFFFFF, 8, 0, 3 if isinstance(v, str) else 16, at[v] if isinstance(v, str) else v) for k, v in found.items())
        body += chunk(0x0102, struct.pack("<2I", 1, 0xFFFFFFFF), struct.pack("<2I6H", 0xFFFFFFFF, at[tag], 20, 20, len(found), 0, 0, 0) + attrs)
    return chunk(3, b"", body)


def resource_table(strings):
    """``strings``: {language: {key: value}}; languages take turns in how their offsets are written."""
    keys = sorted({k for v in strings.values() for k in v})
    texts = sorted({x for v in strings.values() for x in v.values()})
    types, names = string_pool(["id", "string"], False), string_pool(keys, True)
    parts = b""
    for turn, (language, values) in enumerate(strings.items()):
        flags = (0, 2, 1)[turn % 3]
        entries, offsets = b"", []
        for k, key in enumerate(keys):
            if key not in values:
                if flags != 1:
                    offsets.append(None)
                continue
            offsets.append((k, len(entries)))
            if turn % 2:
                entries += struct.pack("<2HI", k, 3 << 8 | 8, texts.index(values[key]))
            else:
                entries += struct.pack("<2HIHBBI", 8, 0, k, 8, 0, 3, texts.index(values[key]))
        if flags == 0:
            table = b"".join(struct.pack("<I", 0xFFFFFFFF if o is None else o[1]) for o in offsets)
        elif flags == 2:
            table = b"".join(struct.pack("<H", 0xFFFF if o is None else o[1] // 4) for o in offsets)
            table += b"\0" * (-len(table) % 4)
        else:
            table = b"".join(struct.pack("<2H", o[0], o[1] // 4) for o in offsets)
        config = struct.pack("<IHH", 28, 0, 0) + language.encode().ljust(2, b"\0") + b"\0" * 18
        parts += chunk(0x0201, struct.pack("<BBHII", 2, flags, 0, len(offsets), 20 + len(config) + len(table)) + config, table + entries)
    head = struct.pack("<I", 127) + "com.x".encode("utf-16-le").ljust(256, b"\0") + struct.pack("<5I", 288, 0, 288 + len(types), 0, 0)
    return chunk(2, struct.pack("<I", 1), string_pool(texts, True) + chunk(0x0200, head, types + names + parts))


MANIFEST = [("manifest", {"package": "com.acme.app", "versionName": "1.2"}), ("uses-permission", {"name": "android.permission.CAMERA"}), ("uses-permission-sdk-23", {"name": "android.permission.READ_SMS"}), ("activity", {"name": ".Main", "exported": 1}), ("service", {"name": "Worker"}), ("meta-data", {"name": "com.other.X"}), ("other", {"name": "no"})]
STRINGS = {"": {"title": "Notizen", "save": "Datei jetzt speichern", "abc_x": "x"}, "en": {"title": "Notes", "save": "Save"}, "de": {"title": "N"}}


@pytest.mark.parametrize("utf8", [True, False])
def test_binary_manifest(utf8):
    got = resources.signals(binary_xml(MANIFEST, utf8))
    assert got == {"package": "com.acme.app", "version": "1.2", "permissions": ["android.permission.CAMERA", "android.permission.READ_SMS"], "components": ["com.acme.app.Main", "com.acme.app.Worker", "com.other.X"]}
    plain = b'<manifest xmlns:a="u" package="p"><uses-permission a:name="q"/></manifest>'
    assert resources.signals(plain)["permissions"] == ["q"] and resources.elements(b"no xml") == [] and resources.elements(binary_xml(MANIFEST)[:40]) == []


def test_resource_strings():
    got = sorted(resources.table_strings(resource_table(STRINGS)))
    want = sorted([("", k, v) for k, v in STRINGS[""].items()] + [(x, k, "") for x in ("en", "de") for k in STRINGS[x]])
    assert got == want
    with pytest.raises(ValueError):
        list(resources.table_strings(b"x" * 20))


def test_packages_are_read(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.apk", "w") as z:
        z.writestr("AndroidManifest.xml", binary_xml(MANIFEST))
        z.writestr("resources.arsc", resource_table(STRINGS))
        z.writestr("assets/a.json", '{"u": "https://API.acme.io/x https://github.com/y"}')
        z.writestr("assets/b.bin", "https://hidden.io")
        z.writestr("classes.dex", b"\0https://dex.acme.io\0")
    (tmp_path / "b.apk").write_bytes(b"broken")
    got = {r.path.rsplit("/", 1)[1]: r for r in resources.read_packages(spark, str(tmp_path)).collect()}
    assert (got["a.apk"].package, got["a.apk"].manifest, got["a.apk"].hosts) == ("com.acme.app", True, ["api.acme.io", "dex.acme.io"])
    assert got["b.apk"].package == "" and got["b.apk"].hosts == []
    strings = resources.app_strings(resources.read_packages(spark, str(tmp_path)).filter("package <> ''"))
    assert strings.filter("lang = ''").count() == 3
    ui = spark.createDataFrame([("a", lang, f"{k}{n}", v) for n in range(10) for lang, k, v in (("", "title", "Datei jetzt speichern"), ("en", "title", ""))], "app_id string, lang string, name string, value string")
    assert packages.english_strings(ui).first().english is True
    assert packages.english_strings(ui.filter("lang = ''")).first().english is False


def walk_bounds(lines, heads, i, reach=160):
    depth, start = 0, None
    for j in range(i, max(-1, i - reach - 1), -1):
        depth += lines[j].count("}") - lines[j].count("{")
        if j in heads and depth <= 0:
            start = j
            break
    if start is None:
        return None
    depth, opened, end = 0, False, start
    for j in range(start, min(len(lines), start + reach)):
        depth += lines[j].count("{") - lines[j].count("}")
        opened |= "{" in lines[j]
        end = j
        if opened and depth <= 0:
            break
    return start, end


def test_function_bounds_against_a_walk():
    rnd = random.Random(2)
    for _ in range(60):
        lines = [rnd.choice(["fun a() {", "x = 1", "}", "if (y) {", "private val z(", "} else {", "", "fun b() = 2"]) for _ in range(rnd.choice([1, 5, 60, 400]))]
        braces = quotes.Braces(lines)
        heads = set(braces.heads.tolist())
        for i in range(0, len(lines), 3):
            assert braces.bounds(i) == walk_bounds(lines, heads, i), (lines, i)


def test_spans_merge_and_stay_short():
    lines = ["val u = \"https://a.io\"", *["x"] * 20, "client.post(u)", *["x"] * 200, "http.get(v)", *["y"] * 10]
    assert quotes.outbound_spans(lines, [21, 222]) == [(0, 69), (210, 232)]
    assert quotes.outbound_spans(["fun a() {", *["x"] * 300, "}"], [5]) == [(0, 120)]
    assert quotes.use_span(["x"] * 50, quotes.Braces(["x"] * 50), [49], 20) == (2, 49)


def test_outbound_lines(spark):
    body = "import a\nfun send() {\n  client.post(\"https://a.io\")\n}\nval x = 1"
    files = spark.createDataFrame([("t", "a/Main.kt", body), ("t", "a/test/T.kt", body), ("t", "b.kt", "nothing")], "tree_id string, path string, body string")
    got = [(r.path, r.line, r.text) for r in quotes.outbound_lines(files).orderBy("line").collect()]
    assert got == [("a/Main.kt", 2, "fun send() {"), ("a/Main.kt", 3, 'client.post("https://a.io")')]
