"""Writing a digest: one bounded text per source tree, put together from sections with budgets of their own.

Every part is a table of lines by tree; a budget is a running sum of bytes in
the order of the section, so that a section ends where its budget does. The
sections of a tree meet once, at the end. ``quotes.quoted_facts`` and
``quotes.digest_readme`` read a digest back.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.functions import markdown
from shelfspark.functions.text import let
from shelfspark.operators import digest, quotes, sinks, source_code
from shelfspark.plans.lineage import cut

# Endings of code files.
CODE_ENDINGS = ("kt", "java", "dart", "aidl", "go", "rs", "swift", "c", "cc", "cpp", "h", "hpp", "js", "jsx", "ts", "tsx", "py", "rb", "scala")
# Words of code that use what a fact is about, and calls that do it.
FACT_WORDS = {
    "contacts": ("contactscontract",),
    "read_sms": ("smsmanager", "telephonymanager"),
    "receive_sms": ("smsmanager", "telephonymanager"),
    "send_sms": ("smsmanager",),
    "coarse_location": ("fusedlocationprovider", "locationmanager", "geolocator", "cllocationmanager"),
    "fine_location": ("fusedlocationprovider", "locationmanager", "geolocator", "cllocationmanager"),
    "camera": (
        "imagecapture", "camerax", "cameradevice", "cameramanager", "previewview", "scancontract",
        "barcodescanner", "barcodescanning", "decoratedbarcodeview", "barcodeview", "integrator", "mobilescanner",
        "qrview", "qr_code_scanner", "visioncamera", "expo-camera", "html5qrcode", "getusermedia",
    ),
    "microphone": ("mediarecorder", "audiorecord", "speechrecognizer", "getusermedia"),
    "call_log": ("calllog",),
    "request_install_packages": ("request_install_packages",),
    "query_all_packages": ("query_all_packages", "getinstalledpackages", "getinstalledapplications"),
    "system_alert_window": ("system_alert_window", "type_application_overlay"),
    "accessibility_service": ("accessibilityservice",),
    "notification_listener": ("notificationlistenerservice",),
    "device_admin": ("deviceadminreceiver",),
    "vpn_service": ("vpnservice",),
    "input_method": ("inputmethodservice",),
    "usage_stats": ("usagestatsmanager",),
    "tracking": ("crashlytics", "mixpanel", "sentry", "firebaseanalytics"),
    "ads": ("admob", "adview", "interstitialad"),
    "google_services": ("firebasemessaging", "firebase.messaging", "firebase_messaging", "googleapiclient", "play-services"),
}
FACT_ACTIONS = {"request_install_packages": ("packageinstaller", "action_install_package", "vnd.android.package-archive", "canrequestpackageinstalls", "manage_unknown_app_sources")}
README_BYTES, USE_SIGNS = 2500, 640
SIGNAL_FRAME = digest.FRAMES["signal"]
_IMPORTS = "^(?:import |package )"


def code_file(path: Column) -> Column:
    name = F.substring_index(path, "/", -1)
    return F.contains(name, F.lit(".")) & F.lower(F.substring_index(name, ".", -1)).isin(*CODE_ENDINGS)


def _trimmed(line: Column) -> Column:
    return F.regexp_replace(line, r"\A\s+|\s+\z", "")


def _running(size: Column, keys: list[str], order: list[str]) -> Column:
    """Bytes written before a row."""
    return F.coalesce(F.sum(size).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _joined(rows: DataFrame, keys: list[str], order: str, text: str = "text") -> DataFrame:
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), "")
    return rows.groupBy(*keys).agg(lines.alias("text"))


# -- signals ------------------------------------------------------------------------

_NEEDLES = [*quotes.CODE_NEEDLES, *digest.PERMISSION_NEEDLES]


def signals(files: DataFrame, tree: str = "tree_id") -> DataFrame:
    """(tree, pos, topic, fact, path, line, text, around) of lines that hold a needle.

    A line gives its first needle whose fact the file has not given before, so
    the lines of a file are gone through in order; only those that hold any
    needle are. Of a fact a tree gives six lines at most, of all 48, as a walk
    meets them; ``around`` are the telling lines about each.
    """
    body = files.filter(_any_word(F.col("body"), tuple(n for _, _, n in _NEEDLES))).select(tree, "path", F.split("body", "\n").alias("lines"))
    held = lambda x: F.filter(F.array(*[F.when(F.contains(x, F.lit(n)), F.struct(F.lit(t).alias("topic"), F.lit(f).alias("fact"))) for t, f, n in _NEEDLES]), lambda h: h.isNotNull())
    each = F.transform("lines", lambda x, i: F.struct((i + 1).alias("line"), x.alias("text")))
    each = F.filter(each, lambda x: _any_word(x["text"], tuple(n for _, _, n in _NEEDLES)))
    each = F.transform(each, lambda x: F.struct(x["line"].alias("line"), _trimmed(x["text"]).alias("text")))
    marked = F.transform(each, lambda x: let(F.lower(x["text"]), lambda low: F.struct(x["line"].alias("line"), x["text"].alias("text"), F.when(~low.rlike(_IMPORTS), held(low)).alias("held"))))
    body = body.withColumn("marked", F.filter(marked, lambda x: F.size(x["held"]) > 0)).filter(F.size("marked") > 0)
    kind = "array<struct<line: int, text: string, topic: string, fact: string>>"
    found = F.aggregate(
        "marked",
        F.array().cast(kind),
        lambda out, x: F.concat(
            out,
            F.transform(
                F.slice(F.filter(x["held"], lambda h: ~F.exists(out, lambda o: o["fact"] == h["fact"])), 1, 1),
                lambda h: F.struct(x["line"].alias("line"), x["text"].alias("text"), h["topic"].alias("topic"), h["fact"].alias("fact")),
            ),
        ),
    )
    hits = body.select(tree, "path", "lines", F.explode(found).alias("h")).select(tree, "path", "lines", "h.*").withColumn("walk", sinks.walk(F.col("path")))
    capped = hits.withColumn("n", F.row_number().over(Window.partitionBy(tree, "fact").orderBy("walk", "line"))).filter(F.col("n") <= digest.PER_FACT)
    capped = capped.withColumn("n", F.row_number().over(Window.partitionBy(tree).orderBy("walk", "line"))).filter(F.col("n") <= digest.OVERALL)
    near = F.sequence(F.greatest(F.col("line") - 1 - SIGNAL_FRAME[0], F.lit(0)), F.least(F.col("line") - 1 + SIGNAL_FRAME[1], F.size("lines") - 1))
    around = F.transform(near, lambda i: F.struct((i + 1).alias("line"), F.substring(_trimmed(F.get("lines", i)), 1, quotes.LINE_SIGNS).alias("text")))
    around = F.filter(around, lambda x: (x["line"] != F.col("line")) & quotes.is_code(x["text"]) & ~F.lower(x["text"]).rlike(_IMPORTS))
    pos = F.row_number().over(Window.partitionBy(tree).orderBy("topic", "fact", "path", "line"))
    return capped.select(tree, pos.alias("pos"), "topic", "fact", "path", "line", F.substring("text", 1, quotes.LINE_SIGNS).alias("text"), around.alias("around"))


def _signal_section(hits: DataFrame, tree: str) -> DataFrame:
    said = lambda x: F.concat(F.lit("- "), "topic", F.lit(" "), "fact", F.lit(" "), "path", F.lit(":"), x["line"].cast("string"), F.lit(": "), x["text"], F.lit("\n"))
    block = F.concat(said(F.struct("line", "text")), F.array_join(F.transform("around", said), ""))
    rows = hits.select(tree, "pos", block.alias("text"))
    rows = rows.withColumn("before", _running(F.octet_length("text"), [tree], ["pos"])).filter(F.col("before") <= quotes.SIGNAL_BYTES)
    return _joined(rows, [tree], "pos").select(tree, F.lit(8).alias("section"), F.concat(F.lit("\nSignals:\n"), "text").alias("text"))


# -- uses and accounts -----------------------------------------------------------------

_SPAN = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])


@F.pandas_udf(_SPAN)
def _use_spans(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for bodies, choices, lines in batches:
        found = []
        for body, near, i in zip(bodies, choices, lines, strict=True):
            held = body.split("\n")
            found.append(quotes.use_span(held, quotes.Braces(held), list(near), i))
        yield pd.DataFrame(found, columns=["a", "b"])


def _any_word(text: Column, words: tuple[str, ...]) -> Column:
    return let(F.lower(text), lambda low: quotes.any_of(low, words))


def _choice_lines(body: Column) -> Column:
    """Lines, from 0, where the user chooses; the lines of a body that has no such word are not gone through."""
    lines = F.filter(F.transform(F.split(body, "\n"), lambda x, i: F.when(quotes.is_choice(x), i)), lambda i: i.isNotNull())
    return F.when(_any_word(body, quotes.CHOICES), lines).otherwise(F.array().cast("array<int>"))


def line_quotes(code: DataFrame, asked: DataFrame, tree: str = "tree_id") -> DataFrame:
    """(tree, fact, score, path, a, b): for each asked fact (tree, fact, hint) the line of code that shows it best, with its frame.

    5 for a call that does it, 3 for a word of it near a line where the user
    chooses, 2 for a word of it, 1 for a telling word of the hint. Of equal
    ones the first as a walk meets it. A file is searched for a fact only if it
    holds one of its words at all.
    """
    words = lambda table: F.create_map(*[x for f, v in table.items() for x in (F.lit(f), F.array(*map(F.lit, v)))])
    none = F.array().cast("array<string>")
    want = asked.select(tree, "fact", quotes.hint_tokens(F.coalesce("hint", F.lit(""))).alias("hints")).distinct()
    want = want.withColumn("words", F.coalesce(F.try_element_at(words(FACT_WORDS), F.col("fact")), none)).withColumn("actions", F.coalesce(F.try_element_at(words(FACT_ACTIONS), F.col("fact")), none))
    want = want.filter((F.size("words") > 0) | (F.size("hints") > 0))
    told = let(F.lower("body"), lambda low: F.exists(F.concat("words", "actions", "hints"), lambda w: F.contains(low, w)))
    met = code.join(want, tree).filter(told)
    lines = met.withColumn("lines", F.split("body", "\n")).withColumn("choices", _choice_lines(F.col("body")))
    any_in = lambda x, parts: F.exists(parts, lambda w: F.contains(x, w))

    def rate(x: Column, i: Column) -> Column:
        near = F.exists("choices", lambda j: F.abs(j - i) <= quotes.DENIAL_REACH)
        spec = any_in(x, F.col("words"))
        said = F.exists("hints", lambda w: quotes.contains_word(x, w))
        got = F.when(any_in(x, F.col("actions")), 5).when(spec & near, 3).when(spec, 2).when(said, 1)
        return F.when((x != "") & ~x.rlike(_IMPORTS), got)

    rated = F.transform("lines", lambda x, i: let(F.lower(_trimmed(x)), lambda low: F.struct((-rate(low, i)).alias("worse"), i.alias("i"))))
    best = lines.withColumn("best", F.array_min(F.filter(rated, lambda r: r["worse"].isNotNull()))).filter("best IS NOT NULL")
    best = best.select(tree, "fact", (-F.col("best.worse")).alias("score"), F.col("best.worse").alias("worse"), sinks.walk(F.col("path")).alias("walk"), "path", F.col("best.i").alias("i"))
    first = best.groupBy(tree, "fact").agg(F.min(F.struct("worse", "walk", "path", "i", "score")).alias("q")).select(tree, "fact", "q.score", "q.path", "q.i")
    return _with_spans(first, code, tree).select(tree, "fact", "score", "path", "a", "b")


def _with_spans(found: DataFrame, code: DataFrame, tree: str) -> DataFrame:
    """``found`` (tree, path, i, ...) with the lines a to b that are quoted about line i."""
    met = found.join(code.select(tree, "path", "body"), [tree, "path"]).withColumn("choices", _choice_lines(F.col("body")))
    return met.withColumn("s", _use_spans("body", "choices", "i")).withColumn("a", F.col("s.a")).withColumn("b", F.col("s.b")).drop("body", "choices", "s")


def account_quotes(code: DataFrame, tree: str = "tree_id") -> DataFrame:
    """(tree, path, a, b): the first line of a tree's code that names an account, with its frame."""
    at = F.array_min(F.filter(F.transform(F.split("body", "\n"), lambda x, i: F.when(quotes.is_account(_trimmed(x)), i)), lambda i: i.isNotNull()))
    named = code.filter(_any_word(F.col("body"), quotes.ACCOUNTS)).select(tree, "path", at.alias("i")).filter("i IS NOT NULL")
    first = named.groupBy(tree).agg(F.min(F.struct(sinks.walk(F.col("path")).alias("walk"), "path", "i")).alias("q")).select(tree, "q.path", "q.i")
    return _with_spans(first, code, tree).select(tree, "path", "a", "b")


def _quote_text(spans: DataFrame, code: DataFrame, keys: list[str], tree: str, signs: str) -> DataFrame:
    """(keys, path, text) of quotes (keys, path, a, b, signs): the lines until more than their budget has been written before one."""
    bodies = code.select(tree, "path", F.split("body", "\n").alias("lines"))
    held = spans.join(bodies, [tree, "path"])
    # How many signs of a line are quoted depends on where the quote comes from.
    lines = quotes.quoted_lines(held, F.col("a"), F.col("b"), [*keys, "path", signs], USE_SIGNS).withColumn("text", F.expr(f"substring(text, 1, {signs})"))
    said = lines.select(*keys, "path", "line", F.concat(F.col("line").cast("string"), F.lit(": "), "text", F.lit("\n")).alias("text"))
    short = said.withColumn("before", _running(F.octet_length("text"), keys, ["line"])).filter(F.col("before") <= quotes.QUOTE_BYTES)
    return _joined(short, [*keys, "path"], "line")


# -- the text ---------------------------------------------------------------------------


def _outbound_section(lines: DataFrame, tree: str) -> DataFrame:
    """Lines (tree, pos, path, line, text) with a head wherever the path changes: hosts, user data and path of all lines of it."""
    per_path = lines.groupBy(tree, "path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), "\n").alias("all"))
    heads = per_path.select(tree, "path", quotes.domains(F.col("all")).alias("hosts"), quotes.payload(F.col("all")).alias("data"))
    before = F.lag("path").over(Window.partitionBy(tree).orderBy("pos"))
    rows = lines.withColumn("was", before).join(heads, [tree, "path"])
    labelled = lambda name, value: F.when(value != "", F.concat(F.lit(name), value, F.lit("\n"))).otherwise("")
    head = F.concat(F.when(F.col("was").isNotNull(), "\n").otherwise(""), labelled("domains: ", F.col("hosts")), labelled("payload: ", F.col("data")), "path", F.lit("\n"))
    said = F.concat(F.when(F.col("was").eqNullSafe(F.col("path")), "").otherwise(head), F.col("line").cast("string"), F.lit(": "), "text", F.lit("\n"))
    rows = rows.select(tree, "pos", said.alias("text")).withColumn("before", _running(F.octet_length("text"), [tree], ["pos"])).filter(F.col("before") <= quotes.OUTBOUND_BYTES)
    return _joined(rows, [tree], "pos").select(tree, F.lit(4).alias("section"), F.concat(F.lit("\nOutbound:\n"), "text").alias("text"))


def _head_sections(files: DataFrame, small: DataFrame, projects: DataFrame | None, with_manifest: bool, tree: str) -> list[DataFrame]:
    n = files.groupBy(tree).agg(F.count(F.lit(1)).alias("n")).select(tree, F.lit(0).alias("section"), F.concat(F.lit("Files: "), F.col("n").cast("string"), F.lit("\n")).alias("text"))
    readme, manifest = digest.shortest_path(small, "readme.md", tree), digest.shortest_path(small, "androidmanifest.xml", tree)
    listed = readme.select(tree, F.lit(0).alias("k"), "path").unionByName(manifest.select(tree, F.lit(1).alias("k"), "path")).withColumn("text", F.concat("path", F.lit("\n")))
    paths = _joined(listed, [tree], "k").select(tree, F.lit(1).alias("section"), F.concat(F.lit("\nPaths:\n"), "text").alias("text"))
    brief = readme.withColumn("brief", markdown.brief_of(F.col("body"), README_BYTES)).filter(F.col("brief") != "").select(tree, F.lit(2).alias("section"), F.concat(F.lit("\nReadme "), "path", F.lit(":\n"), "brief", F.lit("\n")).alias("text"))
    out = [n, paths, brief]
    if projects is not None:
        dump = _trimmed(F.col("project"))
        out.append(projects.select(tree, dump.alias("dump")).filter(F.col("dump") != "").select(tree, F.lit(3).alias("section"), F.concat(F.lit("\nProject:\n"), "dump", F.lit("\n")).alias("text")))
    if with_manifest:
        parts = manifest.withColumn("m", manifest_parts(F.col("body")))
        row = lambda name, x: F.when(F.size(x) > 0, F.concat(F.lit(name), F.array_join(x, ", "), F.lit("\n"))).otherwise("")
        out.append(parts.select(tree, F.lit(5).alias("section"), F.concat(F.lit("\nManifest "), "path", F.lit(":\n"), row("permissions: ", F.col("m.permissions")), row("components: ", F.col("m.components"))).alias("text")))
    return out


def manifest_parts(body: Column) -> Column:
    """Permissions (24 at most) and components with their kinds (15 at most) of a manifest."""
    kinds, names = F.regexp_extract_all(body, F.lit(digest.NAMES), 1), F.regexp_extract_all(body, F.lit(digest.NAMES), 2)
    return F.struct(digest.manifest(body)["permissions"].alias("permissions"), F.slice(F.zip_with(kinds, names, lambda k, n: F.concat(k, F.lit(" "), n)), 1, 15).alias("components"))


def write_digests(files: DataFrame, asked: DataFrame | None = None, projects: DataFrame | None = None, with_manifest: bool = True, tree: str = "tree_id") -> DataFrame:
    """(tree, digest) of every tree of ``files`` (tree, path, body).

    Sections, in order: number of files, paths of readme and manifest, the
    readme cut short, the project (``projects``: tree, project), what is sent,
    the manifest, a quote for each asked fact (``asked``: tree, fact, hint), the
    first quote about an account, signals. Sections without content are left
    out. Files without a body or of more than 256 KiB only count; tests and
    manifests give no quotes. A tree without files gives no row.
    """
    small = files.filter(F.octet_length("body") <= digest.MAX_FILE_BYTES).select(tree, "path", "body")
    read = small.filter(~quotes.test_path(F.col("path")) & (F.lower(F.substring_index("path", "/", -1)) != "androidmanifest.xml"))
    code = read.filter(code_file(F.col("path")))
    parsed = cut(source_code.parsed(code, tree), "code")  # files are read by the scanner once
    sections = _head_sections(files, small, projects, with_manifest, tree)
    sections.append(_outbound_section(sinks.outbound(code, parsed, tree), tree))
    if asked is not None:
        from_lines = line_quotes(code, asked, tree).withColumn("signs", F.lit(USE_SIGNS))
        from_calls = sinks.device_quotes(parsed, asked, tree).withColumn("signs", F.lit(quotes.LINE_SIGNS))
        best = from_lines.unionByName(from_calls).groupBy(tree, "fact").agg(F.max_by(F.struct("path", "a", "b", "signs"), "score").alias("q")).select(tree, "fact", "q.*")
        said = _quote_text(best, code, [tree, "fact"], tree, "signs").withColumn("text", F.concat("fact", F.lit(" "), "path", F.lit("\n"), "text"))
        sections.append(_joined(said, [tree], "fact").select(tree, F.lit(6).alias("section"), F.concat(F.lit("\nUses:\n"), "text").alias("text")))
    account = _quote_text(account_quotes(code, tree).withColumn("signs", F.lit(USE_SIGNS)), code, [tree], tree, "signs")
    sections.append(account.select(tree, F.lit(7).alias("section"), F.concat(F.lit("\nAccount:\n"), "path", F.lit("\n"), "text").alias("text")))
    sections.append(_signal_section(signals(read, tree), tree))
    every = sections[0]
    for s in sections[1:]:
        every = every.unionByName(s)
    return _joined(every, [tree], "section").select(tree, _trimmed(F.col("text")).alias("digest"))
