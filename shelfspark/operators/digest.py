"""Digests of source trees: path rules, needles in lines, context, function bounds, manifests, versions of a tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.functions.regex import literal
from shelfspark.operators import joins
from shelfspark.plans.lineage import cut

# Fixed values: (topic, fact, needle) of permissions, in order.
PERMISSION_NEEDLES = [
    ("privacy", "contacts", "android.permission.read_contacts"),
    ("privacy", "contacts", "android.permission.write_contacts"),
    ("privacy", "sms", "android.permission.read_sms"),
    ("privacy", "sms", "android.permission.receive_sms"),
    ("privacy", "sms", "android.permission.send_sms"),
    ("privacy", "location", "android.permission.access_fine_location"),
    ("privacy", "location", "android.permission.access_coarse_location"),
    ("privacy", "location", "android.permission.access_background_location"),
    ("privacy", "camera", "android.permission.camera"),
    ("privacy", "microphone", "android.permission.record_audio"),
    ("privacy", "phone", "android.permission.read_phone_state"),
    ("privacy", "accounts", "android.permission.get_accounts"),
    ("security", "install", "android.permission.request_install_packages"),
    ("security", "packages", "android.permission.query_all_packages"),
    ("security", "overlay", "android.permission.system_alert_window"),
    ("security", "accessibility", "android.permission.bind_accessibility_service"),
    ("security", "notifications", "android.permission.bind_notification_listener_service"),
    ("security", "device_admin", "android.permission.bind_device_admin"),
    ("security", "vpn", "android.permission.bind_vpn_service"),
]
#: Hits of a fact in a tree, and hits of a tree, at most.
PER_FACT, OVERALL = 6, 48
#: Lines before and after: a signal, a use, an outbound call, a caller.
FRAMES = {"signal": (6, 12), "use": (18, 54), "outbound": (12, 48), "caller": (2, 2)}
MAX_FILE_BYTES = 256 * 1024


def tree_lines(files: DataFrame, tree: str = "tree_id", path: str = "path", body: str = "body") -> DataFrame:
    """(tree, path, line, text) of files that aren't too large, lines from 1."""
    small = files.filter(F.octet_length(body) <= MAX_FILE_BYTES)
    return small.select(tree, path, F.posexplode(F.split(F.replace(F.col(body), F.lit("\r\n"), F.lit("\n")), "\n")).alias("line", "text")).withColumn("line", F.col("line") + 1)


def needle_hits(lines: DataFrame, needles: list[tuple[str, str, str]], tree: str = "tree_id", path: str = "path") -> DataFrame:
    """(tree, path, line, topic, fact, text): the first hit of each fact in a file, capped per fact and tree.

    A line gives its first needle in order; needles are literals of the plan, so no join is needed.
    """
    low = F.lower("text")
    first = F.coalesce(*[F.when(F.contains(low, F.lit(n)), F.struct(F.lit(t).alias("topic"), F.lit(f).alias("fact"))) for t, f, n in needles])
    hits = lines.withColumn("h", first).filter("h IS NOT NULL").select(tree, path, "line", "text", "h.topic", "h.fact")
    once = hits.withColumn("n", F.row_number().over(Window.partitionBy(tree, path, "fact").orderBy("line"))).filter("n = 1").drop("n")
    capped = once.withColumn("n", F.row_number().over(Window.partitionBy(tree, "fact").orderBy(path, "line"))).filter(F.col("n") <= PER_FACT)
    return capped.withColumn("n", F.row_number().over(Window.partitionBy(tree).orderBy(path, "line", "fact"))).filter(F.col("n") <= OVERALL).drop("n")


# Folders that never say what an app does, file names and endings worth reading, endings of generated files.
SKIPPED_FOLDERS = (
    ".git", "node_modules", "build", ".gradle", "pods", "generated",
    "test", "tests", "androidtest", "testdata", "fixtures", "__tests__", "e2e", "spec",
    "docs", "doc", "examples", "example", "samples", "sample", "benchmark", "benchmarks",
    "assets", "raw", "font", "fonts", "screenshots", "images", "img", "media",
    "vendor", "third_party", "thirdparty", "third-party", "3party", "3rdparty", "external", "extern", "deps", "submodules",
    "ios", "macos", "windows", "linux", "iosapp", "desktopapp", "web", "src-tauri",
    ".github", ".idea", ".vscode", "dist", "out", "coverage",
)
KEPT_NAMES = (
    "androidmanifest.xml", "readme.md", "pubspec.yaml", "go.mod", "cargo.toml",
    "package.json", "gradle.properties", "version.properties", "libs.versions.toml",
    "capacitor.config.json", "tauri.conf.json", "app.json", "google-services.json",
    "license", "license.md", "license.txt", "copying", "copying.md", "copying.txt", "licence", "licence.md",
)
KEPT_ENDINGS = ("kt", "java", "dart", "xml", "gradle", "kts", "aidl", "go", "rs", "swift", "c", "cc", "cpp", "h", "hpp", "js", "jsx", "ts", "tsx", "py", "rb", "proto", "scala")
GENERATED = r"\.(?:g\.dart|freezed\.dart|min\.js|spec\.ts|test\.ts|test\.js)\z"
LONGEST_PATH = 240


def keep_path(path: Column) -> Column:
    """Is a file of a tree worth reading? By folder, name, ending and length; plain texts only as store metadata."""
    low = F.lower(path)
    parts = F.split(low, "/")
    name = F.element_at(parts, -1)
    folders = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    ending = F.when(F.contains(name, F.lit(".")), F.element_at(F.split(name, r"\."), -1)).otherwise("")
    denied = F.arrays_overlap(folders, F.array(*[F.lit(d) for d in SKIPPED_FOLDERS])) | F.exists(folders, lambda d: d.startswith("drawable") | d.startswith("mipmap"))
    known = name.isin(*KEPT_NAMES) | ending.isin(*KEPT_ENDINGS) | ((ending == "txt") & F.contains(low, F.lit("metadata/")))
    return (path != "") & (F.octet_length(path) <= LONGEST_PATH) & ~F.contains(path, F.lit("..")) & ~denied & ~name.rlike(GENERATED) & known


# Files that hold application ids or versions, beside gradle files.
BUILD_FILES = ("androidmanifest.xml", "pubspec.yaml", "package.json", "capacitor.config.json", "capacitor.config.ts", "tauri.conf.json", "app.json", "cargo.toml", "gradle.properties", "version.properties", "libs.versions.toml")


def is_build_file(base: Column) -> Column:
    return base.isin(*BUILD_FILES) | base.rlike(r"\.(gradle|kts)\z")


def path_rank(path: Column) -> Column:
    """0 for root and build files, 1 for the app's own code, 2 for the rest."""
    own = F.contains(path, F.lit("/src/main/")) | path.rlike("^(android|app|lib)/")
    return F.when(~F.contains(path, F.lit("/")) | is_build_file(F.lower(F.element_at(F.split(path, "/"), -1))), 0).when(own, 1).otherwise(2)


def best_readme(files: DataFrame, tree: str = "tree_id") -> DataFrame:
    """(tree, readme): the readme nearest to the root; of equally deep ones the first by path."""
    named = files.filter(F.lower(F.substring_index("path", "/", -1)).isin("readme", "readme.md", "readme.txt"))
    depth = F.size(F.split("path", "/"))
    return named.groupBy(tree).agg(F.trim(F.min_by("body", F.struct(depth.alias("d"), F.col("path")))).alias("readme"))


def shortest_path(files: DataFrame, name: str, tree: str = "tree_id") -> DataFrame:
    """(tree, path, body) of the file of a name with the shortest path; of equally short ones the first by path."""
    named = files.filter(F.lower(F.element_at(F.split("path", "/"), -1)) == name)
    return named.groupBy(tree).agg(F.min_by(F.struct("path", "body"), F.struct(F.octet_length("path").alias("n"), F.col("path"))).alias("f")).select(tree, "f.path", "f.body")


# How a manifest asks for permissions, names components and allows clear text.
ASKS = r'(?s)<uses-permission\b.{0,300}?android:name="([^"]+)"'
NAMES = r'(?s)<(activity|service|receiver|provider)\b.{0,400}?android:name="([^"]+)"'
CLEARTEXT = r'usesCleartextTraffic="true"|cleartextTrafficPermitted="true"'


def manifest(body: Column) -> Column:
    """Struct of permissions (24 at most), components (15 at most) and cleartext of an AndroidManifest."""
    perms, comps = F.regexp_extract_all(body, F.lit(ASKS), 1), F.regexp_extract_all(body, F.lit(NAMES), 2)
    return F.struct(F.slice(perms, 1, 24).alias("permissions"), F.slice(comps, 1, 15).alias("components"), body.rlike(CLEARTEXT).alias("cleartext"))


def brace_depth(lines: DataFrame, keys: list[str]) -> DataFrame:
    """``depth`` after each line: a running sum of opened less closed braces."""
    opens = F.length(F.regexp_replace("text", r"[^{]", "")) - F.length(F.regexp_replace("text", r"[^}]", ""))
    return lines.withColumn("depth", F.sum(opens).over(Window.partitionBy(*keys).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)))


def token_in(text: Column, token: Column) -> Column:
    """Does a version or word stand in the text with no letter, digit or dot beside it that would make it another one?"""
    return F.regexp_like(text, F.concat(F.lit(r"(?<![0-9A-Za-z_])(?<![0-9]\.)"), literal(token), F.lit(r"(?![0-9A-Za-z_])(?!\.[0-9])")))


def detect_libraries(classes: DataFrame, corpus: DataFrame, info: DataFrame, app: str = "app_id") -> DataFrame:
    """(app, id, name, type, path, emphasize, anti) of the libraries whose paths hold the app's classes: longest prefix, then details by id.

    ``classes`` (app, path), ``corpus`` (id, path, name, type), ``info`` (id, emphasize, anti).
    """
    usable = corpus.filter(F.col("path").startswith("/") & (F.col("path") != "/PathToLookFor") & (F.col("id") != ""))
    each = classes.select(app, F.col("path").alias("class_path"))
    # Apps share classes, so the library of a class is looked up once.
    known = cut(joins.longest_prefix(each.select("class_path").distinct(), usable, "class_path", "path", ["class_path"]), "class-paths")
    found = each.join(known, "class_path")
    once = found.groupBy(app, "id").agg(F.min(F.struct("path", "name", "type")).alias("l"))
    details = info.groupBy("id").agg(F.max("emphasize").alias("emphasize"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("anti")))).alias("anti"))
    return once.join(joins.small(details), "id", "left").select(app, "id", F.col("l.name").alias("name"), F.col("l.type").alias("type"), F.col("l.path").alias("path"), F.coalesce("emphasize", F.lit(0)).alias("emphasize"), F.coalesce("anti", F.array().cast("array<string>")).alias("anti"))


def notable(lib: DataFrame) -> DataFrame:
    """Libraries worth naming: emphasised, with anti-features, Google services, messaging, analytics, ads or payment."""
    blob, kind = F.lower(F.concat_ws(" ", "id", "name")), F.lower("type")
    return lib.filter((F.col("emphasize") != 0) | (F.size("anti") > 0) | blob.rlike("/com/google/android/gms|play[ -]services|firebase/messaging|firebase cloud messaging|firebase-messaging") | kind.isin("mobile analytics", "advertisement") | F.contains(kind, F.lit("payment")))
