"""Facts of source trees, whether a tree is an app's, and the problems worth flagging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions import text as tx
from shelfspark.functions.regex import literal, re2_to_java
from shelfspark.operators.digest import MAX_FILE_BYTES, is_build_file

# Endings of code, and patterns of ids and versions in build files (RE2).
CODE = ("kt", "java", "dart", "aidl", "go", "rs", "swift", "c", "cc", "cpp", "h", "hpp", "js", "jsx", "ts", "tsx", "py", "rb", "scala")
ID = r"""(?:applicationId|namespace|"appId"|appId|"identifier"|"package")\s*[:=(]?\s*["']([A-Za-z][\w]*(?:\.[\w]+)+)["']"""
MANIFEST_PACKAGE = r"""<manifest[^>]*\spackage="([\w.]+)\""""
VERSION = r"""(?m)(?:versionName\s*[=(]?\s*|^version:\s*|"version"\s*:\s*|^version\s*=\s*)["']?([0-9][\w.+-]*)"""
# Segments of a path that name no library.
GENERIC_SEGMENTS = ("com", "org", "io", "net", "android", "androidx", "app", "sdk", "lib", "core", "mobile", "internal")
SOURCE_MISMATCH, NO_ENGLISH = "source_mismatch", "no_english"
_TEXTS = "array<string>"


def base_name(path: Column) -> Column:
    return F.lower(F.element_at(F.split(path, "/"), -1))


def extension(base: Column) -> Column:
    return F.when(F.contains(base, F.lit(".")), F.element_at(F.split(base, r"\."), -1)).otherwise("")


def is_code(base: Column) -> Column:
    return extension(base).isin(*CODE)


def has_version(text: Column, version: Column) -> Column:
    """Does a version stand in a text with no letter, digit, dot, line or hyphen beside it?"""
    return F.regexp_like(text, F.concat(F.lit("(?<![0-9A-Za-z._-])"), literal(version), F.lit("(?![0-9A-Za-z._-])")))


def tree_facts(files: DataFrame, apps: DataFrame, tree: str = "tree_id") -> DataFrame:
    """(tree, code, license, free, short, full, ids, package, versions, version) of trees against their app's package and version.

    ``files`` has (tree, path, body), ``apps`` (tree, package, version), either
    may be empty. Files beyond MAX_FILE_BYTES count as empty. The licence is
    that of the first root licence file that names one; store texts are those of
    the first English folder. Ids and versions are those of build files, sorted.
    """
    own = apps.select(F.col(tree).alias("__tree"), F.trim("package").alias("__pkg"), F.trim("version").alias("__ver"))
    low, base = F.lower("path"), base_name(F.col("path"))
    f = files.withColumn("raw", F.when(F.octet_length("body") <= MAX_FILE_BYTES, F.col("body")).otherwise("")).withColumn("base", base).withColumn("parts", F.split("path", "/"))
    legal = F.col("base").rlike("^(license|licence|copying)")
    store = ~legal & (F.contains(low, F.lit("en-us/")) | F.contains(low, F.lit("en-gb/")) | F.contains(low, F.lit("/en/")))
    build = ~legal & ~store & is_build_file(F.col("base"))
    raw = F.col("raw")
    every = lambda p: F.when(build, F.regexp_extract_all(raw, F.lit(re2_to_java(p)), 1)).otherwise(F.array().cast(_TEXTS))
    manifest = F.when(build & (F.col("base") == "androidmanifest.xml"), F.regexp_extract_all(raw, F.lit(re2_to_java(MANIFEST_PACKAGE)), 1)).otherwise(F.array().cast(_TEXTS))
    licensed = F.when(legal & ~F.contains(F.col("path"), F.lit("/")), tx.license_of(raw))
    text = lambda name: F.when(store & (F.col("base") == name) & (F.trim(raw) != ""), F.trim(raw))
    # Files are cut to their facts before they meet the app; of their bodies only those of build files go on.
    f = f.select(tree, "parts", (is_code(F.col("base")) & (F.col("base") != "readme.md")).alias("code"), licensed.alias("l"), text("short_description.txt").alias("short"), text("full_description.txt").alias("full"), F.array_union(every(ID), manifest).alias("ids"), every(VERSION).alias("versions"), F.when(build, raw).alias("built")).join(own, F.col(tree) == F.col("__tree"))
    built = F.col("built").isNotNull()
    f = f.withColumn("package", built & (F.col("__pkg") != "") & F.contains("built", F.col("__pkg"))).withColumn("version", built & (F.col("__ver") != "") & has_version(F.col("built"), F.col("__ver")))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("parts"))).alias(c)
    sets = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c)
    g = f.groupBy(tree).agg(F.first("__pkg").alias("pkg"), F.first("__ver").alias("ver"), F.bool_or("code").alias("code"), F.min_by("l", F.when(F.col("l").isNotNull(), F.col("parts"))).alias("l"), first("short"), first("full"), sets("ids"), F.bool_or("package").alias("package"), sets("versions"), F.bool_or("version").alias("version"))
    p, v = F.col("pkg"), F.col("ver")
    related = F.exists("ids", lambda i: (p != "") & ((i == p) | p.startswith(F.concat(i, F.lit("."))) | i.startswith(F.concat(p, F.lit(".")))))
    same = F.exists("versions", lambda x: (v != "") & ((x == v) | x.startswith(F.concat(v, F.lit("+"))) | v.startswith(F.concat(x, F.lit("-")))))
    none = F.array().cast(_TEXTS)
    blank = lambda c: F.coalesce(c, F.lit("")).alias
    return g.select(tree, "code", blank("l.id")("license"), F.coalesce("l.free", F.lit(False)).alias("free"), blank("short")("short"), blank("full")("full"), F.when(p == "", none).otherwise(F.col("ids")).alias("ids"), (F.col("package") | related).alias("package"), F.when(v == "", none).otherwise(F.col("versions")).alias("versions"), (F.col("version") | same).alias("version"))


def matches_package(files: DataFrame, apps: DataFrame, tree: str = "tree_id") -> DataFrame:
    """(tree, ok, reason): does a tree have code, its app's package quoted in a build file, and the version as a token outside the readme?

    Apps whose tree has no file don't match by package.
    """
    own = apps.select(F.col(tree).alias("__tree"), F.trim("package").alias("pkg"), F.trim("version").alias("ver"))
    f = files.join(own, F.col(tree) == F.col("__tree")).withColumn("base", base_name(F.col("path")))
    body, other = F.col("body"), F.col("base") != "readme.md"
    build = (F.col("base") == "androidmanifest.xml") | extension(F.col("base")).isin("gradle", "kts")
    quoted = F.contains(body, F.concat(F.lit('"'), F.col("pkg"), F.lit('"'))) | F.contains(body, F.concat(F.lit("'"), F.col("pkg"), F.lit("'")))
    seen = f.groupBy("__tree").agg(F.bool_or(is_code(F.col("base"))).alias("code"), F.bool_or(other & build & quoted).alias("identity"), F.bool_or(other & (F.col("ver") != "") & has_version(body, F.col("ver"))).alias("found"))
    odd = r"[ \t\n\"'\\/]"
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    reason = F.when(~F.contains("pkg", F.lit(".")) | F.col("pkg").rlike(odd), "package").when((F.col("ver") == "") | F.col("ver").rlike(odd), "version").when(~yes("code") | ~yes("identity"), "package").when(~yes("found"), "version").otherwise("")
    both = own.withColumnRenamed("__tree", tree).join(seen, F.col(tree) == F.col("__tree"), "left")
    return both.select(tree, (reason == "").alias("ok"), reason.alias("reason"))


def tracking_or_ads(kind: Column, anti: Column) -> Column:
    return F.lower(kind).isin("mobile analytics", "advertisement") | F.array_contains(anti, "Tracking") | F.array_contains(anti, "Ads")


def library_tokens(path: Column) -> Column:
    """What would name a library in source: its dotted path, and the second and third segment if they are telling."""
    segments = F.split(F.btrim(path, F.lit("/")), "/")
    telling = F.filter(F.slice(segments, 2, 2), lambda s: (F.octet_length(s) >= 4) & ~s.isin(*GENERIC_SEGMENTS))
    return F.transform(F.array_distinct(F.concat(F.array(F.array_join(segments, ".")), telling)), lambda t: F.lower(t))


def unmentioned(libraries: DataFrame, files: DataFrame, tree: str = "tree_id") -> DataFrame:
    """(tree, names): tracking and ad libraries of an app (tree, id, name, type, path, anti) that its source never names, sorted.

    A file meets the tokens of its own tree only; a library is named once one
    of its tokens occurs in a file, case aside.
    """
    mine = libraries.filter((F.col("path") != "") & tracking_or_ads(F.col("type"), F.col("anti")))
    tokens = mine.select(tree, F.explode(library_tokens(F.col("path"))).alias("token")).distinct()
    lists = tokens.groupBy(F.col(tree).alias("__tree")).agg(F.collect_set("token").alias("tokens"))
    small = files.filter(F.octet_length("body") <= MAX_FILE_BYTES).select(tree, F.lower("body").alias("low"))
    met = small.join(lists, F.col(tree) == F.col("__tree")).select(tree, F.explode(F.filter("tokens", lambda t: F.contains(F.col("low"), t))).alias("token")).distinct()
    each = mine.select(tree, "id", F.coalesce(F.nullif("name", F.lit("")), F.col("id")).alias("label"), F.explode(library_tokens(F.col("path"))).alias("token"))
    hit = met.withColumn("hit", F.lit(True))
    named = each.join(hit, [tree, "token"], "left").groupBy(tree, "id", "label").agg(F.bool_or(F.coalesce("hit", F.lit(False))).alias("named"))
    return named.filter("NOT named").groupBy(tree).agg(F.array_sort(F.collect_set("label")).alias("names"))


def flags(package: Column, version: Column, read: Column, facts: Column, missing: Column, exact: Column, english: Column) -> Column:
    """Array of (id, note): a source that isn't the package's, and an app without English.

    ``facts`` is a row of ``tree_facts``, ``missing`` the libraries the source
    never names, ``english`` null where nothing can be said.
    """
    why = F.array_compact(
        F.array(
            F.when((package != "") & (F.size(facts["ids"]) > 0) & ~facts["package"], F.concat(F.lit("package "), package, F.lit(" is not declared in the source ("), F.array_join(F.slice(F.array_sort(facts["ids"]), 1, 3), ", "), F.lit(")"))),
            F.when(F.size(missing) > 0, F.concat(F.lit("the APK has "), F.array_join(missing, ", "), F.lit(", which the source never references"))),
            F.when(exact & (version != "") & (F.size(facts["versions"]) > 0) & ~facts["version"], F.concat(F.lit("version "), version, F.lit(" is not in the source at this commit"))),
        )
    )
    note = F.array_join(why, "; ")
    mismatch = F.when(read & (F.size(why) > 0), F.struct(F.lit(SOURCE_MISMATCH).alias("id"), F.concat(F.upper(F.substring(note, 1, 1)), F.substring(note, 2, 1 << 20), F.lit(".")).alias("note")))
    foreign = F.when(~english, F.struct(F.lit(NO_ENGLISH).alias("id"), F.lit("The app's own text is not in English and has no English translation.").alias("note")))
    return F.array_compact(F.array(mismatch, foreign))


def tree_size(files: DataFrame, tree: str = "tree_id") -> DataFrame:
    """(tree, files, bytes) of a tree."""
    return files.groupBy(tree).agg(F.count(F.lit(1)).alias("files"), F.sum(F.octet_length("body").cast("long")).alias("bytes"))


def first_files(files: DataFrame, rank: Column, tree: str = "tree_id", most: int = 8000) -> DataFrame:
    """The first files of each tree by rank, then path; ranks are few, so a tree's files are numbered per rank first."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy(tree).orderBy("__rank", "path"))
    return files.withColumn("__rank", rank).withColumn("__n", n).filter(F.col("__n") <= most).drop("__rank", "__n")
