"""Joins that SQL has no word for: longest prefix, first matching rule, contains, closest version."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.functions import arrow_text
from shelfspark.functions.text import let
from shelfspark.plans.lineage import cut

#: A side given as "small" is broadcast up to this many rows; beyond, Spark joins as it sees fit.
SMALL_ROWS = 100_000


def small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it is small by count."""
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def ancestors(path: Column, sep: str = "/") -> Column:
    """Every prefix of a path that ends at a separator or the end, shortest first."""
    parts = F.split(path, sep)
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), sep))


def longest_prefix(df: DataFrame, rules: DataFrame, path: str, prefix: str, keys: list[str]) -> DataFrame:
    """``df``'s keys with the rule of the longest prefix of ``path``: ancestors meet prefixes by equality, no LIKE.

    Of rules with one prefix the largest by its other columns is taken.
    """
    each = df.select(*keys, F.explode(ancestors(F.col(path))).alias("__prefix"))
    met = each.join(small(rules), F.col("__prefix") == F.col(prefix))
    extra = [c for c in rules.columns]
    best = met.groupBy(*keys).agg(F.max(F.struct(F.length("__prefix").alias("__n"), *extra)).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.{c}").alias(c) for c in extra])


def first_regex_rule(df: DataFrame, rules: list[tuple[str, str]], column: str) -> DataFrame:
    """``rule``: the first by name of the rules whose RE2 pattern finds something; one pass, no cross join."""
    return df.withColumn("rule", arrow_text.first_match(F.col(column), rules))


#: Bytes of phrases that are searched for at once; beyond, texts and phrases meet by their word runs.
SMALL_BYTES = 64 << 20


def _occurrences(rows: list, kind: str):
    """Batches of (key, text) -> (key, phrase's key) for each phrase in a text, by one automaton of all phrases."""
    import ahocorasick

    by_text: dict[str, list] = {}
    for key, phrase in rows:
        by_text.setdefault(phrase, []).append(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = ahocorasick.Automaton()
        for phrase, keys in by_text.items():
            machine.add_word(phrase, keys)
        machine.make_automaton()
        for batch in batches:
            at, found = [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                met = {id(keys): keys for _, keys in machine.iter(text)} if text else {}
                for keys in met.values():
                    at += [k] * len(keys)
                    found += keys
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(found, kind)], names=["l", "r"])

    return run


def contains_join(left: DataFrame, right: DataFrame, text: str, phrase: str, left_key: str, right_key: str, grams: int = 4) -> DataFrame:
    """(left_key, right_key) where the text contains the phrase; null texts and phrases meet nothing, an empty phrase every text.

    Up to SMALL_ROWS phrases of SMALL_BYTES together, all are searched for in
    one pass. Beyond, a phrase's inner words give a key of ``grams`` whole words
    (fewer if it has fewer); the texts' runs of as many words meet it by their
    hashes alone, and only texts that meet a phrase are fetched and searched.
    Phrases without an inner word are few and are searched for by the automaton.
    """
    p = right.filter(F.col(phrase).isNotNull()).select(F.col(right_key).alias("__rk"), F.col(phrase).alias("__phrase"))
    docs = left.filter(F.col(text).isNotNull()).select(F.col(left_key).alias("__lk"), F.col(text).alias("__text"))
    names = f"`{left_key}` {left.schema[left_key].dataType.simpleString()}, `{right_key}` {right.schema[right_key].dataType.simpleString()}"
    arrow = right.select(right_key).limit(0).toArrow().schema.field(0).type

    def search(phrases: DataFrame) -> DataFrame:
        empty = phrases.filter("__phrase = ''").select("__rk").collect()
        rows = [(r["__rk"], r["__phrase"]) for r in phrases.filter("__phrase <> ''").collect()]
        found = docs.mapInArrow(_occurrences(rows, arrow), names.replace(f"`{left_key}`", "l", 1).replace(f"`{right_key}`", "r", 1) if left_key != right_key else names)
        found = found.toDF(left_key, right_key)
        for r in empty:
            found = found.unionByName(docs.select(F.col("__lk").alias(left_key), F.lit(r["__rk"]).alias(right_key)))
        return found

    n, size = p.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("__phrase").cast("long")), F.lit(0))).first()
    if n <= SMALL_ROWS and size <= SMALL_BYTES:
        return search(p)
    words = lambda c: F.filter(F.split(c, r"\s+"), lambda w: w != "")
    inner = words(F.col("__phrase"))
    inner = F.slice(inner, 2, F.greatest(F.size(inner) - 2, F.lit(0)))
    cut = p.select("__rk", "__phrase", F.slice(inner, 1, grams).alias("__inner"))
    keyed = cut.filter(F.size("__inner") > 0).select("__rk", F.xxhash64(F.size("__inner"), "__inner").alias("__key"))
    runs = lambda w, n: F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.xxhash64(F.lit(n), F.slice(w, i, n)))).otherwise(F.array().cast("array<bigint>"))
    each = docs.select("__lk", words(F.col("__text")).alias("__w")).select("__lk", F.explode(F.array_distinct(F.concat(*[runs(F.col("__w"), n) for n in range(1, grams + 1)]))).alias("__run"))
    pairs = each.join(keyed, F.col("__run") == F.col("__key")).select("__lk", "__rk").distinct()
    met = pairs.join(docs, "__lk").join(p, "__rk").filter(F.contains("__text", F.col("__phrase"))).select(F.col("__lk").alias(left_key), F.col("__rk").alias(right_key))
    return met.unionByName(search(cut.filter(F.size("__inner") == 0).select("__rk", "__phrase")))


def mentions(df: DataFrame, text: str, tokens: list[str]) -> DataFrame:
    """(token, mentioned): does any text contain the token, case aside? One pass, one row per task."""
    low = F.lower(F.col(text))
    any_ = df.agg(*[F.coalesce(F.bool_or(F.contains(low, F.lit(t.lower()))), F.lit(False)).alias(f"t{k}") for k, t in enumerate(tokens)])
    return any_.select(F.explode(F.array(*[F.struct(F.lit(t).alias("token"), F.col(f"t{k}").alias("mentioned")) for k, t in enumerate(tokens)])).alias("r")).select("r.*")


# -- versions ---------------------------------------------------------------

SEMVER = r"^[vV]?(\d+)\.(\d+)(?:\.(\d+))?(?:[-+](.*))?\z"


def without_v(x: Column) -> Column:
    return F.regexp_replace(F.trim(x), "^[vV]", "")


def without_word_prefix(x: Column) -> Column:
    """``stable-35.0.1`` is ``35.0.1``: letters before the first digit go if they end in -, _ or /."""
    return F.regexp_replace(x, r"^[^0-9]*[-_/][vV]?(?=[0-9])", "")


def semver(x: Column) -> Column:
    """Struct (major, minor, patch, pre), or null; missing parts are 0 (at least major.minor must be there)."""
    whole = F.trim(x)
    parts = F.split(F.regexp_replace(whole, SEMVER, "$1\u0000$2\u0000$3\u0000$4"), "\u0000", 4)

    def read(cut: Column) -> Column:
        number = lambda k: F.when(F.octet_length(F.get(cut, F.lit(k))).between(1, 10), F.get(cut, F.lit(k)).cast("long")).otherwise(0)
        return F.struct(number(0).alias("major"), number(1).alias("minor"), number(2).alias("patch"), F.get(cut, F.lit(3)).alias("pre"))

    return F.when(whole.rlike(SEMVER), let(parts, read))


def closest_version(wanted: DataFrame, tags: DataFrame, key: str) -> DataFrame:
    """(key, version, tag) of the tag nearest to the version: the very name, else the same but for a v, else the
    least distance within the major version; a tie goes to a tag that isn't newer, then to the one nearer in order.

    ``wanted`` has (key, version), ``tags`` (key, pos, tag); no tag is null.
    Names meet by equality. The rest is read from tags in order: of a minor
    version only the next patch below and the next above can be nearest, as the
    distance in patches adds to that in minors; of the same patch only the next
    in order and the one of equal pre-release. So a version meets two tags of
    each minor version, however many tags there are, and each is found by one
    sort of tags and versions together. Only tags of a major version that is
    asked for go on; an equal name that is a version has the same one, so only
    names that are no versions meet the rest of the tags.
    """
    asked = wanted.select(F.col(key).alias("k"), F.col("version").alias("want"), F.trim("version").alias("name")).filter("name <> ''").distinct()
    asked = cut(asked.select("k", "want", "name", without_v(F.col("name")).alias("bare"), F.inline_outer(F.array(semver(F.col("name"))))), "asked")
    refs = tags.select(F.col(key).alias("k"), "pos", F.trim("tag").alias("tag")).filter(F.col("tag").rlike(r"^[0-9A-Za-z][0-9A-Za-z._/+-]*\z"))

    # A generator parses a tag once, however many columns are read from it.
    read = refs.select("k", "pos", "tag", F.inline(F.array(F.coalesce(semver(F.col("tag")), semver(without_word_prefix(F.col("tag")))))))
    majors = asked.filter("major IS NOT NULL").select("k", "major").distinct()
    read = read.join(majors.hint("shuffle_hash"), ["k", "major"], "left_semi")
    read = cut(read.withColumn("final", F.col("pre") == ""), "versions")

    def equal(names: DataFrame, held: DataFrame) -> DataFrame:
        named = names.select("k", "want", "name", "bare").join(held.select("k", "pos", "tag", without_v(F.col("tag")).alias("bare")), ["k", "bare"])
        return named.groupBy("k", "want").agg(F.min(F.struct((F.col("tag") != F.col("name")).alias("other"), "pos", "tag")).alias("t")).select("k", "want", F.col("t.tag").alias("tag"))

    exact = equal(asked.filter("major IS NOT NULL"), read)
    odd = asked.filter("major IS NULL")
    if not odd.isEmpty():
        exact = exact.unionByName(equal(odd, refs.filter(~F.col("tag").rlike(SEMVER))))
    exact = cut(exact, "equal-names")
    probes = asked.filter("major IS NOT NULL").join(exact.select("k", "want"), ["k", "want"], "left_anti").select("k", "want", "major", "minor", "patch", "pre")
    probes = cut(probes.withColumn("final", F.col("pre") == ""), "probes")

    # Of a patch the newest tag counts in minors that are older than the version's, the oldest in newer ones; of equal tags the first.
    first_of = read.groupBy("k", "major", "minor", "patch", "final", "pre").agg(F.min(F.struct("pos", "tag")).alias("f"))
    ends = first_of.groupBy("k", "major", "minor", "patch").agg(F.max(F.struct("final", "pre", "f")).alias("newest"), F.min(F.struct("final", "pre", "f")).alias("oldest"))
    of = lambda end: F.struct("minor", "patch", F.col(f"{end}.final").alias("final"), F.col(f"{end}.pre").alias("pre"), F.col(f"{end}.f.pos").alias("pos"), F.col(f"{end}.f.tag").alias("tag"))
    minors = read.groupBy("k", "major").agg(F.collect_set("minor").alias("minors"))
    asks = probes.join(minors, ["k", "major"]).withColumn("m", F.explode("minors")).drop("minors")

    def beside(held: DataFrame, asking: DataFrame, keys: list[str], what: list[str], order: Column) -> DataFrame:
        """Each row of ``asking`` with the structs ``what`` of the last held row up to it and the first after it."""
        rest = F.struct(*[c for c in asking.columns if c not in keys])
        kind = asking.select(rest.alias("a")).schema["a"].dataType
        none = {w: F.lit(None).cast(held.schema[w].dataType) for w in what}
        both = held.select(*keys, order.alias("o"), F.lit(0).alias("side"), *what, F.lit(None).cast(kind).alias("a"))
        both = both.unionByName(asking.select(*keys, order.alias("o"), F.lit(1).alias("side"), *[none[w].alias(w) for w in what], rest.alias("a")))
        up = Window.partitionBy(*keys).orderBy("o", "side").rowsBetween(Window.unboundedPreceding, 0)
        down = Window.partitionBy(*keys).orderBy("o", "side").rowsBetween(1, Window.unboundedFollowing)
        found = both.select("*", *[F.last(w, True).over(up).alias(f"{w}_below") for w in what], *[F.first(w, True).over(down).alias(f"{w}_above") for w in what])
        return found.filter("side = 1").select("a.*", *keys, *[f"{w}_{d}" for w in what for d in ("below", "above")])

    held = ends.select("k", "major", F.col("minor").alias("m"), "patch", of("newest").alias("newest"), of("oldest").alias("oldest"))
    near = beside(held, asks, ["k", "major", "m"], ["newest", "oldest"], F.struct("patch"))
    # In the version's own minor older patches count by their newest tag, newer ones by their oldest.
    older, own = F.col("m") < F.col("minor"), F.col("m") == F.col("minor")
    below = F.when(older | own, F.col("newest_below")).otherwise(F.col("oldest_below"))
    above = F.when(older, F.col("newest_above")).otherwise(F.col("oldest_above"))
    one = near.select("k", "want", "minor", "patch", "pre", "final", F.explode(F.array(below, above)).alias("c"))
    singles = first_of.select("k", "major", "minor", "patch", "final", "pre", F.struct("minor", "patch", "final", "pre", F.col("f.pos").alias("pos"), F.col("f.tag").alias("tag")).alias("c"))
    within = beside(singles, probes, ["k", "major", "minor"], ["c"], F.struct("patch", "final", "pre"))
    two = within.select("k", "want", "minor", "patch", "pre", "final", F.explode(F.array("c_below", "c_above")).alias("c"))
    alike = beside(singles.withColumnRenamed("pre", "p").withColumnRenamed("minor", "m"), asks.withColumn("p", F.col("pre")), ["k", "major", "m", "p"], ["c"], F.struct("patch"))
    three = alike.select("k", "want", "minor", "patch", "pre", "final", F.explode(F.array("c_below", "c_above")).alias("c"))
    cands = one.unionByName(two).unionByName(three).filter("c IS NOT NULL")
    far = F.abs(F.col("minor") - F.col("c.minor")) * 1_000 + F.abs(F.col("patch") - F.col("c.patch")) + F.when(F.col("pre") != F.col("c.pre"), 1).otherwise(0)
    at = lambda c="": F.struct(*[F.col(f"{c}{x}") for x in ("minor", "patch", "final", "pre")])
    cands = cands.withColumn("far", far).withColumn("newer", at("c.") > at())
    w = Window.partitionBy("k", "want").orderBy("far", "newer", F.when(~F.col("newer"), at("c.")).desc_nulls_last(), F.when(F.col("newer"), at("c.")).asc_nulls_last(), "c.pos")
    nearest = cands.withColumn("n", F.row_number().over(w)).filter("n = 1").select("k", "want", F.col("c.tag").alias("tag"))
    best = exact.unionByName(nearest)
    return wanted.join(best, (F.col(key) == F.col("k")) & (F.col("version") == F.col("want")), "left").select(key, "version", "tag")
