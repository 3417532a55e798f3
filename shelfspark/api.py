"""What a user calls: choosing listings, running work per listing, checking replies, caches, reviews, reports.

Whatever reaches out of Spark (fetching, asking a model) comes in as a function
of the caller; it runs in as many partitions as there may be calls at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.operators import digest_text, evals, listing, scoring, store, tables
from shelfspark.sources import files

# Calls at once by kind, and how long answers are kept, in seconds (models, sites, trees).
SLOTS = {"listing": 8, "git": 4, "fetch": 6, "model": 8}
KEEP = {"llm": 90 * 86400, "site": 7 * 86400, "tree": 30 * 86400}


def matching(listings: DataFrame, part: str = "", ids: DataFrame | None = None, limit_to: DataFrame | None = None) -> DataFrame:
    """Listings to enrich: of the platform, with ``part`` in their id, one of ``ids`` and of ``limit_to`` if given."""
    got = listing.select_listings(listings, part, ids)
    return got if limit_to is None else got.join(limit_to.select("app_id").distinct(), "app_id", "left_semi")


def forced(stored: DataFrame, ids: DataFrame, key: str = "app_id") -> DataFrame:
    """Stored rows without those that are to be made anew."""
    return listing.force(stored, ids, key)


def image_work(stored: DataFrame, profiles: DataFrame) -> DataFrame:
    """Avatars to fetch: those whose picture changed."""
    return store.avatar_work(stored, profiles)


def per_row(rows: DataFrame, work: Callable[[dict], Iterable[dict]], schema: str, slots: int = SLOTS["listing"]) -> DataFrame:
    """What ``work`` gives for each row, at most ``slots`` at once; a row can give any number of rows.

    Rows are dealt evenly to ``slots`` partitions; a lost task does its rows again,
    so ``work`` should not mind being called twice.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                got = list(work(row))
                if got:
                    yield pd.DataFrame(got)

    return rows.repartition(slots).mapInPandas(run, schema)


def checked(replies: DataFrame, check: Column | Callable[[str], str | None], reply: str = "content") -> DataFrame:
    """``replies`` with ``why`` one can't be used, or null: by a Column, or by a function of the reply's text."""
    if isinstance(check, Column):
        return replies.withColumn("why", check)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(check, na_action="ignore")

    return replies.withColumn("why", run(reply))


def first_accepted(replies: DataFrame, key: str, order: str = "attempt") -> DataFrame:
    """The first usable reply of each key (``why`` is null), without ``why``."""
    usable = replies.filter("why IS NULL").drop("why")
    rest = [c for c in usable.columns if c != key]
    return usable.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("r")).select(key, "r.*")


@dataclass(frozen=True)
class TableCache:
    """A cache as a table (kind, key, value, at in seconds): every ``put`` gives a new one."""

    rows: DataFrame
    kind: str
    generation: int = 4

    def _key(self, key: str) -> Column:
        return F.concat(F.lit(f"v{self.generation}:"), F.col(key))

    def get(self, wanted: DataFrame, key: str, now: int) -> DataFrame:
        """``wanted`` with the cached value and ``hit``; older than the kind is kept, or of another generation, misses."""
        asked = wanted.select(F.lit(self.kind).alias("kind"), self._key(key).alias("key"), F.col(key).alias("__own"))
        got = tables.cache_get(self.rows, asked, F.lit(now), F.lit(KEEP.get(self.kind, 0)))
        return wanted.join(got.select(F.col("__own").alias("__k"), "value", "hit").distinct(), F.col(key) == F.col("__k"), "left").drop("__k")

    def put(self, new: DataFrame, key: str, value: str, now: int) -> TableCache:
        rows = new.select(F.lit(self.kind).alias("kind"), self._key(key).alias("key"), F.col(value).cast("string").alias("value"), F.lit(now).cast("long").alias("at"))
        return TableCache(store.cache_put(self.rows, rows), self.kind, self.generation)

    def prune(self, cutoff: int) -> TableCache:
        return TableCache(tables.prune(self.rows, F.lit(cutoff)), self.kind, self.generation)


@dataclass(frozen=True)
class Codec:
    """How a kind of case is checked: ``problems`` gives a list of reasons from a row's columns, ``fields`` the keys it may have."""

    fields: tuple[str, ...]
    problems: Callable[[], Column]


def _listed(why: Column) -> Column:
    return F.array_compact(F.array(why))


#: Kinds of cases by name.
CODECS: dict[str, Codec] = {
    "about": Codec(("id", "split", "tags", "listing", "want", "note"), lambda: _listed(scoring.case_fails(F.col("id"), F.col("split"), F.col("want.action"), F.col("want.about"), F.col("description"), F.col("want.must"), F.col("want.must_not")))),
    "security": Codec(("id", "split", "tags", "listing", "scan", "source", "current", "prev_facts", "want", "note"), lambda: _listed(F.when(F.coalesce(F.col("id"), F.lit("")) == "", "no id").when(~F.col("split").isin(*scoring.SPLITS), F.concat("id", F.lit(": split is not one of [train dev test]"))).when(F.size("scan") == 0, F.concat("id", F.lit(": no scan rows"))))),
}


def review_items(kind: str, cases: DataFrame, actions: DataFrame) -> DataFrame:
    """Cases of a kind with their problems and the state that reviewing them came to; of approved ones only those approved here."""
    judged = cases.withColumn("problems", CODECS[kind].problems())
    return store.review_list(store.review_log(judged, actions).withColumn("kind", F.lit(kind)))


def report_lines(results: DataFrame, checks: list[str], title: str = "pass", tags: str = "tags") -> list[str]:
    """A report on scored results (fails map, tags): the pass rate, failed checks in their order, rates by tag. A few numbers come to the driver."""
    passed = evals.passed(F.col("fails"))
    total = results.agg(F.count_if(passed).alias("n"), F.count(F.lit(1)).alias("total")).select(evals.rate_text(F.col("n"), F.col("total")).alias("r")).first()["r"]
    counts = {r["check"]: r["n"] for r in evals.check_counts(results).collect()}
    by_tag = evals.by_tag(results, tags, passed).orderBy("tag").select("tag", evals.rate_text(F.col("pass"), F.col("total")).alias("r")).collect()
    return [f"{title:<9}{total}", "", "failed checks", *[f"  {c:<9} {counts[c]}" for c in checks if counts.get(c)], "", "by tag", *[f"  {r['tag']:<20} {r['r']}" for r in by_tag]]


def mine(spark: SparkSession, events: str, path: str) -> None:
    """Unlabelled cases of the listings in JSON lines of events, written as JSON lines."""
    read = spark.read.schema("kind int, tags array<array<string>>, content string").json(events)
    store.write_json_lines(scoring.mined_cases(read), path)


def pass_rate(results: DataFrame) -> float:
    """The share of scored results (fails map) without a failed check; 0 without results."""
    n, total = results.agg(F.count_if(evals.passed(F.col("fails"))), F.count(F.lit(1))).first()
    return n / total if total else 0.0


def report(spark: SparkSession, results: str, least: float = 0.0) -> tuple[list[str], bool]:
    """The report on JSON lines of scored results (fails, tags), and whether as many passed as asked for."""
    read = spark.read.schema("id string, fails map<string, string>, tags array<string>").json(results)
    read = read.withColumn("fails", F.coalesce("fails", F.create_map().cast("map<string, string>"))).withColumn("tags", F.coalesce("tags", F.array().cast("array<string>")))
    checks = [r[0] for r in read.select(F.explode(F.map_keys("fails")).alias("c")).distinct().orderBy("c").collect()]
    return report_lines(read, checks), pass_rate(read) >= least


def tree_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(tree_id, digest) of the trees below a folder, one in each folder in it."""
    found = files.tree_files(spark, folder)
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder).toUri().getPath().rstrip("/")
    below = F.substring(F.col("path"), F.lit(len(top) + 2), F.length("path"))
    parts = found.select(F.substring_index(below, "/", 1).alias("tree_id"), below.alias("below"), "body")
    return digest_text.write_digests(parts.select("tree_id", F.expr("substring(below, length(tree_id) + 2)").alias("path"), "body").filter("path <> ''"))


def main(arguments: list[str] | None = None) -> int:
    """``python -m shelfspark.api`` and a command; ``--help`` tells which there are."""
    import argparse

    from shelfspark import registry
    from shelfspark.plans import catalog  # noqa: F401  registers the queries

    parser = argparse.ArgumentParser(prog="shelfspark", description="Queries over a folder of tables, and what is made of cases, results and trees.")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names the queries")
    for name, does in (("run", "shows what a query gives"), ("export", "writes it as JSON lines")):
        p = commands.add_parser(name, help=does)
        p.add_argument("query", choices=sorted(registry.QUERIES))
        p.add_argument("folder")
        if name == "export":
            p.add_argument("path")
        else:
            p.add_argument("--rows", type=int, default=20)
    for name, source, does in (("mine", "events", "writes cases of listing events"), ("digest", "folder", "writes digests of the trees in a folder")):
        p = commands.add_parser(name, help=does)
        p.add_argument(source)
        p.add_argument("path")
    p = commands.add_parser("report", help="reports on scored results; fails below --min")
    p.add_argument("results")
    p.add_argument("--min", type=float, default=0.0)
    given = parser.parse_args(arguments)
    if given.command == "list":
        print("\n".join(sorted(registry.QUERIES)))
        return 0
    spark = SparkSession.builder.appName("shelfspark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if given.command == "mine":
        mine(spark, given.events, given.path)
    elif given.command == "digest":
        store.write_json_lines(tree_digests(spark, given.folder), given.path)
    elif given.command == "report":
        lines, enough = report(spark, given.results, given.min)
        print("\n".join(lines))
        return 0 if enough else 1
    elif given.command == "run":
        registry.QUERIES[given.query](spark, given.folder).show(given.rows, truncate=False)
    else:
        store.write_json_lines(registry.QUERIES[given.query](spark, given.folder), given.path)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
