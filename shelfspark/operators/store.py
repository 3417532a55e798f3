"""The stored tables of apps: opening with migration, lookups, writes that refresh hashes, caches, reviews, pauses, counters, line files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.operators import tables
from shelfspark.plans.lineage import scratch_path

# The columns whose content makes an app's hash, in order; outcomes of a run.
HASHED = ("about", "icon", "security", "trust", "vector")
QUALITIES = ("ok", "degraded", "failed")
REVIEWED, DRAFT, REJECTED = "reviewed", "draft", "rejected: "
_TEXTS = "array<string>"


def exists(spark: SparkSession, path: str) -> bool:
    """Is there anything at a path of any store that Spark reaches?"""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def open_table(spark: SparkSession, path: str, schema: T.StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """A stored table in today's schema: columns that older files lack have their default, a missing table is empty."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    old = spark.read.option("mergeSchema", "true").parquet(path)
    have = set(old.columns)
    value = lambda f: F.col(f"`{f.name}`") if f.name in have else F.lit((defaults or {}).get(f.name))
    filled = [F.coalesce(value(f), F.lit((defaults or {}).get(f.name))).cast(f.dataType).alias(f.name) for f in schema]
    return old.select(*filled)


def lookup(stored: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``wanted`` keys with the stored row of each and ``present``; a missing row is no error."""
    mine = stored.withColumn("__present", F.lit(True))
    return wanted.join(mine, key, "left").withColumn("present", F.coalesce("__present", F.lit(False))).drop("__present")


def all_keys(stored: DataFrame, key: str) -> DataFrame:
    return stored.select(key).orderBy(key)


def files_by_app(stored: DataFrame, key: str = "id") -> DataFrame:
    """(key, apk, files_hash) of the apps that have files."""
    return stored.filter("files_hash <> ''").select(key, "apk", "files_hash")


def avatars(stored: DataFrame, wanted: DataFrame) -> DataFrame:
    """(pubkey, picture, webp, hit) of wanted authors; an empty image misses."""
    got = lookup(stored, wanted, "pubkey")
    return got.select("pubkey", "picture", "webp", (F.col("present") & (F.coalesce(F.octet_length("webp"), F.lit(0)) > 0)).alias("hit"))


def avatar_work(avatars_: DataFrame, profiles: DataFrame) -> DataFrame:
    """Profiles (pubkey, picture) whose picture isn't the stored one."""
    now = avatars_.filter(F.octet_length("webp") > 0).select(F.col("pubkey").alias("__k"), F.trim("picture").alias("__p"))
    return profiles.filter(F.trim("picture") != "").join(now, (F.col("pubkey") == F.col("__k")) & (F.col("picture") == F.col("__p")), "left_anti")


def write(target: DataFrame, updates: DataFrame, key: str = "id", clears: tuple[str, ...] = ("trust", "queries")) -> DataFrame:
    """``target`` after an upsert, with ``files_hash`` over HASHED as it is then.

    Empty texts and empty blobs leave a column as it is, but for ``clears``.
    Queries are not hashed, so they don't change the hash.
    """
    blobs = [c for c, kind in updates.dtypes if kind == "binary"]
    for c in blobs:
        updates = updates.withColumn(c, F.when(F.octet_length(c) > 0, F.col(c)))
    merged = tables.merge(target, updates, key, clears)
    return merged.withColumn("files_hash", files_hash(merged))


def files_hash(rows: DataFrame) -> Column:
    """SHA-256 of the five hashed columns, each as its length, a zero byte and its bytes; empty where all are empty."""
    raw = [F.coalesce(F.col(c).cast("binary"), F.lit(b"")) for c in HASHED if c in rows.columns]
    parts = [F.concat(F.octet_length(x).cast("string").cast("binary"), F.lit(b"\0"), x) for x in raw]
    some = F.lit(False)
    for x in raw:
        some = some | (F.octet_length(x) > 0)
    return F.when(some, F.sha2(F.concat(*parts), 256)).otherwise("")


def set_quality(target: DataFrame, outcomes: DataFrame, key: str = "id") -> DataFrame:
    """``target`` with quality, quality_note and took_ms of runs; another outcome than QUALITIES fails the job, negative times are 0."""
    sure = F.when(F.col("quality").isin(*QUALITIES), F.col("quality")).otherwise(F.raise_error(F.concat(F.lit("no such quality: "), F.col("quality"))))
    checked = outcomes.select(key, sure.alias("quality"), F.col("quality_note"), F.greatest(F.lit(0), F.col("took_ms")).cast("long").alias("took_ms"))
    return tables.merge(target, checked, key, ("quality_note",))


def cache_put(cache: DataFrame, new: DataFrame) -> DataFrame:
    """(kind, key, value, at) with the newest entry of each; of equally new ones that of ``new``."""
    both = cache.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    return both.groupBy("kind", "key").agg(F.max(F.struct("at", "__new", "value")).alias("m")).select("kind", "key", "m.value", "m.at")


def same_values(a: Column, b: Column) -> Column:
    """Equal arrays, order and nulls included."""
    return a.eqNullSafe(b)


# -- reviews ---------------------------------------------------------------------


def apply_action(state: Column, action: Column, problems: Column, forced: Column, reason: Column) -> Column:
    """The state (status, tags, note, refused) of a case after an action; what an action can't do is ``refused`` and changes nothing.

    Approve and reject need a pending case, approve one without problems unless
    forced; restore brings back what was rejected, or approved here.
    """
    tags, note, status = state["tags"], state["note"], state["status"]
    without = lambda tag: F.filter(tags, lambda t: t != tag)
    with_ = lambda some, tag: F.when(F.array_contains(some, tag), some).otherwise(F.concat(some, F.array(F.lit(tag))))
    row = lambda s, t, n: F.struct(F.lit(s).alias("status"), t.alias("tags"), n.alias("note"), F.lit(None).cast("string").alias("refused"))
    no = lambda why: F.struct(status.alias("status"), tags.alias("tags"), note.alias("note"), F.lit(why).alias("refused"))
    restorable = (status == "rejected") | ((status == "approved") & F.array_contains(tags, REVIEWED))
    return (
        F.when(action.isin("approve", "reject", "save") & (status != "pending"), no("not pending"))
        .when((action == "approve") & (F.size(problems) > 0) & ~forced, no("problems"))
        .when(action == "approve", row("approved", with_(without(DRAFT), REVIEWED), note))
        .when(action == "reject", row("rejected", tags, F.concat(F.lit(REJECTED), F.trim(reason))))
        .when((action == "restore") & ~restorable, no("not found"))
        .when(action == "restore", row("pending", with_(without(REVIEWED), DRAFT), F.when(note.startswith(REJECTED), "").otherwise(note)))
        .otherwise(no(None))
    )


def review_log(cases: DataFrame, actions: DataFrame, key: str = "id") -> DataFrame:
    """(key, status, tags, note, refusals) of cases (key, tags, note, problems), all pending, after their actions in order of ``at``."""
    one = F.struct("at", "action", "forced", "reason")
    log = actions.groupBy(F.col(key).alias("__k")).agg(F.array_sort(F.collect_list(one)).alias("log"))
    both = cases.join(log, F.col(key) == F.col("__k"), "left")
    start = F.struct(F.lit("pending").alias("status"), F.col("tags").alias("tags"), F.col("note").alias("note"), F.lit(0).alias("refusals"))

    def step(state: Column, a: Column) -> Column:
        new = apply_action(state, a["action"], F.col("problems"), a["forced"], a["reason"])
        return F.struct(new["status"].alias("status"), new["tags"].alias("tags"), new["note"].alias("note"), (state["refusals"] + F.when(new["refused"].isNotNull(), 1).otherwise(0)).alias("refusals"))

    return both.select(key, F.aggregate(F.coalesce("log", F.array().cast("array<struct<at:bigint,action:string,forced:boolean,reason:string>>")), start, step).alias("s")).select(key, "s.*")


def review_list(items: DataFrame) -> DataFrame:
    """Items by status; of approved ones only those approved here."""
    return items.filter((F.col("status") != "approved") | F.array_contains("tags", REVIEWED))


# -- providers, counters, lines -------------------------------------------------------


def live_providers(providers: DataFrame, failures: DataFrame, now: Column) -> DataFrame:
    """(provider, pos) not paused at ``now``, from failures (provider, at, pause) in seconds; if all are paused, all."""
    until = failures.groupBy(F.col("provider").alias("__p")).agg(F.max_by(F.col("at") + F.col("pause"), "at").alias("until"))
    both = providers.join(until, F.col("provider") == F.col("__p"), "left").withColumn("live", F.col("until").isNull() | (now >= F.col("until")))
    return both.withColumn("any", F.max("live").over(Window.partitionBy(F.lit(1)))).filter("live OR NOT any").select("provider", "pos")  # a list of a few providers


def usage(calls: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, calls, cached, prompt, completion, reasoning): counters over model calls."""
    return calls.groupBy(*keys).agg(F.count(F.lit(1)).alias("calls"), F.count_if("cached").alias("cached_calls"), *[F.sum(c).alias(c) for c in ("prompt", "completion", "reasoning")])


def usage_line(name: Column, model: Column, prompt: Column, completion: Column, reasoning: Column, cached: Column) -> Column:
    return F.when(cached, F.concat(name, F.lit(" cached"))).otherwise(F.format_string("%s %s in %d out %d reasoning %d", name, model, prompt, completion, reasoning))


def repairs(lines: DataFrame, keys: list[str], line: str = "value") -> DataFrame:
    """(keys, repairs): how many lines of a log tell of a repair."""
    return lines.groupBy(*keys).agg(F.count_if(F.contains(F.col(line), F.lit(": repair: "))).alias("repairs"))


def json_ids(lines: DataFrame, line: str = "value", key: str = "id") -> DataFrame:
    """Distinct ids of JSON lines; lines that are none, or have none, are passed over."""
    return lines.select(F.get_json_object(F.when(F.try_parse_json(line).isNotNull(), F.col(line)), f"$.{key}").alias(key)).filter(F.coalesce(F.col(key), F.lit("")) != "").distinct()


def make_folder(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value) of the lines of a text file; a missing file is empty."""
    return spark.read.text(path) if exists(spark, path) else spark.createDataFrame([], "value string")


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Rows as JSON lines, nulls left out, nothing escaped for HTML."""
    df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value")).write.mode(mode).text(path)


def split_drafts(drafts: DataFrame, why: str = "why") -> tuple[DataFrame, DataFrame]:
    """Drafts that can be used, and those that can't with the reason."""
    return drafts.filter(F.col(why).isNull()).drop(why), drafts.filter(F.col(why).isNotNull())


def rewrite(spark: SparkSession, path: str, change) -> None:
    """Replace a stored text table by ``change`` of it: written aside first, then moved, so a failure leaves the old one or a copy."""
    aside = scratch_path(spark, "rewrite")
    change(read_lines(spark, path)).write.text(aside)
    jvm = spark.sparkContext._jvm
    to, from_, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, aside, f"{path}.old"))
    fs = to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(to):
        fs.delete(old, True)
        fs.rename(to, old)
    source = from_.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not jvm.org.apache.hadoop.fs.FileUtil.copy(source, from_, fs, to, True, spark.sparkContext._jsc.hadoopConfiguration()):
        raise OSError(f"{path} was not written")
    fs.delete(old, True)


def tree_path(root: str, commit: str, generation: int = 1) -> str:
    """Where a commit's tree is stored: by its hash, so it is written once and never changes."""
    return f"{root}/tree/commit={commit}/gen={generation}"


def store_tree(spark: SparkSession, root: str, commit: str, files: DataFrame, generation: int = 1) -> DataFrame:
    """The stored tree of a commit; written first if it isn't there."""
    path = tree_path(root, commit, generation)
    if not exists(spark, f"{path}/_SUCCESS"):
        files.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)

