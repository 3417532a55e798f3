"""Keyed tables: merge, delete, expiring caches, compare, backoff, review state, plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge(target: DataFrame, updates: DataFrame, key: str, clears: tuple[str, ...] = ()) -> DataFrame:
    """``target`` after an upsert by key. A null or empty update leaves a column as it is; columns in ``clears`` take an empty one."""
    new = updates.select(F.col(key).alias("__key"), F.lit(True).alias("__there"), *[F.col(c).alias(f"__{c}") for c in updates.columns if c != key])
    joined = target.join(new, F.col(key) == F.col("__key"), "full_outer")

    def value(c: str) -> Column:
        if c == key:
            return F.coalesce(F.col(key), F.col("__key")).alias(key)
        if f"__{c}" not in new.columns:
            return F.col(c)
        fresh = F.col(f"__{c}")
        if c in clears:
            return F.when(F.col("__there") & fresh.isNotNull(), fresh).otherwise(F.col(c)).alias(c)
        empty = fresh.isNull() | (fresh == "") if dict(updates.dtypes)[c] == "string" else fresh.isNull()
        return F.when(F.col("__there") & ~empty, fresh).otherwise(F.col(c)).alias(c)

    return joined.select(*[value(c) for c in target.columns])


def delete(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``target`` without the given keys; keys that aren't there do no harm."""
    return target.join(keys.select(key).distinct(), key, "left_anti")


def stored_text(new: Column, old: Column) -> Column:
    """Trimmed with a line end, or the old text where the new is empty."""
    return F.when(F.trim(new) != "", F.concat(F.trim(new), F.lit("\n"))).otherwise(old)


def cache_get(cache: DataFrame, wanted: DataFrame, now: Column, max_age: Column) -> DataFrame:
    """``wanted`` (kind, key) with the newest cached value and ``hit``; ages over ``max_age`` miss, and 0 is for ever."""
    newest = cache.groupBy("kind", "key").agg(F.max_by("value", "at").alias("value"), F.max("at").alias("at"))
    joined = wanted.join(newest, ["kind", "key"], "left")
    hit = F.col("at").isNotNull() & ((max_age == 0) | (now - F.col("at") <= max_age))
    return joined.withColumn("hit", F.coalesce(hit, F.lit(False))).withColumn("value", F.when(F.col("hit"), F.col("value")))


def prune(cache: DataFrame, cutoff: Column) -> DataFrame:
    return cache.filter(F.col("at") >= cutoff)


#: Backoff: a day, doubled by each refusal, thirty days at most.
FIRST_SECONDS, MOST_SECONDS = 24 * 3600, 30 * 24 * 3600


def backoff_seconds(tries: Column) -> Column:
    return F.when(tries > 5, F.lit(MOST_SECONDS)).otherwise(F.least(F.lit(MOST_SECONDS), F.lit(FIRST_SECONDS) * F.pow(F.lit(2), tries - 1).cast("int"))).cast("long")


def remote_key(remote: Column) -> Column:
    """Case and a last slash don't matter."""
    return F.regexp_replace(F.lower(remote), "/+$", "")


def refusals(events: DataFrame, key: str, at: str) -> DataFrame:
    """(key, tries, until) after all refusals of a key; ``at`` in seconds."""
    state = events.groupBy(key).agg(F.count(F.lit(1)).alias("tries"), F.max(at).alias("__last"))
    return state.select(key, "tries", (F.col("__last") + backoff_seconds(F.col("tries"))).alias("until"))


# Version of the enrichment and icon states of the memo.
GENERATION = 4
ICON_APK, ICON_NONE = "apk", "none"


def plan_work(memo: Column, seen: Column, version: int = GENERATION) -> Column:
    """Struct of what is to be done, from what is stored (null: nothing) and what is observed."""
    known = F.coalesce(memo["version"] == version, F.lit(False))
    m = lambda name: F.when(known, F.coalesce(memo[name], F.lit(""))).otherwise(F.lit(""))
    scan = (seen["apk"] != m("apk")) | ~seen["has_facts"]
    about = (seen["feature"] != m("feature")) | ~seen["has_about"]
    security = ~seen["has_security"] | (seen["facts"] != m("facts"))
    vector = (seen["feature"] != m("feature")) | ~seen["has_vector"]
    settled = (m("icon") == ICON_APK) & (seen["apk"] == m("apk"))
    icon = (~seen["has_icon"] & (m("icon") != ICON_NONE)) | (~settled & scan)
    clone = seen["repo"] & (seen["commit"] != "") & (about | security | (seen["need_readme"] & (m("feature") == "")))
    return F.struct(clone.alias("clone"), (scan | icon).alias("download"), scan.alias("scan"), icon.alias("icon"), about.alias("about"), security.alias("security"), vector.alias("vector"))


# Fixed value: what older memos have for an about text that was passed over.
SKIPPED = "skipped"


def stored_about_hash(stored: Column) -> Column:
    """The hash in a memo, of the empty text where an older one says that it was passed over; null stays null."""
    return F.when(stored == SKIPPED, F.sha2(F.lit(""), 256)).otherwise(stored)


def pending(work: Column) -> Column:
    return work["clone"] | work["download"] | work["scan"] | work["icon"] | work["about"] | work["security"] | work["vector"]


def next_memo(prev: Column, new: Column, done: Column, version: int = GENERATION) -> Column:
    """The memo after a run: a hash moves on only if all stages behind it finished."""
    keep = lambda name, when: F.when(when, new[name]).otherwise(prev[name]).alias(name)
    checked = done["scan"] & done["security"]
    return F.struct(F.lit(version).alias("version"), keep("apk", checked), keep("facts", checked), keep("about", done["about"]), keep("feature", done["about"] & done["vector"] & done["feature"]), keep("icon", done["icon"]))


def run_outcome(marks: DataFrame, plans: DataFrame, key: str) -> DataFrame:
    """(key, quality, missed) from stage marks (key, stage, kind ok, degraded or failed) and plans (key, stages).

    A failed stage fails the run, and so does a planned one that neither failed
    nor finished (``missed``); else a degraded one degrades it. A stage that
    ended degraded has finished.
    """
    some = lambda kind: F.collect_set(F.when(F.col("kind").isin(*kind), F.col("stage")))
    seen = marks.groupBy(F.col(key).alias("__k")).agg(some(["failed"]).alias("bad"), some(["degraded"]).alias("fallback"), some(["ok", "degraded"]).alias("done"))
    none = F.array().cast("array<string>")
    both = plans.join(seen, F.col(key) == F.col("__k"), "full_outer").select(F.coalesce(F.col(key), F.col("__k")).alias(key), *[F.coalesce(c, none).alias(c) for c in ("stages", "bad", "fallback", "done")])
    missed = F.array_except("stages", F.array_union("bad", "done"))
    quality = F.when((F.size("bad") > 0) | (F.size(missed) > 0), "failed").when(F.size("fallback") > 0, "degraded").otherwise("ok")
    return both.select(key, quality.alias("quality"), F.array_sort(missed).alias("missed"))


def planned_not_done(plan: Column, *done: Column) -> Column:
    """Planned stages that no list of done ones has."""
    return F.array_except(plan, F.array_union(done[0], F.array_union(*done[1:3])) if len(done) == 3 else F.flatten(F.array(*done)))


def run_summary(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(*[F.count_if(F.col("quality") == q).alias(q) for q in ("ok", "degraded", "failed")])


def review_state(actions: DataFrame, key: str, at: str) -> DataFrame:
    """(key, status) by the last action: approve, reject, or restore back to pending; anything else leaves it pending."""
    last = F.max_by("action", F.struct(at, "action"))
    return actions.groupBy(key).agg(last.alias("a")).select(key, F.when(F.col("a") == "approve", "approved").when(F.col("a") == "reject", "rejected").otherwise("pending").alias("status"))


def compare_facts(reply: DataFrame, scan: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, fact, status) of a full outer compare: extra, duplicate, wrong, missing or same."""
    r = reply.groupBy(*keys, "fact").agg(F.count(F.lit(1)).alias("n"), F.min_by("value", "pos").alias("value"))
    s = scan.select(*keys, "fact", F.col("value").alias("scanned"))
    status = F.when(F.col("scanned").isNull(), "extra").when(F.col("value").isNull(), "missing").when(F.col("n") > 1, "duplicate").when(F.col("value") != F.col("scanned"), "wrong").otherwise("same")
    return r.join(s, [*keys, "fact"], "full_outer").select(*keys, "fact", status.alias("status"))
