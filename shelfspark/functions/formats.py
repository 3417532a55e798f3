"""Small formatters and classifications as Columns: durations, lines, file names, keys, failures, profiles."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfspark.functions import text as tx

# Stages in the order in which a plan names them.
PLAN_WORDS = (("clone", "clone"), ("download", "apk"), ("scan", "scan"), ("icon", "icon"), ("about", "about"), ("security", "security"), ("vector", "vector"))
NOTE_BYTES, REASON_BYTES = 2000, 160
# Pauses after a failure, in seconds: a provider, its account, a model.
PROVIDER_PAUSE, ACCOUNT_PAUSE, MODEL_PAUSE = 60, 600, 300


def short_hash(x: Column) -> Column:
    return F.substring(F.trim(x), 1, 12)


def fixed1(x: Column) -> Column:
    """A non-negative number with one decimal, rounded by its exact binary value, ties to even."""
    whole = F.floor(x)
    part = x - whole
    tenths = F.lit(0)
    for k in range(10):
        tie = Decimal(2 * k + 1) / 20
        nearest = float(tie)
        # What equals the double next to a tie lies above it, below it, or on it; then the even neighbour wins.
        up = Decimal(nearest) > tie or (Decimal(nearest) == tie and k % 2 == 1)
        tenths = tenths + ((part >= nearest) if up else (part > nearest)).cast("int")
    return F.concat((whole + F.floor(tenths / 10)).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def duration_ms(ms: Column) -> Column:
    """Negative durations are 0."""
    return F.greatest(F.lit(0), ms).cast("long")


def duration_text(ms: Column) -> Column:
    """``250ms``, ``1.5s`` or ``2m5s``."""
    d = duration_ms(ms)
    seconds = F.floor(d / 1000)
    return F.when(d < 1000, F.concat(d.cast("string"), F.lit("ms"))).when(d < 60_000, F.concat(fixed1(d / 1000.0), F.lit("s"))).otherwise(F.concat(F.floor(seconds / 60).cast("string"), F.lit("m"), (seconds % 60).cast("string"), F.lit("s")))


def compact(parts: Column) -> Column:
    """Trimmed parts without empty ones."""
    return F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")


def join_or(parts: Column, empty: str) -> Column:
    some = compact(parts)
    return F.when(F.size(some) == 0, F.lit(empty)).otherwise(F.array_join(some, " "))


def plan_words(work: Column) -> Column:
    """Names of the stages of a plan (struct of booleans) that are to be done."""
    return F.array_compact(F.array(*[F.when(work[field], word) for field, word in PLAN_WORDS]))


def either_work(a: Column, b: Column) -> Column:
    """The plan of what either plan has to do."""
    return F.struct(*[(a[f] | b[f]).alias(f) for f, _ in PLAN_WORDS])


def dump_name(base: Column, name: Column) -> Column:
    return F.concat_ws("-", base, F.nullif(F.trim(name), F.lit("")))


def safe_name(x: Column) -> Column:
    """Small letters, digits, dots and hyphens only."""
    return F.regexp_replace(F.lower(F.trim(x)), "[^a-z0-9.-]", "")


def safe_app_id(x: Column) -> Column:
    """An id that is one path segment."""
    return (F.trim(x) != "") & ~F.contains(x, F.lit("/")) & ~F.contains(x, F.lit("\\")) & ~F.contains(x, F.lit(".."))


def is_hex(x: Column, *lengths: int) -> Column:
    return x.rlike("^(?:" + "|".join(f"[0-9a-f]{{{n}}}" for n in lengths) + r")\z")


def commit_hash(x: Column) -> Column:
    """A commit of 40 or 64 hex digits in small letters, or null."""
    low = F.lower(F.trim(x))
    return F.when(is_hex(low, 40, 64), low)


def completions_url(root: Column) -> Column:
    bare = F.rtrim(root, F.lit("/"))
    return F.when(bare.endswith("/chat/completions"), bare).otherwise(F.concat(bare, F.lit("/chat/completions")))


def json_content(reply: Column) -> Column:
    """A reply without its fence; if it doesn't begin with a brace, from its first to its last brace."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.trim(reply), r"^```(?:json)?", ""), r"```\z", ""))
    return F.when(bare.startswith("{"), bare).otherwise(F.coalesce(F.nullif(F.regexp_extract(bare, r"(?s)\{.*\}", 0), F.lit("")), bare))


def request_key(messages: Column) -> Column:
    """SHA-256 of roles and contents, each ended by a zero byte."""
    return F.sha2(F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit("\0"), m["content"], F.lit("\0"))), ""), 256)


def reply_key(generation: int, key: Column) -> Column:
    """Cache key of a reply: a new generation misses all older ones."""
    return F.concat(F.lit(f"v{generation}:"), key)


def feature_text(name: Column, summary: Column, content: Column, readme: Column, tags: Column) -> Column:
    """The text whose hash tells whether a listing changed; the readme stands in where the listing says nothing."""
    said = F.trim(F.coalesce(content, F.lit("")))
    body = F.when((F.trim(F.coalesce(summary, F.lit(""))) == "") & (said == ""), F.trim(F.coalesce(readme, F.lit("")))).otherwise(said)
    return F.regexp_replace(F.concat_ws("\n", F.coalesce(name, F.lit("")), F.coalesce(summary, F.lit("")), body, F.array_join(tags, " ")), r"^\s+|\s+\z", "")


def vector_document(feature: Column, about: Column, queries: Column) -> Column:
    """The text that is encoded: what the listing says, the about text, likely queries."""
    text = F.concat(feature, F.when(about != "", F.concat(F.lit("\n\n"), about)).otherwise(""))
    return F.when(F.trim(queries) != "", F.concat(F.rtrim(text, F.lit("\n")), F.lit("\n\n"), F.trim(queries))).otherwise(text)


def profile_name(content: Column) -> Column:
    """The display name of a profile's JSON, else its name; empty if neither."""
    field = lambda k: F.nullif(F.trim(F.get_json_object(content, f"$.{k}")), F.lit(""))
    return F.coalesce(field("display_name"), field("name"), F.lit(""))


def valid_json(x: Column) -> Column:
    return F.try_parse_json(x).isNotNull()


def clip_note(lines: Column, most: int = NOTE_BYTES) -> Column:
    return tx.clip_bytes(F.array_join(lines, "\n"), most)


def http_failure(code: Column) -> Column:
    """Struct (kind, pause) of a status: the account, the provider, or the request itself."""
    kind = F.when(code.isin(401, 402, 403), "account").when(code.isin(408, 429) | (code >= 500), "provider").otherwise("request")
    return F.struct(kind.alias("kind"), F.when(kind == "account", ACCOUNT_PAUSE).when(kind == "provider", PROVIDER_PAUSE).otherwise(0).cast("long").alias("pause"))


def transient(code: Column, no_answer: Column) -> Column:
    """May the same request succeed later? No answer, a server error, or too many requests."""
    return no_answer | (code >= 500) | (code == 429)


# What a git host says when it refuses or has no such repository.
REFUSALS = ("could not read username", "terminal prompts disabled", "authentication failed", "access denied", "returned error: 401", "returned error: 403", "returned error: 404", "repository not found", "not found", "does not appear to be a git repository", "is not allowed", "is this a git repository")


def refused(message: Column) -> Column:
    low = F.lower(message)
    out = F.lit(False)
    for r in REFUSALS:
        out = out | F.contains(low, F.lit(r))
    return out


def repository_failure(message: Column, names_remote: Column) -> Column:
    """``failed`` (try again), ``unreadable`` (degraded, under backoff) or ``not-remote`` (degraded, costs nothing to ask)."""
    return F.when(~names_remote, "not-remote").when(refused(message), "unreadable").otherwise("failed")


def icon_source(apk_hash: Column, has_icon: Column, memo_icon: Column, memo_apk: Column, in_apk: Column, listed: Column) -> Column:
    """Where an icon comes from: apk, listing or none; null if the question is settled or there is no package."""
    settled = memo_icon.isin("apk", "listing") & (memo_apk == apk_hash)
    return F.when((F.trim(apk_hash) == "") | (has_icon & settled) | (~has_icon & (memo_icon == "none")), F.lit(None)).when(in_apk, "apk").when(F.trim(listed) != "", "listing").otherwise("none")


def gitlab_api(remote: Column) -> Column:
    """Struct (root, project) of the API behind a repository's address; null if it isn't one."""
    url = F.trim(remote)
    host = F.try_parse_url(url, F.lit("HOST"))
    authority = F.try_parse_url(url, F.lit("AUTHORITY"))
    path = F.btrim(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), F.lit("/"))
    path = F.regexp_replace(F.when(F.contains(path, F.lit("/-/")), F.substring_index(path, "/-/", 1)).otherwise(path), r"\.git\z", "")
    ok = url.startswith("https://") & host.isNotNull() & ~F.contains(F.coalesce(authority, F.lit("")), F.lit("@")) & (path != "")
    return F.when(ok, F.struct(F.concat(F.lit("https://"), authority, F.lit("/api/v4")).alias("root"), F.replace(F.replace(F.url_encode(path), F.lit("+"), F.lit("%20")), F.lit("%2f"), F.lit("%2F")).alias("project")))
