"""Listings as events with tags: projections, choices of repository and package, selections, carried rows, names of followers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.operators import joins

# The platform that is enriched, and the kind of a repository announcement.
PLATFORM = "android-arm64-v8a"
REPOSITORY_KIND = "30617"
MOST_FOLLOWERS = 5
_TEXTS = "array<string>"


def values(tags: Column, name: str) -> Column:
    """Values of all tags of a name, in order."""
    return F.transform(F.filter(tags, lambda t: (t[0] == name) & (F.size(t) > 1)), lambda t: t[1])


def value(tags: Column, name: str) -> Column:
    """Value of the first tag of a name, or empty."""
    return F.coalesce(F.get(values(tags, name), F.lit(0)), F.lit(""))


def on_platform(tags: Column) -> Column:
    return F.array_contains(values(tags, "f"), PLATFORM)


def repository(tags: Column) -> Column:
    """The repository tag; without one the first announced repository, ``30617:<64 hex>:<id>``, with its relay after a space if it names one."""
    named = value(tags, "repository")
    announced = F.filter(tags, lambda t: (t[0] == "a") & (F.size(t) > 1) & t[1].rlike(rf"^{REPOSITORY_KIND}:[0-9a-f]{{64}}:.+"))
    one = F.get(announced, F.lit(0))
    relay = F.trim(F.coalesce(F.get(one, F.lit(2)), F.lit("")))
    return F.when(F.trim(named) != "", named).otherwise(F.coalesce(F.concat_ws(" ", one[1], F.nullif(relay, F.lit(""))), F.lit("")))


def package(assets: Column) -> Column:
    """Struct (url, hash, commit) of the asset to read: the first for the platform with address and hash, else the first with either; all empty if none."""
    read = F.transform(assets, lambda a: F.struct(value(a, "url").alias("url"), value(a, "x").alias("hash"), value(a, "commit").alias("commit"), on_platform(a).alias("mine")))
    best = F.filter(read, lambda a: a["mine"] & (a["url"] != "") & (a["hash"] != ""))
    some = F.filter(read, lambda a: (a["url"] != "") | (a["hash"] != ""))
    got = F.coalesce(F.get(best, F.lit(0)), F.get(some, F.lit(0)))
    part = lambda k: F.coalesce(got[k], F.lit("")).alias(k)
    return F.struct(part("url"), part("hash"), part("commit"))


def listing_input(listings: DataFrame) -> DataFrame:
    """The fields of a listing (app_id, pubkey, content, tags, release, assets) that enriching reads."""
    t, p = F.col("tags"), package(F.col("assets"))
    return listings.select(
        "app_id",
        value(t, "name").alias("name"),
        value(t, "summary").alias("summary"),
        F.coalesce("content", F.lit("")).alias("content"),
        values(t, "t").alias("topics"),
        F.trim(value(t, "url")).alias("website"),
        repository(t).alias("repository"),
        value(t, "license").alias("license"),
        value(t, "icon").alias("icon_url"),
        "pubkey",
        value(F.col("release"), "version").alias("version"),
        p["url"].alias("apk_url"),
        p["hash"].alias("apk_hash"),
        p["commit"].alias("commit"),
    )


def select_listings(listings: DataFrame, part: str = "", ids: DataFrame | None = None) -> DataFrame:
    """Listings on the platform whose id has ``part`` in it and is one of ``ids`` (app_id), if given; the filter reaches the scan."""
    got = listings.filter(on_platform(F.col("tags")))
    if part:
        got = got.filter(F.contains("app_id", F.lit(part)))
    return got if ids is None else got.join(ids.select("app_id").distinct(), "app_id", "left_semi")


def with_people(listings: DataFrame, pictures: DataFrame, signers: DataFrame) -> DataFrame:
    """Listings with their publisher's picture and their signer, where known."""
    return listings.join(joins.small(pictures), "pubkey", "left").join(joins.small(signers), "app_id", "left")


def force(target: DataFrame, ids: DataFrame, key: str = "app_id") -> DataFrame:
    """A stored table without the rows that are to be made anew."""
    return target.join(ids.select(key).distinct(), key, "left_anti")


# -- rows that a run keeps -----------------------------------------------------


def clean_reason(text: Column) -> Column:
    """A reason in one line without a leading no-change; two that say nothing are empty."""
    line = F.array_join(F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda w: w != ""), " ")
    bare = F.trim(F.regexp_replace(line, r"(?i)^no[- ]change,? ", ""))
    return F.when(F.lower(bare).isin("internet permission absent", "no network permission"), "").otherwise(bare)


def justify(rows: DataFrame, reasons: DataFrame, keys: list[str], most: int = 160) -> DataFrame:
    """Rows with the reason given for their fact, if they say yes and it is no longer than ``most`` bytes."""
    given = reasons.select(*[F.col(k).alias(f"__{k}") for k in (*keys, "fact")], clean_reason(F.col("reason")).alias("__reason"))
    on = F.lit(True)
    for k in (*keys, "fact"):
        on = on & (F.col(k) == F.col(f"__{k}"))
    new = F.when((F.col("value") == "yes") & (F.coalesce("__reason", F.lit("")) != "") & (F.octet_length("__reason") <= most), F.col("__reason")).otherwise(F.col("reason"))
    return rows.join(given, on, "left").withColumn("reason", new).select(*rows.columns)


# Facts that are made anew by each run.
DROPPED = ("decentralized", "accountless", "open_source", "e2ee", "source_available")


def run_rows(rows: DataFrame, apps: DataFrame, source: DataFrame, key: str = "app_id") -> DataFrame:
    """Rows of a run: without the facts that aren't stored, claims of being offline only from the package, an offline row for every app, and the source row."""
    kept = rows.filter(~F.col("fact").isin(*DROPPED) & ~((F.col("fact") == "offline_capable") & (F.col("basis") != "apk")))
    has = kept.filter("fact = 'offline_capable'").select(F.col(key).alias("__has"))
    blank = {"fact": F.lit("offline_capable"), "value": F.lit("no"), "basis": F.lit("apk")}
    online = apps.join(has, F.col(key) == F.col("__has"), "left_anti").select(*[F.col(c) if c == key else blank.get(c, F.lit("")).alias(c) for c in rows.columns])
    own = source.select(*[F.col(c) if c in source.columns else F.lit("").alias(c) for c in rows.columns])
    return kept.unionByName(online).unionByName(own)


def carry_source_row(rows: DataFrame, previous: DataFrame, key: str = "app_id") -> DataFrame:
    """``rows`` and the previous source row of apps that have none now: those whose repository was not tried."""
    now = rows.filter("fact = 'source_available'").select(F.col(key).alias("__now"))
    old = previous.filter("fact = 'source_available'").join(now, F.col(key) == F.col("__now"), "left_anti")
    return rows.unionByName(old.select(*rows.columns))


def carry_flags(now: DataFrame, previous: DataFrame, read: DataFrame, key: str = "app_id", about_source: str = "source_mismatch") -> DataFrame:
    """Flags of a run; those about the source are carried over for apps whose source was not read (``read`` lists the others)."""
    kept = previous.filter(F.col("id") == about_source).join(read.select(F.col(key).alias("__read")), F.col(key) == F.col("__read"), "left_anti")
    return now.unionByName(kept.select(*now.columns)).distinct()


# Beginnings of licences that are free.
FREE = ("MIT", "BSD", "ISC", "APACHE", "MPL", "LGPL", "GPL", "AGPL", "UNLICENSE", "0BSD", "EUPL", "CC0", "WTFPL", "ZLIB", "ARTISTIC", "EPL", "OSL")


def same_license(a: Column, b: Column) -> Column:
    """Do two licence ids agree, but for -only, -or-later, + and more exact versions?"""
    norm = lambda x: F.regexp_replace(F.regexp_replace(F.regexp_replace(F.upper(F.trim(x)), r"-ONLY\z", ""), r"-OR-LATER\z", ""), r"\+\z", "")
    return norm(a).startswith(norm(b)) | norm(b).startswith(norm(a))


def license_note(listed: Column, found: Column, free: Column) -> Column:
    said = F.trim(F.coalesce(listed, F.lit("")))
    up = F.upper(said)
    is_free = F.lit(False)
    for f in FREE:
        is_free = is_free | up.startswith(f)
    own = F.coalesce(found, F.lit(""))
    return (
        F.when((own == "") & (said == ""), "No license is declared.")
        .when((own == "") & is_free, F.concat(said, F.lit(" license.")))
        .when(own == "", F.concat(said, F.lit(", not an open source license.")))
        .when(~F.coalesce(free, F.lit(False)), F.concat(own, F.lit(", not an open source license.")))
        .when((said != "") & ~same_license(said, own), F.concat(own, F.lit(" license. The listing says "), said, F.lit(".")))
        .otherwise(F.concat(own, F.lit(" license.")))
    )


def source_row(listed: Column, failed: Column, read: Column, code: Column, license_: Column, found: Column, free: Column) -> Column:
    """Struct (fact, value, basis, reason) of source_available; null if a listed repository wasn't tried."""
    row = lambda v, basis, reason: F.struct(F.lit("source_available").alias("fact"), F.lit(v).alias("value"), F.lit(basis).alias("basis"), reason.alias("reason"))
    return (
        F.when(~listed, row("no", "listing", F.lit("No repository is listed.")))
        .when(failed, row("no", "listing", F.lit("The listed repository could not be read.")))
        .when(~read, None)
        .when(~code, row("no", "listing", F.lit("The listed repository has no app code.")))
        .otherwise(row("yes", "source", license_note(license_, found, free)))
    )


# -- people --------------------------------------------------------------------


def top_followers(followers: DataFrame, key: str = "app_id", most: int = MOST_FOLLOWERS) -> DataFrame:
    """The ``most`` followers of highest rank per key; ties by name."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("rank"), "follower"))
    return followers.withColumn("__n", n).filter(F.col("__n") <= most).drop("__n")


def follower_names(profiles: DataFrame, wanted: DataFrame, name: Column) -> DataFrame:
    """(pubkey, name) from the newest profile of each wanted author; of equally new ones the first by ``pos``; authors without a name are left out."""
    mine = profiles.join(wanted.select("pubkey").distinct(), "pubkey", "left_semi")
    newest = mine.groupBy("pubkey").agg(F.min_by(name, F.struct((-F.col("created_at")).alias("t"), "pos")).alias("name"))
    return newest.filter("name <> ''")


# -- bech32 names of keys and repositories (NIP-19) ------------------------------

_SIGNS = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"


def bech32(prefix: str, payload: bytes) -> str:
    """BIP-173 text of bytes, without its length limit."""

    def check(bits: list[int]) -> int:
        state = 1
        for b in bits:
            top, state = state >> 25, ((state & 0x1FFFFFF) << 5) ^ b
            for k, g in enumerate((0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)):
                state ^= g if top >> k & 1 else 0
        return state

    number, n = int.from_bytes(payload, "big"), len(payload) * 8
    groups = -(-n // 5)
    number <<= groups * 5 - n
    data = [number >> 5 * k & 31 for k in range(groups - 1, -1, -1)]
    spread = [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix]
    sum_ = check(spread + data + [0] * 6) ^ 1
    return prefix + "1" + "".join(_SIGNS[x] for x in data + [sum_ >> 5 * (5 - k) & 31 for k in range(6)])


def repository_address(coordinate: str | None) -> str | None:
    """The naddr of ``30617:<key>:<id>`` and an optional relay after a space; anything else as it is."""
    head, _, relay = (coordinate or "").partition(" ")
    kind, _, rest = head.partition(":")
    key, _, name = rest.partition(":")
    if kind != REPOSITORY_KIND or len(key) != 64 or not name:
        return coordinate
    field = lambda t, v: bytes([t, len(v)]) + v
    return bech32("naddr", field(0, name.encode()) + (field(1, relay.encode()) if relay else b"") + field(2, bytes.fromhex(key)) + field(3, int(kind).to_bytes(4, "big")))


@F.pandas_udf(T.StringType())
def repository_addresses(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield s.map(repository_address)


@F.pandas_udf(T.StringType())
def public_names(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield s.map(lambda k: bech32("npub", bytes.fromhex(k)) if isinstance(k, str) and len(k) == 64 else None)
