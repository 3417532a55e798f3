"""Fact rows of an app: merging, permissions, CSV text, notes and the security document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Permission -> fact.
PERMISSION_FACTS = {
    "android.permission.read_contacts": "contacts",
    "android.permission.write_contacts": "contacts",
    "android.permission.read_sms": "read_sms",
    "android.permission.receive_sms": "receive_sms",
    "android.permission.send_sms": "send_sms",
    "android.permission.access_coarse_location": "coarse_location",
    "android.permission.access_fine_location": "fine_location",
    "android.permission.camera": "camera",
    "android.permission.record_audio": "microphone",
    "android.permission.read_call_log": "call_log",
    "android.permission.request_install_packages": "request_install_packages",
    "android.permission.query_all_packages": "query_all_packages",
    "android.permission.system_alert_window": "system_alert_window",
    "android.permission.bind_accessibility_service": "accessibility_service",
    "android.permission.bind_notification_listener_service": "notification_listener",
    "android.permission.bind_device_admin": "device_admin",
    "android.permission.bind_vpn_service": "vpn_service",
    "android.permission.bind_input_method": "input_method",
    "android.permission.package_usage_stats": "usage_stats",
}
BACKGROUND = "android.permission.access_background_location"
INTERNET = "android.permission.internet"


def one_per_fact(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per fact from (keys, fact, value, reason, evidence, pos): yes wins, evidence is the sorted union.

    The reason is that of the first yes; where that has none, the first that
    came before it, else the first after. ``pos`` is the fact's first place.
    """
    rows = rows.filter((F.col("fact") != "") & F.col("value").isin("yes", "no"))
    first_yes = F.min(F.when(F.col("value") == "yes", F.col("pos")))
    said = F.collect_list(F.when(F.coalesce(F.col("reason"), F.lit("")) != "", F.struct("pos", "reason", "value")))
    got = rows.groupBy(*keys, "fact").agg(F.max("value").alias("value"), F.min("pos").alias("pos"), first_yes.alias("y"), F.array_sort(said).alias("said"), F.flatten(F.collect_list(F.transform(F.split("evidence", ","), lambda e: F.trim(e)))).alias("ev"))
    own = F.get(F.filter("said", lambda s: s["pos"] == F.col("y")), F.lit(0))["reason"]
    any_ = F.get(F.col("said"), F.lit(0))["reason"]
    return got.select(*keys, "fact", "value", F.coalesce(own, any_, F.lit("")).alias("reason"), F.array_join(F.array_sort(F.array_distinct(F.filter("ev", lambda e: e != ""))), ", ").alias("evidence"), "pos")


def permission_rows(apps: DataFrame, key: str, permissions: str) -> DataFrame:
    """(key, fact, value, evidence): a yes per fact of the permissions asked for, location with its background rider, and offline without INTERNET."""
    asked = F.transform(permissions, lambda p: F.lower(F.trim(p)))
    known = F.create_map(*[F.lit(x) for kv in PERMISSION_FACTS.items() for x in kv])
    named = apps.select(key, asked.alias("ps")).withColumn("back", F.array_contains("ps", BACKGROUND))
    each = named.select(key, "back", F.explode("ps").alias("p")).withColumn("fact", F.try_element_at(known, F.col("p"))).filter("fact IS NOT NULL")
    short = F.upper(F.regexp_replace("p", "^android\\.permission\\.", ""))
    facts = each.groupBy(key, "fact").agg(F.collect_set(short).alias("e"), F.bool_or("back").alias("back"))
    rider = F.when(F.col("back") & F.col("fact").isin("coarse_location", "fine_location"), F.array(F.lit("ACCESS_BACKGROUND_LOCATION"))).otherwise(F.array().cast("array<string>"))
    facts = facts.select(key, "fact", F.lit("yes").alias("value"), F.array_join(F.array_sort(F.array_union("e", rider)), ", ").alias("evidence"))
    offline = named.filter(~F.array_contains("ps", INTERNET)).select(key, F.lit("offline_capable").alias("fact"), F.lit("yes").alias("value"), F.lit("No INTERNET").alias("evidence"))
    return facts.unionByName(offline)


def library_rows(found: DataFrame, key: str) -> DataFrame:
    """(key, fact, value, evidence) from (key, fact, label): names distinct, sorted and joined."""
    return found.groupBy(key, "fact").agg(F.array_join(F.array_sort(F.collect_set("label")), ", ").alias("evidence")).select(key, "fact", F.lit("yes").alias("value"), "evidence")


def csv_line(*columns: Column) -> Column:
    """All fields quoted, quotes doubled."""
    return F.concat_ws(",", *[F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in columns])


def csv_minimal(*columns: Column) -> Column:
    """Only fields with a comma, quote, line end or a leading space are quoted."""
    one = lambda c: F.when(c.rlike('[,"\r\n]|^ '), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    return F.concat_ws(",", *[one(F.coalesce(c, F.lit(""))) for c in columns])


def facts_csv(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, csv): fact, value and note lines in order of ``pos``."""
    line = csv_line(F.col("fact"), F.col("value"), F.concat_ws(". ", F.nullif("evidence", F.lit("")), F.nullif("reason", F.lit(""))))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "fact", line.alias("line")))), lambda s: s["line"]), "\n").alias("csv"))


#: Facts whose no is worth stating.
FALSE_FACTS = ("source_available", "google_services", "offline_capable")


def security_json(rows: DataFrame, keys: list[str], stated: tuple[str, ...] | None = None) -> DataFrame:
    """(keys, json): facts and notes as maps in key order; a no is kept for few facts, notes only with a yes."""
    keep = (F.col("value") == "yes") | F.col("fact").isin(*(stated or FALSE_FACTS))
    noted = (F.col("evidence") != "") & ((F.col("value") == "yes") | (F.col("fact") == "source_available"))
    fact = F.when(keep, F.struct("fact", (F.col("value") == "yes").alias("v")))
    note = F.when(noted, F.struct("fact", F.col("evidence").alias("v")))
    got = rows.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(fact))).alias("facts"), F.map_from_entries(F.array_sort(F.collect_list(note))).alias("notes"))
    return got.select(*keys, F.to_json(F.struct("facts", F.when(F.size("notes") > 0, F.col("notes")).alias("notes"))).alias("json"))


def split_notice(prose: Column) -> Column:
    """Struct (notice, body): parted at a rule line, else at the first empty line, else all body."""
    at = F.when(F.instr(prose, "\n---\n") > 0, F.struct(F.substring_index(prose, "\n---\n", 1).alias("notice"), F.substring(prose, F.instr(prose, "\n---\n") + 5, F.length(prose)).alias("body")))
    blank = F.when(F.instr(prose, "\n\n") > 0, F.struct(F.substring_index(prose, "\n\n", 1).alias("notice"), F.substring(prose, F.instr(prose, "\n\n") + 2, F.length(prose)).alias("body")))
    got = F.coalesce(at, blank, F.struct(F.lit("").alias("notice"), prose.alias("body")))
    return F.struct(F.trim(got["notice"]).alias("notice"), F.trim(got["body"]).alias("body"))
