"""Libraries, permissions and strings of packages: detection by class paths and rules, labels, inventories, the language of an app's own text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions import arrow_text
from shelfspark.functions import text as tx
from shelfspark.operators import digest, joins

# Permissions that are dangerous, without their prefix.
DANGEROUS = "ACCESS_COARSE_LOCATION ACCESS_FINE_LOCATION ACCESS_BACKGROUND_LOCATION CAMERA RECORD_AUDIO READ_CONTACTS WRITE_CONTACTS GET_ACCOUNTS READ_CALENDAR WRITE_CALENDAR SEND_SMS RECEIVE_SMS READ_SMS RECEIVE_MMS RECEIVE_WAP_PUSH READ_CALL_LOG WRITE_CALL_LOG CALL_PHONE READ_PHONE_STATE READ_PHONE_NUMBERS ANSWER_PHONE_CALLS ADD_VOICEMAIL USE_SIP BODY_SENSORS ACTIVITY_RECOGNITION READ_EXTERNAL_STORAGE WRITE_EXTERNAL_STORAGE ACCESS_MEDIA_LOCATION READ_MEDIA_IMAGES READ_MEDIA_VIDEO READ_MEDIA_AUDIO POST_NOTIFICATIONS BLUETOOTH_CONNECT BLUETOOTH_SCAN NEARBY_WIFI_DEVICES QUERY_ALL_PACKAGES REQUEST_INSTALL_PACKAGES".split()
PREFIX = "android.permission."
# Native libraries that are known by name, class paths that only look like a tracker's, types that say nothing.
NATIVE = {"libflutter.so": ("Flutter", "Development Framework"), "libreactnativejni.so": ("React Native", "Development Framework"), "libhermes.so": ("Hermes", "Development Framework"), "libsqlcipher.so": ("SQLCipher", "Utility")}
STUBS = ("/com/google/firebase/analytics/connector",)
BLAND = ("utility", "ui component", "development framework")
MOST_COMPONENTS = 20
# String resources that come with common libraries.
LIBRARY_PREFIXES = (
    "abc_", "mtrl_", "m3_", "m3c_", "material_", "androidx_", "exo_", "common_google_play_services_",
    "fcm_", "call_notification_", "bottomsheet_", "bottom_sheet_", "character_counter_",
    "clear_text_end_icon_", "error_icon_", "exposed_dropdown_menu_", "fab_transformation_",
    "hide_bottom_view_", "password_toggle_", "path_password_", "side_sheet_",
    "searchbar_", "searchview_", "fallback_menu_item_", "v7_preference_", "tooltip_",
    "nav_app_bar_", "gcm_", "firebase_", "leak_canary_", "com.", "androidx.", "bottom_navigation_",
    "time_picker_", "date_picker_", "date_range_picker_", "search_bar_", "snackbar_",
)
LIBRARY_KEYS = (
    "icon_content_description", "item_view_role_description",
    "appbar_scrolling_view_behavior", "status_bar_notification_info_overflow",
    "search_menu_title", "preference_copied", "summary_collapsed_preference_list",
    "expand_button_title", "copy_toast_msg", "not_set", "copy",
    "default_web_client_id", "google_api_key", "google_app_id",
    "google_crash_reporting_api_key", "google_storage_bucket", "project_id",
    "close_drawer", "close_sheet", "default_popup_window_title",
    "dialog", "dropdown_menu", "in_progress", "indeterminate",
    "navigation_menu", "off", "on", "range_end", "range_start",
    "selected", "switch_role", "tab", "template_percent",
    "state_empty", "state_off", "state_on", "not_selected",
    "autofill", "chip_text",
)
_TEXTS = "array<string>"


def dangerous(permissions: Column) -> Column:
    """Dangerous permissions, each once, without their prefix."""
    full = [PREFIX + p for p in DANGEROUS]
    return F.array_distinct(F.transform(F.filter(permissions, lambda p: p.isin(*full)), lambda p: F.substring(p, len(PREFIX) + 1, 1 << 16)))


def dotted_path(name: Column) -> Column:
    """``/a/b`` of a.b; empty for a reference to a resource."""
    n = F.trim(name)
    return F.when((n == "") | n.startswith("@"), "").otherwise(F.concat(F.lit("/"), F.replace(n, F.lit("."), F.lit("/"))))


def signature_path(code: Column) -> Column:
    """The path that a tracker's signature begins with; empty if it is a pattern."""
    c = F.replace(F.rtrim(F.substring_index(code, "|", 1), F.lit(".")), F.lit("\\."), F.lit("."))
    return F.when((c == "") | c.rlike(r"[\[\]()?*+]"), "").otherwise(F.concat(F.lit("/"), F.replace(c, F.lit("."), F.lit("/"))))


def descriptor_path(descriptor: Column) -> Column:
    """``/a/b/C`` of the descriptor La/b/C;, inner classes without what follows the first $."""
    return F.concat(F.lit("/"), F.regexp_extract(descriptor, r"^L([^;$]+)", 1))


def tracker_anti(categories: Column) -> Column:
    """Anti-features of a tracker's categories, each once, in order."""
    one = F.transform(categories, lambda c: F.when(F.lower(c) == "advertisement", "Ads").when(F.lower(c).isin("analytics", "identification", "profiling", "location"), "Tracking"))
    return F.array_distinct(F.array_compact(one))


def tracker_type(categories: Column) -> Column:
    return F.coalesce(F.get(categories, F.lit(0)), F.lit("Tracker"))


def is_stub(path: Column) -> Column:
    out = F.lit(False)
    for s in STUBS:
        out = out | (path == s) | path.startswith(s + "/")
    return out


def tracker_hits(classes: DataFrame, rules: list[tuple[str, str]], app: str = "app_id") -> DataFrame:
    """(app, rule): trackers by the first rule, in order of name, that finds a class; ``rules`` are (name, RE2 pattern over dotted names), stubs don't count."""
    some = classes.filter(~is_stub(F.col("path"))).select(app, F.replace(F.regexp_replace("path", "^/", ""), F.lit("/"), F.lit(".")).alias("dotted"))
    return some.select(app, arrow_text.first_match(F.col("dotted"), rules).alias("rule")).filter("rule IS NOT NULL").distinct()


def overlapping(found: DataFrame, signatures: DataFrame, app: str = "app_id") -> DataFrame:
    """(app, rule, id): for each tracker of an app (app, rule, path) the library (app, id, path) whose path holds or is held by the signature's.

    Both directions are equality joins over ancestors. Of several the shortest
    path wins, then the first id.
    """
    up = signatures.select(app, "rule", F.explode(joins.ancestors(F.col("path"))).alias("p")).filter("p <> ''").join(found.select(app, "id", F.col("path").alias("p"), F.col("path").alias("own")), [app, "p"])
    down = found.select(app, "id", F.col("path").alias("own"), F.explode(joins.ancestors(F.col("path"))).alias("p")).filter("p <> ''").join(signatures.select(app, "rule", F.col("path").alias("p")), [app, "p"])
    both = up.select(app, "rule", "id", "own").unionByName(down.select(app, "rule", "id", "own"))
    return both.groupBy(app, "rule").agg(F.min(F.struct(F.length("own").alias("n"), "id")).alias("b")).select(app, "rule", F.col("b.id").alias("id"))


def native_libraries(names: DataFrame, app: str = "app_id") -> DataFrame:
    """(app, id, name, type) of native libraries that are known by their file name."""
    known = names.sparkSession.createDataFrame([(so, n, t) for so, (n, t) in NATIVE.items()], "so string, name string, type string")
    return names.join(F.broadcast(known), F.col("file") == F.col("so")).select(app, F.col("name").alias("id"), "name", "type").distinct()  # a fixed table of four rows


def report(libraries: DataFrame, app: str = "app_id") -> DataFrame:
    """(app, library_count, names, anti): of all libraries (app, id, name, type, path, emphasize, anti) their number, the notable ones by name and their anti-features."""
    n = libraries.groupBy(app).agg(F.count_distinct("id").alias("library_count"))
    some = digest.notable(libraries).groupBy(F.col(app).alias("__app")).agg(F.transform(F.array_sort(F.collect_list(F.struct("name", "id"))), lambda s: s["name"]).alias("names"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("anti")))).alias("anti"))
    none = F.array().cast(_TEXTS)
    return n.join(some, F.col(app) == F.col("__app"), "left").select(app, "library_count", F.coalesce("names", none).alias("names"), F.coalesce("anti", none).alias("anti"))


def library_label(name: Column, id_: Column, kind: Column, anti: Column) -> Column:
    """Name, with type and anti-features where they say what happens to data; null for frameworks and what has no name."""
    own = F.coalesce(F.nullif(F.trim(name), F.lit("")), F.nullif(F.trim(id_), F.lit("")))
    type_ = F.trim(F.coalesce(kind, F.lit("")))
    tags = F.concat(F.when((type_ == "") | F.lower(type_).isin(*BLAND), F.array().cast(_TEXTS)).otherwise(F.array(type_)), F.filter(F.transform(F.array_distinct(anti), lambda a: F.trim(a)), lambda a: a != ""))
    return F.when(F.lower(type_) != "development framework", F.when(F.size(tags) == 0, own).otherwise(F.concat(own, F.lit(" ("), F.array_join(tags, ", "), F.lit(")"))))


def inventory(package: Column, native: Column, labels: Column, hosts: Column, permissions: Column, components: Column) -> Column:
    """A package's inventory as text: a line per kind, sorted, distinct, no empty ones."""

    def line(label: str, items: Column, most: int | None = None) -> Column:
        kept = F.array_sort(F.array_distinct(F.filter(items, lambda x: x != "")))
        kept = kept if most is None else F.slice(kept, 1, most)
        return F.when(F.size(kept) > 0, F.concat(F.lit(f"{label}: "), F.array_join(kept, ", ")))

    short = F.transform(permissions, lambda p: F.regexp_replace(p, r"^android\.permission\.", ""))
    parts = F.array(F.when(F.trim(package) != "", F.concat(F.lit("package: "), F.trim(package))), line("native", native), line("libraries", F.array_compact(labels)), line("hosts", hosts), line("permissions", short), line("components", components, MOST_COMPONENTS))
    return F.array_join(F.array_compact(parts), "\n")


def own_key(key: Column) -> Column:
    """Is a string resource the app's own?"""
    prefixes = "|".join(p.replace(".", r"\.") for p in LIBRARY_PREFIXES)
    return ~key.isin(*LIBRARY_KEYS) & ~key.rlike(f"^(?:{prefixes})")


def english_strings(strings: DataFrame, app: str = "app_id") -> DataFrame:
    """(app, english): do an app's own strings (app, lang, name, value; lang empty for the default) read as English, or are half of them translated to it? Null where too few say."""
    own = strings.filter(own_key(F.col("name")))
    phrase = F.size(tx.fields(F.col("value"))) >= 3
    g = own.groupBy(app).agg(F.collect_list(F.when((F.col("lang") == "") & phrase, F.col("value"))).alias("phrases"), F.count_distinct(F.when(F.col("lang") == "", F.col("name"))).alias("n"), F.count_distinct(F.when(F.col("lang") == "en", F.col("name"))).alias("en"))
    reads = tx.english_ui(F.col("phrases"))
    return g.withColumn("__reads", reads).select(app, F.when(F.col("__reads").isNull(), None).when(F.col("__reads"), True).otherwise(F.col("en") * 2 >= F.col("n")).alias("english"))
