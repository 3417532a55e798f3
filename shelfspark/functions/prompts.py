"""Messages to a model: what is asked, and the record of a listing, a scan and its source, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfspark.functions import text as tx

ABOUT = """You decide what an app's page says about it. You get the listing, the description offered to keep, other words of the developer, and the readme.
Reply with one JSON object: {"verdict": "keep or write, and why", "about": "", "keywords": [], "queries": []}.
Keep the description if it says plainly what the app does. Otherwise write 100 to 300 characters of plain English in the developer's words: no name of the app, no praise, no other build or store.
Keywords: at most eight, one to three small words each. Queries: five to ten, two to six small words each, as someone would search without knowing the name."""
SECURITY = """You write a short note on what an app can reach and where data goes. You get the current note, the scan, the listing and quotes from the source.
Reply with one JSON object: {"security": "", "facts": ""}. Facts is CSV, a row per scanned fact: fact, value, note.
If a tracker, an ad library or an access without a shown use is there, begin with one sentence of warning and an empty line. Say only what the scan or the quotes show, in everyday words, under 500 characters. Write no-change if the current note still holds."""
NO_DESCRIPTION = "none: the listing description is empty, too short, too long, or not English. Write the about.\n"
NO_NOTE = "security: write the summary. no-change is invalid.\n"
EMPTY_SHEET = '"fact","value","notes"\n'


def _trimmed(x: Column) -> Column:
    return F.trim(F.coalesce(x, F.lit("")))


def _when_any(x: Column, *parts: Column | str) -> Column:
    """The parts, joined, if the trimmed text isn't empty."""
    return F.when(_trimmed(x) != "", F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])).otherwise("")


def listing_text(app: dict[str, Column], most: int, tags: bool) -> Column:
    """A listing as text: name or id, summary, content of ``most`` bytes, then its lines."""
    name = F.coalesce(F.nullif(_trimmed(app["name"]), F.lit("")), _trimmed(app["id"]))
    line = lambda label, x: _when_any(x, f"{label}: ", _trimmed(x), "\n")
    shown = [_when_any(name, "# ", name, "\n"), _when_any(app["summary"], "\n", _trimmed(app["summary"]), "\n"), _when_any(app["content"], "\n", tx.clip_bytes(_trimmed(app["content"]), most), "\n")]
    if tags:
        shown.append(line("Tags", F.array_join(app["tags"], ", ")))
    return F.concat(*shown, line("Website", app["website"]), line("License", app["license"]), line("Repository", app["repository"]))


def _parts(*parts: tuple[str, Column]) -> Column:
    """Labelled parts, those that are not empty, with a rule line between."""
    shown = [F.when(body != "", F.concat(F.lit(label), body)) for label, body in parts]
    return F.array_join(F.array_compact(F.array(*shown)), "---\n")


def about_record(app: dict[str, Column], description: Column, others: Column, readme: Column, most: int = 6000) -> Column:
    """What the model gets for an about text; ``others`` is an array of (source, text)."""
    offered = F.when(_trimmed(description) != "", F.concat(tx.one_line(description), F.lit("\n"))).otherwise(NO_DESCRIPTION)
    more = F.array_join(F.transform(F.filter(others, lambda o: F.trim(o["text"]) != ""), lambda o: F.concat(o["source"], F.lit(": "), tx.one_line(o["text"]), F.lit("\n"))), "")
    return _parts(("Listing:\n", listing_text(app, most, True)), ("Description:\n", offered), ("Other developer text:\n", more), ("README:\n", _when_any(readme, _trimmed(readme), "\n")))


def security_record(app: dict[str, Column], current: Column, sheet: Column, source: Column, most: int = 1500) -> Column:
    """What the model gets for a security note."""
    now = F.when(_trimmed(current) != "", F.concat(F.lit("Current:\n"), F.to_json(F.struct(_trimmed(current).alias("security"))), F.lit("\n"))).otherwise(NO_NOTE)
    return _parts(("", now), ("Scan:\n", F.when(F.coalesce(sheet, F.lit("")) != "", sheet).otherwise(EMPTY_SHEET)), ("Listing:\n", listing_text(app, most, False)), ("Source:\n", _when_any(source, _trimmed(source), "\n")))


def messages(system: str, user: Column) -> Column:
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.array(turn("system", F.lit(system)), turn("user", user))
