"""Secret scans weighed by corpus-wide ownership of each candidate.

Candidates are found by pattern in whole texts, and values that some text gives
away are then looked up as bare tokens in all of them. Their hashes are counted
over the corpus by distinct repositories and distinct owners: a value that many
owners or repositories copy is an example, one that stays with a single owner
and few repositories looks live.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm import text as tx
from shelfspark.plans.lineage import cut

#: Kind -> (pattern, group with the value, fewest signs of that group). Fixed values; kinds sort in this order.
KINDS: dict[str, tuple[re.Pattern, int, int]] = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]{24,}"), 0, 24),
}
#: Further kinds of the method, beside those of the contract; they sort after them. Fixed values.
MORE: dict[str, tuple[re.Pattern, int, int]] = {
    "block": (re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----\s*([A-Za-z0-9+/=\s]+)"), 1, 16),
    "prefixed": (re.compile(r"(?<![A-Za-z0-9_])(?:ghp_|gho_|ghs_|glpat-|sk_live_|sk-|xox[abp]-|AIza)[A-Za-z0-9_-]+"), 0, 20),
    "login": (re.compile(r"[a-z][a-z0-9+.-]{1,30}://[^\s:/@]{1,200}:([^\s:/@]+)@"), 1, 4),
}
#: Bare tokens that can be a value known from elsewhere: of so many signs, a letter beside a digit among them.
BARE, LEAST_BARE = re.compile(r"[A-Za-z0-9+/_.=-]+"), 8
_MIXED = re.compile(r"[A-Za-z][0-9]|[0-9][A-Za-z]")
#: The kind of such a token once a text gives it away; it sorts last.
KNOWN = "known"
ORDER = (*KINDS, *MORE, KNOWN)
#: Texts that these patterns (RE2, run over a whole Arrow batch) miss hold no candidate, and no bare token.
MAYBE = r"(?i)password|passwd|secret|token|api_?key|akia|[0-9a-f]{24}|private key-----|gh[pos]_|glpat-|sk[-_]|xox[abp]-|aiza|://"
MAYBE_BARE = "[A-Za-z][0-9]|[0-9][A-Za-z]"
#: Owners from which on a value counts as copied widely.
WIDE_OWNERS = 3
#: Repositories from which on a value counts as copied widely, even if one owner has them all.
WIDE_REPOSITORIES = 10
#: Values of fewer different signs are fillers, whoever has them.
FEW_SIGNS = 4


def find(text: str, kinds: dict[str, tuple[re.Pattern, int, int]] = KINDS) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) by start, then kind; positions in code points, leftmost and non-overlapping per kind."""
    found = []
    for rank, (kind, (pattern, group, least)) in enumerate(kinds.items()):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), rank, kind, m.end(), m.group(group)))
    return [(kind, start, end, value) for start, _, kind, end, value in sorted(found)]


def bare_tokens(text: str) -> list[tuple[int, int, str]]:
    """(start, end, value) of tokens that may be a value that some text gives away; full stops at the end are the sentence's."""
    out = []
    for m in BARE.finditer(text):
        value = m.group().rstrip(".")
        if len(value) >= LEAST_BARE and _MIXED.search(value):
            out.append((m.start(), m.start() + len(value), value))
    return out


def plain(value: str) -> str:
    """A value without the full stops of the sentence that it ends; spans keep them."""
    return value.rstrip(".") or value


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value_sha", pa.string()), ("signs", pa.int32())])
_SPANS = "array<struct<kind:string,start:int,end:int,value_sha:string,signs:int>>"


def _span(kind: str, start: int, end: int, value: str) -> dict:
    value = plain(value)
    return {"kind": kind, "start": start, "end": end, "value_sha": hashlib.sha256(value.encode()).hexdigest(), "signs": len(set(value))}


def _scan(keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = tx.as_array(batch.column(keep))
            hits = lambda p: pc.indices_nonzero(pc.fill_null(pc.match_substring_regex(texts, p), False)).to_pylist()  # noqa: B023, E731
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            bare: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for k in hits(MAYBE):
                spans[k] = [_span(*s) for s in find(texts[k].as_py(), KINDS | MORE)]
            for k in hits(MAYBE_BARE):
                taken = {(s["start"], s["end"]) for s in spans[k]}
                bare[k] = [_span(KNOWN, *s) for s in bare_tokens(texts[k].as_py()) if s[:2] not in taken]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(keep)], pa.array(spans, pa.list_(_SPAN)), pa.array(bare, pa.list_(_SPAN))], names=[*batch.schema.names[:keep], "secrets", "bare"])

    return run


def find_secrets(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``secrets`` and ``bare`` (kind, start, end, value_sha, signs) of each row.

    Null texts are empty; texts of any length are read whole. Values leave the
    row only as hashes. Columns of ``keep`` called ``secrets`` or ``bare`` are
    replaced, other columns go. An empty table gives no rows.
    """
    source = docs.select(*[F.col(f"`{k}`") for k in keep if k not in ("secrets", "bare")], F.col(f"`{text}`").cast("string").alias("__text"))
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    return source.mapInArrow(_scan(len(schema)), ", ".join([*schema, f"secrets {_SPANS}", f"bare {_SPANS}"]))


def ownership(found: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """Per value_sha: repositories and owners that have it, signs, and verdict.

    Distinct counting goes in two steps, first to (value, owner) and (value,
    repository), so a value that a third of the corpus holds is summed where it
    is read. Verdicts: ``filler`` (hardly any different signs), ``example``
    (WIDE_OWNERS or more, or WIDE_REPOSITORIES or more whoever owns them),
    ``shared`` (in between), ``live`` (a single owner, few repositories).
    Null owners are one owner, null repositories one repository.
    """
    each = found.select(F.col(repository).cast("string").alias("repository"), F.col(owner).cast("string").alias("owner"), F.explode("secrets").alias("s"))
    pairs = each.select(F.col("s.value_sha").alias("value_sha"), F.col("s.signs").alias("signs"), "repository", "owner")
    by_owner = pairs.groupBy("value_sha", "signs", "owner").agg(F.count(F.lit(1)).alias("n")).groupBy("value_sha", "signs").agg(F.count(F.lit(1)).alias("owners"), F.sum("n").alias("copies"))
    by_repository = pairs.groupBy("value_sha", "repository").agg(F.lit(1).alias("one")).groupBy(F.col("value_sha").alias("v")).agg(F.count(F.lit(1)).alias("repositories"))
    verdict = F.when(F.col("signs") < FEW_SIGNS, "filler").when((F.col("owners") >= WIDE_OWNERS) | (F.col("repositories") >= WIDE_REPOSITORIES), "example").when(F.col("owners") > 1, "shared").otherwise("live")
    return by_owner.join(by_repository, F.col("value_sha") == F.col("v")).select("value_sha", "owners", "repositories", "copies", verdict.alias("verdict"))


def _known_bare(found: DataFrame) -> DataFrame:
    """(row_sha, added): the bare tokens of a row whose value some text gives away as a secret and that lie in none of the row's spans."""
    known = found.select(F.explode("secrets.value_sha").alias("value_sha")).distinct()
    tokens = found.filter(F.size("bare") > 0).select("row_sha", F.col("secrets").alias("s"), F.explode("bare").alias("b")).select("row_sha", "b", F.exists("s", lambda s: (s["start"] <= F.col("b.start")) & (s["end"] >= F.col("b.end"))).alias("inside"))
    tokens = tokens.filter("NOT inside").select("row_sha", "b", F.col("b.value_sha").alias("value_sha")).distinct()
    return tokens.join(known, "value_sha", "left_semi").groupBy(F.col("row_sha").alias("r")).agg(F.collect_list("b").alias("added"))


def scan_secrets(docs: DataFrame, text: str = "text", key: str = "doc_id", owner: str = "source") -> DataFrame:
    """Per row of ``docs``: key, secrets, n_live, n_shared, n_example, n_filler.

    ``secrets`` has the spans of KINDS, of MORE, and bare tokens equal to a value
    that any text gives away (KNOWN), by start and kind. Texts are read once;
    the spans found are cut to a narrow table, tokens meet known values by
    hash, and verdicts come back to rows by value hash. Rows that are equal in
    key, owner and spans get equal counts, each its own row. Rows without
    candidates, null and empty texts have an empty list and zeros; texts of any
    length are read whole, and an empty table gives no rows. Other columns of
    ``docs`` are not looked at.
    """
    found = cut(find_secrets(docs.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{owner}`").cast("string").alias("__owner"), F.col(f"`{text}`").alias("text")), "text", ("__key", "__owner")).withColumn("row_sha", F.sha2(F.to_json(F.struct("__key", "__owner", "secrets", "bare")), 256)), "secrets")
    rank = F.create_map(*[x for k, kind in enumerate(ORDER) for x in (F.lit(kind), F.lit(k))])
    ordered = F.array_sort(F.transform(F.concat("secrets", F.coalesce("added", F.array().cast(_SPANS))), lambda s: F.struct(s["start"].alias("start"), F.element_at(rank, s["kind"]).alias("rank"), s["end"].alias("end"), s.alias("s"))))
    all_ = found.join(_known_bare(found), F.col("row_sha") == F.col("r"), "left").select("__key", "__owner", "row_sha", F.transform(ordered, lambda o: o["s"]).alias("secrets"))
    all_ = cut(all_, "secrets-all")
    some = all_.filter(F.size("secrets") > 0)
    verdicts = ownership(some, "__key", "__owner").select(F.col("value_sha").alias("v"), "verdict")
    values = some.select("row_sha", F.explode("secrets").alias("s")).select("row_sha", F.struct("s.kind", "s.start", "s.end").alias("span"), F.col("s.value_sha").alias("value_sha")).distinct()
    count = lambda v: F.sum(F.when(F.col("verdict") == v, 1).otherwise(0)).cast("long").alias(f"n_{v}")
    per_row = values.join(verdicts, F.col("value_sha") == F.col("v")).groupBy(F.col("row_sha").alias("r")).agg(*[count(v) for v in ("live", "shared", "example", "filler")])
    none = all_.filter(F.size("secrets") == 0).select("__key", "secrets", *[F.lit(0).cast("long").alias(f"n_{v}") for v in ("live", "shared", "example", "filler")])
    rows = none.unionByName(some.join(per_row, F.col("row_sha") == F.col("r")).select("__key", "secrets", "n_live", "n_shared", "n_example", "n_filler"))
    return rows.withColumnRenamed("__key", key)
