"""A ledger of quality rules: every rule is evaluated once, its failure is a bit, its measurements stay.

Policies are versioned sets of rules, applied later to the stored bits, and an
ablation asks of each rule what it alone keeps out, from counts per bit mask.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm import text as tx

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower")
#: Signs that count as symbols.
SYMBOLS = "#*$%&|<>"

#: Rule, in the order of its bit (never reorder: stored ledgers hold the bits) -> SQL over MEASURES that is true where the rule fails.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 25 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 50 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "shouting": "n_upper > n_lower",
}
#: Versioned policies: the rules whose failure rejects.
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("few_words", "repeated_windows"),
    "full-1": tuple(RULES),
}
DEFAULT_POLICY = "full-1"


def mask_of(rules: tuple[str, ...]) -> int:
    """The bits of some rules."""
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def _counts(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each row, how many of its bytes have the flag."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]


def _per_row(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n)


def repeated_positions(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """True where the same key occurs again in the same row."""
    order = np.argsort(tx.mix(keys ^ (rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))))
    k, r = keys[order], rows[order]
    same = (k[1:] == k[:-1]) & (r[1:] == r[:-1])
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def measure_rows(data: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """MEASURES of each row, from bytes and offsets."""
    n = len(at) - 1
    starts, ends, first = tx.word_bounds(data, at)
    rows = tx.row_of(first)
    lead = (data & 0xC0) != 0x80
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS.encode())] = True
    out = {"n_words": np.diff(first), "word_chars": _counts(lead & tx.BY_SPACE[data], at), "n_symbols": _counts(symbol[data], at), "n_upper": _counts((data >= 65) & (data <= 90), at), "n_lower": _counts((data >= 97) & (data <= 122), at)}
    values = tx.byte_values(lower=False)
    hashes = tx.span_hashes(data, starts, ends, values)
    runs = tx.run_hashes(hashes, 3)
    whole = np.flatnonzero(rows[: len(runs)] == rows[2:]) if len(runs) else np.zeros(0, np.int64)
    again = whole[repeated_positions(runs[whole], rows[whole])]
    covered = np.zeros(len(starts), bool)
    for k in range(3):
        covered[again + k] = True
    out["n_repeat_words"] = _per_row(rows[covered], n)
    # A line is a run without \n; one counts where it has a word.
    line = np.ones(256, bool)
    line[10] = False
    a, b, lfirst = tx.word_bounds(data, at, line)
    has = np.searchsorted(starts, b) > np.searchsorted(starts, a)
    a, b, lrows = a[has], b[has], tx.row_of(lfirst)[has]
    lh = tx.span_hashes(data, a, b, values)
    order = np.lexsort((lh, lrows))
    later = np.zeros(len(lh), bool)
    later[1:] = (lh[order][1:] == lh[order][:-1]) & (lrows[order][1:] == lrows[order][:-1])
    out["n_lines"] = _per_row(lrows, n)
    out["n_dup_lines"] = _per_row(lrows[order][later], n)
    return out


def measure(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and MEASURES of each whole text; null and empty texts measure 0.

    Works in slices of a few MB; equality of words and lines is that of 64-bit
    hashes within one text.
    """
    keep = tuple(k for k in keep if k not in MEASURES)
    schema = docs.select(*[F.col(f"`{k}`") for k in keep]).schema.simpleString()[7:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, at in tx.slices(batch, "__text"):
                got = measure_rows(data, at)
                yield pa.RecordBatch.from_arrays([*[part.column(k) for k in range(len(keep))], *[pa.array(got[m].astype(np.int64)) for m in MEASURES]], names=[*keep, *MEASURES])

    source = docs.select(*[F.col(f"`{k}`") for k in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    return source.mapInArrow(run, ", ".join([schema, *[f"{m} long" for m in MEASURES]]) if schema else ", ".join(f"{m} long" for m in MEASURES))


def failures() -> Column:
    """The bit mask of the rules that fail, over a row of MEASURES."""
    return F.expr(" + ".join(f"CASE WHEN {rule} THEN {1 << k}L ELSE 0L END" for k, rule in enumerate(RULES.values())))


def ledger(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``measure`` with ``failed``: one bit per rule. Every row of ``docs`` is in it, repeated ones as often."""
    return measure(docs, text, keep).withColumn("failed", failures())


def verdict(policy: str = DEFAULT_POLICY) -> Column:
    """True where no rule of the policy fails, over a row of a ledger."""
    return F.col("failed").bitwiseAND(F.lit(mask_of(POLICIES[policy]))) == 0


def ablation(book: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """Per rule of the policy: rows failing it, rows that it alone rejects, rows kept with and without it.

    Rows are first counted per bit mask, at most 2^rules groups whatever the
    table's size; the rest is bit arithmetic on those. An empty ledger gives no rows.
    """
    mask = mask_of(POLICIES[policy])
    masks = book.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("f")).agg(F.count(F.lit(1)).alias("n"))
    names = list(RULES)
    per = masks.withColumn("rule", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit")) for r in POLICIES[policy]])))
    bit = F.col("rule.bit")
    fails, alone, kept = F.col("f").bitwiseAND(bit) != 0, F.col("f") == bit, F.col("f") == 0
    total = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return per.groupBy(F.col("rule.rule").alias("rule")).agg(total(fails).alias("failing"), total(alone).alias("rejected_alone"), total(kept).alias("kept"), total(kept | alone).alias("kept_without"), F.bit_or("f").alias("masks_seen"))
