"""Chat formatting in budgeted windows of whole turns.

Prefix sums over the tokens of turns choose spans that end where a turn ends.
Each window says the system turn again, repeats some of the turns before it and
goes on with new ones; only assistant turns that are new bear loss, so every
target is learnt once. Turns are marked, and what looks like a mark inside a text
is escaped so that reading a window back gives the very text.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.plans.lineage import cut

BUDGET, HISTORY, HISTORY_TURNS = 1024, 256, 8
#: Turns are formatted in blocks of so many turn numbers, which bounds what a task holds of a conversation.
BLOCK_TURNS = 256
#: Rows without conversation or turn number are dealt to so many blocks of their own.
LOOSE_BLOCKS = 4096
#: A token is taken to be so many bytes, and the marks of a turn so many tokens.
TOKEN_BYTES, MARK_TOKENS = 4, 4

OPEN, SHUT = "<turn ", "</turn>\n"


def escape(text: str) -> str:
    """``text`` without the strings that marks begin with; ``unescape`` gives it back."""
    return text.replace("\\", "\\\\").replace("<turn", "<\\turn").replace("</turn", "</\\turn")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: ">" if m[1] == "g" else m[1], text, flags=re.S)


def mark(role: str, text: str) -> tuple[str, str, str]:
    """A turn as its opening mark, escaped text and closing mark."""
    return OPEN + escape(role).replace(">", "\\g") + ">\n", escape(text), SHUT


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a window."""
    turns, at = [], 0
    while at < len(formatted):
        body = formatted.index(">\n", at) + 2
        end = formatted.index(SHUT, body)
        turns.append((unescape(formatted[at + len(OPEN) : body - 2]), unescape(formatted[body:end])))
        at = end + len(SHUT)
    return turns


def spans(tokens: list[int], known: int, first: bool, system: int | None, budget: int, history: int, history_turns: int) -> Iterator[tuple[int, int, int]]:
    """(history begin, new begin, new end) of each window over the turns from ``known`` on.

    ``system`` has the tokens of the conversation's system turn; with ``first``
    it is turn 0 itself and said again in all windows but the first. Repeated
    turns are the nearest ones of ``history`` tokens and ``history_turns`` turns
    at most; new turns fill the rest of the budget, one at least, for which
    repeated ones give way.
    """
    at = [0, *accumulate(tokens)]
    floor = 1 if first and system is not None else 0
    lo = known
    while lo < len(tokens):
        room = budget - (system or 0) * (not first or lo > 0)
        begin = max(lo - history_turns, min(floor, lo))
        while begin < lo and at[lo] - at[begin] > min(history, room):
            begin += 1
        hi = max(lo + 1, bisect_right(at, at[begin] + room) - 1)
        while begin < lo and at[hi] - at[begin] > room:
            begin += 1
        yield begin, lo, hi
        lo = hi


def _write(budget: int, history: int, history_turns: int, target: str):
    layout = pa.schema([("n", pa.int32()), ("formatted", pa.string()), ("loss", pa.list_(pa.struct([("begin", pa.int32()), ("stop", pa.int32())]))), ("n_turns", pa.int32()), ("n_repeated", pa.int32()), ("n_tokens", pa.int64()), ("over_budget", pa.bool_())])

    def windows(turns: list[dict], before: list[dict], system: dict | None, first: bool) -> Iterator[dict]:
        if first:
            system = turns[0] if turns[0]["role"] == "system" else None
        everything = [*before, *turns]
        tokens = [t["tokens"] for t in everything]
        for n, (begin, lo, hi) in enumerate(spans(tokens, len(before), first, system and system["tokens"], budget, history, history_turns)):
            again = [system] if system and not (first and lo == 0) else []
            shown, out, loss, chars = [*again, *everything[begin:hi]], [], [], 0
            repeated = len(shown) - (hi - lo)
            for k, t in enumerate(shown):
                opened, text, shut = mark(t["role"], t["text"])
                if k >= repeated and t["role"] == target:
                    loss.append({"begin": chars + len(opened), "stop": chars + len(opened) + len(text)})
                out += [opened, text, shut]
                chars += len(opened) + len(text) + len(shut)
            used = sum(t["tokens"] for t in shown)
            yield {"n": n, "formatted": "".join(out), "loss": loss, "n_turns": hi - lo, "n_repeated": repeated, "n_tokens": used, "over_budget": used > budget}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [batch.schema.get_field_index(c) for c in ("conv", "block")]
            for k in range(batch.num_rows):  # a block at a time: its windows are a batch of their own
                row = batch.slice(k, 1)
                r = row.to_pylist()[0]
                made = pa.RecordBatch.from_pylist(list(windows(r["turns"], r["before"] or [], r["system"], r["first"])), schema=layout)
                yield pa.RecordBatch.from_arrays([*[row.column(c).take(pa.array([0] * made.num_rows)) for c in keep], *made.columns], names=["conv", "block", *layout.names])

    return run


_BLOCK = "struct<part: long, turn: long, loose: int>"


def turn_tokens(role: Column, text: Column) -> Column:
    """Tokens of a formatted turn, by bytes: no tokenizer is loaded; callers pass counts of their own in a column."""
    return F.ceil((F.octet_length(text) + F.octet_length(role)) / TOKEN_BYTES).cast("long") + MARK_TOKENS


def format_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, history_turns: int = HISTORY_TURNS, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", tokens: str | None = None, target: str = "assistant", block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Windows of all conversations: (conv, block, n) in order, formatted, loss, n_turns, n_repeated, n_tokens, over_budget.

    The rows of a conversation go by turn number, ties by role and text, rows
    without a number first. Null role and text are empty; rows without a
    conversation are one conversation of their own. ``tokens`` names a column
    with the tokens of a turn; without, ``turn_tokens`` estimates them by bytes.
    A first turn of role ``system`` is said again in every window. ``loss`` has
    the code points of ``formatted`` that are learnt: the escaped texts of
    ``target`` turns that are new in the window. A window takes ``budget``
    tokens at most, unless one turn and the system turn take more
    (``over_budget``). Repeated rows are turns of their own, texts of any
    length stay whole, an empty table gives no rows, and other columns, whatever
    they are called, are not looked at.

    A conversation is formatted in blocks of ``block_turns`` turn numbers, each
    with the last turns of the block before it; so one that holds a third of all
    rows spreads over many tasks, and windows end where blocks end. Rows without
    a conversation or a number are dealt by hash, still in order of turn, so
    that many of them don't meet in one block. Only conversations of several
    blocks are read again for those turns.
    """
    number = F.col(f"`{turn}`").cast("long")
    said = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    n = F.col(f"`{tokens}`").cast("long") if tokens else turn_tokens(*said)
    rows = turns.select(F.col(f"`{conv}`").alias("conv"), number.alias("turn"), *said, n.alias("tokens"))
    loose = F.col("conv").isNull() | F.col("turn").isNull()
    block = F.struct(F.floor(F.col("turn") / block_turns).alias("part"), F.when(loose, F.col("turn")).alias("turn"), F.when(loose, F.pmod(F.xxhash64("role", "text"), F.lit(LOOSE_BLOCKS)).cast("int")).alias("loose"))
    rows = rows.withColumn("block", block.cast(_BLOCK))
    along = Window.partitionBy("conv").orderBy("block")
    chain = rows.select("conv", "block").distinct().select("conv", "block", F.lead("block").over(along).alias("next"), F.row_number().over(along).alias("nth")).filter("nth > 1 OR next IS NOT NULL")
    chain = cut(chain, "chat-chain")  # a row per block of long conversations; its size is known before texts are joined
    turn_ = F.struct("turn", "role", "text", "tokens")
    chained = rows.join(chain.select(F.col("conv").alias("__c"), F.col("block").alias("__b"), "next", "nth"), F.col("conv").eqNullSafe(F.col("__c")) & (F.col("block") == F.col("__b")))
    tails = chained.filter("next IS NOT NULL").groupBy(F.col("conv").alias("tail_conv"), F.col("next").alias("tail_block")).agg(F.sort_array(F.collect_list(turn_)).alias("t"))
    tails = tails.select("tail_conv", "tail_block", F.slice("t", F.greatest(F.size("t") - history_turns + 1, F.lit(1)), history_turns).alias("before") if history_turns else F.slice("t", 1, 0).alias("before"))
    systems = chained.filter("nth = 1").groupBy(F.col("conv").alias("system_conv")).agg(F.min(turn_).alias("system")).filter("system.role = 'system'")
    tails, systems = cut(tails, "chat-tails"), cut(systems, "chat-systems")
    blocks = rows.groupBy("conv", "block").agg(F.sort_array(F.collect_list(turn_)).alias("turns"))
    full = blocks.join(tails, F.col("conv").eqNullSafe(F.col("tail_conv")) & (F.col("block") == F.col("tail_block")), "left").join(systems, F.col("conv").eqNullSafe(F.col("system_conv")), "left")
    full = full.select("conv", "block", "turns", "before", "system", F.col("before").isNull().alias("first"))
    kind = rows.schema["conv"].dataType.simpleString()
    return full.mapInArrow(_write(budget, history, history_turns, target), f"conv {kind}, block {_BLOCK}, n int, formatted string, loss array<struct<begin: int, stop: int>>, n_turns int, n_repeated int, n_tokens long, over_budget boolean")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [batch.schema.get_field_index(c) for c in ("conv", "block", "n")]
        said, learnt = [], []
        for r in batch.select(["formatted", "loss", "n_repeated"]).to_pylist():
            said.append([{"role": role, "text": text} for role, text in parse(r["formatted"])[r["n_repeated"] :]])
            learnt.append([unescape(r["formatted"][x["begin"] : x["stop"]]) for x in r["loss"]])
        yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], pa.array(said, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))), pa.array(learnt, pa.list_(pa.string()))], names=["conv", "block", "n", "turns", "learnt"])


def read_windows(windows: DataFrame) -> DataFrame:
    """(conv, block, n, turns, learnt) from windows as written: the new turns of each, and its texts under the loss mask, unescaped."""
    kind = windows.schema["conv"].dataType.simpleString()
    return windows.select("conv", "block", "n", "formatted", "loss", "n_repeated").mapInArrow(_read, f"conv {kind}, block {_BLOCK}, n int, turns array<struct<role: string, text: string>>, learnt array<string>")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose windows come one after another; hash states are all that is held."""
    key, state = (), None

    def told() -> pa.RecordBatch:
        turns, n, loss, n_loss, chars = state
        return pa.RecordBatch.from_arrays([pa.array([key[0]], kind), *[pa.array([x]) for x in (n, turns.hexdigest(), n_loss, loss.hexdigest(), chars)]], names=["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    for batch in batches:
        kind = batch.column(0).type
        for conv, formatted, loss, repeated in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if state is None or (conv,) != key:
                if state is not None:
                    yield told()
                key, state = (conv,), [hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            said = parse(formatted)[repeated:]
            state[0].update("".join(f"{role}\n{text}\n" for role, text in said).encode())
            state[1] += len(said)
            learnt = "".join(unescape(formatted[x["begin"] : x["stop"]]) for x in loss)
            state[2].update(learnt.encode())
            state[3] += len(learnt)
            state[4] += len(formatted)
    if state is not None:
        yield told()


def conversation_digests(windows: DataFrame) -> DataFrame:
    """One row per conversation of written windows, read back: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A digest reads its conversation in order, so the windows of one go to one
    task, as they were written; they stream through it and nothing is gathered.
    """
    kind = windows.schema["conv"].dataType.simpleString()
    ordered = windows.repartition("conv").sortWithinPartitions("conv", "block", "n").select("conv", "formatted", "loss", "n_repeated")
    return ordered.mapInArrow(_digest, f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
