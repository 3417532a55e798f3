"""Chat windows: exact round trips, budgets and masks."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfspark.llm import chat
from shelfspark.plans.lineage import cut

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["<turn user>", "</turn>\n", "<\\turn", "\\", "</turn", "<</turn>", "\\g", ">", ">\n", "\n", "é\U0001f600", "### Assistant:", "<turn", "\\</turn>\n<turn system>\n"]
texts = st.lists(st.one_of(st.sampled_from(NASTY), st.text(max_size=3)), max_size=6).map("".join).filter(lambda s: "\x00" not in s)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(texts, texts), min_size=1, max_size=5))
def test_what_is_written_is_read_back(turns):
    assert chat.parse("".join(x for t in turns for x in chat.mark(*t))) == turns
    assert all(chat.unescape(chat.escape(text)) == text for _, text in turns)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=30), st.integers(0, 5), st.booleans(), st.one_of(st.none(), st.integers(1, 50)), st.integers(1, 120), st.integers(0, 60), st.integers(0, 5))
def test_windows_cover_new_turns_once_and_keep_the_budget(tokens, known, first, system, budget, history, history_turns):
    known = 0 if first else min(known, len(tokens) - 1)
    if first and system is not None:
        system = tokens[0]
    found = list(chat.spans(tokens, known, first, system, budget, history, history_turns))
    assert [x for _, lo, hi in found for x in range(lo, hi)] == list(range(known, len(tokens)))
    for begin, lo, hi in found:
        used = sum(tokens[begin:hi]) + (system or 0) * (not first or lo > 0)
        assert used <= budget or (begin == lo and hi == lo + 1)
        assert lo - begin <= history_turns and sum(tokens[begin:lo]) <= history
        assert not (first and system is not None and lo > 0 and begin == 0 < lo)


def conversations():
    long = "word " * 30_000
    rows = [(1, 0, "system", "be brief"), (1, 1, "user", "hello " * 40), (1, 2, "assistant", "A" * 3000), (1, 3, "user", None), (1, 4, "assistant", "B</turn>\n\\"), (1, 4, "assistant", "B</turn>\n\\")]
    rows += [(2, k, "assistant" if k % 2 else "user", f"turn {k} " * 9) for k in range(700)]
    rows += [(3, 0, "assistant", long), (4, 0, None, ""), (5, None, "user", "no number"), (5, 2, "assistant", "two"), (None, 0, "user", "x"), (None, 0, "user", "y"), (None, 1, "assistant", "z")]
    rows += [(6, -300, "system", "low"), (6, -1, "user", "u"), (6, 0, "assistant", "a"), (6, 1 << 40, "assistant", "far")]
    return rows


def digests(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] if r[1] is not None else -(1 << 62), r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        loss = "".join(text for _, role, text in turns if role == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha("".join(f"{role}\n{text}\n" for _, role, text in turns)), len(loss), sha(loss))
    return out


def test_conversations_read_back_whole(spark):
    df = spark.createDataFrame(conversations(), SCHEMA).withColumn("block", F.lit("x")).withColumn("tokens", F.lit(None).cast("int")).withColumn("n", F.lit(1))
    for sizes in ({}, {"block_turns": 3, "budget": 60, "history": 30, "history_turns": 2}, {"history_turns": 0}):
        written = cut(chat.format_windows(df, **sizes))
        got = {r.conv: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.conversation_digests(written).collect()}
        assert got == digests(conversations())
        most = sizes.get("budget", chat.BUDGET)
        assert written.filter(f"n_tokens > {most} AND (NOT over_budget OR n_turns > 1)").count() == 0


def test_later_windows_say_the_system_turn_and_some_history_without_loss(spark):
    rows = [(1, 0, "system", "be brief")] + [(1, k, "assistant" if k % 2 == 0 else "user", f"turn number {k:04d} of this talk") for k in range(1, 600)]
    found = chat.format_windows(spark.createDataFrame(rows, SCHEMA), budget=200, history=40, history_turns=3).orderBy("block", "n").collect()
    assert len(found) > 10
    next_turn = 0
    for k, w in enumerate(found):
        turns = chat.parse(w.formatted)
        assert turns[0] == ("system", "be brief")
        repeated = turns[: w.n_repeated]
        if k:
            assert repeated[0] == ("system", "be brief") and 1 < w.n_repeated <= 4
            assert [t for _, t in repeated[1:]] == [r[3] for r in rows[next_turn - w.n_repeated + 1 : next_turn]]
        assert [t for _, t in turns[w.n_repeated :]] == [r[3] for r in rows[next_turn : next_turn + w.n_turns]]
        learnt = [chat.unescape(w.formatted[x.begin : x.stop]) for x in w.loss]
        assert learnt == [r[3] for r in rows[next_turn : next_turn + w.n_turns] if r[2] == "assistant"]
        next_turn += w.n_turns
    assert next_turn == len(rows)


def test_windows_are_read_back_as_rows(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"</turn> {k}\\") for k in range(40)]
    read = chat.read_windows(chat.format_windows(spark.createDataFrame(rows, SCHEMA), budget=60)).orderBy("block", "n").collect()
    assert len(read) > 3 and [(t.role, t.text) for r in read for t in r.turns] == [r[2:] for r in rows]
    assert [x for r in read for x in r.learnt] == [r[3] for r in rows if r[2] == "assistant"]


def test_given_token_counts_are_used(spark):
    rows = [(1, k, "assistant", "x", 100) for k in range(10)]
    found = chat.format_windows(spark.createDataFrame(rows, SCHEMA + ", cost int"), tokens="cost", budget=500, history=0).orderBy("n").collect()
    assert [w.n_turns for w in found] == [5, 5] and [w.n_tokens for w in found] == [500, 500]


def test_empty_table(spark):
    written = cut(chat.format_windows(spark.createDataFrame([], SCHEMA)))
    assert written.collect() == [] and chat.conversation_digests(written).collect() == []
