"""Walks over providers and models, against a plain one and on written cases."""

import random

from shelfspark.operators import walks

PLAN = [("a", ["a1", "a2"]), ("b", ["b1"]), ("c", ["c1", "c2"])]


def test_written_cases():
    w = walks.Walk(PLAN)
    ask = lambda now, **gives: w.request(now, {(m[0], m): v for m, v in gives.items()})
    assert ask(0, a1=("ok", None, 0)) == ("a", "a1", False, ["a/a1"])
    assert ask(1, a1=("rejected", "ok", 0)) == ("a", "a1", True, ["a/a1", "a/a1 repair"])
    assert ask(2, a1=("rejected", "rejected", 0), a2=("ok", None, 0)) == ("a", "a2", False, ["a/a1", "a/a1 repair", "a/a2"])
    assert ask(3, a1=("cut", None, 0), a2=("ok", None, 0)) == ("a", "a2", False, ["a/a1", "a/a2"])
    assert ask(302, a1=("ok", None, 0), a2=("ok", None, 0)) == ("a", "a2", False, ["a/a2"])  # a1 pauses
    assert ask(303, a1=("ok", None, 0)) == ("a", "a1", False, ["a/a1"])
    assert ask(400, a1=("down", None, 60), b1=("ok", None, 0)) == ("b", "b1", False, ["a/a1", "b/b1"])
    assert ask(459, a1=("ok", None, 0), b1=("rejected", "down", 1000), c1=("ok", None, 0)) == ("c", "c1", False, ["b/b1", "b/b1 repair", "c/c1"])
    assert ask(460, a1=("down", None, 500), c1=("down", None, 500)) == (None, None, False, ["a/a1", "c/c1"])
    assert ask(470, b1=("ok", None, 0)) == ("b", "b1", False, ["a/a1", "a/a2", "b/b1"])  # all pause: all are asked


def test_walks_of_many_clients(spark):
    rnd = random.Random(9)
    requests, outcomes = [], []
    for r in range(400):
        requests.append((rnd.choice([1, 2, 3, None]), r, rnd.randint(0, 3000)))
        for provider, models in PLAN:
            for model in models:
                if rnd.random() < 0.9:
                    outcomes.append((r, provider, model, rnd.choice(["ok", "rejected", "down", "cut", "failed"]), rnd.choice(["ok", "rejected", "down", "cut", "failed", None]), rnd.choice([10, 300, 900, None])))
    got = walks.walk(spark.createDataFrame(requests, "client int, request int, at int"), spark.createDataFrame(outcomes, "request int, provider string, model string, first string, second string, pause int"), PLAN).collect()
    held = {}
    for r, provider, model, *rest in outcomes:
        held.setdefault(r, {})[provider, model] = (rest[0], rest[1], rest[2] or 0)
    want = []
    for client in (1, 2, 3, None):
        until = {}
        for _, r, at in sorted((x for x in requests if x[0] == client), key=lambda x: (x[2], x[1])):
            live = [p for p, _ in PLAN if until.get(p, 0) <= at] or [p for p, _ in PLAN]
            answer, calls = (None, None, False), []
            for provider, models in PLAN:
                if provider not in live or answer[0]:
                    continue
                for model in models:
                    if until.get((provider, model), 0) > at:
                        continue
                    first, second, pause = held.get(r, {}).get((provider, model), ("failed", None, 0))
                    calls.append(f"{provider}/{model}")
                    end = first
                    if first == "rejected":
                        calls.append(f"{provider}/{model} repair")
                        end = second
                    if end == "ok":
                        answer = (provider, model, first == "rejected")
                    elif end == "down":
                        until[provider] = at + pause
                    elif end == "cut":
                        until[provider, model] = at + 300
                    if end in ("ok", "down"):
                        break
            want.append((client, r, *answer, calls))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    empty = walks.walk(spark.createDataFrame([], "client int, request int, at int"), spark.createDataFrame([], "request int, provider string, model string, first string, second string, pause int"), PLAN)
    assert empty.collect() == []
