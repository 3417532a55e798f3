"""Walks over providers and models: which calls a run of requests makes, given what each call would give.

Every client walks for itself. Its providers are asked in order, the models of
each in order; a provider that is down pauses and ends its turn, a model whose
reply was cut off pauses alone, a rejected reply is repaired once by the same
model. Pauses hold for the client's later requests. Where all providers pause,
all are asked rather than none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: seconds for which a model pauses after a reply that was cut off.
MODEL_PAUSE = 5 * 60
#: What a call can give.
OK, REJECTED, DOWN, CUT, FAILED = "ok", "rejected", "down", "cut", "failed"

Plan = list[tuple[str, list[str]]]


@dataclass
class Walk:
    """Pauses of one client: the time from which a provider, or a model of one, is asked again."""

    plan: Plan
    until: dict[tuple[str, ...], int] = field(default_factory=dict)

    def _rests(self, *who: str, now: int) -> bool:
        return now < self.until.get(who, now)

    def request(self, now: int, gives: dict[tuple[str, str], tuple[str, str | None, int]]) -> tuple[str | None, str | None, bool, list[str]]:
        """(provider, model, repaired, calls) of a request; ``gives`` has for a model what its call gives, what the repair gives, and how long it is down."""
        live = [p for p in self.plan if not self._rests(p[0], now=now)] or self.plan
        calls: list[str] = []
        for provider, models in live:
            for model in models:
                if self._rests(provider, model, now=now):
                    continue
                first, second, pause = gives.get((provider, model), (FAILED, None, 0))
                calls.append(f"{provider}/{model}")
                repaired = first == REJECTED
                if repaired:
                    first = second or FAILED
                    calls.append(f"{provider}/{model} repair")
                if first == OK:
                    return provider, model, repaired, calls
                if first == DOWN:
                    self.until[provider,] = now + pause
                    break
                if first == CUT:
                    self.until[provider, model] = now + MODEL_PAUSE
        return None, None, False, calls


def walk(requests: DataFrame, outcomes: DataFrame, plan: Plan, client: str = "client", request: str = "request") -> DataFrame:
    """(client, request, provider, model, repaired, calls) of ``requests`` (client, request, at in seconds).

    ``outcomes`` (request, provider, model, first, second, pause) say what a call
    and its repair would give; a model without one fails. A client's requests go
    in order of time, then request; they stream through one task, which holds
    the pauses of one client. Requests without a usable reply have no provider.
    """
    gives = outcomes.groupBy(F.col(request).alias("__r")).agg(F.collect_list(F.struct("provider", "model", "first", "second", F.coalesce("pause", F.lit(0)).cast("long").alias("pause"))).alias("gives"))
    rows = requests.select(F.col(client).alias("client"), F.col(request).alias("request"), F.col("at").cast("long").alias("at")).join(gives, F.col("request") == F.col("__r"), "left").drop("__r")
    kinds = [rows.schema[c].dataType.simpleString() for c in ("client", "request")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who, mine = (), Walk(plan)
        for batch in batches:
            out = []
            for c, at, held in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if who != (c,):
                    who, mine = (c,), Walk(plan)
                out.append(mine.request(at or 0, {(g["provider"], g["model"]): (g["first"], g["second"], g["pause"]) for g in held or []}))
            provider, model, repaired, calls = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(provider, pa.string()), pa.array(model, pa.string()), pa.array(repaired, pa.bool_()), pa.array(calls, pa.list_(pa.string()))], names=["client", "request", "provider", "model", "repaired", "calls"])

    ordered = rows.repartition("client").sortWithinPartitions("client", "at", "request").select("client", "request", "at", "gives")
    found = ordered.mapInArrow(run, f"client {kinds[0]}, request {kinds[1]}, provider string, model string, repaired boolean, calls array<string>")
    return found.withColumnRenamed("client", client).withColumnRenamed("request", request)
