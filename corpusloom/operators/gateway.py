"""Calls to a model as an operator: an injected client, routed targets, retries, fallback and validation.

A client is any picklable ``call(target, prompt) -> str`` that raises ``CallError``. Prompts stream through Arrow batches;
each row goes through its targets in order. ``attempts`` of a row come back beside its answer, so cost and health are
plain aggregates afterwards. Registries name the parts that a user may replace.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .journal import DISPOSITIONS


class CallError(Exception):
    """A failed call of a kind in ``journal.DISPOSITIONS``."""

    def __init__(self, kind: str, message: str = "", retry_after_ms: int | None = None) -> None:
        super().__init__(message or kind)
        self.kind, self.retry_after_ms = kind, retry_after_ms


class Registry(dict):
    """Named, replaceable parts."""

    def register(self, name: str, part: Callable | None = None):
        def add(p):
            self[name] = p
            return p

        return add(part) if part else add

    def pick(self, name: str):
        if name not in self:
            raise KeyError(f"{name} isn't one of {', '.join(sorted(self))}")
        return self[name]


PIPELINES, ROUTINGS, CONTEXTS, CLIENTS = Registry(), Registry(), Registry(), Registry()


@dataclass(frozen=True)
class Policy:
    attempts: int = 3
    first_ms: int = 0
    factor: float = 2.0
    most_ms: int = 30_000
    #: Whether an answer that doesn't validate may go to the next target.
    fallback_on_invalid: bool = True

    def delay_ms(self, attempt: int, wish: int | None) -> float:
        return min(self.most_ms, wish if wish is not None else self.first_ms * self.factor ** (attempt - 1))


def complete(call: Callable[[str, str], str], targets: list[str], prompt: str, policy: Policy, valid: Callable[[str, str], bool] | None = None) -> tuple[str | None, list[tuple[str, int, str]]]:
    """One answer, or none, and what was tried: (target, attempt, outcome)."""
    tried: list[tuple[str, int, str]] = []
    for target in targets:
        for attempt in range(1, policy.attempts + 1):
            try:
                answer = call(target, prompt)
                if valid is None or valid(prompt, answer):
                    tried.append((target, attempt, "success"))
                    return answer, tried
                kind, wish = "response_format", None
            except CallError as e:
                kind, wish = e.kind, e.retry_after_ms
            tried.append((target, attempt, kind))
            retry, other = (True, policy.fallback_on_invalid) if kind == "response_format" else DISPOSITIONS.get(kind, DISPOSITIONS["unknown"])
            if not retry:
                break
            if attempt < policy.attempts and (wait := policy.delay_ms(attempt, wish)):
                time.sleep(wait / 1000)
        if not other:
            break
    return None, tried


def ask(df: DataFrame, key: str, prompt: str, call: Callable[[str, str], str], targets: list[str], policy: Policy = Policy(),  # noqa: B008
        valid: Callable[[str, str], bool] | None = None) -> DataFrame:
    """``key, answer, attempts`` for each prompt; ``answer`` is null where every target failed."""
    kind = dict(df.dtypes)[key]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            got = [complete(call, targets, p or "", policy, valid) for p in frame[prompt]]
            yield pd.DataFrame({key: frame[key], "answer": [a for a, _ in got], "attempts": [[{"target": t, "attempt": n, "outcome": o} for t, n, o in x] for _, x in got]})

    return df.select(key, prompt).mapInPandas(run, f"{key} {kind}, answer string, attempts array<struct<target string, attempt int, outcome string>>")


def escalate(df: DataFrame, key: str, rungs: list[str], call, targets: list[str], accept: Callable[[str, str], bool], policy: Policy = Policy()) -> DataFrame:  # noqa: B008
    """Rungs of context, cheapest first: a rung only sees rows that none before it answered acceptably."""
    left, done = df, None
    for i, rung in enumerate(rungs):
        got = ask(left, key, rung, call, targets, policy, accept).where("answer is not null").select(key, "answer", F.lit(i).alias("rung"))
        done = got if done is None else done.unionByName(got)
        left = left.join(got.select(key), key, "left_anti")
    return done


def translate_units(units: DataFrame, memory: DataFrame, call, targets: list[str], rounds: int = 2) -> tuple[DataFrame, DataFrame]:
    """``key, unit`` to ``key, translation``: wordless units stay as they are, known ones come from ``memory``, the rest are
    asked for, and only those still missing are asked again. Returns all, and the pairs that were learned."""
    plain = units.where(~F.col("unit").rlike("\\p{L}")).select("key", F.col("unit").alias("translation"))
    worded = units.where(F.col("unit").rlike("\\p{L}")).dropDuplicates(["key"])
    known = worded.join(memory, "key").select("key", "translation")
    left, learned = worded.join(memory, "key", "left_anti"), None
    for _ in range(rounds):
        got = ask(left, "key", "unit", call, targets).where("answer is not null").select("key", F.col("answer").alias("translation"))
        learned = got if learned is None else learned.unionByName(got)
        left = left.join(got.select("key"), "key", "left_anti")
    return plain.unionByName(known).unionByName(learned), learned
