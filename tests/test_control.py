"""Run control, model answers and configuration against plain Python."""

import random

import pytest
from corpusloom.operators import control, dossiers
from pyspark.sql import functions as F


def brute_states(ok, needs):
    """Rounds as a driver would do them, task by task."""
    done, broken, out, pending, wave = set(), set(), {}, set(ok), 0
    needs = {t: {n for n in needs.get(t, ()) if n in ok} for t in ok}
    while pending:
        doomed = {t for t in pending if needs[t] & broken}
        ready = {t for t in pending - doomed if needs[t] <= done}
        if not doomed and not ready:
            out |= {t: ("skipped", "unsatisfiable dependencies", None) for t in pending}
            break
        out |= {t: ("skipped", "dependency-failed", None) for t in doomed} | {t: ("completed" if ok[t] else "failed", None, wave) for t in ready}
        broken |= doomed | {t for t in ready if not ok[t]}
        done |= {t for t in ready if ok[t]}
        pending -= doomed | ready
        wave += 1
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_states_of_random_graphs(spark, seed):
    r = random.Random(seed)
    ok = {t: r.random() < 0.85 for t in range(40)}
    needs = {t: {r.randrange(45) if r.random() < 0.1 else r.randrange(max(1, t)) for _ in range(r.randrange(3))} - {t if r.random() < 0.9 else -1} for t in ok}
    tasks = spark.createDataFrame(list(ok.items()), "task bigint, ok boolean")
    edges = spark.createDataFrame([(t, n) for t, ns in needs.items() for n in ns], "task bigint, needs bigint")
    got = {x.task: (x.state, x.reason, x.wave) for x in control.settle(tasks, edges).collect()}
    assert got == brute_states(ok, needs)


def test_states_of_empty_tables(spark):
    none = spark.createDataFrame([], "task bigint, ok boolean")
    edges = spark.createDataFrame([], "task bigint, needs bigint")
    assert control.settle(none, edges).count() == 0
    assert [x.state for x in control.settle(none.unionByName(spark.createDataFrame([(1, True)], none.schema)), edges).collect()] == ["completed"]


def test_reasoning_fields_of_dialects():
    assert control.reasoning_fields("none", True) == {}
    assert control.reasoning_fields("reasoning_effort", False) == {"reasoning_effort": "none"}
    assert control.reasoning_fields("reasoning", True, "low", 9) == {"reasoning": {"effort": "low", "exclude": False, "max_tokens": 9}}
    assert control.reasoning_fields("reasoning", False) == {"reasoning": {"enabled": False}}
    assert control.reasoning_fields("thinking", True, "high") == {"thinking": {"type": "enabled", "budget_tokens": 16384}}
    assert control.reasoning_fields("thinking", False) == {"thinking": {"type": "disabled"}}


def test_broken_references_are_named():
    good = {"endpoints": {"e": {}}, "models": {"m": {"endpoint": "e"}}, "pools": {"p": {"models": ["m"]}}, "output": {"channels": {"c": {}}},
            "tasks": {"t": {"pool": "p", "channel": "c"}}, "defaultPool": "p"}
    assert control.broken_references(good) == []
    bad = good | {"models": {"m": {"endpoint": "x"}}, "pools": {"p": {"models": ["n"]}}, "tasks": {"t": {"pool": "q", "channel": "d"}, "off": {"pool": "q", "enabled": False}}, "defaultPool": "z"}
    assert len(control.broken_references(bad)) == 5


def test_document_items(spark):
    raw = '[{"label":"x","target":"t","type":"tab"},{"label":"y","target":"u"},"z"]'
    row = spark.createDataFrame([(raw,), (None,), ("{",)], "raw string").select(dossiers.sanitized_items(F.col("raw"), documents=True).alias("s")).collect()
    assert [(i.label, i.target) for i in row[0].s["items"]] == [("x", "t"), ("y", "u")] and row[0].s["items"][0].type and row[0].s["dropped"] == 1
    assert row[1].s["items"] == row[2].s["items"] == [] and row[1].s["dropped"] == 0
