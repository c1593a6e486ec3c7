"""Run control on tables: which tasks can run, in what wave, and why others can't; model answers read defensively."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cut(df: DataFrame) -> DataFrame:
    """``df`` as a checkpoint in the folder that ``spark.checkpoint.dir`` names; without one only a single process gets its own."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or "file:///tmp/checkpoints/corpusloom")
    return df.checkpoint()


def remaining_needs(edges: DataFrame, skipped: DataFrame) -> DataFrame:
    """``task, needs`` without prerequisites that are skipped: what was done before is satisfied."""
    return edges.join(skipped.select(F.col("task").alias("needs")), "needs", "left_anti").select("task", "needs")


def settle(tasks: DataFrame, edges: DataFrame) -> DataFrame:
    """``tasks`` (``task``, and whether it is ``ok`` when run) with ``state``, ``reason`` and ``wave``.

    A wave holds the tasks whose prerequisites (``edges``: ``task, needs``) have all completed. Whatever needs a task that
    failed or was skipped is skipped; what is left when no wave is possible waits on a cycle. Needs outside ``tasks`` are
    dropped. A round costs two joins by task, and there are as many as the longest chain has tasks.
    """
    known = tasks.select(F.col("task").alias("needs"))
    edges = _cut(edges.join(known, "needs", "left_semi").join(tasks.select("task"), "task", "left_semi").distinct())
    settled = _cut(tasks.select("task", F.lit(None).cast("string").alias("state"), F.lit(None).cast("string").alias("reason"), F.lit(None).cast("int").alias("wave")).limit(0))
    pending, wave, broken = _cut(tasks.select("task", "ok")), 0, F.col("state").isin("failed", "skipped")
    while True:
        met = edges.join(pending.select("task"), "task", "left_semi").join(settled.select(F.col("task").alias("needs"), "state"), "needs", "left").groupBy("task").agg(
            F.coalesce(F.bool_or(broken), F.lit(False)).alias("doomed"), F.bool_and(F.coalesce(F.col("state") == "completed", F.lit(False))).alias("ready"))
        judged = pending.join(met, "task", "left").select(
            "task", "ok", F.coalesce("doomed", F.lit(False)).alias("doomed"), F.coalesce("ready", F.lit(True)).alias("ready")).where("doomed or ready")
        now = _cut(judged.select(
            "task", F.when(F.col("doomed"), "skipped").when(F.col("ok"), "completed").otherwise("failed").alias("state"),
            F.when(F.col("doomed"), "dependency-failed").alias("reason"), F.when(~F.col("doomed"), wave).alias("wave")))
        if now.isEmpty():
            stuck = pending.select("task", F.lit("skipped").alias("state"), F.lit("unsatisfiable dependencies").alias("reason"), F.lit(None).cast("int").alias("wave"))
            return settled.unionByName(stuck)
        settled, pending, wave = settled.unionByName(now), _cut(pending.join(now.select("task"), "task", "left_anti")), wave + 1


# Reasons to finish that are known.
FINISH = ("stop", "length", "content_filter", "tool_calls")


def read_completion(raw: Column) -> dict[str, Column]:
    """A chat completion's text, token usage, finish reason and failure, from JSON that may lack any of them. An answer that
    was cut off is a ``response_format`` failure."""
    v = F.try_parse_json(raw)
    text = lambda p: F.try_variant_get(v, p, "string")
    number = lambda *ps: F.coalesce(*[F.try_variant_get(v, p, "bigint") for p in ps], F.lit(0).cast("bigint"))
    content = F.try_variant_get(v, "$.choices[0].message.content", "variant")
    parts = F.from_json(F.to_json(content), "array<struct<type string, text string>>")
    joined = F.array_join(F.transform(F.filter(parts, lambda p: p["type"].isNull() | (p["type"] == "text")), lambda p: F.coalesce(p["text"], F.lit(""))), "")
    kind = F.schema_of_variant(content)
    finish = F.coalesce(text("$.choices[0].finish_reason"), F.lit(""))
    prompt, completion = number("$.usage.prompt_tokens"), number("$.usage.completion_tokens")
    return {
        "text": F.when(kind == "STRING", text("$.choices[0].message.content")).when(kind.startswith("ARRAY"), joined).otherwise(F.lit("")),
        "prompt": prompt, "completion": completion, "cached": number("$.usage.prompt_tokens_details.cached_tokens", "$.usage.cache_read_input_tokens"),
        "reasoning": number("$.usage.completion_tokens_details.reasoning_tokens"),
        "total": F.coalesce(F.try_variant_get(v, "$.usage.total_tokens", "bigint"), prompt + completion),
        "finish": F.when(finish.isin(*FINISH), finish).otherwise("unknown"), "failure": F.when(finish == "length", "response_format"),
    }


# Thinking budgets by effort.
EFFORTS = {"minimal": 1024, "low": 2048, "medium": 8192, "high": 16384}


def reasoning_fields(dialect: str, enabled: bool, effort: str = "medium", most: int | None = None, exclude: bool = False) -> dict:
    """What a request says about reasoning in a provider's dialect; all but ``none`` say so when it is off, too."""
    if dialect == "reasoning_effort":
        return {"reasoning_effort": effort if enabled else "none"}
    if dialect == "reasoning":
        asked = {"effort": effort, "exclude": exclude} | ({"max_tokens": most} if most else {})
        return {"reasoning": asked if enabled else {"enabled": False}}
    if dialect == "thinking":
        return {"thinking": {"type": "enabled", "budget_tokens": most if most is not None else EFFORTS.get(effort, 8192)} if enabled else {"type": "disabled"}}
    return {}


def run_id(now: Column, random: Column) -> Column:
    """``20240131-235959-ab12``, which sorts by time; ``random`` gives the last four hexadecimal digits."""
    return F.concat_ws("-", F.date_format(now, "yyyyMMdd"), F.date_format(now, "HHmmss"), F.left(F.md5(random.cast("string")), F.lit(4)))


def broken_references(config: dict) -> list[str]:
    """What a configuration names but doesn't have: endpoints of models, models of pools, pools and channels of tasks, and
    a default pool. A configuration is small, so this is plain Python."""
    endpoints, models, pools = config.get("endpoints", {}), config.get("models", {}), config.get("pools", {})
    channels = config.get("output", {}).get("channels", {})
    found = [f"models.{m}: unknown endpoint {x['endpoint']}" for m, x in models.items() if x.get("endpoint") not in endpoints]
    found += [f"pools.{p}: unknown model {m}" for p, x in pools.items() for m in x.get("models", []) if m not in models]
    for name, task in config.get("tasks", {}).items():
        if task.get("enabled", True):
            found += [f"tasks.{name}: unknown pool {task['pool']}"] * ("pool" in task and task["pool"] not in pools)
            found += [f"tasks.{name}: unknown channel {task['channel']}"] * ("channel" in task and task["channel"] not in channels)
    default = config.get("defaultPool")
    return found + [f"defaultPool: unknown pool {default}"] * (default is not None and default not in pools)


def members_present(raw: Column, members: tuple[str, ...]) -> Column:
    """Which members a JSON object has, null ones included."""
    keys = F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>"))
    return F.filter(F.array(*map(F.lit, members)), lambda m: F.array_contains(keys, m))

