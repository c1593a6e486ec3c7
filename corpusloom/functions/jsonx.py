"""JSON that answers and files carry: lenient extraction, duplicate keys, nulls."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, BooleanType, MapType, StringType


def json_block(text: str | None, opening: str = "{[") -> str | None:
    """The first balanced object or array in a text; brackets inside strings don't count, a fence is taken off."""
    if not text:
        return None
    fenced = re.search(r"```[a-zA-Z]*\s*\n(.*?)\n\s*```", text, re.S)
    body = fenced[1] if fenced else text
    start = min((i for c in opening if (i := body.find(c)) >= 0), default=-1)
    if start < 0:
        return None
    depth, quoted, skip = 0, False, False
    for i in range(start, len(body)):
        c = body[i]
        if skip:
            skip = False
        elif quoted:
            skip, quoted = c == "\\", c != '"'
        elif c == '"':
            quoted = True
        elif c in "{[":
            depth += 1
        elif c in "}]":
            depth -= 1
            if not depth:
                return body[start : i + 1]
    return None


def repeated_keys(text: str | None) -> list[str]:
    """Keys that occur twice in one object, at any depth."""
    found: list[str] = []

    def pairs(items: list[tuple[str, object]]) -> dict:
        seen: set[str] = set()
        for k, _ in items:
            if k in seen and k not in found:
                found.append(k)
            seen.add(k)
        return dict(items)

    try:
        json.loads(text or "", object_pairs_hook=pairs)
    except ValueError:
        return []
    return found


def holds_null(text: str | None) -> bool:
    def walk(x: object) -> bool:
        return x is None or any(map(walk, x.values() if isinstance(x, dict) else x if isinstance(x, list) else ()))

    try:
        return walk(json.loads(text)) if text else False
    except ValueError:
        return False


def flat_answer(text: str | None) -> dict[str, str]:
    """Fields of an answer: JSON, at most two levels deep, else ``key: value`` lines. The first value of a key stays; lists
    are comma-joined, deeper objects left out."""
    out: dict[str, str] = {}

    def put(k: str, v: object) -> None:
        if isinstance(v, list):
            v = ",".join(str(x) for x in v if not isinstance(x, (dict, list)))
        if v is not None and not isinstance(v, dict) and str(v).strip():
            out.setdefault(k.strip().lower().rpartition(".")[2], " ".join(str(v).split()))

    block = json_block(text, "{")
    try:
        data = json.loads(block) if block else None
    except ValueError:
        data = None
    if isinstance(data, dict):
        for k, v in data.items():
            for k2, v2 in v.items() if isinstance(v, dict) else [(k, v)]:
                put(k2, v2)
    else:
        for k, v in re.findall(r"(?m)^\s*[-*]?\s*([A-Za-z_.]+)\s*:\s*(.+?)\s*$", text or ""):
            put(k, v)
    return out


def _each(f):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(f)

    return run


@pandas_udf(StringType())
def extract_json(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    yield from _each(json_block)(batches)


@pandas_udf(ArrayType(StringType()))
def duplicate_keys(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    yield from _each(repeated_keys)(batches)


@pandas_udf(BooleanType())
def contains_null(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    yield from _each(holds_null)(batches)


@pandas_udf(MapType(StringType(), StringType()))
def parse_answer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    yield from _each(flat_answer)(batches)
