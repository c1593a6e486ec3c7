"""Spelling similarity by optimal string alignment: edits, with a swap of neighbours as one."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, IntegerType


def alignment(a: str, b: str, limit: int = 3) -> int:
    """The distance, or ``limit + 1`` where it is larger."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    above: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, above, row = above, row, [i]
        for j, y in enumerate(b, 1):
            d = min(row[j - 1] + 1, above[j] + 1, above[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older[j - 2] + 1)
            row.append(d)
        if min(row) > limit:
            return limit + 1
    return min(row[-1], limit + 1)


@pandas_udf(IntegerType())
def distance(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Distance of two columns up to 3; Spark's ``levenshtein`` charges two for a swap."""
    for a, b in pairs:
        yield pd.Series([None if x is None or y is None else alignment(x, y) for x, y in zip(a, b, strict=True)], dtype="Int32")


def similarity(a: Column, b: Column, d: Column) -> Column:
    """1 for equal strings, 0 beyond three edits or for empty ones; ``d`` is their distance."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when((a == "") | (b == ""), 0.0).when(a == b, 1.0).when(d > 3, 0.0).otherwise(F.greatest(F.lit(0.0), 1 - d / longest))


def threshold(length: Column) -> Column:
    return F.when(length <= 4, 1.0).when(length <= 6, 0.83).otherwise(0.86)


@lru_cache(1 << 16)
def likeness(a: str, b: str) -> float:
    """``similarity`` of two strings."""
    d = alignment(a, b)
    return 0.0 if not a or not b or d > 3 else max(0.0, 1 - d / max(len(a), len(b)))


@pandas_udf(DoubleType())
def closest(rows: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """The best score of file tokens, folder tokens and surnames: 0.62 at the threshold to 0.9, and 0.04 less by a folder."""

    def score(token: str, name: str, less: float) -> float | None:
        n = max(len(token), len(name))
        least = 1.0 if n <= 4 else 0.83 if n <= 6 else 0.86
        value = likeness(name, token)
        return None if value < least else 0.62 + (value - least) / max(1e-6, 1 - least) * (0.9 - 0.62) - less

    for files, folders, names in rows:
        out = []
        for f, d, s in zip(files, folders, names, strict=True):
            found = [] if s is None else [score(t, n, less) for tokens, less in ((f, 0.0), (d, 0.04)) for t in tokens for n in s]
            out.append(max((x for x in found if x is not None), default=None))
        yield pd.Series(out, dtype="Float64")
