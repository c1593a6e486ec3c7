"""Registered queries: a name, what builds its DataFrame, and DuckDB SQL for the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[["Tables"], DataFrame]
QUERIES: dict[str, Builder] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of a folder, read lazily by attribute, and SQL over them."""

    NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "benchmark",
             "pages", "labels", "conversations", "embeddings")

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        """``text`` with ``{name}`` for a table of the folder or one of ``frames``."""
        used = {n: getattr(self, n) for n in self.NAMES if "{" + n + "}" in text}
        return self.spark.sql(text, **used, **frames)


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def add(f: Builder) -> Builder:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


def plain(text: str) -> str:
    """Input SQL for DuckDB, where tables go by their names."""
    for n in Tables.NAMES:
        text = text.replace("{" + n + "}", n)
    return text
