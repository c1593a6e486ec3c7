"""Connected components by alternating stars, on tables: nothing is gathered on the driver but row counts.

A large-star step points each node's larger neighbours at its smallest one, a small-star step the others; a node's
minimum combines before the shuffle, and joins meet one row a node on one side, so Spark can split a hot hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import Scratch


def components(edges: DataFrame, tmp: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) of all nodes that have an edge, from a table of ``tmp``.
    Null ends are ignored; no edges give no rows."""
    now = tmp.write(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u")
        out = tmp.write(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
            .where("u > v").distinct()
        )
        state = out.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        tmp.drop(now)
        now, before = out, state
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
