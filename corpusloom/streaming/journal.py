"""A run journal as a stream: windowed totals with late events, distinct fingerprints, and a streaming breaker."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENT = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def read(spark: SparkSession, path: str, files_per_batch: int = 10) -> DataFrame:
    """JSON lines as they arrive."""
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", files_per_batch).json(path)


def error_rates(events: DataFrame, window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Events, errors and their share by window; windows close ``late`` after their end."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w")).agg(
        F.count("*").alias("events"), F.count_if(F.col("event_type") == "error").alias("errors")).select(
        F.col("w.start").alias("start"), "events", "errors", (F.col("errors") / F.col("events")).alias("share"))


def sessions(events: DataFrame, gap: str = "5 minutes", late: str = "30 minutes") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("events")).select(
        "user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events")


def distinct_events(events: DataFrame, late: str = "30 minutes") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def breaker(events: DataFrame, threshold: int = 3, cooldown_s: float = 600.0) -> DataFrame:
    """The state of each user's circuit breaker after every event; a failure in the half-open state opens it again."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mode, failures, opened = state.get if state.exists else ("closed", 0, 0.0)
        for frame in frames:
            frame = frame.sort_values(["ts", "event_id"])
            out = []
            for at, kind in zip(frame["ts"].astype("int64") / 1e9, frame["event_type"], strict=True):
                if mode == "open" and at - opened >= cooldown_s:
                    mode = "half-open"
                if mode != "open":
                    failures = failures + 1 if kind == "error" else 0
                    if kind != "error":
                        mode = "closed"
                    elif mode == "half-open" or failures >= threshold:
                        mode, opened, failures = "open", at, 0
                out.append(mode)
            yield pd.DataFrame({"user_id": key[0], "event_id": frame["event_id"], "state": out})
        state.update((mode, failures, opened))

    return events.groupBy("user_id").applyInPandasWithState(
        step, "user_id bigint, event_id bigint, state string", "mode string, failures int, opened double", "append", GroupStateTimeout.NoTimeout)
