"""Analytics over run journals: totals, cost, error kinds, streaks, breakers, budgets and rate limits.

Attempts have ``seq, ts, target, call_id, outcome, latency_ms, prompt, cached, completion, reasoning`` and prices.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .catalogue import number_rows


def cost(prompt: Column, cached: Column, completion: Column, reasoning: Column, price_in: Column, price_out: Column,
         price_cached: Column | None = None, price_reasoning: Column | None = None) -> Column:
    """Price of a call; prices are per million tokens, cached and reasoning ones default to input's and output's."""
    zero = F.lit(0)
    hit = F.least(F.coalesce(cached, zero), prompt)
    thought = F.coalesce(reasoning, zero)
    return (
        (prompt - hit) * price_in + hit * F.coalesce(price_cached if price_cached is not None else F.lit(None), price_in)
        + F.greatest(zero, completion - thought) * price_out
        + thought * F.coalesce(price_reasoning if price_reasoning is not None else F.lit(None), price_out)
    ) / F.lit(1e6)


def usable_tokens(window: Column, margin: Column, reserve: Column, most_out: Column) -> Column:
    return F.greatest(F.lit(0), F.floor(window * margin) - F.least(reserve, most_out)).cast("long")


def routed_chain(targets: DataFrame, tokens: int, margin: float = 0.9, reserve: int = 512) -> DataFrame:
    """Each pool's ``targets`` (window_size, most_out, price, weight, pos) by ``rank`` for so many tokens: those that fit by
    price and weight, then those that ``overflow``, most room first."""
    room = usable_tokens(F.col("window_size"), F.lit(margin), F.lit(reserve), F.col("most_out")) - tokens
    t = targets.withColumn("overflows", room < 0)
    keys = ("overflows", F.when(room < 0, -room), "price", F.desc("weight"), "pos")
    return t.withColumn("rank", F.row_number().over(Window.partitionBy("pool").orderBy(*keys)))


def first_choices(requests: DataFrame, targets: DataFrame, orders: dict[str, list[Column]], widest: tuple[str, ...] = ()) -> DataFrame:
    """The target that each of ``orders`` puts first for a ``request`` (pool, tokens) among its pool's ``targets`` (usable, pos):
    of those that fit, the first by the order's keys; if none fits, or the order is in ``widest``, of those with most room.

    Requests never meet the targets of their pool. The best targets of each usable size run down from the largest size, so
    the best that fit are one row for each size that is asked for; most room is the same targets for all sizes."""
    c = F.col
    keys = {n: F.struct(*[k.alias(f"k{i}") for i, k in enumerate(ks)], "target").alias(n) for n, ks in orders.items()}
    known = targets.where(c("usable").isNotNull())
    sizes = known.groupBy("pool", c("usable").alias("at")).agg(*[F.min(k).alias(n) for n, k in keys.items()], F.lit(False).alias("asked"))
    asked = requests.select("pool", c("tokens").alias("at")).distinct().withColumn("asked", F.lit(True))
    # A request without size comes last, after all targets.
    down = Window.partitionBy("pool").orderBy(c("at").desc_nulls_last()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    fitting = sizes.unionByName(asked, allowMissingColumns=True).withColumns({n: F.min(n).over(down) for n in keys}).where("asked").drop("asked")
    roomy = targets.groupBy("pool").agg(*[
        F.min(F.when(c("usable").isNotNull(), F.struct((-c("usable")).alias("less"), k))).alias(f"{n}__most") for n, k in keys.items()])
    both = requests.alias("r").join(roomy, "pool").join(fitting.alias("f"), (c("r.pool") == c("f.pool")) & c("r.tokens").eqNullSafe(c("f.at")))

    def choice(n: str) -> Column:
        fit, most = c(f"f.{n}"), c(f"{n}__most")
        of = lambda rank, less, key: F.struct(F.lit(rank).alias("rank"), less.alias("less"), key.alias("key"))
        by_room = F.when(most.isNotNull(), of(1, c("r.tokens") + most["less"], most[n]))
        no_room = of(0, F.lit(None).cast("long"), fit)
        return F.when(c("r.tokens").isNull() & fit.isNotNull(), no_room).otherwise(by_room) if n in widest else F.when(fit.isNotNull(), no_room).otherwise(by_room)

    return both.groupBy("r.request").agg(*[F.min(choice(n))["key"]["target"].alias(n) for n in keys])


def in_turn(requests: DataFrame, targets: DataFrame) -> DataFrame:
    """``request, target``: a pool's targets by ``pos`` take its requests in turn by ``seq``. Places are numbered, so a request
    joins the one target whose turn it is."""
    c = F.col
    placed = number_rows(targets.where("pool is not null and pos is not null").select("pool", "pos", "target"), ["pool", "pos"])
    sizes = targets.groupBy("pool").agg(F.count("*").alias("size"), F.count("pos").alias("named"))
    pools = sizes.join(placed.groupBy("pool").agg(F.min("n").alias("first")), "pool", "left")
    # Targets without place come last and give their turn to the first.
    turn = F.pmod("seq", "size")
    at = requests.join(pools, "pool").select("request", "pool", (c("first") + F.when(turn >= c("named"), 0).otherwise(turn)).alias("n"))
    return at.join(placed.select("pool", "n", "target"), ["pool", "n"], "left").groupBy("request").agg(F.min("target").alias("target"))


# Error kinds by message and provider code (lower case, first match first), by status, and by network code;
# whether a kind is retried against the same target, and whether another target may help.
MESSAGE_KINDS = (
    ("context_length", "context length|context_length|maximum context|too many tokens|prompt is too long|reduce the length"),
    ("content_filter", "content filter|content_policy|safety|flagged"),
    ("quota", "insufficient|quota|billing|credit|payment required"),
    ("model_unavailable", "model .*(?:not found|unavailable|does not exist)|unknown model|no healthy deployment"),
)
STATUS_KINDS = {
    429: "rate_limit", 401: "auth", 403: "auth", 402: "quota", 404: "model_unavailable", 408: "timeout", 409: "timeout",
    413: "context_length", 422: "context_length",
}
NETWORK_CODES = """econnreset econnrefused econnaborted epipe etimedout enotfound eai_again ehostunreach enetunreach und_err_socket
    und_err_connect_timeout""".split()
NETWORK_MESSAGE = "fetch failed|socket hang up|network|econn|enotfound|eai_again"
DISPOSITIONS = {
    "rate_limit": (True, True), "timeout": (True, True), "network": (True, True), "server": (True, True), "auth": (False, True),
    "invalid_request": (False, False), "context_length": (False, True), "content_filter": (False, True), "quota": (False, True),
    "model_unavailable": (False, True), "response_format": (True, True), "circuit_open": (False, True), "unknown": (False, True),
}


def error_kind(message: Column, status: Column, code: Column | None = None) -> Column:
    """An error's kind: what its message or provider code says, else its HTTP status, else the way the connection failed."""
    code = F.lower(F.coalesce(code if code is not None else F.lit(None).cast("string"), F.lit("")))
    said = F.concat_ws(" ", code, F.lower(F.coalesce(message, F.lit(""))))
    out = F.when(F.lit(False), None)
    for kind, pattern in MESSAGE_KINDS:
        out = out.when(said.rlike(pattern), kind)
    for number, kind in STATUS_KINDS.items():
        out = out.when(status == number, kind)
    return (
        out.when(status >= 500, "server").when(status >= 400, "invalid_request")
        .when(code.isin(*NETWORK_CODES) | said.rlike(NETWORK_MESSAGE), "network").when(said.rlike("timed? ?out"), "timeout").otherwise("unknown")
    )


def disposition(kind: Column) -> Column:
    out = F.when(F.lit(False), None)
    for name, (retry, other) in DISPOSITIONS.items():
        out = out.when(kind == name, F.struct(F.lit(retry).alias("retryable"), F.lit(other).alias("fallbackable")))
    return out


def duration_ms(value: Column) -> Column:
    """Milliseconds of ``250ms``, ``1.5s``, ``2m``, ``1h`` or bare seconds."""
    pattern = "^\\s*([\\d.]+)(ms|s|m|h)?\\s*$"
    n, unit = F.regexp_extract(value, pattern, 1).try_cast("double"), F.regexp_extract(value, pattern, 2)
    return n * F.when(unit == "ms", 1).when(unit == "m", 60_000).when(unit == "h", 3_600_000).otherwise(1000)


def retry_after_ms(retry_after: Column, now: Column, reset: Column | None = None) -> Column:
    """A server's wish: ``Retry-After`` in seconds or as an HTTP date (from ``now`` on), else a rate limit's reset duration."""
    zero, when = F.lit(0.0), F.try_to_timestamp(F.regexp_extract(retry_after, "^\\w{3}, (\\d{2} \\w{3} \\d{4} \\d{2}:\\d{2}:\\d{2}) GMT$", 1), F.lit("dd MMM yyyy HH:mm:ss"))
    seconds = F.when(F.trim(retry_after).rlike("^[+-]?(?:\\d+\\.?\\d*|\\.\\d+)(?:[eE][+-]?\\d+)?$"), F.trim(retry_after).try_cast("double"))
    ahead = F.unix_millis(when) - F.unix_millis(now.cast("timestamp"))
    wish = F.coalesce(seconds * 1000, ahead.cast("double"))
    wish = F.when(wish.isNotNull(), F.greatest(zero, wish))
    return F.round(F.coalesce(wish, duration_ms(reset)) if reset is not None else wish).cast("long")


def backoff_ms(attempt: Column, first: int = 1000, factor: float = 2.0, most: int = 30_000, retry_after: Column | None = None) -> Column:
    """Delay before the next attempt, without jitter; a server's wish wins, up to the same cap."""
    own = F.least(F.lit(float(most)), F.lit(float(first)) * F.pow(F.lit(factor), attempt - 1))
    return F.coalesce(F.least(F.lit(float(most)), retry_after) if retry_after is not None else F.lit(None), own).cast("long")


def totals(attempts: DataFrame, *by: str) -> DataFrame:
    return attempts.groupBy(*by).agg(
        F.count("*").alias("requests"), F.count_if(F.col("outcome") == "success").alias("successes"),
        F.count_if(F.col("outcome") == "failure").alias("failures"), F.sum("prompt").alias("prompt"), F.sum("completion").alias("completion"),
        F.sum("latency_ms").alias("latency_ms"), F.max("ts").alias("last_used"), F.round(F.sum("cost"), 6).alias("cost"),
    )


def failure_streak(attempts: DataFrame, key: str = "target") -> DataFrame:
    """``attempts`` with the failures in a row up to each, since the last success."""
    w = Window.partitionBy(key).orderBy("ts", "seq")
    island = F.sum(F.when(F.col("outcome") == "success", 1).otherwise(0)).over(w)
    return attempts.withColumn("island", island).withColumn(
        "streak", F.sum(F.when(F.col("outcome") == "failure", 1).otherwise(0)).over(Window.partitionBy(key, "island").orderBy("ts", "seq"))
    ).drop("island")


def budget(attempts: DataFrame, run: str, limit: float, amount: str = "cost") -> DataFrame:
    """``attempts`` with what was spent before each, and whether the limit had been reached by then."""
    w = Window.partitionBy(run).orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return attempts.withColumn("spent_before", F.coalesce(F.sum(amount).over(w), F.lit(0.0))).withColumn("tripped", F.col("spent_before") >= limit)


def numbered(df: DataFrame, by: str, *order: str) -> DataFrame:
    return df.withColumn("seq_no", F.row_number().over(Window.partitionBy(by).orderBy(*order)) - 1)


def breaker(attempts: DataFrame, threshold: int = 3, cooldown_s: float = 600.0, probes: int = 1, key: str = "target") -> DataFrame:
    """Circuit breaker replay: ``key, seq, state`` at each attempt and whether it was let through. State is a sequence of
    transitions in time, so a target's attempts run through one small state machine, in order; a target's rows are
    streamed in Arrow batches, not gathered."""

    def replay(_key, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, failures, opened, used = "closed", 0, 0.0, 0
        for frame in frames:
            states, passed = [], []
            for at, outcome in zip(frame["at"], frame["outcome"], strict=True):
                if state == "open" and at - opened >= cooldown_s:
                    state, used = "half-open", 0
                ok = state == "closed" or (state == "half-open" and used < probes)
                states.append(state)
                passed.append(ok)
                if not ok:
                    continue
                used += state == "half-open"
                if outcome == "success":
                    state, failures = "closed", 0
                else:
                    failures += 1
                    if state == "half-open" or failures >= threshold:
                        state, opened, failures = "open", at, 0
            yield pd.DataFrame({key: frame[key], "seq": frame["seq"], "state": states, "passed": passed})

    rows = attempts.select(key, "seq", F.col("ts").cast("timestamp").cast("double").alias("at"), "outcome")
    return _ordered_groups(rows, key, ["at", "seq"], replay, f"{key} bigint, seq bigint, state string, passed boolean")


def token_bucket(attempts: DataFrame, per_minute: float, burst: float, key: str = "target") -> DataFrame:
    """When each attempt would have started under a token bucket: ``key, seq, wait_ms``."""

    def replay(_key, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        level, last, rate = burst, None, per_minute / 60
        for frame in frames:
            waits = []
            for at in frame["at"]:
                now = at if last is None else max(at, last)
                if last is not None:
                    level = min(burst, level + (now - last) * rate)
                wait = 0.0 if level >= 1 else (1 - level) / rate
                start = now + wait
                level, last = (level - 1 if wait == 0 else 0.0), start
                ms = (start - at) * 1000
                waits.append(math.floor(ms) + (ms - math.floor(ms) >= 0.5))  # half a millisecond is one, as SQL rounds
            yield pd.DataFrame({key: frame[key], "seq": frame["seq"], "wait_ms": waits})

    rows = attempts.select(key, "seq", F.col("ts").cast("timestamp").cast("double").alias("at"))
    return _ordered_groups(rows, key, ["at", "seq"], replay, f"{key} bigint, seq bigint, wait_ms bigint")


def _ordered_groups(rows: DataFrame, key: str, order: list[str], replay, schema: str) -> DataFrame:
    """``replay`` over each key's rows in order. Rows are dealt by key and sorted by Spark, and stream through a task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def groups():
            for frame in frames:
                for k, part in frame.groupby(key, sort=False):
                    yield k, part

        source = groups()
        pending = next(source, None)
        while pending is not None:
            k = pending[0]

            def same(first=pending, k=k):
                nonlocal pending
                yield first[1]
                for nxt in source:
                    if nxt[0] != k:
                        pending = nxt
                        return
                    yield nxt[1]
                pending = None

            yield from replay(k, same())

    return rows.repartition(key).sortWithinPartitions(key, *order).mapInPandas(run, schema)
