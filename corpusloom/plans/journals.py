"""Queries over the ``events`` table read as a run journal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import journal
from .registry import Tables, plain, query

ATTEMPTS = """
    select event_id as seq, ts, user_id % 25 as target, user_id as run, case event_type when 'error' then 'failure' when 'view' then 'failure' else 'success' end as outcome, event_type,
        cast(floor(value * 100) as bigint) as latency_ms, cast(regexp_extract(props, '[0-9]+', 0) as bigint) * 17 as prompt, cast(regexp_extract(props, '[0-9]+', 0) as bigint) * 5 as cached,
        cast(floor(value * 7) as bigint) as completion, cast(floor(value * 3) as bigint) as reasoning,
        case event_id % 9 when 0 then 'Maximum context length is 8192' when 1 then 'quota exceeded' when 2 then 'The model x does not exist' when 3 then 'fetch failed' when 4 then 'request timed out'
            when 5 then 'content filter hit' else event_type end as message,
        case event_id % 7 when 0 then 429 when 1 then 401 when 2 then 503 when 3 then 400 when 4 then 404 else null end as status,
        case event_id % 6 when 0 then '250ms' when 1 then '1.5s' when 2 then '2m' when 3 then '7' when 4 then 'soon' else null end as retry_after
    from {events}"""
_DUCK = plain(ATTEMPTS)
_COST = "((prompt - least(cached, prompt)) * 0.6 + least(cached, prompt) * 0.15 + greatest(0, completion - reasoning) * 2.4 + reasoning * 2.4) / 1e6"
_PRICED = f"(select *, {_COST} as cost from ({_DUCK}))"


def attempts(t: Tables) -> DataFrame:
    c = F.col
    return t.sql(ATTEMPTS).withColumn("cost", journal.cost(c("prompt"), c("cached"), c("completion"), c("reasoning"), F.lit(0.6), F.lit(2.4), F.lit(0.15)))


@query("A2_A7_A8_run_totals", f"""select target, count(*)::bigint as requests, count(*) filter (outcome = 'success')::bigint as successes, count(*) filter (outcome = 'failure')::bigint as failures,
    sum(prompt)::bigint as prompt, sum(completion)::bigint as completion, sum(latency_ms)::bigint as latency_ms, max(ts) as last_used, round(sum(cost), 6) as cost from {_PRICED} group by target""")
def run_totals(t: Tables) -> DataFrame:
    return journal.totals(attempts(t), "target")


@query("F82_F83_A16_costs", f"""select seq, round({_COST}, 9) as cost, round(coalesce(case when seq % 5 = 0 then latency_ms / 1e6 end, {_COST}), 9) as resolved,
    round(reasoning / greatest(1, completion)::double, 9) as reasoning_share, greatest(0, floor(prompt * 0.9) - least(512, completion))::bigint as usable from ({_DUCK})""")
def costs(t: Tables) -> DataFrame:
    c = F.col
    return attempts(t).select(
        "seq", F.round("cost", 9).alias("cost"), F.round(F.coalesce(F.when(c("seq") % 5 == 0, c("latency_ms") / 1e6), "cost"), 9).alias("resolved"),
        F.round(c("reasoning") / F.greatest(F.lit(1), "completion"), 9).alias("reasoning_share"),
        journal.usable_tokens(c("prompt"), F.lit(0.9), F.lit(512), c("completion")).alias("usable"),
    )


#: Errors as providers word them: a message, a status and a code, in all combinations that the events' numbers give.
ERRORS = """
    select event_id as seq, ts, event_id % 8 + 1 as attempt,
        case event_id % 19 when 0 then 'This model''s Maximum Context length is 8192' when 1 then 'Prompt is too long' when 2 then 'please reduce the length' when 3 then 'Content filter hit'
            when 4 then 'output was flagged' when 5 then 'Payment Required' when 6 then 'insufficient credit' when 7 then 'quota exceeded' when 8 then 'Model x is unavailable' when 9 then 'unknown model'
            when 10 then 'no healthy deployment' when 11 then 'socket hang up' when 12 then 'fetch failed' when 13 then 'request timed out' when 14 then 'time out' when 15 then null else event_type end as message,
        case event_id % 17 when 0 then 400 when 1 then 401 when 2 then 402 when 3 then 403 when 4 then 404 when 5 then 408 when 6 then 409 when 7 then 413 when 8 then 422 when 9 then 429 when 10 then 500
            when 11 then 503 when 12 then 418 else null end as status,
        case event_id % 5 when 0 then 'EPIPE' when 1 then 'context_length_exceeded' when 2 then 'E_OTHER' else null end as code,
        case event_id % 9 when 0 then '7' when 1 then '1.5' when 2 then '-3' when 3 then 'soon' when 4 then 'Wed, 21 Oct 2015 07:28:00 GMT' when 5 then 'Fri, 01 Jan 2100 00:00:00 GMT' else null end as retry_after,
        case event_id % 7 when 0 then '250ms' when 1 then '1.5s' when 2 then '2m' when 3 then '1h' when 4 then '20' when 5 then 'later' else null end as reset
    from {events}"""

#: The kinds case by case, as a table of what is asked first.
_KIND = """case when said like '%context length%' or said like '%context_length%' or said like '%maximum context%' or said like '%too many tokens%' or said like '%prompt is too long%' or said like '%reduce the length%'
        then 'context_length'
    when said like '%content filter%' or said like '%content_policy%' or said like '%safety%' or said like '%flagged%' then 'content_filter'
    when said like '%insufficient%' or said like '%quota%' or said like '%billing%' or said like '%credit%' or said like '%payment required%' then 'quota'
    when said like '%model %not found%' or said like '%model %unavailable%' or said like '%model %does not exist%' or said like '%unknown model%' or said like '%no healthy deployment%' then 'model_unavailable'
    when status in (402) then 'quota' when status in (401, 403) then 'auth' when status = 404 then 'model_unavailable' when status in (408, 409) then 'timeout' when status in (413, 422) then 'context_length'
    when status = 429 then 'rate_limit' when status >= 500 then 'server' when status >= 400 then 'invalid_request'
    when code = 'EPIPE' or said like '%fetch failed%' or said like '%socket hang up%' or said like '%network%' then 'network'
    when said like '%timed out%' or said like '%timeout%' or said like '%time out%' then 'timeout' else 'unknown' end"""


@query("A3_F87_F89_errors_by_kind", f"""select kind, kind in ('rate_limit', 'timeout', 'network', 'server', 'response_format') as retryable, kind <> 'invalid_request' as fallbackable, count(*)::bigint as n
    from (select {_KIND} as kind from (select *, lower(coalesce(code, '') || ' ' || coalesce(message, '')) as said from ({plain(ERRORS)}))) group by kind""")
def errors_by_kind(t: Tables) -> DataFrame:
    k = t.sql(ERRORS).groupBy(journal.error_kind(F.col("message"), F.col("status"), F.col("code")).alias("kind")).agg(F.count("*").alias("n"))
    d = journal.disposition(F.col("kind"))
    return k.select("kind", d["retryable"].alias("retryable"), d["fallbackable"].alias("fallbackable"), "n").orderBy(F.desc("n"), "kind")


@query("F86_F88_retry_delays", f"""with m as (select seq, attempt, coalesce(
        case retry_after when '7' then 7000 when '1.5' then 1500 when '-3' then 0 when 'Wed, 21 Oct 2015 07:28:00 GMT' then greatest(0, epoch_us(timestamp '2015-10-21 07:28:00') // 1000 - epoch_us(ts) // 1000)
            when 'Fri, 01 Jan 2100 00:00:00 GMT' then greatest(0, epoch_us(timestamp '2100-01-01') // 1000 - epoch_us(ts) // 1000) end,
        case reset when '250ms' then 250 when '1.5s' then 1500 when '2m' then 120000 when '1h' then 3600000 when '20' then 20000 end)::bigint as wish from ({plain(ERRORS)}))
    select seq, wish as retry_after_ms, coalesce(least(30000, wish), least(30000, 1000 * 2 ** (attempt - 1)))::bigint as delay_ms from m""")
def retry_delays(t: Tables) -> DataFrame:
    wish = journal.retry_after_ms(F.col("retry_after"), F.col("ts"), F.col("reset"))
    return t.sql(ERRORS).select("seq", wish.alias("retry_after_ms"), journal.backoff_ms(F.col("attempt"), retry_after=wish).alias("delay_ms"))


@query("W7_failure_streaks", f"""with i as (select *, sum((outcome = 'success')::int) over (partition by target order by ts, seq) as island from ({_DUCK}))
    select seq, target, sum((outcome = 'failure')::int) over (partition by target, island order by ts, seq)::bigint as streak from i""")
def failure_streaks(t: Tables) -> DataFrame:
    return journal.failure_streak(t.sql(ATTEMPTS)).select("seq", "target", "streak")


@query("W10_budget_guard", f"""select seq, run, round(coalesce(sum(cost) over w, 0), 9) as spent_before, coalesce(sum(cost) over w, 0) >= 0.05 as tripped from {_PRICED}
    window w as (partition by run order by ts, seq rows between unbounded preceding and 1 preceding)""")
def budget_guard(t: Tables) -> DataFrame:
    return journal.budget(attempts(t), "run", 0.05).select("seq", "run", F.round("spent_before", 9).alias("spent_before"), "tripped")


@query("W11_K6_journal_sequence", f"select seq, run, (row_number() over (partition by run order by ts, seq) - 1)::int as seq_no from ({_DUCK})")
def journal_sequence(t: Tables) -> DataFrame:
    return journal.numbered(t.sql(ATTEMPTS), "run", "ts", "seq").select("seq", "run", "seq_no")


#: Attempts of each target in order, for step-by-step replays in recursive SQL.
_STEPS = f"o as (select target, seq, outcome, epoch_us(ts) / 1e6 as moment, row_number() over (partition by target order by ts, seq) as n from ({_DUCK}))"


@query("W8_circuit_breaker", f"""
    with recursive {_STEPS},
    r as (select distinct target, 0::bigint as n, null::bigint as seq, 'closed' as state, 0 as failures, 0.0::double as opened, 0 as used, null::varchar as shown, null::boolean as passed from o
        union all select target, n, seq, case when not ok then s1 when outcome = 'success' then 'closed' when s1 = 'half-open' or failures + 1 >= 3 then 'open' else s1 end,
            case when not ok then failures when outcome = 'success' or s1 = 'half-open' or failures + 1 >= 3 then 0 else failures + 1 end,
            case when ok and outcome <> 'success' and (s1 = 'half-open' or failures + 1 >= 3) then moment else opened end, u1 + case when ok and s1 = 'half-open' then 1 else 0 end, s1, ok
        from (select *, s1 = 'closed' or (s1 = 'half-open' and u1 < 1) as ok from (select o.*, r.failures, r.opened,
            case when r.state = 'open' and o.moment - r.opened >= 600 then 'half-open' else r.state end as s1, case when r.state = 'open' and o.moment - r.opened >= 600 then 0 else r.used end as u1
            from r join o on o.target = r.target and o.n = r.n + 1)))
    select target, seq, shown as state, passed from r where n > 0""")
def circuit_breaker(t: Tables) -> DataFrame:
    return journal.breaker(t.sql(ATTEMPTS))


@query("W9_token_bucket", f"""
    with recursive {_STEPS},
    r as (select distinct target, 0::bigint as n, null::bigint as seq, 3.0::double as level, null::double as last, null::bigint as wait_ms from o
        union all select target, n, seq, case when wait = 0 then l1 - 1 else 0 end, now + wait, round((now + wait - moment) * 1000)::bigint
        from (select *, case when l1 >= 1 then 0.0::double else (1 - l1) / (2.0::double / 60) end as wait from (select o.target, o.n, o.seq, o.moment, greatest(o.moment, coalesce(r.last, o.moment)) as now,
            case when r.last is null then r.level else least(3.0::double, r.level + (greatest(o.moment, r.last) - r.last) * (2.0::double / 60)) end as l1 from r join o on o.target = r.target and o.n = r.n + 1)))
    select target, seq, wait_ms from r where n > 0""")
def token_bucket(t: Tables) -> DataFrame:
    return journal.token_bucket(t.sql(ATTEMPTS), per_minute=2.0, burst=3.0)


@query("K7_M9_S9_checkpoint_upsert", f"""select prompt as fingerprint, arg_max(outcome, (ts, seq)) as status, max(ts) as updated_at, count(*)::bigint as attempts,
    arg_max(outcome, (ts, seq)) = 'success' as done from ({_DUCK}) group by prompt""")
def checkpoint(t: Tables) -> DataFrame:
    last = F.max_by("outcome", F.struct("ts", "seq"))
    return t.sql(ATTEMPTS).groupBy(F.col("prompt").alias("fingerprint")).agg(
        last.alias("status"), F.max("ts").alias("updated_at"), F.count("*").alias("attempts"), (last == "success").alias("done"))


@query("A4_A5_plan_preview_skips", f"""select event_type as pipeline, count(*)::bigint as tasks, count(*) filter (cached = 0)::bigint as free_tasks, sum(prompt)::bigint as tokens,
    count(*) filter (outcome = 'success')::bigint as skipped_done, round(sum(case when outcome = 'success' then 0 else (prompt * 0.6 + 1024 * 2.4) / 1e6 end), 6) as cost from ({_DUCK}) group by event_type""")
def plan_preview(t: Tables) -> DataFrame:
    ok = F.col("outcome") == "success"
    price = (F.col("prompt") * 0.6 + 1024 * 2.4) / 1e6
    return t.sql(ATTEMPTS).groupBy(F.col("event_type").alias("pipeline")).agg(
        F.count("*").alias("tasks"), F.count_if(F.col("cached") == 0).alias("free_tasks"), F.sum("prompt").alias("tokens"),
        F.count_if(ok).alias("skipped_done"), F.round(F.sum(F.when(ok, 0.0).otherwise(price)), 6).alias("cost"))


@query("K12_paid_results_discarded", f"select seq, target, round(cost, 9) as cost from {_PRICED} where event_type = 'view' and cost > 0.001")
def paid_discarded(t: Tables) -> DataFrame:
    return attempts(t).where("event_type = 'view' and cost > 0.001").select("seq", "target", F.round("cost", 9).alias("cost"))


# --- routing ---------------------------------------------------------------------------------------------------------

#: Suppliers as model targets: window, output limit, price, weight, failures in a row.
TARGETS = """select s_suppkey as target, s_nationkey % 5 as pool, 2000 + (s_suppkey * 37) % 9000 as window_size, 256 + s_suppkey % 512 as most_out, 0.1 + (s_suppkey * 13 % 29) / 10.0 as price,
    s_suppkey % 4 as weight, s_suppkey % 3 as failures, s_suppkey as pos from {supplier}"""
#: Parts as requests: a pool and an input size.
REQUESTS = "select p_partkey as request, p_size % 5 as pool, (p_partkey * 71) % 8000 as tokens, p_partkey as seq from {part}"
_ROUTED = f"""select r.request, m.target, m.pool, floor(window_size * 0.9) - least(512, most_out) as usable, tokens, price, weight, failures, pos, r.seq,
    floor(window_size * 0.9) - least(512, most_out) - tokens as headroom, tokens <= floor(window_size * 0.9) - least(512, most_out) as fits
    from ({plain(REQUESTS)}) r join ({plain(TARGETS)}) m using (pool)"""
_FIT = "fits desc, case when not fits then headroom end desc"


@query("O5_O6_O7_O9_O10_O11_J11_J12_routing", f"""
    with r as ({_ROUTED}), o as (select request, target,
        row_number() over (partition by request order by {_FIT}, price, weight desc, pos) as by_cost,
        row_number() over (partition by request order by headroom desc, price, pos) as by_context,
        row_number() over (partition by request order by {_FIT}, pos) as sequential,
        row_number() over (partition by request order by {_FIT}, failures, price, pos) as least_failures from r)
    select request, max(target) filter (by_cost = 1) as by_cost, max(target) filter (by_context = 1) as by_context, max(target) filter (sequential = 1) as sequential,
        max(target) filter (least_failures = 1) as least_failures from o group by request""")
def routing(t: Tables) -> DataFrame:
    c = F.col
    usable = journal.usable_tokens(c("window_size"), F.lit(0.9), F.lit(512), c("most_out"))
    m = t.sql(TARGETS).withColumn("usable", F.when(c("window_size").isNotNull(), usable))
    return journal.first_choices(t.sql(REQUESTS), m, {
        "by_cost": [c("price"), -c("weight"), c("pos")], "by_context": [c("price"), c("pos")], "sequential": [c("pos")],
        "least_failures": [c("failures"), c("price"), c("pos")]}, widest=("by_context",))


@query("O8_W6_round_robin", f"""with m as (select *, row_number() over (partition by pool order by pos) - 1 as p, count(*) over (partition by pool) as n from ({plain(TARGETS)}))
    select request, arg_min(target, (p - seq % n + n) % n) as target from ({plain(REQUESTS)}) r join m using (pool) group by request""")
def round_robin(t: Tables) -> DataFrame:
    return journal.in_turn(t.sql(REQUESTS), t.sql(TARGETS))


@query("A15_largest_window", f"select pool, max(floor(window_size * 0.9) - least(512, most_out))::bigint as usable from ({plain(TARGETS)}) group by pool")
def largest_window(t: Tables) -> DataFrame:
    m = t.sql(TARGETS).withColumn("usable", journal.usable_tokens(F.col("window_size"), F.lit(0.9), F.lit(512), F.col("most_out")))
    return m.groupBy("pool").agg(F.max("usable").alias("usable"))
