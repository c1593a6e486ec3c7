"""Queries of calls, run control and the rules that need raw JSON or file lists."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text, values
from ..operators import catalogue, gateway, journal, markdown
from .journals import TARGETS
from .registry import Tables, plain, query


def shout(target: str, prompt: str) -> str:
    """A stand-in for a model: upper-cases, fails on some prompts, and target ``a`` is often out of order."""
    if target == "a" and len(prompt) % 3 == 0:
        raise gateway.CallError("server")
    if len(prompt) % 11 == 0:
        raise gateway.CallError("invalid_request")
    return prompt.upper()


@query("L1_L2_A8_X4_calls_with_fallback", """
    with p as (select p_partkey, length(p_name) as n, p_name from part)
    select p_partkey, case when n % 11 = 0 then null else upper(p_name) end as answer, (case when n % 33 = 0 then 4 when n % 11 = 0 then 1 when n % 3 = 0 then 4 else 1 end)::int as attempts,
        case when n % 11 = 0 then 'invalid_request' else 'success' end as outcome from p""")
def calls(t: Tables) -> DataFrame:
    got = gateway.ask(t.part, "p_partkey", "p_name", shout, ["a", "b"])
    return got.select("p_partkey", "answer", F.size("attempts").alias("attempts"), F.element_at("attempts", -1)["outcome"].alias("outcome"))


def long_enough(prompt: str, answer: str) -> bool:
    return len(answer) >= 12


@query("L3_L10_U13_escalation", """select p_partkey, case when length(p_name) >= 12 then upper(p_name) else upper(p_name || ' ' || p_type) end as answer, case when length(p_name) >= 12 then 0 else 1 end::int as rung
    from part where length(p_name) >= 12 and length(p_name) % 11 <> 0 or length(p_name || ' ' || p_type) >= 12 and length(p_name || ' ' || p_type) % 11 <> 0 and length(p_name) < 12""")
def escalation(t: Tables) -> DataFrame:
    d = t.part.withColumn("full", F.concat_ws(" ", "p_name", "p_type"))
    return gateway.escalate(d, "p_partkey", ["p_name", "full"], shout, ["b"], long_enough, gateway.Policy(attempts=1))


@query("L4_L5_J8_translate_units", """
    with u as (select distinct sha256(p_name)[:8] as key, p_name as unit from part union all select 'n0', '123')
    select key, case when key = 'n0' then '123' when key < '8' then 'known ' || unit else upper(unit) end as translation from u where key < '8' or key = 'n0' or length(unit) % 11 <> 0""")
def translated(t: Tables) -> DataFrame:
    units = t.part.select(text.unit_key(F.col("p_name")).alias("key"), F.col("p_name").alias("unit")).distinct()
    memory = units.where("key < '8'").select("key", F.concat(F.lit("known "), "unit").alias("translation"))
    wordless = t.spark.createDataFrame([("n0", "123")], "key string, unit string")
    return gateway.translate_units(units.unionByName(wordless), memory, shout, ["a", "b"])[0]


_SWAP = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz', 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ')".format


@query("L16_L17_U17_translation_pipeline", f"""
    select doc_id, md5('# ' || {_SWAP("'Doc ' || doc_id")} || chr(10) || chr(10) || '::: image' || chr(10) || 'src: img/' || doc_id || '.jpg' || chr(10) || 'caption: ' || {_SWAP("'A *photo* of ' || source")} || chr(10) || ':::' || chr(10) || chr(10)
        || {_SWAP("coalesce(text, '')")} || chr(10) || chr(10) || '## wORKS' || chr(10) || '| pIECE | tAB |' || chr(10) || '|---|---|' || chr(10) || '| ' || {_SWAP("'Étude '")} || (doc_id % 7) || ' | [' || {_SWAP("lang")} || '](music/' || (doc_id % 9) || '.mid) |' || chr(10)
        || chr(10) || '```' || chr(10) || '::: image' || chr(10) || '[x](y.mp3)' || chr(10) || '```' || chr(10) || '> A [LINK](https://x.org/' || source || ' "T")' || chr(10) || '- ITEM' || chr(10) || '1. ONE' || chr(10) || '---') as translated,
        true as same_structure, true as restored from documents""")
def translation_pipeline(t: Tables) -> DataFrame:
    """Spans of each article translated (letters of the other case), put back, and its structure compared with the source's."""
    from .texts import articles

    turn = str.maketrans({**{chr(c): chr(c + 32) for c in range(65, 91)}, **{chr(c + 32): chr(c) for c in range(65, 91)}})

    def swapped(x: str) -> str:
        found = markdown.spans(x)
        return markdown.apply_spans(x, found, {s.text: s.text.translate(turn) for s in found})

    def rows(x: str) -> list[tuple]:
        made = swapped(x)
        return [(hashlib.md5(made.encode()).hexdigest(), not markdown.differences(x, made), swapped(made) == x)]

    return markdown.generate(articles(t), "doc_id", "body", rows, "translated string, same_structure boolean, restored boolean")


RAW = """select c_custkey as id, case c_custkey % 6 when 0 then '{{"title": "x", "born": "1893"}}' when 1 then '[1]' when 2 then '{{"metadata": {{"title": "t", "url": "u"}}}}' when 3 then '{{"metadata": 5}}'
    when 4 then '{{"catalog": {{"type": "composer", "img": "i"}}, "metadata": {{}}}}' else '{{bad' end as raw from {customer}"""


@query("V7_V19_M6a_M6b_raw_dossiers", """
    select c_custkey as id, case c_custkey % 6 when 0 then 'INV-7' when 1 then 'INV-19' when 2 then 'INV-7' when 3 then 'INV-19' when 4 then 'INV-7' else 'SCHEMA' end as invariant,
        case c_custkey % 6 when 0 then 'x' when 2 then 't' end as title, case c_custkey % 6 when 4 then 'composer' end as type from customer""")
def raw_dossiers(t: Tables) -> DataFrame:
    """Identity members where they don't belong, lifted into hints: the catalogue's win over the root's over metadata's."""
    v = t.sql(RAW).withColumn("v", F.try_parse_json("raw"))
    get = lambda p: F.try_variant_get("v", p, "string")
    lift = lambda f: F.coalesce(get(f"$.catalog.{f}"), get(f"$.{f}"), get(f"$.metadata.{f}"))
    kind, meta = F.schema_of_variant("v"), F.schema_of_variant(F.try_variant_get("v", "$.metadata", "variant"))
    hints = [F.coalesce(get(f"$.{f}"), get(f"$.metadata.{f}")).isNotNull() for f in ("title", "type", "gender", "country", "img", "id", "bio")]
    lifted = F.try_variant_get("v", "$.catalog", "variant").isNotNull()
    for h in hints:
        lifted = lifted | h
    bad = F.when(F.col("v").isNull(), "SCHEMA").when(~kind.startswith("OBJECT") | (meta.isNotNull() & ~meta.startswith("OBJECT")), "INV-19").when(lifted, "INV-7")
    return v.select("id", bad.alias("invariant"), lift("title").alias("title"), lift("type").alias("type"))


@query("V23_stray_files", """select page_id, 'en/' || page_id || case page_id % 4 when 0 then '.md' when 1 then '.json' when 2 then '.jpg' else '' end as path from pages where page_id % 4 in (2, 3)""")
def stray_files(t: Tables) -> DataFrame:
    ext = F.when(F.col("page_id") % 4 == 0, ".md").when(F.col("page_id") % 4 == 1, ".json").when(F.col("page_id") % 4 == 2, ".jpg").otherwise("")
    files = t.pages.select("page_id", F.concat(F.lit("en/"), F.col("page_id").cast("string"), ext).alias("path"))
    return files.where(F.col("path").rlike("^(?:" + "|".join(values.LANGUAGES) + ")/") & ~F.col("path").rlike("\\.(?:md|json)$"))


@query("F85_O11_capabilities", """select s_suppkey, len(list_filter(need, lambda x: not list_contains(cap, x))) = 0 as able from (select s_suppkey, case s_suppkey % 3 when 0 then ['json'] else ['json', 'vision'] end as need,
    case s_suppkey % 4 when 0 then ['json', 'vision', 'tools'] when 1 then ['json'] else [] end as cap from supplier)""")
def capabilities(t: Tables) -> DataFrame:
    arr = lambda *xs: F.array(*map(F.lit, xs)).cast("array<string>")
    need = F.when(F.col("s_suppkey") % 3 == 0, arr("json")).otherwise(arr("json", "vision"))
    cap = F.when(F.col("s_suppkey") % 4 == 0, arr("json", "vision", "tools")).when(F.col("s_suppkey") % 4 == 1, arr("json")).otherwise(arr())
    return t.supplier.select("s_suppkey", (F.size(F.array_except(need, cap)) == 0).alias("able"))


def _fixed(x: str, digits: int) -> str:
    """``printf`` rounds the exact value, ties to even; here ties, which are odd multiples of 2 ** -(digits + 1), go up."""
    tie = f"({x}) * {2 ** (digits + 1)} = floor(({x}) * {2 ** (digits + 1)}) and ({x}) * {2**digits} <> floor(({x}) * {2**digits}) and ({x}) * {2 * 10**digits} = floor(({x}) * {2 * 10**digits})"
    return f"printf('%.{digits}f', case when {tie} then ({x}) + {0.1 / 10**digits:.9f} else {x} end)"


#: Token counts, costs, durations and labels of all magnitudes, ties among them.
AMOUNTS = """select o_orderkey, o_orderpriority, cast(case o_orderkey % 4 when 0 then floor(o_totalprice) % 1000 when 1 then floor(o_totalprice) * 97 when 2 then floor(o_totalprice / 50) * 50 else floor(o_totalprice) end as bigint) as n,
    cast(case o_orderkey % 5 when 0 then 0 when 1 then o_totalprice / 1e9 when 2 then floor(o_totalprice) / 32 else o_totalprice / 1e6 end as double) as usd,
    cast(case o_orderkey % 3 when 0 then floor(o_totalprice) % 1000 + 0.5 when 1 then floor(o_totalprice) % 59900 else o_totalprice * 10 end as double) as ms from {orders}"""


@query("F56_report_formats", f"""select o_orderkey, case when n < 1000 then n::varchar when n < 1000000 then {_fixed("n / 1000.0::double", 1)} || 'k' else {_fixed("n / 1000000.0::double", 2)} || 'M' end as tokens,
    case when usd = 0 then '$0' when usd < 0.01 then '$' || {_fixed("usd", 5)} else '$' || {_fixed("usd", 4)} end as cost,
    case when ms < 1000 then floor(ms + 0.5)::bigint || 'ms' when ms / 1000 < 60 then {_fixed("ms / 1000", 1)} || 's'
        else floor(ms / 1000 / 60)::bigint || 'm ' || floor(ms / 1000 - floor(ms / 1000 / 60) * 60 + 0.5)::bigint || 's' end as duration,
    case when length(o_orderpriority) > 6 then o_orderpriority[1:5] || '…' else o_orderpriority end as label from ({plain(AMOUNTS)})""")
def formats(t: Tables) -> DataFrame:
    return t.sql(AMOUNTS).select(
        "o_orderkey", values.format_tokens(F.col("n")).alias("tokens"), values.format_cost(F.col("usd")).alias("cost"), values.format_duration(F.col("ms")).alias("duration"),
        values.truncate(F.col("o_orderpriority"), 6).alias("label"))


@query("Q7_Q11_listing", """select lower(c_mktsegment) as facet, count(*)::bigint as shown from customer where c_custkey % 11 <> 0 group by 1""")
def listing(t: Tables) -> DataFrame:
    """Facet counts without hidden rows."""
    from .catalogues import ROWS

    r = t.sql(ROWS).select("position", F.when(F.col("type") == "hidden", True).otherwise(False).alias("hidden"))
    c = t.customer.join(r.withColumnRenamed("position", "c_custkey"), "c_custkey").where("not hidden")
    return c.groupBy(F.lower("c_mktsegment").alias("facet")).agg(F.count("*").alias("shown"))


@query("R7_R8_run_status", """select user_id as run, case when count(*) filter (event_type = 'signup') > 0 then 'aborted' when count(*) filter (event_type = 'error') > 0 then 'failed' else 'completed' end as status from events group by user_id""")
def run_status(t: Tables) -> DataFrame:
    c = F.col("event_type")
    return t.events.groupBy(F.col("user_id").alias("run")).agg(F.when(F.count_if(c == "signup") > 0, "aborted").when(F.count_if(c == "error") > 0, "failed").otherwise("completed").alias("status"))


@query("R9_R14_cost_preview", """
    with m as (select s_nationkey % 5 as pool, min(0.1 + (s_suppkey * 13 % 29) / 10.0) as price from supplier group by 1), r as (select p_size % 5 as pool, (p_partkey * 71) % 8000 as tokens from part)
    select pool, count(*)::bigint as tasks, round(sum(tokens * price / 1e6 + 1024 * price * 4 / 1e6), 6) as cost from r join m using (pool) group by pool""")
def cost_preview(t: Tables) -> DataFrame:
    from .journals import REQUESTS

    m = t.sql(TARGETS).groupBy("pool").agg(F.min(F.col("price").cast("double")).alias("price"))
    zero = F.lit(0)
    cost = journal.cost(F.col("tokens"), zero, F.lit(1024), zero, F.col("price"), F.col("price") * 4)
    return t.sql(REQUESTS).join(m, "pool").groupBy("pool").agg(F.count("*").alias("tasks"), F.round(F.sum(cost), 6).alias("cost"))


@query("R14_routing_preview", f"""select pool, target, row_number() over (partition by pool order by usable < 4000, case when usable < 4000 then -usable end, price, weight desc, pos)::int as rank, usable < 4000 as overflows
    from (select *, floor(window_size * 0.9) - least(512, most_out) as usable from ({plain(TARGETS)}))""")
def routing_preview(t: Tables) -> DataFrame:
    return journal.routed_chain(t.sql(TARGETS), 4000).select("pool", "target", "rank", "overflows")


@query("Q11_row_normalization")
def normalized_rows(t: Tables) -> DataFrame:
    from .catalogues import ROWS

    return catalogue.read_rows(t.sql(ROWS)).select("id", "slug", "title", "type", "gender", "country", F.array_join("lang", ",").alias("lang"))
