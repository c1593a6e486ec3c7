"""Queries of dossiers, answers, countries, JSON and the consumer's operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, jsonx, text, values
from ..operators import dossiers
from .registry import Tables, plain, query

FACTS = """
    select c_custkey as id, case c_custkey % 4 when 0 then 'Unknown' else c_name end as forename, case c_custkey % 3 when 0 then null else ' ' || c_mktsegment || '  x ' end as surname,
        case c_custkey % 5 when 0 then '21.2.1893' when 1 then '1893' when 2 then 'May 1885' when 3 then '31.02.1900' else null end as born,
        case c_custkey % 3 when 0 then 'rock, Pop , rock' else lower(c_mktsegment) || ',' || c_mktsegment || ', x' end as jobs, case c_custkey % 6 when 0 then '120' when 1 then 'n/a' else cast(c_nationkey as string) end as ranking
    from {customer}"""
MORE = """select s_suppkey as id, s_name as forename, 'Mc' || s_name as surname, case s_suppkey % 4 when 0 then '21.02.1893' when 1 then '05.1885' when 2 then '1900' else null end as born, 'pop,' || s_name as jobs, '50' as ranking from {supplier}"""
_NULLS = "lower({0}) in (" + ", ".join(repr(w) for w in values._NO_VALUE) + ")"
_SQUASH = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"


def _csv(x: str) -> str:
    return f"(select nullif(array_to_string(list_filter(l, lambda x, i: list_position(list_transform(l, lambda z: lower(z)), lower(x)) = i), ','), '') from (select list_filter(list_transform(string_split({x}, ','), lambda x: trim(x)), lambda x: x <> '') as l))"


_CLEAN = f"""(select id, case when {_NULLS.format("forename")} then null else forename end as forename, {_SQUASH.format("surname")} as surname,
    case born when '21.2.1893' then '21.02.1893' when 'May 1885' then '05.1885' when '31.02.1900' then null else born end as born, {_csv("jobs")} as jobs,
    least(100, greatest(0, floor(try_cast(ranking as double) + 0.5)))::int::varchar as ranking0, ranking as raw_ranking from ({{0}}))"""
_CLEAN_A = f"(select * exclude (ranking0, raw_ranking), case when try_cast(raw_ranking as double) is not null then ranking0 end as ranking from {_CLEAN.format(plain(FACTS))})"
_CLEAN_B = f"(select * exclude (ranking0, raw_ranking), case when try_cast(raw_ranking as double) is not null then ranking0 end as ranking from {_CLEAN.format(plain(MORE))})"
_USED = ("forename", "surname", "born", "jobs", "ranking")


def facts(t: Tables, sql: str = FACTS) -> DataFrame:
    return t.sql(sql).select("id", *[dossiers.normalized(F.col(f), f).alias(f) for f in _USED])


@query("M6_M8_L8_sanitized_facts", f"select id, forename, surname, born, jobs, ranking from {_CLEAN_A}")
def sanitized(t: Tables) -> DataFrame:
    return facts(t)


_SHARP = "(length(b.born) > length(a.born) and right(b.born, 4) = right(a.born, 4) and (length(a.born) = 4 or left(right(b.born, 7), 2) = left(right(a.born, 7), 2)))"


@query("M7_A17_J1_merged_facts", f"""
    with m as (select coalesce(a.id, b.id) as id, coalesce(a.forename, b.forename) as forename, coalesce(a.surname, b.surname) as surname,
        case when a.born is null then b.born when {_SHARP} then b.born else a.born end as born, coalesce({_csv("concat_ws(',', a.jobs, b.jobs)")}, null) as jobs, coalesce(a.ranking, b.ranking) as ranking,
        a.forename as f0, a.surname as s0, a.born as b0, a.jobs as j0, a.ranking as r0 from {_CLEAN_A} a full join {_CLEAN_B} b on a.id = b.id)
    select id, forename, surname, born, jobs, ranking, concat_ws(',', case when forename is distinct from f0 then 'forename' end, case when surname is distinct from s0 then 'surname' end,
        case when born is distinct from b0 then 'born' end, case when jobs is distinct from j0 then 'jobs' end, case when ranking is distinct from r0 then 'ranking' end) as filled from m""")
def merged(t: Tables) -> DataFrame:
    return dossiers.merge(facts(t), facts(t, MORE), "id").withColumn("filled", F.array_join("filled", ","))


@query("A9_merged_chunks", f"""select id % 50 as grp, arg_min(forename, id) filter (forename is not null) as forename, arg_min(born, id) filter (born is not null) as born,
    {_csv("string_agg(jobs, ',' order by id)")} as jobs from {_CLEAN_A} group by 1""")
def merged_chunks(t: Tables) -> DataFrame:
    f = facts(t).select((F.col("id") % 50).alias("grp"), F.col("id").alias("chunk"), "forename", "born", "jobs")
    return dossiers.merge_chunks(f, "grp", "chunk")


@query("L6_L11_F9_F10_gaps", f"""
    with d as (select id, born, case when id % 2 = 0 then jobs end as jobs from {_CLEAN_A})
    select id, 'born' as question from d where born is null union all select id, 'birthplace' from d union all select id, 'url' from d union all select id, 'jobs' from d where jobs is null
    union all select id, 'died' from d where 2026 - right(born, 4)::int >= 78 union all select id, 'refine:born' from d where length(born) < 10""")
def open_questions(t: Tables) -> DataFrame:
    none = F.lit(None).cast("string")
    d = facts(t).select("id", "born", F.when(F.col("id") % 2 == 0, F.col("jobs")).alias("jobs"), none.alias("birthplace"), none.alias("url"), none.alias("died"))
    return dossiers.gaps(d, "id", 2026)


WEB = """select p_partkey, case p_partkey % 3 when 0 then 'born' when 1 then 'died' else 'jobs' end as field, case p_partkey % 4 when 0 then '21.02.1893' when 1 then 'unknown' else '1893' end as value,
    case p_partkey % 5 when 0 then 'book' else 'https://x.org/' || p_brand end as source, case p_partkey % 7 when 0 then 0.3 when 1 then null else 0.9 end as confidence,
    case p_partkey % 6 when 0 then '1893' when 3 then '1901' else null end as current, case p_partkey % 8 when 0 then 'alive' when 1 then 'he died' else 'unclear' end as status from {part}"""


@query("L12_L13_L10_web_answers", f"""
    with w as (select *, case when value = 'unknown' then null else value end as v from ({plain(WEB)}))
    select p_partkey, case when v is null then 'not a value' when coalesce(confidence, 1.0) < 0.6 then 'confidence' when source = 'book' then 'no source'
        when field = 'died' and status <> 'he died' then case when status = 'alive' then 'alive' else 'not known to be dead' end
        when current is not null and current <> v and not (current = '1893' and v = '21.02.1893') then 'contradicts' end as reason from w""")
def web_answers(t: Tables) -> DataFrame:
    w = t.sql(WEB).withColumn("confidence", F.col("confidence").cast("double"))
    return dossiers.accept_web(w).select("p_partkey", "reason")


ANSWERS = """select c_custkey, case c_custkey % 4 when 0 then 'Sure: ```json' || chr(10) || '{{"Forename": "' || c_name || '", "metadata": {{"born": "1893"}}, "jobs": ["a", "b"]}}' || chr(10) || '```'
    when 1 then 'forename: ' || c_name || chr(10) || '- born: 1893' when 2 then '{{"a": "}}", "forename": "' || c_name || '", "a": null}}' else 'nothing' end as answer from {customer}"""


@query("L7_F72_F73_F74_F75_F76_V26_answers", f"""select c_custkey, case c_custkey % 4 when 3 then null else 'Customer#' || lpad(c_custkey::varchar, 9, '0') end as forename, case when c_custkey % 4 < 2 then '1893' end as born,
    case when c_custkey % 4 = 0 then 'a,b' end as jobs, c_custkey % 4 in (0, 2) as has_json, case when c_custkey % 4 = 2 then 'a' else '' end as repeated, c_custkey % 4 = 2 as nulls from customer""")
def answers(t: Tables) -> DataFrame:
    a = t.sql(ANSWERS).withColumn("f", jsonx.parse_answer("answer")).withColumn("j", jsonx.extract_json("answer"))
    return a.select("c_custkey", F.col("f")["forename"].alias("forename"), F.col("f")["born"].alias("born"), F.col("f")["jobs"].alias("jobs"), F.try_parse_json("j").isNotNull().alias("valid"), "j").select(
        "c_custkey", "forename", "born", "jobs", F.col("j").isNotNull().alias("has_json"), F.array_join(jsonx.duplicate_keys("j"), ",").alias("repeated"), jsonx.contains_null("j").alias("nulls"))


# --- countries: a dictionary is a parameter; here the nations, each with a code, an alias and a name -------------------

CODES = "select chr(97 + n_nationkey) || 'x' as code, chr(97 + n_nationkey) || 'xy' as code3, n_name as name, lower(replace(n_name, '_', ' land ')) as alias from {nation}"
PLACES = """select c_custkey, case c_custkey % 5 when 0 then upper(chr(97 + c_nationkey)) || 'x' when 1 then chr(97 + c_nationkey) || 'XY ' when 2 then 'Nation Land ' || cast(c_nationkey as string)
    when 3 then 'nation ' || cast(c_nationkey as string) else 'Nati' end as raw from {customer}"""


@query("F67_F68_F69_F70_F71_J14_countries", f"""
    with d as ({plain(CODES)}), p as (select c_custkey, trim(regexp_replace(lower(raw), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) as k from ({plain(PLACES)})),
    keys as (select code as k, code from d union all select code3, code from d union all select alias, code from d union all select replace(lower(name), '_', ' '), code from d)
    select c_custkey, keys.code, d.name from p left join keys on p.k = keys.k left join d on d.code = keys.code""")
def countries(t: Tables) -> DataFrame:
    """Codes, aliases and names by one equi-join on the folded key; a prefix only if it is long enough and unique."""
    d = t.sql(CODES)
    key = lambda c: text.country_key(F.col(c))
    keys = d.select(F.explode(F.array(key("code"), key("code3"), key("alias"), key("name"))).alias("k"), "code")
    sole = keys.groupBy("k").agg(F.min("code").alias("code"), F.countDistinct("code").alias("n")).where("n = 1").drop("n")
    places = t.sql(PLACES).select("c_custkey", text.country_key(F.col("raw")).alias("k"))
    exact = places.join(sole, "k", "left")
    prefix = sole.select("code", F.explode(F.transform(F.sequence(F.greatest(F.lit(4), F.length("k") - 3), F.greatest(F.lit(4), F.length("k") - 1)), lambda n: F.left("k", n))).alias("p"))
    once = prefix.groupBy("p").agg(F.min("code").alias("by_prefix"), F.countDistinct("code").alias("n")).where("n = 1").drop("n")
    found = exact.join(once, exact["k"] == once["p"], "left").withColumn("code", F.coalesce("code", "by_prefix"))
    return found.join(d.select("code", "name"), "code", "left").select("c_custkey", "code", "name")


# --- consumers -------------------------------------------------------------------------------------------------------


@query("L14_L15_Q2_display_names", f"""
    with f as (select id, forename, surname from {_CLEAN_A}),
    l as (select id, list_filter([trim(concat_ws(' ', forename, surname)), surname, nullif(concat_ws(', ', surname, forename), '')], lambda x: x is not null and x <> '') as l from f)
    select id, array_to_string(list_filter(l, lambda x, i: list_position(list_transform(l, lambda z: lower(z)), lower(x)) = i), '|') as names, coalesce(l[1], id::varchar) as shown from l""")
def display_names(t: Tables) -> DataFrame:
    d = F.nullif(F.trim(F.concat_ws(" ", "forename", "surname")), F.lit(""))
    f = facts(t).select("id", dossiers.display_names(d, F.col("surname"), F.col("forename")).alias("names"))
    return f.select("id", F.array_join("names", "|").alias("names"), F.coalesce(F.get("names", F.lit(0)), F.col("id").cast("string")).alias("shown"))


@query("Q1_search", """
    with q as (select distinct split_part(p_name, ' ', 1) || ' ' || p_brand as query from part), w as (select query, unnest(string_split(lower(query), ' ')) as w from q),
    n as (select p_partkey as id, 3 as weight, lower(p_name) as n from part union all select p_partkey, 1, lower(p_brand) from part),
    h as (select query, id, w, max(weight * case when n = w then 100 when starts_with(n, w) then 70 when contains(' ' || n, ' ' || w) then 50 else 25 end) as s from w join n on contains(n, w) group by all)
    select query, id, sum(s)::bigint as score from h group by query, id having count(*) = 2""")
def search(t: Tables) -> DataFrame:
    names = t.part.select(F.col("p_partkey").alias("id"), F.lit(3).alias("weight"), F.col("p_name").alias("name")).unionByName(
        t.part.select(F.col("p_partkey").alias("id"), F.lit(1).alias("weight"), F.col("p_brand").alias("name")))
    queries = t.part.select(F.concat_ws(" ", F.get(F.split("p_name", " "), F.lit(0)), "p_brand").alias("query")).distinct()
    return dossiers.search(names, queries)


RESOURCES = """select page_id, case page_id % 6 when 0 then '^x/a.jpg' when 1 then '../b.jpg' when 2 then '../../../../c.jpg' when 3 then url when 4 then './d//e.txt' else '/f/../g.jpg' end as target, 'base/dir' as base, page_id % 101 as ranking from {pages}"""


@query("Q5_Q6_Q9_resources", f"""select page_id, case page_id % 6 when 0 then '/x/a.jpg' when 1 then '/base/b.jpg' when 2 then '/c.jpg' when 3 then target when 4 then '/base/dir/d/e.txt' else '/g.jpg' end as resolved,
    case when ranking >= 90 then 5 when ranking >= 75 then 4 when ranking >= 55 then 3 when ranking >= 35 then 2 else 1 end as stars,
    case when page_id % 6 in (0, 1, 2, 5) then 'image' when page_id % 6 = 4 then 'text' else 'link' end as shown_as from ({plain(RESOURCES)})""")
def resources(t: Tables) -> DataFrame:
    r = t.sql(RESOURCES)
    shown = F.when(values.is_image(F.col("target")), "image").when(values.extension(F.col("target")) == ".txt", "text").otherwise("link")
    return r.select("page_id", dossiers.resolve_resource(F.col("target"), F.col("base")).alias("resolved"), dossiers.stars(F.col("ranking")).alias("stars"), shown.alias("shown_as"))


@query("Q8_derived_dates", """select o_orderkey, 2000 - extract(year from o_orderdate) - case when (extract(month from o_orderdate), extract(day from o_orderdate)) > (6, 15) then 1 else 0 end as age,
    extract(year from o_orderdate)::varchar || '–2000' as lifespan, extract(month from o_orderdate) = 6 and extract(day from o_orderdate) = 15 and extract(year from o_orderdate) < 2000 as anniversary from orders""")
def derived_dates(t: Tables) -> DataFrame:
    born, today = F.to_date("o_orderdate"), F.lit("2000-06-15").cast("date")
    return t.orders.select("o_orderkey", F.floor(F.months_between(today, born) / 12).cast("long").alias("age"), F.concat(F.year(born).cast("string"), F.lit("–2000")).alias("lifespan"),
                           ((F.month(born) == 6) & (F.day(born) == 15) & (F.year(born) < 2000)).alias("anniversary"))


@query("J10_A14_V17_cross_edition", """select p_brand, count(*)::bigint as editions, count(distinct p_type || '/' || (p_size % 3))::bigint as readings from part group by p_brand having count(distinct p_type || '/' || (p_size % 3)) > 1""")
def cross_edition(t: Tables) -> DataFrame:
    l0 = F.to_json(F.struct("p_type", (F.col("p_size") % 3).alias("s")))
    return t.part.groupBy("p_brand").agg(F.count("*").alias("editions"), F.countDistinct(l0).alias("readings")).where("readings > 1")


@query("U25_U26_identity_cards", f"""select id, 'system' || chr(10) || chr(10) || concat_ws(chr(10), 'forename: ' || forename, 'surname: ' || surname, 'born: ' || born, 'jobs: ' || jobs) as message from {_CLEAN_A}""")
def identity_cards(t: Tables) -> DataFrame:
    lines = [F.concat(F.lit(f"{f}: "), f) for f in ("forename", "surname", "born", "jobs")]
    return facts(t).select("id", F.concat_ws("\n\n", F.lit("system"), F.concat_ws("\n", *lines)).alias("message"))


@query("F54_places", """select c_custkey, case c_custkey % 3 when 0 then 'Town, NATION_' || c_nationkey when 1 then 'Town' else 'NATION_' || c_nationkey end as place from customer""")
def places(t: Tables) -> DataFrame:
    """A place whose last part is a country's code gets the country's name."""
    raw = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("Town, "), F.upper(F.concat(F.char(F.lit(97) + F.col("c_nationkey")), F.lit("xy"))))).when(F.col("c_custkey") % 3 == 1, "Town").otherwise(
        F.upper(F.concat(F.char(F.lit(97) + F.col("c_nationkey")), F.lit("xy"))))
    p = t.customer.select("c_custkey", raw.alias("raw"), F.lit(None).cast("string").alias("known"))
    return dossiers.spelled_places(p, t.sql(CODES)).select("c_custkey", "place")


@query("O3_O4_O12_ordered_report", "select c_custkey::varchar as id, c_name from customer order by c_custkey limit 100")
def ordered(t: Tables) -> DataFrame:
    """The report's first hundred rows, in numeric order of a string id: the limit is the feature."""
    return t.customer.select(F.col("c_custkey").cast("string").alias("id"), "c_name").orderBy(F.col("id").cast("long")).limit(100)


@query("G3_appended_items", "select l_orderkey, count(distinct l_partkey)::bigint as items from lineitem group by l_orderkey")
def appended(t: Tables) -> DataFrame:
    """Items appended by target: those that an order doesn't have yet."""
    first = t.lineitem.where("l_linenumber <= 3").groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("a"))
    rest = t.lineitem.where("l_linenumber > 3").groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("b"))
    none = F.array().cast("array<bigint>")
    both = first.join(rest, "l_orderkey", "full_outer")
    return both.select("l_orderkey", F.size(F.array_union(F.coalesce("a", none), F.coalesce("b", none))).cast("long").alias("items"))
