"""Queries of catalogue merges and rules, over index rows, names, dossiers and files derived from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import values
from ..operators import catalogue
from .registry import Tables, plain, query

ROWS = """
    select c_custkey as position, case c_custkey % 23 when 1 then cast(c_custkey - 1 as string) when 2 then '0' || cast(c_custkey as string) else cast(c_custkey as string) end as id,
        case c_custkey % 17 when 4 then null else c_name end as title,
        case c_custkey % 7 when 0 then 'ru' when 1 then 'ru,en' when 2 then 'en,de,en' when 3 then 'RU,xx' else 'de,ru' end as lang,
        case c_custkey % 11 when 0 then 'hidden' when 1 then 'Composer' when 2 then null else lower(c_mktsegment) end as type,
        case c_custkey % 5 when 0 then 'm' when 1 then 'F' when 2 then 'x' else null end as gender,
        case c_custkey % 6 when 0 then 'c' || cast(c_nationkey as string) when 1 then 'C' || cast(c_nationkey as string) when 2 then 'zz' else null end as country,
        case c_custkey % 19 when 3 then null when 5 then '/ru/' || lower(replace(c_name, '#', '_')) || '.bio.md' when 6 then '/bad name ' || cast(c_custkey as string) || '.md'
            when 7 then '/same.md' else '/' || lower(replace(c_name, '#', '_')) || '.bio.md' end as md,
        case c_custkey % 4 when 0 then '/' || lower(replace(c_name, '#', '_')) || '.json' else null end as json,
        case c_custkey % 9 when 0 then '/pages/x.jpg' when 1 then 'photo/' || cast(c_custkey as string) || '.jpg' else null end as img
    from {customer}"""
_ROWS = plain(ROWS)
COUNTRIES = "select 'c' || cast(n_nationkey as string) as code from {nation}"
_LANGS = values.LANGUAGES
_ACCEPTED = f"""
    named as (select *, regexp_replace(regexp_extract(md, '[^/]*$'), '(?i)(\\.bio)?\\.md$', '') as slug, regexp_full_match(id, '0|[1-9][0-9]*') as id_ok from ({_ROWS})),
    ranked as (select *, case when id_ok then row_number() over (partition by id order by position) end as id_rank from named),
    r as (select *, case when coalesce(id_rank = 1 and md is not null, false) then row_number() over (partition by slug, coalesce(id_rank = 1 and md is not null, false) order by position) end as slug_rank from ranked),
    alive as (select *, string_split(lang, ',') as ls from r where id_rank = 1 and md is not null), sound as (select * from alive where slug_rank = 1)"""

_V_ROWS = f"""
    with {_ACCEPTED}
    select position, 'INV-2' as invariant, 'error' as severity from r where not id_ok
    union all select position, 'INV-1', 'error' from r where id_rank > 1
    union all select position, 'INV-5', 'error' from r where id_rank = 1 and md is null
    union all select position, 'INV-4', 'error' from alive where not regexp_full_match(slug, '[A-Za-z0-9_.-]+')
    union all select position, 'INV-3', 'error' from alive where slug_rank > 1
    union all select position, 'INV-5', 'error' from sound where title is null or type is null
    union all select position, 'INV-5', 'error' from sound where regexp_matches(md, '(^|/)({"|".join(_LANGS)})/')
    union all select position, 'INV-9', 'error' from sound where country is not null and lower(country) not in (select code from ({plain(COUNTRIES)}))
    union all select position, 'INV-10', 'error' from sound where lower(gender) not in ('m', 'f', 'mixed')
    union all select position, 'INV-11', 'error' from sound where len(list_distinct(ls)) < len(ls) or len(list_filter(ls, lambda x: x not in {_LANGS})) > 0
    union all select position, 'INV-24', 'warning' from sound where type = 'hidden' and (img is not null or gender is not null)
    union all select position, 'INV-25', 'warning' from sound where country <> lower(country) or lang <> lower(lang) or type <> lower(type) or starts_with(img, '/pages/')"""


@query("V1_V2_V3_V4_V5_V9_V10_V11_V24_V25_W1_M1_row_rules", _V_ROWS)
def row_rules(t: Tables) -> DataFrame:
    return catalogue.row_findings(t.sql(ROWS), t.sql(COUNTRIES))


@query("A6_A18_findings_by_rule", f"select invariant, severity, count(*)::bigint as n from ({_V_ROWS}) group by all")
def findings_by_rule(t: Tables) -> DataFrame:
    return catalogue.by_invariant(catalogue.row_findings(t.sql(ROWS), t.sql(COUNTRIES)))


NAMES = """select case s_suppkey % 3 when 0 then 'ru' else 'en' end as lang, case s_suppkey % 13 when 0 then '07' else cast(s_suppkey * 2 as string) end as id,
    case s_suppkey % 5 when 0 then array('Customer#' || lpad(cast(s_suppkey * 2 as string), 9, '0')) when 1 then array(s_name, upper(s_name)) when 2 then array('ab', s_name) else array(s_name, 'Other ' || s_name) end as aliases
    from {supplier}"""
_NAMES = plain(NAMES).replace("array(", "list_value(")
_FOLD = "lower(strip_accents({}))"


@query("V12_V13_V14_V28_J2_name_rules", f"""
    with n as (select lang, id, aliases, list_transform(aliases, lambda a: lower(a)) as f from ({_NAMES})),
    titled as (select id, arg_min(title, position) as title from ({_ROWS}) group by id), j as (select n.*, title from n left join titled using (id))
    select lang, id, 'INV-2' as invariant, 'error' as severity from j where not regexp_full_match(id, '0|[1-9][0-9]*')
    union all select lang, id, 'INV-12', 'error' from j where title is null
    union all select lang, id, 'INV-14', 'warning' from j where len(aliases) = 1 and f[1] = lower(title)
    union all select lang, id, 'INV-28', 'warning' from j where len(list_distinct(f)) < len(f) or len(list_filter(aliases, lambda a: length(a) < 3)) > 0""")
def name_rules(t: Tables) -> DataFrame:
    return catalogue.name_findings(t.sql(NAMES), t.sql(ROWS))


DOSSIERS = """select p_partkey, 'd/' || cast(p_partkey as string) || '.json' as path, case p_partkey % 4 when 0 then 'ru' when 1 then 'en' else 'de' end as lang,
    cast(case p_partkey % 9 when 0 then 120 when 1 then -1 else p_size end as double) as ranking,
    case p_partkey % 6 when 0 then '31.02.1900' when 1 then '1.13.1900' when 2 then '05.1885' when 3 then 'May 1885' else null end as born,
    'https://x.org/' || cast(p_partkey % 5 as string) as url, case p_partkey % 3 when 0 then 'Гитара ' || p_name else p_name || ' plain words' end as prose,
    case p_partkey % 7 when 0 then null else p_name end as label, case p_partkey % 5 when 0 then 'Embedded' when 1 then 'https://x.org/1' else p_brand end as target,
    case p_partkey % 8 when 0 then 'tab' else 'SCAN' end as kind from {part}"""


@query("V0_V18_V20_V21_V22_V27_dossier_rules", f"""
    with d as ({plain(DOSSIERS)}), p as (select *, string_split(born, '.') as b from d)
    select path, 'INV-20' as invariant, 'error' as severity from d where not ranking between 0 and 100
    union all select path, 'INV-21', 'error' from p where born is not null and not case when regexp_full_match(born, '\\d{{1,2}}\\.\\d{{1,2}}\\.\\d{{4}}') then b[1]::int between 1 and 31 and b[2]::int between 1 and 12
        when regexp_full_match(born, '\\d{{1,2}}\\.\\d{{4}}') then b[1]::int between 1 and 12 else regexp_full_match(born, '\\d{{4}}') end
    union all select path, 'INV-22', 'error' from d where label is null or target is null or lower(target) = 'embedded' and target <> 'embedded'
    union all select path, 'INV-27', 'warning' from d where target = url
    union all select path, 'SCHEMA', 'error' from d where not regexp_full_match(kind, '[A-Z][A-Z0-9_]*')
    union all select path, 'INV-18', 'warning' from d where lang in ('ru', 'zh', 'ja', 'ko') and regexp_full_match(prose, '[\\x20-\\x7E]*') and length(prose) >= 8
        or lang in ('en', 'de', 'es', 'fr') and regexp_matches(prose, '\\p{{Cyrillic}}')""")
def dossier_rules(t: Tables) -> DataFrame:
    d = t.sql(DOSSIERS).withColumn("documents", F.array(F.struct("label", "target", F.col("kind").alias("type"))))
    return catalogue.dossier_findings(d)


FILES = """select lang || md as path from (select 'ru' as lang, md, c_custkey from (select c_custkey, '/' || lower(replace(c_name, '#', '_')) || '.bio.md' as md from {customer}) a union all
    select 'de' as lang, md, c_custkey from (select c_custkey, '/' || lower(replace(c_name, '#', '_')) || '.bio.md' as md from {customer}) b) f where c_custkey % 3 <> 1"""


@query("V8_J3_G8_editions", f"""
    with w as (select distinct id, unnest(list_distinct(string_split(lang, ','))) as lang, md, json from ({_ROWS})),
    p as (select id, lang, lang || '/' || md as missing from w where md is not null union all select id, lang, lang || '/' || json from w where json is not null)
    select id, lang, missing from p where missing not in (select replace(path, '/', '//') from ({plain(FILES)}))""")
def editions(t: Tables) -> DataFrame:
    rows = t.sql(ROWS).select("id", "lang", "md", "json").distinct()
    return catalogue.edition_findings(rows, t.sql(FILES).select(F.replace("path", F.lit("/"), F.lit("//")).alias("path")))


EXISTING = """select s_suppkey as position, cast(s_suppkey as string) as id, 'e' || cast(s_suppkey as string) as slug, '/old' || cast(s_suppkey as string) || '.md' as md,
    case s_suppkey % 2 when 0 then '/j.json' else null end as json, s_name as title, case s_suppkey % 3 when 0 then 'composer' else null end as type, cast(null as string) as gender,
    case s_suppkey % 4 when 0 then 'es' else null end as country, cast(null as string) as img from {supplier}"""
UPDATES = """select 'e' || cast(c_custkey as string) as slug, case c_custkey % 5 when 0 then null else '/new' || cast(c_custkey as string) || '.md' end as md, case c_custkey % 6 when 0 then null else '/n.json' end as json,
    case c_custkey % 7 when 0 then null else c_name end as title, case c_custkey % 8 when 0 then null when 2 then null else 'composer' end as type, case c_custkey % 2 when 0 then 'm' else null end as gender, 'de' as country, 'i.jpg' as img from {customer} where c_custkey % 2 = 0"""


@query("M2_M3_W2_index_upsert", f"""
    with e as ({plain(EXISTING)}), u as (select * replace (coalesce(type, case when json is null then 'hidden' else 'musician' end) as type) from ({plain(UPDATES)})), top as (select max(id::bigint) as i, max(position) as p from e),
    fresh as (select *, row_number() over (order by slug) as n from u where slug not in (select slug from e))
    select e.slug, e.id, e.position, coalesce(u.md, e.md) as md, coalesce(e.json, u.json) as json, coalesce(e.title, u.title) as title, coalesce(e.type, u.type) as type,
        coalesce(e.gender, u.gender) as gender, coalesce(e.country, u.country) as country, coalesce(e.img, u.img) as img from e left join u using (slug)
    union all select slug, (i + n)::varchar, p + n, md, json, coalesce(title, slug), type, gender, country, img from fresh, top""")
def index_upsert(t: Tables) -> DataFrame:
    return catalogue.upsert(t.sql(EXISTING), t.sql(UPDATES))


@query("G2_merge_languages", """
    select c_custkey, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ',') as langs from (select c_custkey, list_concat(list_concat(['ru'],
        list_filter(d, lambda x: not (list_contains(c, x) and not list_contains(v, x)))), v) as l from (select c_custkey, case c_custkey % 3 when 0 then ['en', 'de'] when 1 then ['fr'] else ['ru', 'es'] end as d,
        case c_custkey % 4 when 0 then ['de', 'fr'] else ['en'] end as c, case c_custkey % 5 when 0 then ['it'] else ['de'] end as v from customer))""")
def merged_languages(t: Tables) -> DataFrame:
    pick = lambda n, *sets: F.when(F.col("c_custkey") % n == 0, F.array(*map(F.lit, sets[0]))).otherwise(F.array(*map(F.lit, sets[1])))
    d = F.when(F.col("c_custkey") % 3 == 0, F.array(F.lit("en"), F.lit("de"))).when(F.col("c_custkey") % 3 == 1, F.array(F.lit("fr"))).otherwise(F.array(F.lit("ru"), F.lit("es")))
    langs = catalogue.merge_languages(F.lit("ru"), d, pick(4, ("de", "fr"), ("en",)), pick(5, ("it",), ("de",)))
    return t.customer.select("c_custkey", F.array_join(langs, ",").alias("langs"))


ADDED = """select 'en' as lang, cast(c_custkey as string) as id, case c_custkey % 3 when 0 then array(c_name, 'xy') when 1 then array('Supplier#' || lpad(cast(c_custkey as string), 9, '0'), lower(c_name)) else array(c_mktsegment, c_name) end as aliases from {customer}"""
KNOWN = "select 'en' as lang, cast(s_suppkey as string) as id, array(s_name, 'Älias ' || s_name) as aliases from {supplier}"


@query("M5_G4_G5_G7_merge_names", f"""
    with e as ({plain(KNOWN).replace("array(", "list_value(")}), n as ({plain(ADDED).replace("array(", "list_value(")}),
    j as (select coalesce(e.lang, n.lang) as lang, coalesce(e.id, n.id) as id, coalesce(e.aliases, []) as old, coalesce(n.aliases, []) as new from e full join n on e.lang = n.lang and e.id = n.id),
    a as (select lang, id, old, case when len(old) > 0 then list_concat(old, list_filter(new, lambda a: length(a) >= 3)) else list_concat(new[1:1], list_filter(new[2:], lambda a: length(a) >= 3)) end as l from j),
    f as (select lang, id, old, list_filter(l, lambda x, i: list_position(list_transform(l, lambda z: lower(strip_accents(z))), lower(strip_accents(x))) = i) as k from a)
    select lang, id, array_to_string(k, '|') as aliases, k is distinct from old as changed from f""")
def merged_names(t: Tables) -> DataFrame:
    return catalogue.merge_names(t.sql(KNOWN), t.sql(ADDED)).withColumn("aliases", F.array_join("aliases", "|"))
