"""Queries of the scalar operators, over messy values derived from the tables in SQL that both engines read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text, values
from .registry import Tables, plain, query

# --- text ------------------------------------------------------------------------------------------------------------

_CLASSES = """
    select doc_id, regexp_matches(t, '\\p{L}') as has_letters, regexp_full_match(t, '[\\x20-\\x7E]*') as ascii,
        regexp_matches(t, '\\p{L}') and not regexp_matches(regexp_replace(t, '\\p{Latin}|\\P{L}', '', 'g'), '.') as latin,
        regexp_matches(t, '\\p{Cyrillic}') as cyrillic,
        case when regexp_matches(t, '\\p{Cyrillic}') then 'cyrillic' else 'latin' end as script,
        length(regexp_replace(regexp_replace(t, '^[\\s\\pZ]+', ''), '[\\s\\pZ]+$', ''))::bigint as trimmed
    from (select doc_id, coalesce(text, '') as t from documents)"""


@query("F11_F36_F37_F38_F40_F51_text_classes", _CLASSES)
def text_classes(t: Tables) -> DataFrame:
    c = F.coalesce("text", F.lit(""))
    return t.documents.select(
        "doc_id", text.has_letters(c).alias("has_letters"), text.is_ascii(c).alias("ascii"), text.is_latin(c).alias("latin"),
        text.has_cyrillic(c).alias("cyrillic"), text.script_of(c).alias("script"),
        F.coalesce(F.length(text.text_or_null(c)), F.lit(0)).cast("long").alias("trimmed"),
    )


_FOLDS = """
    select doc_id, md5(trim(regexp_replace(f, '\\s+', ' ', 'g'))) as name_key,
        md5(regexp_replace(regexp_replace(f, '[^\\p{L}\\p{N}]+', '-', 'g'), '^-+|-+$', '', 'g')) as vocabulary_key,
        md5(trim(regexp_replace(f, '[^\\p{L}\\p{N}]+', ' ', 'g'))) as country_key,
        md5(regexp_replace(replace(f, 'ß', 'ss'), '[^\\p{L}]+', '', 'g')) as letters_key,
        md5(strip_accents(replace(t, 'ß', 'ss'))) as ascii
    from (select doc_id, coalesce(text, '') as t, lower(strip_accents(coalesce(text, ''))) as f from documents)"""


@query("F29_F30_F31_F32_F33_folds", _FOLDS)
def folds(t: Tables) -> DataFrame:
    c = F.coalesce("text", F.lit(""))
    return t.documents.select(
        "doc_id", F.md5(text.fold_name(c)).alias("name_key"), F.md5(text.vocabulary_key(c)).alias("vocabulary_key"),
        F.md5(text.country_key(c)).alias("country_key"), F.md5(text.name_fold(c)).alias("letters_key"), F.md5(text.fold_ascii(c)).alias("ascii"),
    )


def _nested(expr: str, pairs) -> str:
    return reduce(lambda x, ab: f"replace({x}, '{ab[0]}', '{ab[1]}')", pairs, expr)


#: Names spelled in Cyrillic, one for each customer: letters by key, in three cases.
_CYRILLIC = """select c_custkey, case c_custkey % 3 when 0 then w when 1 then upper(w) else upper(substr(w, 1, 1)) || substr(w, 2) end as name
    from (select c_custkey, translate(cast(c_custkey * 7919 as string), '0123456789', 'жщюяёйьхцч') || 'о' || translate(cast(c_custkey as string), '0123456789', 'абвгдеиклм') as w
        from {customer})"""


def _roman_sql(expr: str) -> str:
    pairs = list(text.ROMAN.items())
    pairs += [(a.upper(), b[:1].upper() + b[1:]) for a, b in pairs if a.upper() != a]
    return _nested(expr, pairs)


@query("F34_F35_romanize", f"""select c_custkey, name, {_roman_sql('name')} as roman, {_roman_sql('name')} as plain_ascii
    from ({plain(_CYRILLIC)})""")
def romanize(t: Tables) -> DataFrame:
    return t.sql(_CYRILLIC).select("c_custkey", "name", text.romanize(F.col("name")).alias("roman"), text.to_ascii(F.col("name")).alias("plain_ascii"))


def _phonetic_sql(word: str) -> str:
    steps = [*text.PHONETIC[:-1]]
    out = reduce(lambda x, ab: f"regexp_replace({x}, '{ab[0]}', '{ab[1]}', 'g')", steps, word)
    # Repeated letters without back references: one pass for each letter that the data hold.
    for c in "abcdefghiklmnoprstuväöüßéèêçñíóúáàâûîô":
        out = f"regexp_replace({out}, '{c}{c}+', '{c}', 'g')"
    return out


_WORDS = "select word, count(*) as n from (select unnest(regexp_extract_all(lower(strip_accents(replace(text, 'ß', 'ss'))), '\\p{L}+')) as word from documents) group by word"


@query("F44_A11_phonetic_keys", f"""
    select case when length(s) <= 2 then s else s[1] || regexp_replace(s[2:-2], '[aeiou]', '', 'g') || s[-1] end as phonetic,
        count(*)::bigint as words, sum(n)::bigint as uses, min(word) as first_word
    from (select word, n, {_phonetic_sql('word')} as s from ({_WORDS})) group by 1""")
def phonetic_keys(t: Tables) -> DataFrame:
    words = t.documents.select(F.explode(F.regexp_extract_all(F.lower(text.fold_ascii(F.col("text"))), F.lit("\\p{L}+"), F.lit(0))).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("n"))  # keys are computed once a word, not once a use
    return counted.groupBy(text.phonetic_key(F.col("word")).alias("phonetic")).agg(
        F.count("*").alias("words"), F.sum("n").alias("uses"), F.min("word").alias("first_word"))


_TOKENS = """select p_partkey, replace(p_name, ' ', '_') || '-' || lower(p_brand) || case p_partkey % 4 when 0 then '.cd07' when 1 then '(copy)' when 2 then '+van_Ärm' else ' x' end as raw
    from {part}"""


@query("F39_F41_F42_F43_name_tokens", f"""
    with s as (select p_partkey, raw, list_filter(list_transform(regexp_split_to_array(raw, '[\\s_\\-.+()\\[\\]]+'),
            lambda x: regexp_replace(lower(strip_accents(x)), '[^\\p{{L}}]+', '', 'g')), lambda x: x <> '') as tokens,
        list_filter(regexp_split_to_array(raw, '[-_]+'), lambda x: x <> '') as parts from ({plain(_TOKENS)}))
    select p_partkey, array_to_string(tokens, ',') as tokens,
        array_to_string(list_filter(tokens, lambda x: not (x in ({", ".join(f"'{w}'" for w in text.NOISE)}) or length(x) < 2)), ',') as names,
        len(list_filter(tokens, lambda x: x in ({", ".join(f"'{w}'" for w in text.PARTICLES)})))::int as particles,
        array_to_string(list_transform(parts, lambda p: upper(p[1]) || p[2:]), ' ') as display from s""")
def name_tokens(t: Tables) -> DataFrame:
    s = t.sql(_TOKENS).select("p_partkey", "raw", text.split_tokens(F.col("raw")).alias("tokens"))
    return s.select(
        "p_partkey", F.array_join("tokens", ",").alias("tokens"),
        F.array_join(F.filter("tokens", lambda x: ~text.is_noise(x)), ",").alias("names"),
        F.size(F.filter("tokens", text.is_particle)).alias("particles"), text.deslug(F.col("raw")).alias("display"),
    )


_MARKED = """select p_partkey, '*' || p_name || '* [' || p_type || '](https://x.org/' || cast(p_partkey as string) || ' "t")  _' || p_brand || '_ \\[' || cast(p_size as string) || '\\] `code`' as raw
    from {part}"""
_MARKED_SPARK = _MARKED.replace("\\[", "\\\\[").replace("\\]", "\\\\]")


@query("F48_strip_markdown", f"""
    select p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw,
        '\\[([^\\]]*)\\]\\(\\s*[^)\\s]+(?:\\s+"[^"]*")?\\s*\\)', '\\1', 'g'), '[*_`]', '', 'g'), '\\\\([\\[\\]])', '\\1', 'g'), '\\s+', ' ', 'g')) as bare
    from ({plain(_MARKED)})""")
def strip_markdown(t: Tables) -> DataFrame:
    return t.sql(_MARKED_SPARK).select("p_partkey", text.strip_markdown(F.col("raw")).alias("bare"))


# --- dates -----------------------------------------------------------------------------------------------------------

_DATES = """
    select o_orderkey, y, m, d, case o_orderkey % 16
        when 0 then y || '-' || lpad(m, 2, '0') || '-' || lpad(d, 2, '0')
        when 1 then d || '.' || m || '.' || y
        when 2 then ' c. ' || y || ' '
        when 3 then lpad(m, 2, '0') || '.' || y
        when 4 then y || '-' || m
        when 5 then d || '/' || m || '/' || y || ','
        when 6 then '31.' || m || '.' || y
        when 7 then y || '-' || cast(cast(y as int) + 5 as string)
        when 8 then y || ' г.'
        when 9 then d || 'th of ' || name || ' ' || y
        when 10 then name || ' ' || d || ', ' || y
        when 11 then name || ' ' || y
        when 12 then 'around ' || name || ' ' || y
        when 13 then d || '.' || cast(cast(m as int) + 6 as string) || '.' || y
        when 14 then o_orderpriority || ' ' || y
        else '' end as raw
    from (select o_orderkey, o_orderpriority, cast(extract(year from o_orderdate) as string) as y, cast(extract(month from o_orderdate) as string) as m,
        cast(extract(day from o_orderdate) as string) as d,
        case extract(month from o_orderdate) when 1 then 'January' when 2 then 'Februar' when 3 then 'марта' when 4 then 'avril' when 5 then 'мая'
            when 6 then 'junio' when 7 then 'Juli' when 8 then 'agosto' when 9 then 'сентября' when 10 then 'Oktober' when 11 then 'November' else 'décembre' end as name
        from {orders}) x"""
#: What each form states, from the parts it was made of: the authored forms read back.
_DATES_SQL = f"""
    with raw as ({plain(_DATES)}),
    parts as (select o_orderkey, raw, o_orderkey % 16 as k, y::int as y, m::int as m, d::int as d from raw),
    stated as (select o_orderkey, raw,
        case when k in (7, 14, 15) then null when k in (13) and m + 6 > 12 then null else y end as y,
        case when k in (0, 1, 3, 4, 5, 6, 9, 10, 11, 12) then m when k = 13 then m + 6 end as m,
        case when k in (0, 1, 5, 9, 10, 13) then d when k = 6 then 31 end as d from parts),
    known as (select o_orderkey, raw, case when d is null or m is null or m <= 12 and d <= day(last_day(make_date(y, m, 1))) then y end as y, m, d from stated)
    select o_orderkey, raw,
        case when y is null then null when d is not null then lpad(d::varchar, 2, '0') || '.' || lpad(m::varchar, 2, '0') || '.' || y
            when m is not null then lpad(m::varchar, 2, '0') || '.' || y else y::varchar end as value,
        case when y is null then null when d is not null then 'day' when m is not null then 'month' else 'year' end as precision,
        case when y is null or m is null then null when d is not null then lpad(d::varchar, 2, '0') || '.' || lpad(m::varchar, 2, '0') || '.' || y
            else lpad(m::varchar, 2, '0') || '.' || y end as at_least_month,
        regexp_full_match(trim(raw), '\\d{{1,2}}\\.\\d{{1,2}}\\.\\d{{4}}') and coalesce(try_cast(split_part(trim(raw), '.', 1) as int) between 1 and 31, false)
            and coalesce(try_cast(split_part(trim(raw), '.', 2) as int) between 1 and 12, false) as reader_accepts,
        coalesce(y is not null and m is not null, false) as sharper_than_year, 2026 - y as age from known"""


@query("F1_F10_dates", _DATES_SQL)
def date_forms(t: Tables) -> DataFrame:
    raw = F.col("raw")
    d = dates.parse_date(raw)
    return t.sql(_DATES).select("o_orderkey", "raw", "y", d.alias("d")).select(
        "o_orderkey", "raw", F.col("d.value").alias("value"), F.col("d.precision").alias("precision"),
        F.when(F.col("d.precision").isin("day", "month"), F.col("d.value")).alias("at_least_month"),
        dates.is_valid_date(raw).alias("reader_accepts"),
        F.coalesce(F.col("d.month").isNotNull() & (F.col("d.year").cast("string") == F.col("y")), F.lit(False)).alias("sharper_than_year"),
        (F.lit(2026) - F.col("d.year")).alias("age"),
    )


@query("F8_refines_date", f"""
    with k as ({_DATES_SQL})
    select o_orderkey, coalesce(precision in ('month', 'day'), false) as refines_year,
        coalesce(precision = 'day', false) as refines_month from k""")
def refines(t: Tables) -> DataFrame:
    v = t.sql(_DATES).withColumn("value", dates.parse_date(F.col("raw"))["value"])
    year, month = F.right("value", F.lit(4)), F.right("value", F.lit(7))
    return v.select("o_orderkey", dates.refines(year, F.col("value")).alias("refines_year"), dates.refines(month, F.col("value")).alias("refines_month"))


# --- lists, ids, paths ------------------------------------------------------------------------------------------------

_LISTS = """select p_partkey, p_name || ' , ' || upper(p_type) || ',, ' || p_name || ',' || lower(p_type) || ',  ' || replace(p_name, ' ', '   ') as raw,
    p_brand || ', ' || p_type as more from {part}"""


def _csv_sql(expr: str) -> str:
    items = f"list_filter(list_transform(string_split({expr}, ','), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> '')"
    return f"(select array_to_string(list_filter(l, lambda x, i: list_position(list_transform(l, lambda z: lower(z)), lower(x)) = i), ',') from (select {items} as l))"


@query("F12_F13_F14_G1_csv_lists", f"select p_partkey, {_csv_sql('raw')} as list, {_csv_sql(chr(39).join(['raw || ', ',', ' || more']))} as merged from ({plain(_LISTS)})")
def csv_lists(t: Tables) -> DataFrame:
    raw = F.col("raw")
    return t.sql(_LISTS).select("p_partkey", text.csv_list(raw).alias("list"), text.merge_csv(raw, F.col("more")).alias("merged"))


_NUMBERS = """select l_orderkey, l_partkey, l_suppkey, l_linenumber, case l_linenumber % 5 when 0 then cast(l_quantity * 3 - 20 as string) when 1 then ' ' || cast(cast(l_quantity as int) as string)
    when 2 then '' when 3 then 'n/a' else cast(l_extendedprice as string) end as raw,
    case l_partkey % 4 when 0 then cast(l_partkey as string) when 1 then '0' || cast(l_partkey as string) when 2 then ' ' || cast(l_partkey as string) else '-' || cast(l_partkey as string) end as id
    from {lineitem}"""


@query("F15_F26_rankings_and_ids", f"""
    select raw, id, case when trim(raw) = '' then 0 when try_cast(trim(raw) as double) is null then null else least(100, greatest(0, floor(try_cast(trim(raw) as double) + 0.5)))::int end as ranking,
        case when regexp_full_match(trim(id), '0|[1-9][0-9]*') then trim(id) end as canonical, count(*)::bigint as n
    from ({plain(_NUMBERS)}) group by all""")
def rankings(t: Tables) -> DataFrame:
    return t.sql(_NUMBERS).groupBy("raw", "id").agg(F.count("*").alias("n")).select(
        "raw", "id", values.ranking(F.col("raw")).alias("ranking"), values.canonical_id(F.col("id")).alias("canonical"), "n")


_PATHS = """select page_id, url, case page_id % 8 when 0 then ' Embedded' when 1 then 'de/music/' || cast(page_id as string) || '.MP3' when 2 then '/./a//../b.jpg'
    when 3 then 'xx/photo.png?x=1' when 4 then url when 5 then '//cdn/x.mid' when 6 then 'articles\\\\en\\\\a_b.BIO.md' else 'en/x/..hidden' end as raw from {pages}"""
_PATHS_DUCK = plain(_PATHS).replace("\\\\", "\\")
_OPAQUE = "regexp_matches(r, '(?i)^(?:[a-z][a-z0-9+.-]*:|//|[?#])')"
_EXT = "lower(regexp_extract(string_split(regexp_extract(r, '^[^?#]*'), '/')[-1], '^.+(\\.[^.]*)$', 1))"
_SEG = "list_filter(string_split(r, '/'), lambda p: p not in ('', '.', '..'))"


@query("F16_F25_F55_targets_and_paths", f"""
    select page_id, regexp_replace(lower(regexp_extract(url, '^(?:https?://[^/?#]+)', 0)), ':80$', '') || regexp_replace(regexp_extract(url, '^https?://[^/?#]+(.*)$', 1), '^([^/]|$)', '/\\1') as url,
        case when lower(r) = 'embedded' then 'embedded' when regexp_extract(r, '^([a-z]{{2}})/', 1) in {values.LANGUAGES} and not {_OPAQUE} then r[4:] else r end as target,
        {_EXT} as extension, {_EXT} in {tuple(values.AUDIO)} as audio, {_EXT} in {tuple(values.IMAGE)} as image, {_OPAQUE} as opaque,
        regexp_replace(regexp_extract(r, '[^/\\\\]*$'), '(?i)(?:\\.bio)?\\.md$', '') as slug,
        regexp_full_match(regexp_replace(regexp_extract(r, '[^/\\\\]*$'), '(?i)(?:\\.bio)?\\.md$', ''), '[A-Za-z0-9_.-]+') as slug_ok,
        case when {_OPAQUE} then r when regexp_matches(r, '[?#]') then null when len({_SEG}) > 0 then '/' || array_to_string({_SEG}, '/') end as content_path,
        case when {_OPAQUE} then r when len({_SEG}) > 0 then array_to_string({_SEG}, '/') end as asset_path
    from (select page_id, url, trim(raw) as r from ({_PATHS_DUCK}))""")
def targets(t: Tables) -> DataFrame:
    r = F.trim("raw")
    return t.sql(_PATHS).select(
        "page_id", values.url(F.col("url")).alias("url"), values.target(r).alias("target"), values.extension(r).alias("extension"),
        values.is_audio(r).alias("audio"), values.is_image(r).alias("image"), values.is_opaque(F.trim(r)).alias("opaque"), values.slug(r).alias("slug"),
        values.is_slug(values.slug(r)).alias("slug_ok"), values.content_path(r).alias("content_path"), values.asset_path(r).alias("asset_path"),
    )


_LANGS = """select c_custkey, case c_custkey % 6 when 0 then 'ru,en-US, ru' when 1 then 'ch,JP,kr' when 2 then 'gr , xx' when 3 then ''
    when 4 then 'Deutsch,fr_FR,' || lower(substr(c_mktsegment, 1, 2)) else lower(substr(c_mktsegment, 1, 2)) || ',ua' end as raw from {customer}"""


@query("F27_F28_languages", f"""
    with c as (select c_custkey, list_transform(string_split(raw, ','), lambda x: regexp_extract(lower(trim(x)), '^[^-_]*')) as l from ({plain(_LANGS)})),
    f as (select c_custkey, list_filter(list_transform(l, lambda x: case x when 'ch' then 'zh' when 'cn' then 'zh' when 'jp' then 'ja' when 'kr' then 'ko' when 'ua' then 'uk' when 'gr' then 'el' else x end),
        lambda x: x in {values.LANGUAGES}) as l from c)
    select c_custkey, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ',') as languages from f""")
def language_lists(t: Tables) -> DataFrame:
    return t.sql(_LANGS).select("c_custkey", F.array_join(values.languages(F.col("raw")), ",").alias("languages"))


# --- hashes and estimates --------------------------------------------------------------------------------------------


@query("F57_F58_F59_F60_F61_F62_S2_R1_R2_hashes", """
    select doc_id, sha256(t)[:16] as content_hash, octet_length(encode(t))::bigint as bytes, sha256(regexp_replace(regexp_replace(t, '^[\\s\\pZ]+', ''), '[\\s\\pZ]+$', ''))[:8] as unit_key,
        case when t = '' then 0 else ceil(length(t) / greatest(1.0, 3.2 * (1 - 0.45 * length(regexp_replace(t, '[\\x00-\\x7F]+', '', 'g')) / length(t)))) end::bigint as tokens,
        sha256('translate|' || lang || '/' || doc_id || '|en')[:12] as task_id,
        sha256('{"contract":"v1","promptVersion":"p1","sourceHash":"' || sha256(t)[:16] || '","taskId":"' || sha256('translate|' || lang || '/' || doc_id || '|en')[:12] || '"}')[:16] as fingerprint,
        floor(length(t) * 3.2)::bigint as chars_for
    from (select doc_id, lang, coalesce(text, '') as t from documents)""")
def hashes(t: Tables) -> DataFrame:
    c = F.coalesce("text", F.lit(""))
    task = text.short_hash(F.concat(F.lit("translate|"), F.col("lang"), F.lit("/"), F.col("doc_id").cast("string"), F.lit("|en")), 12)
    content = text.short_hash(c, 16)
    return t.documents.select(
        "doc_id", content.alias("content_hash"), F.octet_length(c).cast("long").alias("bytes"), text.unit_key(c).alias("unit_key"),
        text.estimate_tokens(c).alias("tokens"), task.alias("task_id"),
        text.structure_hash({"taskId": task, "sourceHash": content, "promptVersion": F.lit("p1"), "contract": F.lit("v1")}).alias("fingerprint"),
        text.chars_for_tokens(F.length(c)).alias("chars_for"),
    )


# --- vocabulary ------------------------------------------------------------------------------------------------------

_TERMS = """select p_partkey, case p_partkey % 12 when 0 then 'Guitarist, Composer' when 1 then 'Guitar  Player' when 2 then 'дирижёр' when 3 then 'hidden/page' when 4 then 'luthier und Verlag'
    when 5 then 'Historian' when 6 then '' when 7 then p_type when 8 then 'певец и исполнитель' when 9 then 'musico' when 10 then 'Éditor, x' else p_brand end as craft,
    case p_partkey % 8 when 0 then 'Male' when 1 then 'женщина' when 2 then 'Group ' when 3 then p_type when 4 then 'W' when 5 then 'Ансамбль' when 6 then 'муж' else '' end as gender,
    case p_partkey % 7 when 0 then 'Tab' when 1 then 'афиша' when 2 then p_name when 3 then 'link!' when 4 then p_brand when 5 then 'Дискография' else '  ' end as kind from {part}"""


def _key_sql(x: str) -> str:
    return f"regexp_replace(regexp_replace(lower(strip_accents({x})), '[^\\p{{L}}\\p{{N}}]+', '-', 'g'), '^-+|-+$', '', 'g')"


def _case_sql(x: str, words: dict[str, str]) -> str:
    return "case " + " ".join(f"when {x} in ({', '.join(repr(w) for w in line.split())}) then '{k}'" for k, line in words.items()) + " end"


@query("F63_F64_F65_F66_vocabulary", f"""
    with raw as ({plain(_TERMS)}),
    parts as (select p_partkey, {_key_sql('part')} as k from (select p_partkey, unnest(regexp_split_to_array(trim(craft), '(?i)[,;/|+]|\\s+(?:and|und|и)\\s+')) as part from raw)),
    crafts as (select p_partkey, list_distinct(list({_case_sql('k', values.TYPE_WORDS)})) as c from parts where k <> '' group by p_partkey)
    select raw.p_partkey, case when list_contains(c, 'hidden') then 'hidden' when len(c) = 1 then c[1] when len(c) > 1 then 'musician' end as entry_type,
        {_case_sql(_key_sql('gender'), values.GENDER_WORDS)} as gender,
        case when {_key_sql('kind')} = '' then null else coalesce({_case_sql(_key_sql('kind'), values.DOCUMENT_WORDS)},
            nullif(regexp_extract(regexp_replace(regexp_replace(upper(trim(kind)), '[^A-Z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), '^[A-Z][A-Z0-9_]*$'), '')) end as document_type
    from raw left join crafts using (p_partkey)""")
def vocabulary(t: Tables) -> DataFrame:
    return t.sql(_TERMS).select(
        "p_partkey", values.entry_type(F.col("craft")).alias("entry_type"), values.gender(F.col("gender")).alias("gender"),
        values.document_type(F.col("kind")).alias("document_type"),
    )


_STATED = """select c_custkey, case c_custkey % 6 when 0 then ' Unknown ' when 1 then c_name when 2 then 'нет данных' when 3 then c_mktsegment || '   x' when 4 then '' else 'N/A' end as raw,
    case c_custkey % 3 when 0 then 'card.metadata.title' when 1 then 'born' else 'a.b' end as field from {customer}"""


@query("F52_F53_F77_stated_values", f"""
    select c_custkey, case when lower(v) in ({', '.join(repr(w) for w in values._NO_VALUE)}) or v = '' then null else v end as stated,
        case when regexp_extract(field, '[^.]*$') = 'title' then 'latin' else regexp_extract(field, '[^.]*$') end as card_key,
        regexp_full_match(field, 'card\\.[^.]+\\.title|born') as selected
    from (select c_custkey, field, trim(regexp_replace(raw, '\\s+', ' ', 'g')) as v from ({plain(_STATED)}))""")
def stated_values(t: Tables) -> DataFrame:
    return t.sql(_STATED).select(
        "c_custkey", values.stated(F.col("raw")).alias("stated"), values.card_key(F.col("field")).alias("card_key"),
        F.col("field").rlike(values.path_pattern(["card.*.title", "born"])).alias("selected"),
    )
