"""Queries of name-to-image linkage: images named after parts, and names to look for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import similarity
from ..operators import linkage
from .registry import Tables, plain, query

IMAGES = """
    select p_partkey, case p_partkey % 8 when 0 then 'photo/' || substr(p_name, 1, 1) || '/' || replace(p_name, ' ', '_') || cast(p_partkey as string) || '.jpg'
        when 1 then 'photo/x/unused/' || replace(p_name, ' ', '-') || '.png' when 2 then 'articles/' || replace(p_name, ' ', '_') || '/cover_' || cast(p_partkey as string) || '.jpg'
        when 3 then 'photo/' || replace(p_name, ' ', '') || '_cd05.jpg' when 4 then 'music/scores/' || p_name || '.gif' when 5 then 'photos/z/' || substr(p_name, 1, 1) || '_' || split_part(p_name, ' ', 2) || '.jpg'
        when 6 then 'photo/' || split_part(p_name, ' ', 2) || '_with_' || lower(p_type) || '.jpg' else 'photo/' || lower(p_type) || '/' || split_part(p_name, ' ', 2) || '.jpg' end as rel_path,
        cast(40 + p_size * 13 as int) as width, cast(60 + (p_partkey * 7) % 700 as int) as height, (40 + p_size * 13) * (60 + (p_partkey * 7) % 700) / 1e6 as mp,
        case p_partkey % 3 when 0 then 'portrait' when 1 then 'square' else 'landscape' end as orientation, case p_partkey % 4 when 0 then 'bw' when 1 then 'color' else 'unknown' end as color,
        case p_size % 7 when 0 then 'portrait' when 1 then 'upper_body' when 2 then 'full_body' when 3 then 'group' when 4 then 'sheet_music' when 5 then 'other' else 'unknown' end as class,
        (p_partkey % 101) / 100.0 as confidence, cast(p_partkey % 4 as int) as faces, (p_size % 21) / 20.0 as coverage from {part}"""
_IMAGES = plain(IMAGES)


def images(t: Tables) -> DataFrame:
    return t.sql(IMAGES).withColumns({c: F.col(c).cast("double") for c in ("mp", "confidence", "coverage")})


_MARK = """list_filter([case when contains('/' || regexp_extract(lower(rel_path), '^(.*)/[^/]*$', 1) || '/', '/unused/') then 'unused' end, case when regexp_matches(lower(rel_path), '(^|[_\\-/])(with|and|feat)[_\\-]') then 'joint-photo' end,
    case when regexp_matches(base, '(?i)(^|[^a-z])(cd|lp|ep|dvd|vhs|lcd)\\d|(^|[_\\-])(cover|obl)([_\\-]|$)') then 'release-cover' end,
    case when regexp_matches(lower(rel_path), '(tech|technique|shkola|school|book|notes?|scores?|tabs?)($|[_\\-/])') then 'illustration' end,
    case when starts_with(lower(rel_path), 'music/scores') then 'sheet-directory' end, case when starts_with(lower(rel_path), 'articles/') then 'article-directory' end], lambda x: x is not null)"""
_MARKED = f"(select *, {_MARK} as markers from (select *, regexp_replace(regexp_extract(rel_path, '[^/]*$'), '(?i)\\.[a-z0-9]+$', '') as base from ({_IMAGES})))"


@query("U24_S7_path_analysis", f"select p_partkey, nullif(lower(regexp_extract(rel_path, '(?i)^photos?/([a-z])(/|$)', 1)), '') as bucket, array_to_string(markers, ',') as markers from {_MARKED}")
def path_analysis(t: Tables) -> DataFrame:
    a = linkage.analyse_path(F.col("rel_path"))
    return images(t).select("p_partkey", a["bucket"].alias("bucket"), F.array_join(a["markers"], ",").alias("markers"))


_HES = "(class = 'sheet_music' and faces = 1 and confidence < 0.6)"
_PEN = " + ".join(f"(case when list_contains(markers, '{k}') then {v} else 0 end)" for k, v in linkage.PENALTY.items())


def _case(col: str, table: dict) -> str:
    return "case " + col + " " + " ".join(f"when '{k}' then {v}" for k, v in table.items()) + " else 0 end"


@query("P9_P10_P11_P12_F78_F79_F80_F81_suitability", f"""
    with x as (select *, case when list_contains(markers, 'sheet-directory') then 'sheet tree' when class = 'sheet_music' and not {_HES} then 'classified sheet_music' when {_HES} then null
            when list_contains(markers, 'release-cover') then 'release cover' when width > 0 and least(width, height) < 80 then 'too small' end as excluded,
        {_case('class', linkage.CLASS_SCORE)} * (0.6 + 0.4 * confidence) + case when faces = 1 then 40 when faces > 1 then -25 else 0 end
        + case when coverage <= 0 then 0.0 when coverage < 0.3 then 15 * greatest(0.0, coverage - 0.04) / 0.26 when coverage <= 0.62 then 15.0 else greatest(4.0, 15 - (coverage - 0.62) * 30) end
        + case orientation when 'portrait' then 8 when 'square' then 4 else 0 end + case color when 'color' then 4 when 'bw' then 0 else -1 end
        + case when mp <= 0 then 0.0 else least(8.0, greatest(0.0, log10(mp / 0.01) * 3)) end - ({_PEN}) as score from {_MARKED})
    select p_partkey, excluded, case when excluded is not null then 4 when class in ('portrait', 'upper_body', 'full_body') and faces = 1 then 1 when class in ('portrait', 'upper_body', 'full_body') and faces = 0 then 2
        when faces = 1 and class in ('group', 'other', 'unknown') then 2 when class = 'sheet_music' then 4 else 3 end as tier,
        round(case when excluded is not null then 0.0 else least(1.0, greatest(0.0, (score + 30) / 140)) end, 6) as suitability, {_case('class', linkage.CLASS_RANK)} as class_rank,
        case faces when 1 then 3 when 0 then 1 else 0 end as face_rank, list_contains(markers, 'unused') or list_contains(markers, 'illustration') as shelved from x""")
def looks(t: Tables) -> DataFrame:
    r = images(t).withColumn("markers", linkage.analyse_path(F.col("rel_path"))["markers"])
    return linkage.suitability(r).select("p_partkey", "excluded", "tier", F.round("suitability", 6).alias("suitability"), "class_rank", "face_rank", "shelved")


@query("A10_inverted_index")
def inverted_index(t: Tables) -> DataFrame:
    return linkage.inverted(linkage.index(images(t).select("rel_path").distinct())).groupBy("kind", "key").agg(F.count("*").alias("images"))


#: Names as the parts have them, and misspelled ones.
NAMES = "select distinct p_name as query, case p_size % 9 when 0 then replace(p_name, 'e', 'ee') else p_name end as name from {part}"


def _names(t: Tables) -> DataFrame:
    return linkage.name_query(t.sql(NAMES).groupBy("query").agg(F.min("name").alias("name")))


def _candidates(t: Tables) -> DataFrame:
    records = linkage.suitability(linkage.index(images(t).drop("p_partkey").dropDuplicates(["rel_path"])))
    queries = _names(t)
    pairs = linkage.shortlist(linkage.inverted(records), queries)
    r = records.withColumnsRenamed({"joined": "r_joined", "phonetics": "r_phonetics", "initials": "r_initials"})
    return linkage.identity(pairs.join(r, "rel_path").join(queries, "query"))


@query("P1_P2_P3_P4_P5_P6_P8_J6_J7_identity")
def identities(t: Tables) -> DataFrame:
    return _candidates(t).select("query", "rel_path", "kind", "identity", F.array_join("foreign", ",").alias("foreign"))


@query("O1_O2_P13_P14_portrait_choice")
def portrait_choice(t: Tables) -> DataFrame:
    chosen = linkage.choose(_candidates(t), _names(t))
    fallback = F.when(F.length("query") % 2 == 0, "default-m.png").otherwise("default-f.png")
    return chosen.withColumn("shown", F.coalesce("chosen", fallback))


@query("F45_F46_F47_spelling_similarity", """
    with w as (select distinct split_part(p_name, ' ', 2) as a from part), v as (select distinct split_part(p_name, ' ', 1) as b from part),
    p as (select a, b, least(4, damerau_levenshtein(a, b)) as d, greatest(length(a), length(b)) as n from w, v where abs(length(a) - length(b)) <= 2)
    select a, b, d::int as distance, round(case when a = b then 1.0 when d > 3 then 0.0 else greatest(0.0, 1 - d / n) end, 6) as similarity,
        case when n <= 4 then 1.0 when n <= 6 then 0.83 else 0.86 end::double as threshold from p""")
def spelling(t: Tables) -> DataFrame:
    """Two small vocabularies, compared within two letters of length by an equi-join on it."""
    name = F.split("p_name", " ")
    a = t.part.select(F.get(name, F.lit(1)).alias("a")).distinct().select("a", F.explode(F.sequence(F.length("a") - 2, F.length("a") + 2)).alias("n"))
    b = t.part.select(F.get(name, F.lit(0)).alias("b")).distinct().withColumn("n", F.length("b"))
    p = a.join(b, "n").withColumn("distance", similarity.distance("a", "b"))
    return p.select("a", "b", "distance", F.round(similarity.similarity(F.col("a"), F.col("b"), F.col("distance")), 6).alias("similarity"),
                    similarity.threshold(F.greatest(F.length("a"), F.length("b"))).cast("double").alias("threshold"))
