"""Names to images: an inverted index, a shortlist by exact keys, identity and visual scores, and a choice.

Records: ``rel_path``, width, height, mp, orientation, color, class, confidence, faces, coverage, and where there is
metadata title, description, ocr, keywords, people. Queries: ``query`` and its arrays surnames, forenames, everything,
phonetics, joined, initials. Identity is decided before looks, and never traded against them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType

from ..functions import similarity, text
from ..functions.values import band

# Scores of evidence, in the order in which equal ones win.
EVIDENCE = (
    ("meta-people", 1.0), ("full-name-file", 0.98), ("surname-file", 0.92), ("concatenation", 0.95), ("full-name-dir", 0.94), ("surname-dir", 0.88),
    ("meta-title", 0.9), ("phonetic", 0.86), ("meta-keywords", 0.75), ("meta-text", 0.62),
)
METADATA = {"title": "string", "description": "string", "ocr": "string", "keywords": "array<string>", "people": "array<string>"}
CLASS_SCORE = {"portrait": 40, "upper_body": 32, "full_body": 22, "group": 2, "sheet_music": -100}
CLASS_RANK = {"portrait": 5, "upper_body": 4, "full_body": 3, "group": 2, "other": 1, "sheet_music": -100}
PENALTY = {"release-cover": 20, "joint-photo": 6, "unused": 6, "illustration": 12, "sheet-directory": 60, "article-directory": 4}
STRUCTURAL = ("photo", "photos", "images", "img", "files", "unused", "thumbs", "small")


def analyse_path(path: Column) -> dict[str, Column]:
    """What a path says: bucket letter, tokens of file and folders, unsplit spellings, initials and markers."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    base = F.regexp_replace(F.element_at(parts, -1), "(?i)\\.[a-z0-9]+$", "")
    folders = F.slice(parts, F.lit(1), F.size(parts) - 1)
    named = F.filter(folders, lambda d: ~F.lower(d).isin(*STRUCTURAL) & (F.length(d) > 2))
    keep = lambda a: F.array_distinct(F.filter(a, lambda t: ~text.is_noise(t)))
    low = F.lower(path)
    mark = lambda cond, name: F.when(cond, F.lit(name))
    return {
        "bucket": F.nullif(F.lower(F.regexp_extract(path, "(?i)^photos?/([a-z])(?:/|$)", 1)), F.lit("")),
        "file_tokens": keep(text.split_tokens(base)),
        "dir_tokens": keep(F.flatten(F.transform(named, text.split_tokens))),
        "joined": F.array_distinct(F.filter(F.array_compact(F.array(text.name_fold(base), F.when(~F.lower(F.element_at(folders, -1)).isin(*STRUCTURAL), text.name_fold(F.element_at(folders, -1))))), lambda x: F.length(x) >= 4)),
        "initials": F.filter(text.split_tokens(base), lambda t: F.length(t) <= 2),
        "markers": F.array_compact(F.array(
            mark(F.exists(folders, lambda d: F.lower(d) == "unused"), "unused"), mark(low.rlike("(?:^|[_\\-/])(?:with|and|feat)[_\\-]"), "joint-photo"),
            mark(base.rlike("(?i)(?:^|[^a-z])(?:cd|lp|ep|dvd|vhs|lcd)\\d|(?:^|[_\\-])(?:cover|obl)(?:[_\\-]|$)"), "release-cover"),
            mark(low.rlike("(?:tech|technique|shkola|school|book|notes?|scores?|tabs?)(?:$|[_\\-/])"), "illustration"),
            mark(low.startswith("music/scores"), "sheet-directory"), mark(low.startswith("articles/"), "article-directory"))),
    }


def index(records: DataFrame) -> DataFrame:
    """``records`` with their path analysis and phonetic keys; metadata that isn't there is null."""
    absent = [F.lit(None).cast(kind).alias(c) for c, kind in METADATA.items() if c not in records.columns]
    r = records.select("*", *absent, *[v.alias(k) for k, v in analyse_path(F.col("rel_path")).items()])
    return r.withColumn("phonetics", F.transform("file_tokens", text.phonetic_key))


def _words(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, "[^\\p{L}]+"), text.name_fold), lambda w: w != "")


def inverted(indexed: DataFrame) -> DataFrame:
    """``kind, key, rel_path`` rows: tokens, phonetic keys, unsplit spellings and words of metadata."""
    named = F.array_compact(F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in (F.col("people"), F.array("title"), F.col("keywords"))]))
    meta = F.filter(F.flatten(F.transform(named, _words)), lambda w: (F.length(w) >= 3) & ~text.is_noise(w))
    keys = lambda kind, col: indexed.select(F.lit(kind).alias("kind"), F.explode(col).alias("key"), "rel_path")
    return keys("token", F.array_union("file_tokens", "dir_tokens")).unionByName(
        keys("phonetic", F.array_union("phonetics", F.transform("dir_tokens", text.phonetic_key)))).unionByName(keys("joined", F.col("joined"))).unionByName(keys("meta", meta)).distinct()


def spellings(parts: Column) -> Column:
    """Folded name parts as written, and romanized where they are Cyrillic, else in ASCII."""
    other = lambda p: text.name_fold(F.when(text.has_cyrillic(p), text.romanize(p)).otherwise(text.to_ascii(p)))
    return F.array_distinct(F.filter(F.concat(parts, F.transform(parts, other)), lambda p: p != ""))


def name_query(names: DataFrame) -> DataFrame:
    """Arrays of a ``query`` (a name, ``first last``): surnames, forenames, phonetics, unsplit spellings, initials."""
    parts = F.filter(F.split(F.col("name"), "[\\s_-]+"), lambda p: p != "")
    fold = F.transform(parts, text.name_fold)
    n = F.size(fold)
    last = F.get(fold, n - 1)
    rest = F.filter(F.slice(fold, F.lit(1), n - 1), lambda t: ~text.is_particle(t))
    surnames, forenames = spellings(F.array(last)), spellings(rest)
    return names.select(
        "query", surnames.alias("surnames"), forenames.alias("forenames"), F.array_union(surnames, forenames).alias("everything"), F.array_distinct(F.transform(surnames, text.phonetic_key)).alias("phonetics"),
        F.filter(F.array_distinct(F.array(F.array_join(fold, ""), F.concat(last, F.array_join(rest, "")))), lambda x: F.length(x) >= 4).alias("joined"),
        F.transform(F.array_union(F.array(last), rest), lambda t: F.left(t, F.lit(1))).alias("initials"),
    )


def shortlist(inv: DataFrame, queries: DataFrame) -> DataFrame:
    """``query, rel_path`` pairs by exact keys; only for queries without any, tokens of like length and spelling."""
    q = lambda kind, col: queries.select("query", F.lit(kind).alias("kind"), F.explode(col).alias("key"))
    wanted = reduce(DataFrame.unionByName, (q("token", F.array_union("everything", "joined")), q("phonetic", F.col("phonetics")), q("joined", F.col("joined")), q("meta", F.col("everything"))))
    exact = wanted.join(inv, ["kind", "key"]).select("query", "rel_path").distinct()
    lost = queries.join(exact, "query", "left_anti").select("query", F.explode("surnames").alias("surname"))
    vocabulary = inv.where("kind = 'token'").select(F.col("key").alias("token")).distinct()
    near = lost.select("query", "surname", F.explode(F.sequence(F.length("surname") - 2, F.length("surname") + 2)).alias("n"))
    pairs = near.join(vocabulary.withColumn("n", F.length("token")), "n").withColumn("d", similarity.distance("surname", "token"))
    like = pairs.where(similarity.similarity(F.col("surname"), F.col("token"), F.col("d")) >= similarity.threshold(F.greatest(F.length("surname"), F.length("token"))))
    fuzzy = like.select("query", F.col("token").alias("key")).join(inv.where("kind = 'token'").select("key", "rel_path"), "key").select("query", "rel_path")
    return exact.unionByName(fuzzy).distinct()


@pandas_udf(ArrayType(StringType()))
def strangers(rows: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """A file's Latin tokens of four letters or more that neither are, sound like, nearly spell nor shorten a name."""

    def strange(t: str, names: tuple[str, ...]) -> bool:
        return len(t) >= 4 and t not in text.PARTICLES and not re.search("[\u0400-\u052f]", t) and not any(
            similarity.likeness(n, t) >= 0.75 or len(n) >= 4 and (n.startswith(t) or n.startswith(t[1:])) for n in names)

    for frame in rows:
        yield pd.Series([[t for t, key in zip(tokens, keys, strict=True) if t not in (*names, *joined) and key not in sounds and strange(t, tuple(names))]
                         for tokens, keys, names, joined, sounds in zip(*frame, strict=True)], dtype=object)


def identity(pairs: DataFrame) -> DataFrame:
    """``pairs`` of a query and an indexed record with ``identity`` (3 digits) and ``kind`` of the best evidence. Spelling
    counts only where there is no other; pairs without any, or with nothing left of it, are left out."""
    c = F.col
    hit = lambda a, b: F.arrays_overlap(c(a), c(b))
    file_s, dir_s, file_f, dir_f = hit("file_tokens", "surnames"), hit("dir_tokens", "surnames"), hit("file_tokens", "forenames"), hit("dir_tokens", "forenames")
    holds = {
        "full-name-file": file_s & file_f, "surname-file": file_s & ~file_f, "concatenation": F.arrays_overlap("r_joined", "joined"),
        "full-name-dir": dir_s & dir_f, "surname-dir": dir_s & ~dir_f, "phonetic": ~file_s & ~dir_s & F.arrays_overlap("r_phonetics", "phonetics"),
        "meta-people": F.exists(F.transform("people", lambda p: F.filter(F.transform(F.split(p, "[\\s,]+"), text.name_fold), lambda w: w != "")), lambda w: (F.size(w) > 0) & (
            F.array_contains("joined", F.array_join(w, "")) | F.array_contains("surnames", F.get(w, F.size(w) - 1)) & F.arrays_overlap(w, c("forenames")))),
        "meta-title": F.arrays_overlap(_words(c("title")), c("surnames")), "meta-keywords": F.exists("keywords", lambda k: F.arrays_overlap(_words(k), c("surnames"))),
        "meta-text": F.arrays_overlap(_words(F.concat_ws(" ", "description", "ocr")), c("surnames")),
    }
    best = reduce(lambda x, k: x.when(holds[k[0]], F.struct(F.lit(k[1]).alias("score"), F.lit(k[0]).alias("kind"))),
                  sorted(EVIDENCE, key=lambda k: -k[1]), F.when(F.lit(False), F.struct(F.lit(0.0).alias("score"), F.lit("").alias("kind"))))
    p = pairs.withColumn("best", best)
    # Held to be nondeterministic, the functions stay in steps of their own; merged into lambdas they couldn't run.
    alone = lambda a: F.when(c("best").isNull(), c(a))
    p = p.withColumn("fuzzy", similarity.closest.asNondeterministic()(alone("file_tokens"), alone("dir_tokens"), alone("surnames")))
    p = p.withColumn("best", F.coalesce("best", F.when(c("fuzzy").isNotNull(), F.struct(c("fuzzy").alias("score"), F.lit("fuzzy").alias("kind"))))).where("best is not null")
    p = p.withColumn("foreign", strangers.asNondeterministic()("file_tokens", "r_phonetics", "everything", "joined", "phonetics"))
    k, n = c("best.kind"), F.size("foreign")
    score = (
        c("best.score") + F.when((file_f | dir_f) & ~k.isin("full-name-file", "full-name-dir"), 0.05).otherwise(0.0)
        + F.when(~file_f & F.exists("r_initials", lambda i: F.exists("forenames", lambda f: f.startswith(i))), 0.02).otherwise(0.0)
        + F.when(F.array_contains("initials", c("bucket")), 0.02).otherwise(0.0) - F.when(n > 0, F.least(F.lit(0.25), 0.1 * n)).otherwise(0.0)
        - F.when(~F.array_contains("initials", c("bucket")) & F.exists("foreign", lambda f: f.startswith(c("bucket"))), 0.3).otherwise(0.0)
        - F.when(F.array_contains("markers", "joint-photo"), 0.1).otherwise(0.0) - F.when(k.isin("surname-dir", "full-name-dir") & ~file_s, 0.06).otherwise(0.0)
    )
    return p.withColumn("identity", F.floor(F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)) * 1000 + 0.5) / 1000).withColumn("kind", k).where("identity > 0").drop("best", "fuzzy")


def _table(key: Column, values: dict[str, int]) -> Column:
    return reduce(lambda x, kv: x.when(key == kv[0], kv[1]), values.items(), F.when(F.lit(False), 0)).otherwise(0)


def suitability(records: DataFrame) -> DataFrame:
    """``records`` (with ``markers``) with ``excluded`` (why), ``tier``, ``suitability`` and the ranks of looks."""
    c = F.col
    has = lambda m: F.array_contains("markers", m)
    person = c("class").isin("portrait", "upper_body", "full_body")
    hesitant = (c("class") == "sheet_music") & (c("faces") == 1) & (c("confidence") < 0.6)
    excluded = (
        F.when(has("sheet-directory"), "sheet tree").when((c("class") == "sheet_music") & ~hesitant, "classified sheet_music").when(hesitant, None)
        .when(has("release-cover"), "release cover").when((c("width") > 0) & (F.least("width", "height") < 80), "too small")
    )
    tier = (
        F.when(person & (c("faces") == 1), 1).when(person & (c("faces") == 0), 2)
        .when((c("faces") == 1) & c("class").isin("group", "other", "unknown"), 2).when(c("class") == "sheet_music", 4).otherwise(3)
    )
    cover = c("coverage")
    bonus = (
        F.when(cover <= 0, 0.0).when(cover < 0.3, 15 * F.greatest(F.lit(0.0), cover - 0.04) / 0.26).when(cover <= 0.62, 15.0)
        .otherwise(F.greatest(F.lit(4.0), 15 - (cover - 0.62) * 30))
    )
    sharp = F.when(c("mp") <= 0, 0.0).otherwise(F.least(F.lit(8.0), F.greatest(F.lit(0.0), F.log10(c("mp") / 0.01) * 3)))
    score = (
        _table(c("class"), CLASS_SCORE) * (0.6 + 0.4 * c("confidence")) + F.when(c("faces") == 1, 40).when(c("faces") > 1, -25).otherwise(0) + bonus
        + F.when(c("orientation") == "portrait", 8).when(c("orientation") == "square", 4).otherwise(0) + F.when(c("color") == "color", 4).when(c("color") == "bw", 0).otherwise(-1) + sharp
        - reduce(lambda x, kv: x + F.when(has(kv[0]), kv[1]).otherwise(0), PENALTY.items(), F.lit(0))
    )
    looks = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (score + 30) / 140))
    return records.select(
        "*", excluded.alias("excluded"), F.when(excluded.isNotNull(), 4).otherwise(tier).alias("tier"), F.when(excluded.isNotNull(), 0.0).otherwise(looks).alias("suitability"),
        _table(c("class"), CLASS_RANK).alias("class_rank"), F.when(c("faces") == 1, 3).when(c("faces") == 0, 1).otherwise(0).alias("face_rank"),
        F.when(c("orientation") == "portrait", 3).when(c("orientation") == "square", 2).otherwise(1).alias("orientation_rank"),
        (has("unused") | has("illustration")).alias("shelved"),
    )


def sort_key() -> list[Column]:
    """The twelve keys of a candidate, best first."""
    c = F.col
    return [
        c("excluded").isNull().desc(), band(c("identity"), 0.1).desc(), c("tier").asc(), c("shelved").asc(), c("class_rank").desc(), c("face_rank").desc(),
        band(c("coverage"), 0.05).desc(), c("orientation_rank").desc(), band(c("suitability"), 0.05).desc(), band(c("confidence"), 0.1).desc(),
        (c("color") == "color").desc(), band(c("mp"), 0.05).desc(), c("rel_path").asc(),
    ]


def choose(candidates: DataFrame, queries: DataFrame, least: float = 0.9, worst_tier: int = 2) -> DataFrame:
    """A row per query, with or without candidates: the chosen path, or why none was."""
    ranked = candidates.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*sort_key())))
    usable = F.col("excluded").isNull() & (F.col("tier") <= worst_tier)
    sure = F.col("identity") >= least
    pick = F.min(F.when(usable & sure, F.struct("rank", "rel_path", "identity")))
    found = ranked.groupBy("query").agg(pick.alias("p"), F.max(sure).alias("known"), F.count("*").alias("candidates"))
    return queries.select("query").distinct().join(found, "query", "left").select(
        "query", F.col("p.rel_path").alias("chosen"), F.col("p.identity").alias("identity"), F.coalesce("candidates", F.lit(0)).alias("candidates"),
        F.when(F.col("p").isNotNull(), None).when(F.col("candidates").isNull(), "the image index holds nothing under this name").when(F.col("known"), "every image of this person is unusable").otherwise("identity is below the threshold").alias("declined"))
