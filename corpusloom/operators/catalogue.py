"""Keyed merges and integrity rules of a published catalogue.

Index rows: ``position, id, title, lang, type, gender, country, md, json, img``. Name rows: ``lang, id, aliases``.
Existing values win in merges: an update refreshes paths and fills blanks, and never overwrites or deletes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text, values

LANG_DIR = "(?:^|/)(?:" + "|".join(values.LANGUAGES) + ")/"


def accepted(rows: DataFrame) -> DataFrame:
    """``rows`` with ``slug``, ``id_rank`` and ``slug_rank``: their place among rows of the id, and among rows of the slug
    that weren't dropped for their id. Later places are duplicates; a dropped row doesn't claim its slug."""
    named = rows.withColumn("slug", values.slug(F.col("md"))).withColumn("id_ok", F.coalesce(values.canonical_id(F.col("id")).isNotNull(), F.lit(False)))
    ids = Window.partitionBy("id").orderBy("position")
    first = named.withColumn("id_rank", F.when(F.col("id_ok"), F.row_number().over(ids)))
    usable = (F.col("id_rank") == 1) & F.col("md").isNotNull()
    slugs = Window.partitionBy("slug", usable).orderBy("position")
    return first.withColumn("slug_rank", F.when(usable, F.row_number().over(slugs)))


def read_rows(rows: DataFrame) -> DataFrame:
    """``rows`` as a reader takes them: without those that lack an id or ``md`` or repeat an earlier row's id or slug; types
    and genders in lower case, countries in upper case, unknown genders and countries dropped, no title is the id."""
    clean = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    trimmed = rows.withColumns({c: clean(c) for c in ("id", "title", "type", "gender", "country", "md", "json", "img")}).where("id is not null and md is not null")
    kept = trimmed.withColumn("slug", values.slug(F.col("md")))
    for key in ("id", "slug"):
        first = Window.partitionBy(key).orderBy("position")
        kept = kept.withColumn("place", F.row_number().over(first)).where((F.col("place") == 1) | F.col(key).isNull()).drop("place")
    gender, country = F.lower("gender"), F.upper("country")
    lang = F.array_distinct(F.filter(F.transform(F.split(F.lower("lang"), ","), F.trim), lambda x: x.isin(*values.LANGUAGES)))
    return kept.withColumns({
        "title": F.coalesce("title", "id"), "type": F.coalesce(F.lower("type"), F.lit("")), "gender": F.when(gender.isin("m", "f", "mixed"), gender),
        "country": F.when(country.rlike("^[A-Z]{2}$"), country), "lang": F.when(F.size(lang) > 0, lang).otherwise(F.array(F.lit(values.LANGUAGES[0])))})


def _bad(cond: Column, invariant: str, severity: str = "error") -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(invariant).alias("invariant"), F.lit(severity).alias("severity")))


def row_findings(rows: DataFrame, countries: DataFrame) -> DataFrame:
    """Findings of index rows: ``position, invariant, severity``. All rules are one pass over the rows after the two
    ranks; a row dropped by a key rule isn't judged by later ones."""
    c = F.col
    r = accepted(rows).join(F.broadcast(countries.select(F.col("code").alias("__code"))), F.lower("country") == c("__code"), "left")
    langs = F.transform(F.split("lang", ","), lambda x: F.trim(x))
    alive = (c("id_rank") == 1) & c("md").isNotNull()
    sound = alive & (c("slug_rank") == 1)
    checks = [
        _bad(~c("id_ok"), "INV-2"), _bad(c("id_rank") > 1, "INV-1"), _bad((c("id_rank") == 1) & c("md").isNull(), "INV-5"),
        _bad(alive & ~values.is_slug(c("slug")), "INV-4"), _bad(alive & (c("slug_rank") > 1), "INV-3"),
        _bad(sound & (c("title").isNull() | c("type").isNull()), "INV-5"), _bad(sound & c("md").rlike(LANG_DIR), "INV-5"),
        _bad(sound & c("country").isNotNull() & c("__code").isNull(), "INV-9"),
        _bad(sound & c("gender").isNotNull() & ~F.lower("gender").isin("m", "f", "mixed"), "INV-10"),
        _bad(sound & ((F.size(F.array_distinct(langs)) < F.size(langs)) | (F.size(F.filter(langs, lambda x: ~x.isin(*values.LANGUAGES))) > 0)), "INV-11"),
        _bad(sound & (c("type") == "hidden") & (c("img").isNotNull() | c("gender").isNotNull()), "INV-24", "warning"),
        _bad(sound & (F.coalesce(c("country") != F.lower("country"), F.lit(False)) | F.coalesce(c("lang") != F.lower("lang"), F.lit(False))
                      | F.coalesce(c("type") != F.lower("type"), F.lit(False)) | F.coalesce(c("img").startswith("/pages/"), F.lit(False))), "INV-25", "warning"),
    ]
    return r.select("position", F.explode(F.array_compact(F.array(*checks))).alias("f")).select("position", "f.invariant", "f.severity")


def name_findings(names: DataFrame, rows: DataFrame) -> DataFrame:
    """Findings of name rows: keys without an index row, a lone name that folds to the title, and poor aliases. The title of
    an id is the first that its rows have."""
    c = F.col
    titled = rows.groupBy("id").agg(F.min_by("title", F.when(c("title").isNotNull(), c("position"))).alias("title"))
    n = names.join(titled, "id", "left")
    folds = F.transform("aliases", text.fold_name)
    checks = [
        _bad(values.canonical_id(c("id")).isNull(), "INV-2"), _bad(c("title").isNull(), "INV-12"), _bad(F.size("aliases") == 0, "INV-13"),
        _bad((F.size("aliases") == 1) & (F.get(folds, F.lit(0)) == text.fold_name(c("title"))), "INV-14", "warning"),
        _bad((F.size(F.array_distinct(folds)) < F.size(folds)) | (F.size(F.filter("aliases", lambda a: F.length(a) < 3)) > 0), "INV-28", "warning"),
    ]
    return n.select("lang", "id", F.explode(F.array_compact(F.array(*checks))).alias("f")).select("lang", "id", "f.invariant", "f.severity")


def dossier_findings(dossiers: DataFrame, least: str = "year") -> DataFrame:
    """Findings of dossiers ``path, lang, ranking, born, url, prose, documents`` (array of label, target, type)."""
    from ..functions.dates import is_valid_date

    c = F.col
    ascii_long = text.is_ascii(c("prose")) & (F.length("prose") >= 8)
    item = lambda test: F.size(F.filter("documents", test)) > 0
    checks = [
        _bad(c("ranking").isNotNull() & ~c("ranking").between(0, 100), "INV-20"), _bad(c("born").isNotNull() & ~is_valid_date(c("born"), least), "INV-21"),
        _bad(item(lambda d: d["label"].isNull() | d["target"].isNull() | ((F.lower(d["target"]) == "embedded") & (d["target"] != "embedded"))), "INV-22"),
        _bad(item(lambda d: d["target"] == c("url")), "INV-27", "warning"), _bad(item(lambda d: ~d["type"].rlike("^[A-Z][A-Z0-9_]*$")), "SCHEMA"),
        _bad((c("lang").isin("ru", "zh", "ja", "ko") & ascii_long) | (c("lang").isin("en", "de", "es", "fr") & text.has_cyrillic(c("prose"))), "INV-18", "warning"),
    ]
    return dossiers.select("path", F.explode(F.array_compact(F.array(*checks))).alias("f")).select("path", "f.invariant", "f.severity")


def edition_findings(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Declared editions without an article, or without a dossier where the row names one: ``id, lang, missing``."""
    wanted = rows.select("id", F.explode(F.array_distinct(F.split("lang", ","))).alias("lang"), "md", "json")
    paths = wanted.select("id", "lang", F.explode(F.array_compact(F.array(F.concat("lang", F.lit("/"), "md"), F.concat("lang", F.lit("/"), "json")))).alias("missing"))
    return paths.join(files.select(F.col("path").alias("missing")), "missing", "left_anti").select("id", "lang", "missing")


def by_invariant(findings: DataFrame) -> DataFrame:
    """Counts of findings by rule, in the rules' numeric order."""
    n = F.regexp_extract("invariant", "(\\d+)$", 1).try_cast("int")
    return findings.groupBy("invariant", "severity").agg(F.count("*").alias("n")).orderBy(n.asc_nulls_first(), "invariant")


def merge_languages(original: Column, declared: Column, checked: Column, verified: Column) -> Column:
    """The original language first, then declared ones but for those checked and missing, then newly verified ones."""
    missing = F.array_except(checked, verified)
    return F.array_distinct(F.concat(F.array(original), F.array_except(declared, missing), verified))


def upsert(rows: DataFrame, updates: DataFrame, default_type: str = "musician", page_type: str = "hidden") -> DataFrame:
    """Index rows after updates keyed by ``slug``. Paths are refreshed, blanks filled, ids of new rows follow the largest or
    begin with 1. An updated row without type gets the default one of entries with a dossier or of mere pages, a new row
    without title its slug."""
    e, u = rows.alias("e"), updates.alias("u")
    top = rows.agg(F.max(F.col("id").try_cast("long")).alias("top_id"), F.max("position").alias("top_position"))
    both = e.join(u, F.col("e.slug") == F.col("u.slug"), "full_outer").crossJoin(F.broadcast(top))
    old = lambda c: F.coalesce(F.col(f"e.{c}"), F.col(f"u.{c}"))
    typed = F.when(F.col("u.slug").isNotNull(), F.when(F.col("u.json").isNotNull(), default_type).otherwise(page_type))
    found = {"title": F.coalesce(old("title"), F.when(F.col("e.slug").isNull(), F.col("u.slug"))), "type": F.coalesce(old("type"), typed)}
    merged = both.select(
        F.coalesce("e.slug", "u.slug").alias("slug"), F.col("e.id").alias("id"), F.col("e.position").alias("position"), "top_id", "top_position",
        F.coalesce("u.md", "e.md").alias("md"), F.coalesce("e.json", "u.json").alias("json"), *[found.get(c, old(c)).alias(c) for c in ("title", "type", "gender", "country", "img")])
    new = merged.where("id is null")
    # New rows are numbered in parts: counts of each part are summed, rows within it counted, and no task sees them all.
    numbered = number_rows(new, ["slug"])
    fresh = numbered.withColumn("id", (F.coalesce("top_id", F.lit(0)) + F.col("n")).cast("string")).withColumn("position", F.coalesce("top_position", F.lit(-1)) + F.col("n"))
    return merged.where("id is not null").unionByName(fresh.drop("n")).drop("top_id", "top_position")


def number_rows(df: DataFrame, order: list[str], name: str = "n") -> DataFrame:
    """``df`` with 1, 2, 3 and so on in ``order``. The rows are cut into parts at some thousand of their own keys, those with
    the least hashes, so a row's part depends on the data alone: partition ids can differ between the two uses below, as
    range bounds are sampled and partitions merged for each. Offsets come from one count a part."""
    key, h = F.struct(*order), F.xxhash64(*order)
    picked = df.groupBy(h.bitwiseAND(F.lit(1023)).alias("r")).agg(F.min(F.struct(h.alias("h"), key.alias("k")))["k"].alias("k"))
    cuts = picked.agg(F.sort_array(F.collect_list("k")).alias("__cuts"))
    steps = F.array(*[F.lit(1 << i) for i in range(9, -1, -1)])  # binary search
    place = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get("__cuts", at + step - 1) <= key, at + step).otherwise(at))
    parts = df.crossJoin(F.broadcast(cuts)).withColumn("__p", place).drop("__cuts")
    counts = parts.groupBy("__p").count()
    offsets = counts.withColumn("__before", F.coalesce(F.sum("count").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    within = F.row_number().over(Window.partitionBy("__p").orderBy(*order))
    return parts.withColumn("__i", within).join(F.broadcast(offsets), "__p").withColumn(name, F.col("__i") + F.col("__before")).drop("__p", "__i", "__before")


def merge_names(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Name rows after additions: the first name stays, aliases of three letters or more are appended fold-distinct, and
    nothing is deleted. ``changed`` tells whether a row differs."""
    e, n = existing.alias("e"), new.alias("n")
    none = F.array().cast("array<string>")
    old, add = F.coalesce("e.aliases", none), F.coalesce("n.aliases", none)
    kept = F.filter(add, lambda a: (F.length(a) >= 3))
    joined = e.join(n, (F.col("e.lang") == F.col("n.lang")) & (F.col("e.id") == F.col("n.id")), "full_outer")
    out = joined.select(F.coalesce("e.lang", "n.lang").alias("lang"), F.coalesce("e.id", "n.id").alias("id"), old.alias("old"),
                        F.when(F.size(old) > 0, F.concat(old, kept)).otherwise(F.concat(F.slice(add, 1, 1), F.filter(F.slice(add, F.lit(2), F.size(add)), lambda a: F.length(a) >= 3))).alias("all"))
    return out.select("lang", "id", text.distinct_by(F.col("all"), text.fold_name).alias("aliases"), "old").withColumn(
        "changed", ~F.col("aliases").eqNullSafe(F.col("old"))).drop("old")
