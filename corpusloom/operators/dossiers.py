"""Dossiers: building, sanitizing and merging records of facts; gaps and web answers; display names and search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text, values

# Fields and how each is normalized.
PROSE = ("forename", "surname", "birthname", "birthplace", "deathplace")
LISTS = ("relatives", "instruments", "genres", "bands", "awards", "teachers", "disciples", "jobs")
DATES = ("born", "died", "activefrom", "activeto")
FIELDS = (*PROSE, *LISTS, *DATES, "ranking", "url", "type", "gender", "country", "latin")


def normalized(c: Column, field: str, least: str = "year") -> Column:
    """A fact's canonical string, or null."""
    s = values.stated(c)
    if field in LISTS:
        return F.nullif(text.csv_list(s), F.lit(""))
    if field in DATES:
        return dates.normalize_date(s, least)
    kinds = {"ranking": lambda: values.ranking(s).cast("string"), "url": lambda: values.url(s), "type": lambda: values.entry_type(s), "gender": lambda: values.gender(s),
             "latin": lambda: text.to_ascii(s)}
    return kinds.get(field, lambda: text.text_or_null(s))()


def build(answers: DataFrame, key: str, answer: str = "answer") -> DataFrame:
    """A column for each field of a map of answers."""
    return answers.select(key, *[normalized(F.col(answer)[f], f).alias(f) for f in FIELDS])


def merge(base: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """Facts of ``base`` win; lists are united, dates only sharpened; ``filled`` names what ``more`` added or sharpened."""
    b, m = base.alias("b"), more.alias("m")

    def field(f: str) -> Column:
        x, y = F.col(f"b.{f}"), F.col(f"m.{f}")
        if f in LISTS:
            return F.nullif(text.merge_csv(F.coalesce(x, F.lit("")), F.coalesce(y, F.lit(""))), F.lit(""))
        if f in DATES:
            return F.when(x.isNull(), y).when(dates.refines(x, y), y).otherwise(x)
        return F.coalesce(x, y)

    fields = [c for c in base.columns if c != key]
    out = b.join(m, F.col(f"b.{key}") == F.col(f"m.{key}"), "full_outer").select(
        F.coalesce(f"b.{key}", f"m.{key}").alias(key), *[field(f).alias(f) for f in fields], *[F.col(f"b.{f}").alias(f"old_{f}") for f in fields])
    changed = F.array_compact(F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"old_{f}")), F.lit(f)) for f in fields]))
    return out.withColumn("filled", changed).drop(*[f"old_{f}" for f in fields])


def merge_chunks(flat: DataFrame, key: str, order: str) -> DataFrame:
    """One record of several: the first stated scalar by ``order``, and lists united in order."""
    def agg(f: str) -> Column:
        if f in LISTS:
            items = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col(f).isNotNull(), F.struct(order, F.col(f).alias("v"))))), lambda e: e["v"]), ",")
            return F.nullif(text.csv_list(items), F.lit("")).alias(f)
        return F.min_by(f, F.when(F.col(f).isNotNull(), F.col(order))).alias(f)

    return flat.groupBy(key).agg(*[agg(c) for c in flat.columns if c not in (key, order)])


def present(fields: list[str]) -> Column:
    return F.array_compact(F.array(*[F.when(F.col(f).isNotNull(), F.lit(f)) for f in fields]))


def gaps(dossier: DataFrame, key: str, year: int, refine: bool = True, old: int = 78) -> DataFrame:
    """Questions that a dossier leaves open: absent fields; death only of the old; coarse dates if ``refine``."""
    age = dates.age_in(F.col("born"), F.lit(year))
    ask = [F.when(F.col(f).isNull(), F.lit(f)) for f in ("born", "birthplace", "jobs", "url")]
    ask.append(F.when(F.col("died").isNull() & (age >= old), F.lit("died")))
    if refine:
        ask += [F.when(F.col(f).isNotNull() & (dates.precision_of(F.col(f)) != "day"), F.lit(f"refine:{f}")) for f in ("born", "died")]
    return dossier.select(key, F.explode(F.array_compact(F.array(*ask))).alias("question"))


def accept_web(answers: DataFrame, floor: float = 0.6) -> DataFrame:
    """``answers`` (field, value, source, confidence, current, status) with ``accepted`` or the ``reason`` against it."""
    c = F.col
    value = F.coalesce(*[F.when(c("field") == f, normalized(c("value"), f)) for f in ("born", "died", "jobs", "url", "birthplace")])
    v = answers.withColumn("canonical", value)
    alive = c("status").rlike("(?i)alive|living|жив") & ~c("status").rlike("(?i)\\bnot\\b")
    dead = c("status").rlike("(?i)dead|died|deceased|умер")
    reason = (
        F.when(c("canonical").isNull(), "not a value").when(F.coalesce(c("confidence"), F.lit(1.0)) < floor, "confidence").when(values.url(c("source")).isNull(), "no source")
        .when((c("field") == "died") & ~dead, F.when(alive, "alive").otherwise("not known to be dead"))
        .when(c("current").isNotNull() & (c("current") != c("canonical")) & ~dates.refines(c("current"), c("canonical")), "contradicts")
    )
    return v.withColumn("reason", reason).withColumn("accepted", reason.isNull())


def spelled_places(entries: DataFrame, countries: DataFrame, most: int = 120) -> DataFrame:
    """``entries`` (raw, known: the entry's country or null) with ``place``: null beyond ``most`` characters; a code that is
    the whole value or follows its last comma becomes a country's name, if it is alpha-3, or alpha-2 and the known country's.
    ``countries``: code, code3, name."""
    c = F.col
    value = text.text_or_null(c("raw"))
    codes = countries.select(F.lower("code").alias("__iso"), F.explode(F.array(F.lower("code"), F.lower("code3"))).alias("__code"), c("name").alias("__name"))
    p = entries.withColumn("__value", F.when(F.length(value) <= most, value))
    tail, head = F.trim(F.regexp_extract("__value", "([^,]*)$", 1)), F.trim(F.regexp_extract("__value", "^(.*),", 1))
    token = F.when(tail.rlike("^[A-Za-z]{2,3}$") & ((head != "") | ~F.contains("__value", F.lit(","))), F.lower(tail))
    found = p.withColumn("__head", head).withColumn("__token", token).join(
        codes, (c("__token") == c("__code")) & ((F.length("__token") == 3) | (F.lower("known") == c("__iso"))), "left")
    place = F.when(c("__name").isNull(), c("__value")).when(c("__head") == "", c("__name")).otherwise(F.concat_ws(", ", "__head", "__name"))
    return found.withColumn("place", place).drop("__value", "__head", "__token", "__iso", "__code", "__name")


def display_names(display: Column, surname: Column, forename: Column) -> Column:
    """Names of an entry: display, surname, inverted, and a romanization of a name in another script."""
    inverted = F.when(~F.contains(display, F.lit(",")), F.concat_ws(", ", surname, forename))
    names = F.array(display, surname, inverted, F.when(~text.is_latin(display), text.to_ascii(display)))
    return text.distinct_by(F.filter(F.array_compact(names), lambda x: x != ""), F.lower)


def latin_title(hint: Column, edition: Column, slug: Column, name: Column) -> Column:
    ok = lambda x: F.when(text.is_ascii(x) & text.has_letters(x), x)
    return F.coalesce(ok(hint), ok(text.fold_ascii(edition)), F.nullif(text.deslug(slug), F.lit("")), text.romanize(name), slug)


def search(names: DataFrame, queries: DataFrame) -> DataFrame:
    """Entries that match all words of a query: ``query, id, score``. ``names`` has id, name and weight. Words meet by an
    equi-join on their first two letters; interior matches join on every letter and pair of letters of a name. Names in
    another script also match, with the lowest rank, as they are romanized."""
    name = F.col("name")
    spelled = lambda c, native: F.struct(text.fold_name(c).alias("n"), F.lit(native).alias("native"))
    spellings = F.array_compact(F.array(spelled(name, True), F.when(~text.is_latin(name), spelled(text.to_ascii(name), False))))
    folded = names.select("id", "weight", F.explode(spellings).alias("s")).select("id", "weight", "s.*")
    parts = lambda k: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("n") - (k - 1))), lambda i: F.substr("n", i, F.lit(k)))
    grams = folded.withColumn("g", F.explode(F.array_union(parts(1), parts(2))))
    words = queries.select("query", F.explode(F.array_distinct(F.filter(F.split(text.fold_name(F.col("query")), " "), lambda w: w != ""))).alias("w"))
    hits = grams.join(words.withColumn("g", F.left("w", F.lit(2))), "g").where(F.contains("n", "w"))
    c = F.col
    score = (
        F.when(~c("native"), 10).when(c("n") == c("w"), 100).when(F.startswith("n", "w"), 70).when(F.contains(F.concat(F.lit(" "), "n"), F.concat(F.lit(" "), "w")), 50).otherwise(25)
    )
    best = hits.groupBy("query", "id", "w").agg(F.max(score * c("weight")).alias("s"))
    asked = words.groupBy("query").agg(F.count("*").alias("asked"))
    return best.groupBy("query", "id").agg(F.sum("s").alias("score"), F.count("*").alias("found")).join(asked, "query").where("found = asked").select("query", "id", "score")


def resolve_resource(target: Column, base: Column) -> Column:
    """A resource's path: opaque ones as they are, ``^`` and ``/`` from the root, others from the base; ``..`` stops there."""
    whole = F.when(target.rlike("^[/^]"), F.substr(target, F.lit(2))).otherwise(F.concat_ws("/", base, target))
    stack = F.aggregate(
        F.split(whole, "/"), F.array().cast("array<string>"),
        lambda acc, p: F.when(p.isin("", "."), acc).when(p == "..", F.slice(acc, F.lit(1), F.greatest(F.lit(0), F.size(acc) - 1))).otherwise(F.concat(acc, F.array(p))))
    return F.when(values.is_opaque(target), target).otherwise(F.concat(F.lit("/"), F.array_join(stack, "/")))


def stars(ranking: Column) -> Column:
    return reduce(lambda x, kv: x.when(ranking >= kv[0], kv[1]), ((90, 5), (75, 4), (55, 3), (35, 2)), F.when(F.lit(False), 0)).otherwise(1)


# --- items, plans and what a reader sees ---------------------------------------------------------------------------------


def sanitized_items(raw: Column, documents: bool = False) -> Column:
    """Media or document items of a JSON list: ``items`` (label, target, ``type`` of documents, ``rest`` of the members) and how
    many were ``dropped`` for want of a label or a target. Of equal targets the first stays; the order is kept."""
    entries = F.coalesce(F.from_json(raw, "array<string>"), F.array().cast("array<string>"))
    own = ["label", "target"] + ["type"] * documents

    def item(e: Column) -> Column:
        m = F.coalesce(F.from_json(e, "map<string,string>"), F.create_map().cast("map<string,string>"))
        return text.let(m, lambda m: F.struct(
            text.text_or_null(F.element_at(m, "label")).alias("label"), values.target(text.text_or_null(F.element_at(m, "target"))).alias("target"),
            (values.document_type(text.text_or_null(F.element_at(m, "type"))) if documents else F.lit(None).cast("string")).alias("type"),
            F.sort_array(F.map_entries(F.map_filter(m, lambda k, v: ~k.isin(*own) & v.isNotNull()))).alias("rest")))

    def judged(read: Column) -> Column:
        good = F.filter(read, lambda x: x["label"].isNotNull() & x["target"].isNotNull())
        return F.struct(text.distinct_by(good, lambda x: x["target"]).alias("items"), (F.size(read) - F.size(good)).alias("dropped"))

    return text.let(F.transform(entries, item), judged)


def extraction_plan(exists: Column, on_existing: str, missing: Column) -> Column:
    """``create`` without a dossier, else as configured; completing one that lacks nothing asks nothing: ``nothing-left``."""
    plan = F.when(~exists, "create").otherwise(F.lit(on_existing))
    return F.when((plan == "complete") & (F.size(missing) == 0), "nothing-left").otherwise(plan)


def edition(langs: Column, ui: Column) -> Column:
    """The language an entry is read in: the reader's if there is such an edition, else the original, which comes first."""
    return F.when(F.array_contains(langs, ui), ui).otherwise(F.get(langs, F.lit(0)))


def _leave(path: Column, otherwise: Column) -> Column:
    return F.when((path == "") | path.rlike("^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//"), path).otherwise(otherwise)


def catalogue_path(path: Column, base: str = "") -> Column:
    return _leave(path, F.concat(F.lit(f"{base}/"), F.regexp_replace(path, "^/+", "")))


def localized_path(path: Column, lang: Column) -> Column:
    return _leave(path, F.concat(F.lit("/"), lang, F.lit("/"), F.regexp_replace(path, "^/+", "")))


def portrait(img: Column, gender: Column) -> Column:
    """The declared portrait, else the default one of the gender; none declared is mixed."""
    default = F.when(gender == "m", "male").when(gender == "f", "female").otherwise("mixed")
    return F.coalesce(img, F.concat(F.lit("photos/default-"), default, F.lit(".svg")))


def monogram(slug: Column, name: Column) -> Column:
    """What stands for a portrait that doesn't load: up to two initials, and a colour (degrees) that the slug decides."""
    words = F.filter(F.split(name, "[^\\p{L}]+"), lambda w: w != "")
    first, last = F.upper(F.left(F.get(words, F.lit(0)), F.lit(1))), F.when(F.size(words) > 1, F.upper(F.left(F.element_at(words, -1), F.lit(1))))
    return F.struct(F.concat_ws("", first, last).alias("letters"), F.pmod(F.conv(F.left(F.md5(slug), F.lit(8)), 16, 10).cast("long"), F.lit(360)).cast("int").alias("hue"))


def entry_kind(json: Column) -> Column:
    """Declared, never inferred: an entry that names a dossier is a biography, even where that is missing."""
    return F.when(json.isNotNull(), "biography").otherwise("page")


def source_dossier(items: DataFrame, output: DataFrame, authored: DataFrame) -> DataFrame:
    """``items`` (``item``) with the dossier to localize: this run's output, else the authored one beside the article, with
    ``origin`` and a hash of its text. A file that isn't JSON counts as none."""
    def readable(files: DataFrame, name: str) -> DataFrame:
        return files.where(F.try_parse_json("raw").isNotNull()).select("item", F.col("raw").alias(name))

    both = items.join(readable(output, "made"), "item", "left").join(readable(authored, "written"), "item", "left")
    raw = F.coalesce("made", "written")
    return both.select("item", F.when(F.col("made").isNotNull(), "output").when(F.col("written").isNotNull(), "source").alias("origin"), text.short_hash(raw, 12).alias("hash"))
