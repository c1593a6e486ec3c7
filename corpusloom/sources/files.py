"""Sources: corpora of text files, published catalogues, image indices, memories and journals of JSON lines."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, values


def scan_corpus(spark: SparkSession, root: str, include: str = "*.md", exclude: str | None = None, limit: int | None = None) -> DataFrame:
    """Documents below ``root``: ``id, slug, language, path, content, content_hash, bytes, tokens``. The language is the
    first folder. No match is an error; hidden files aren't read; ``limit`` takes the first by path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", include).load(root)
    base = "^(?:[a-z]+:/*)?/?" + re.escape(re.sub(r"^[a-z]+:/+", "", root).strip("/")) + "/"
    rel = F.regexp_replace("path", base, "")
    d = files.select(rel.alias("path"), F.decode("content", "UTF-8").alias("content"), F.length("content").alias("bytes")).where(~F.col("path").rlike("(?:^|/)\\."))
    if exclude:
        d = d.where(~F.col("path").rlike(exclude))
    if limit:
        d = d.orderBy("path").limit(limit)
    lang = F.regexp_extract("path", "^([a-z]{2,3}(?:-[A-Za-z0-9]+)*)/", 1)
    slug = F.regexp_replace(F.element_at(F.split("path", "/"), -1), "\\.bio\\.md$|\\.md$", "")
    known = F.when(lang == "", F.raise_error(F.concat(F.lit("no language folder in "), "path"))).otherwise(lang)
    out = d.select(F.concat_ws("/", known, slug).alias("id"), slug.alias("slug"), lang.alias("language"), "path", "content",
                   text.short_hash(F.col("content"), 16).alias("content_hash"), "bytes", text.estimate_tokens(F.col("content")).alias("tokens"))
    if not out.limit(1).count():
        raise FileNotFoundError(f"no file below {root} matches {include}")
    return out


def read_catalogue(spark: SparkSession, root: str) -> DataFrame:
    """JSON files of a catalogue: ``path, kind`` (index, names, dossier), ``lang, raw, value`` (null where it can't be parsed)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(root)
    base = "^(?:[a-z]+:/*)?/?" + re.escape(re.sub(r"^[a-z]+:/+", "", root).strip("/")) + "/"
    d = files.select(F.regexp_replace("path", base, "").alias("path"), F.regexp_replace(F.decode("content", "UTF-8"), "^\\x{FEFF}", "").alias("raw"))
    lang = F.coalesce(F.nullif(F.regexp_extract("path", "^index-([a-z]{2})\\.json$", 1), F.lit("")), F.nullif(F.regexp_extract("path", "^([a-z]{2})/", 1), F.lit("")))
    kind = F.when(F.col("path") == "index.json", "index").when(F.col("path").rlike("^index-[a-z]{2}\\.json$"), "names").when(lang.isin(*values.LANGUAGES), "dossier")
    return d.select("path", kind.alias("kind"), lang.alias("lang"), "raw", F.try_parse_json("raw").alias("value")).where("kind is not null")


def read_image_index(spark: SparkSession, path: str) -> DataFrame:
    """Records of an image index of schema version 1; fields out of range are clamped, unknown classes are ``unknown``."""
    schema = ("schemaVersion int, images array<struct<relPath string, image struct<width int, height int, orientation string, mp double>, color struct<mode string>, "
              "meta struct<title string, description string, keywords array<string>, people array<string>, ocr string>, ai struct<class string, confidence double, faceCount int, faceCoverage double>>>")  # fmt: skip
    doc = spark.read.schema(schema).option("multiLine", "true").json(path)
    if not doc.where("schemaVersion = 1 and images is not null").limit(1).count():
        raise ValueError(f"{path} isn't an image index of version 1")
    i = doc.select(F.explode("images").alias("i")).select("i.*").where("relPath is not null")
    w, h = F.coalesce("image.width", F.lit(0)), F.coalesce("image.height", F.lit(0))
    shape = F.when(F.abs(w - h) <= 0.05 * F.greatest(w, h), "square").when(h > w, "portrait").otherwise("landscape")
    unit = lambda c: F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(F.col(c), F.lit(0.0))))
    known = F.col("ai.class").isin("portrait", "upper_body", "full_body", "group", "other", "sheet_music")
    return i.select(
        F.col("relPath").alias("rel_path"), w.alias("width"), h.alias("height"), F.coalesce("image.mp", w * h / 1e6).alias("mp"),
        F.when(F.col("image.orientation").isin("portrait", "square", "landscape"), F.col("image.orientation")).otherwise(shape).alias("orientation"),
        F.coalesce("color.mode", F.lit("unknown")).alias("color"), F.when(known, F.col("ai.class")).otherwise("unknown").alias("class"), unit("ai.confidence").alias("confidence"),
        F.coalesce("ai.faceCount", F.lit(0)).alias("faces"), unit("ai.faceCoverage").alias("coverage"), *[usable(F.col(f"meta.{c}")).alias(c) for c in ("title", "description", "ocr")],
        *[F.filter(F.coalesce(f"meta.{c}", F.array().cast("array<string>")), lambda k: usable(k).isNotNull() & k.rlike("\\p{L}{2}")).alias(c) for c in ("keywords", "people")])


def usable(c: Column) -> Column:
    """A metadata text that isn't machine junk."""
    t = F.trim(c)
    junk = t.rlike("^[{\\[]|'\\w+'\\s*:|(?i)uuid|xmp|exif")
    return F.when(F.length(t).between(2, 400) & ~junk, t)


def read_memory(spark: SparkSession, path: str) -> DataFrame:
    """A translation memory of JSON lines ``{"k": "<lang>:<key>", "v": ...}``: the last line of a key wins, broken lines are
    skipped. Lines have their place by file and offset."""
    lines = spark.read.option("mode", "DROPMALFORMED").schema("k string, v string").json(path).where("k is not null and v is not null")
    placed = lines.withColumn("at", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()))
    return placed.groupBy("k").agg(F.max_by("v", "at").alias("v")).select(F.split_part("k", F.lit(":"), F.lit(1)).alias("lang"), F.split_part("k", F.lit(":"), F.lit(2)).alias("key"), "v")


def interpolate(value, env: Mapping[str, str] = os.environ):
    """``${NAME}`` and ``${NAME:-default}`` in the strings of a parsed configuration."""
    if isinstance(value, dict):
        return {k: interpolate(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [interpolate(v, env) for v in value]
    if not isinstance(value, str):
        return value

    def put(m: re.Match) -> str:
        if m[1] in env or m[2] is not None:
            return env.get(m[1], m[2] or "")
        raise KeyError(f"environment variable {m[1]} is not set")

    return re.sub(r"\$\{(\w+)(?::-([^}]*))?\}", put, value)


def deep_merge(base: dict, over: dict) -> dict:
    """Objects merge, lists and scalars replace, ``None`` leaves what is there."""
    out = dict(base)
    for k, v in over.items():
        if isinstance(v, dict) and isinstance(out.get(k), dict):
            out[k] = deep_merge(out[k], v)
        elif v is not None:
            out[k] = v
    return out


def redact(config):
    """A configuration without secrets, for printing."""
    if isinstance(config, dict):
        return {k: "***" if re.search(r"(?i)api.?key|authorization|token|secret|password", k) and isinstance(v, str) else redact(v) for k, v in config.items()}
    return [redact(v) for v in config] if isinstance(config, list) else config
