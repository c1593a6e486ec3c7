"""Paths, URLs, ids, rankings and enumerations as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import distinct_by, trim_all, vocabulary_key

# Fixed values.
AUDIO = ".mp3 .wav .ogg .oga .m4a .aac .flac .mid .midi".split()
IMAGE = ".jpg .jpeg .png .gif .webp .avif .svg .bmp .apng .ico".split()
LANGUAGES = ("ru", "en", "de", "es", "fr", "it", "pt", "zh", "ja", "ko", "uk", "pl", "el")
LANGUAGE_FIXES = {"ch": "zh", "cn": "zh", "jp": "ja", "kr": "ko", "ua": "uk", "gr": "el"}
TYPE_WORDS = {
    "guitarist": "guitarist guitar-player guitar guitarrista guitariste gitarrist chitarrista гитарист гитаристка flamenco-guitarist classical-guitarist",
    "composer": "composer compositor compositeur komponist compositore композитор",
    "conductor": "conductor dirigent chef-d-orchestre дирижер",
    "luthier": "luthier guitar-maker instrument-maker guitar-builder gitarrenbauer лютье мастер-гитар гитарныи-мастер",
    "guitar-historian": "guitar-historian historian musicologist guitar-researcher историк историк-гитары музыковед",
    "publisher": "publisher editor publishing-house verlag издатель издательство",
    "musician": "musician musico musiker musicien музыкант singer vocalist певец performer исполнитель ensemble band ансамбль коллектив "
    "arranger аранжировщик teacher pedagogue педагог",
    "hidden": "hidden page technical about служебная",
}
GENDER_WORDS = {
    "m": "m male man masculine masculino mann homme м муж мужскои мужчина",
    "f": "f female woman feminine femenino frau femme w ж жен женскии женщина",
    "mixed": "mixed group collective ensemble team band n other смешанныи группа коллектив ансамбль",
}
DOCUMENT_WORDS = {
    "TRANSCRIPT": "transcript transcription tab tablature score ноты табулатура переложение",
    "DOSSIER": "dossier досье",
    "ARTICLE": "article essay статья очерк",
    "REFERENCE": "reference link encyclopedia справочник ссылка",
    "SCAN": "scan photo programme program poster скан афиша программа",
    "DISCOGRAPHY": "discography recordings дискография записи",
}


def _lookup(words: dict[str, str]) -> Column:
    pairs = {w: k for k, line in words.items() for w in line.split()}
    return F.create_map(*chain.from_iterable((F.lit(w), F.lit(k)) for w, k in pairs.items()))


def ranking(c: Column) -> Column:
    """A number or numeric string, rounded half up, within 0 to 100. An empty string is 0."""
    t = trim_all(c)
    x = F.when(t == "", F.lit(0.0)).when(t.rlike("^[+-]?(?:\\d+\\.?\\d*|\\.\\d+)(?:[eE][+-]?\\d+)?$"), t.try_cast("double"))
    return F.when(x.isNotNull(), F.least(F.lit(100), F.greatest(F.lit(0), F.floor(x + 0.5)))).cast("int")


def is_opaque(c: Column) -> Column:
    return c.rlike("(?i)^(?:[a-z][a-z0-9+.-]*:|//|[?#])")


def url(c: Column) -> Column:
    """An absolute http address with scheme and host in lower case and a path; null for anything else."""
    t = trim_all(c)
    rest = F.regexp_extract(t, "(?i)^https?://[^/?#\\s]+(\\S*)$", 1)
    head = F.lower(F.regexp_extract(t, "(?i)^(https?://[^/?#\\s]+)", 1))
    head = F.regexp_replace(F.regexp_replace(head, "^(http://.*):80$", "$1"), "^(https://.*):443$", "$1")
    return F.when(t.rlike("(?i)^https?://[^/?#\\s]\\S*$"), F.concat(head, F.when(rest.rlike("^/"), rest).otherwise(F.concat(F.lit("/"), rest))))


def target(c: Column, languages: tuple[str, ...] = LANGUAGES) -> Column:
    """A media target: the sentinel in lower case, a leading supported language folder cut off."""
    t = trim_all(c)
    lang = F.regexp_extract(t, "^([a-z]{2})/", 1)
    return F.when(t == "", None).when(F.lower(t) == "embedded", "embedded").when(lang.isin(*languages) & ~is_opaque(t), F.substr(t, F.lit(4))).otherwise(t)


def extension(c: Column) -> Column:
    name = F.element_at(F.split(F.get(F.split(c, "[?#]"), F.lit(0)), "/"), -1)
    return F.lower(F.regexp_extract(name, "^.+(\\.[^.]*)$", 1))


def is_audio(c: Column) -> Column:
    return extension(c).isin(*AUDIO)


def is_image(c: Column) -> Column:
    return extension(c).isin(*IMAGE)


def slug(c: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(c, "[/\\\\]"), -1), "(?i)(?:\\.bio)?\\.md$", "")


def is_slug(c: Column) -> Column:
    return c.rlike("^[A-Za-z0-9_.-]+$")


def _segments(t: Column) -> Column:
    return F.filter(F.split(t, "/"), lambda p: ~p.isin("", ".", ".."))


def content_path(c: Column) -> Column:
    t = trim_all(c)
    parts = _segments(t)
    return (
        F.when(t == "", None).when(is_opaque(t), t).when(t.rlike("[?#]"), None)
        .when(F.size(parts) > 0, F.concat(F.lit("/"), F.array_join(parts, "/")))
    )


def asset_path(c: Column) -> Column:
    t = trim_all(c)
    parts = _segments(t)
    return F.when(t == "", None).when(is_opaque(t), t).when(F.size(parts) > 0, F.array_join(parts, "/"))


def join_asset(prefix: Column, path: Column) -> Column:
    return F.regexp_replace(F.concat(F.regexp_replace(prefix, "/+$", ""), F.lit("/"), F.regexp_replace(path, "^/+", "")), "^/+", "")


def canonical_id(c: Column) -> Column:
    t = trim_all(c)
    return F.when(t.rlike("^(?:0|[1-9][0-9]*)$"), t)


def language(c: Column, supported: tuple[str, ...] = LANGUAGES) -> Column:
    code = F.get(F.split(F.lower(trim_all(c)), "[-_]"), F.lit(0))
    fixed = F.coalesce(F.create_map(*chain.from_iterable((F.lit(a), F.lit(b)) for a, b in LANGUAGE_FIXES.items()))[code], code)
    return F.when(fixed.rlike("^[a-z]{2}$") & fixed.isin(*supported), fixed)


def languages(c: Column, supported: tuple[str, ...] = LANGUAGES) -> Column:
    """Supported codes of a comma list, in order, without repeats."""
    return F.array_distinct(F.array_compact(F.transform(F.split(c, ","), lambda x: language(x, supported))))


def entry_type(c: Column, allow_unknown: bool = False) -> Column:
    keys = F.filter(F.transform(F.split(trim_all(c), "(?iu)[,;/|+]|\\s+(?:and|und|и)\\s+"), vocabulary_key), lambda k: k != "")
    table = _lookup(TYPE_WORDS)
    crafts = F.array_distinct(F.array_compact(F.transform(keys, lambda k: table[k])))
    unknown = F.get(F.filter(keys, lambda k: table[k].isNull()), F.lit(0))
    out = F.when(F.array_contains(crafts, "hidden"), "hidden").when(F.size(crafts) == 1, F.get(crafts, F.lit(0))).when(F.size(crafts) > 1, "musician")
    return out.when(unknown.rlike("^[a-z0-9][a-z0-9_-]*$"), unknown) if allow_unknown else out


def gender(c: Column) -> Column:
    return _lookup(GENDER_WORDS)[vocabulary_key(c)]


def document_type(c: Column) -> Column:
    key = vocabulary_key(c)
    symbol = F.regexp_replace(F.regexp_replace(F.upper(trim_all(c)), "[^A-Z0-9]+", "_"), "^_+|_+$", "")
    return F.when(key == "", None).otherwise(F.coalesce(_lookup(DOCUMENT_WORDS)[key], F.when(symbol.rlike("^[A-Z][A-Z0-9_]*$"), symbol)))


#: Words that stand for no value.
_NO_VALUE = "unknown|none|null|n/a|na|nil|undefined|not known|not available|unspecified|-|—|?|неизвестно|не известно|нет данных|нет|unbekannt|keine|inconnu|aucun|desconocido|ninguno".split("|")


def stated(c: Column) -> Column:
    """Collapsed text, null for the words that say there is none."""
    t = F.trim(F.regexp_replace(c, "\\s+", " "))
    return F.when(F.lower(t).isin(*_NO_VALUE), None).otherwise(F.nullif(t, F.lit("")))


def card_key(c: Column) -> Column:
    k = F.element_at(F.split(c, "\\."), -1)
    return F.when(k == "title", "latin").otherwise(k)


def union_ordered(a: Column, b: Column, key=lambda x: x) -> Column:
    return distinct_by(F.concat(a, b), key)


def band(c: Column, step: float) -> Column:
    """``c / step`` rounded half up."""
    return F.floor(c / F.lit(step) + F.lit(0.5))


def path_pattern(patterns: list[str]) -> str:
    """Dotted paths with ``*`` for one segment, as one anchored regular expression."""
    escaped = ("\\.".join("[^.]+" if s == "*" else s.replace("-", "\\-") for s in p.split(".")) for p in patterns)
    return f"^(?:{'|'.join(escaped)})$"



def to_fixed(x: Column, digits: int) -> Column:
    """A number that isn't negative with so many decimals, rounded by its exact binary value, ties up. The product's rounding
    error is found by splitting both factors, so a value just below a tie isn't taken for one."""
    scale = float(10**digits)
    x = x.cast("double")
    high = (x * 134217729.0) - ((x * 134217729.0) - x)
    s_high = (scale * 134217729.0) - ((scale * 134217729.0) - scale)
    low, s_low = x - high, scale - s_high
    p = x * scale
    error = ((high * s_high - p) + high * s_low + low * s_high) + low * s_low
    whole = F.floor(p)
    rest = p - whole
    n = whole + F.when((rest > 0.5) | ((rest == 0.5) & (error >= 0)), 1).otherwise(0)
    if not digits:
        return n.cast("string")
    unit = F.lit(10**digits).cast("long")
    return F.concat(F.floor(n / unit).cast("string"), F.lit("."), F.lpad(F.pmod(n, unit).cast("string"), digits, "0"))


def format_tokens(n: Column) -> Column:
    return F.when(n < 1000, n.cast("string")).when(n < 1_000_000, F.concat(to_fixed(n / 1000, 1), F.lit("k"))).otherwise(F.concat(to_fixed(n / 1_000_000, 2), F.lit("M")))


def format_cost(usd: Column) -> Column:
    return F.when(usd == 0, "$0").when(usd < 0.01, F.concat(F.lit("$"), to_fixed(usd, 5))).otherwise(F.concat(F.lit("$"), to_fixed(usd, 4)))


def format_duration(ms: Column) -> Column:
    seconds = ms / 1000
    minutes = F.floor(seconds / 60)
    rest = F.floor(seconds - minutes * 60 + 0.5).cast("long")
    return (
        F.when(ms < 1000, F.concat(F.floor(ms + 0.5).cast("string"), F.lit("ms"))).when(seconds < 60, F.concat(to_fixed(seconds, 1), F.lit("s")))
        .otherwise(F.concat(minutes.cast("string"), F.lit("m "), rest.cast("string"), F.lit("s")))
    )


def truncate(text: Column, most: int) -> Column:
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.left(text, F.lit(max(0, most - 1))), F.lit("…")))
