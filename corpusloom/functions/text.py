"""Text normalizers as column expressions: trimming, folding, romanization, name tokens, phonetic keys.

All are built-in expressions, so they run inside code generation. Tables of accented letters are derived from the
Unicode database by rule, not listed.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = "[\\s\\p{Z}\\x{FEFF}]+"


def trim_all(c: Column) -> Column:
    """Trim of Unicode white space at both ends."""
    return F.regexp_replace(F.regexp_replace(c, f"^{_SPACE}", ""), f"{_SPACE}$", "")


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, _SPACE, " "))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, and once in the plan: large expressions don't multiply."""
    return F.transform(F.array(value), body)[0]


def text_or_null(c: Column) -> Column:
    """A trimmed, non-empty string, else null."""
    return F.nullif(trim_all(c), F.lit(""))


@lru_cache
def _bare_letters() -> tuple[str, str]:
    """Letters of the Latin, Greek and Cyrillic blocks whose canonical decomposition is one letter and marks."""
    source, bare = [], []
    for code in [*range(0xC0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000)]:
        base = [x for x in unicodedata.normalize("NFD", chr(code)) if not unicodedata.category(x).startswith("M")]
        if len(base) == 1 and base[0] != chr(code):
            source.append(chr(code))
            bare.append(base[0])
    return "".join(source), "".join(bare)


def strip_marks(c: Column) -> Column:
    """Decompose, drop marks, compose again."""
    return F.regexp_replace(F.translate(c, *_bare_letters()), "\\p{M}+", "")


def fold_name(c: Column) -> Column:
    """The key under which two spellings of a name are one."""
    return collapse(F.lower(strip_marks(c)))


def vocabulary_key(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(strip_marks(c)), "[^\\p{L}\\p{N}]+", "-"), "^-+|-+$", "")


def country_key(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(strip_marks(c)), "[^\\p{L}\\p{N}]+", " "))


# Latin letters that don't decompose, and a practical romanization of Cyrillic.
UNDECOMPOSED = {"æ": "ae", "œ": "oe", "ø": "o", "ð": "d", "þ": "th", "ß": "ss", "ł": "l", "đ": "d", "ħ": "h", "ı": "i", "ŋ": "n"}
ROMAN = dict(zip("абвгдеёзийклмнопрстуфыэіґў", "abvgdeezijklmnoprstufyeigw", strict=True)) | {
    "й": "y", "ж": "zh", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ь": "", "ю": "yu", "я": "ya",
    "ї": "yi", "є": "ye",
}


def _replace_all(c: Column, table: dict[str, str]) -> Column:
    """One ``translate`` for single letters, one ``replace`` for each longer value; capitals become a capital first letter."""
    full = dict(table)
    for a, b in table.items():
        if a.upper() != a and len(a.upper()) == 1:
            full.setdefault(a.upper(), b[:1].upper() + b[1:])
    single = {a: b for a, b in full.items() if len(b) == 1}
    c = F.translate(c, "".join(single), "".join(single.values()))
    gone = "".join(a for a, b in full.items() if not b)
    c = F.translate(c, gone, "") if gone else c
    return reduce(lambda x, ab: F.replace(x, F.lit(ab[0]), F.lit(ab[1])), ((a, b) for a, b in full.items() if len(b) > 1), c)


def fold_ascii(c: Column) -> Column:
    return strip_marks(_replace_all(c, UNDECOMPOSED))


def has_cyrillic(c: Column) -> Column:
    return c.rlike("\\p{IsCyrillic}")


def is_ascii(c: Column) -> Column:
    return c.rlike("^[\\x20-\\x7E]*$")


def has_letters(c: Column) -> Column:
    return c.rlike("\\p{L}")


def is_latin(c: Column) -> Column:
    """At least one letter, and no letter of another script."""
    return has_letters(c) & ~c.rlike("[\\p{L}&&[^\\p{IsLatin}]]")


def script_of(c: Column) -> Column:
    return F.when(has_cyrillic(c), "cyrillic").otherwise("latin")


def romanize(c: Column) -> Column:
    """Cyrillic in Latin letters; null for text without Cyrillic."""
    return F.when(has_cyrillic(c), F.nullif(collapse(fold_ascii(_replace_all(c, ROMAN))), F.lit("")))


def to_ascii(c: Column) -> Column:
    t = trim_all(c)
    folded = fold_ascii(t)
    return F.when(t == "", None).when(is_ascii(folded), folded).otherwise(romanize(t))


# Name particles, and words that are never a name.
PARTICLES = """de del della dello di da das dos du van von der den ter la le el al bin ibn ben mac mc st saint san
    де дель ди да дос ван фон ла ле эль аль сан""".split()
NOISE = """cd cds lp lps ep dvd vhs lcd cdr mc vinyl album cover covers disc disk box set vol part pt book books poster
    afisha program programme magazine journal press pub concert festival award diplom diploma logo banner flyer ticket
    guitar guitars gitara score scores note notes noty tab tabs tablature sheet music song songs suite sonata concerto
    etude etudes opus op trio duo duet quartet quintet ensemble orchestra band group unused old new copy small big large
    thumb thumbs icon mini preview orig original final draft temp tmp img image photo photos pic pics picture foto scan
    scans tech technique shkola school lesson master class with and feat featuring portrait young
    jan feb mar apr may jun jul aug sep sept oct nov dec""".split()


def name_fold(c: Column) -> Column:
    """Letters only, folded: ``José-3`` becomes ``jose``."""
    return F.regexp_replace(F.lower(fold_ascii(c)), "[^\\p{L}]+", "")


def is_particle(c: Column) -> Column:
    return c.isin(*PARTICLES)


def is_noise(c: Column) -> Column:
    return c.isin(*NOISE) | c.rlike("^(?:cd|lp|ep|dvd|vhs|lcd|cdr|mc|track|side)\\d+[a-z]?$|^\\d+$") | (F.length(c) < 2)


def split_tokens(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, "[\\s_\\-.+()\\[\\]]+"), name_fold), lambda x: x != "")


#: Digraphs on which transliterations disagree, in the order they collapse.
PHONETIC = (
    ("sch|shch", "sh"), ("tsch|tsh", "ch"), ("ph", "f"), ("th", "t"), ("ck", "k"), ("qu", "kv"), ("[qk]", "k"), ("x", "ks"),
    ("w", "v"), ("[yj]", "i"), ("z", "s"), ("(.)\\1+", "$1"),
)


def phonetic_key(c: Column) -> Column:
    """A key that is the same for usual transliterations of a name: digraphs collapse and inner vowels go. The folded name
    and its short form are computed once; their lambdas are interpreted, not compiled, which costs less than repeats."""

    def framed(short: Column) -> Column:
        inner = F.regexp_replace(F.substr(short, F.lit(2), F.length(short) - 2), "[aeiou]", "")
        return F.when(F.length(short) <= 2, short).otherwise(F.concat(F.left(short, F.lit(1)), inner, F.right(short, F.lit(1))))

    def keyed(key: Column) -> Column:
        return F.when(has_cyrillic(key), key).otherwise(let(reduce(lambda x, ab: F.regexp_replace(x, *ab), PHONETIC, key), framed))

    return let(name_fold(c), keyed)


def deslug(c: Column) -> Column:
    """``john-of-gaunt`` becomes a display name; particles after the first word stay small."""
    parts = F.filter(F.split(c, "[-_]+"), lambda p: p != "")
    named = F.transform(
        parts, lambda p, i: F.when((i > 0) & is_particle(F.lower(p)), F.lower(p)).otherwise(F.concat(F.upper(F.left(p, F.lit(1))), F.substr(p, F.lit(2))))
    )
    return F.array_join(named, " ")


def strip_markdown(c: Column) -> Column:
    steps = (("(?<!!)\\[([^\\]]*)\\]\\(\\s*[^)\\s]+(?:\\s+\"[^\"]*\")?\\s*\\)", "$1"), ("[*_`]", ""), ("\\\\([\\[\\]])", "$1"))
    return collapse(reduce(lambda x, ab: F.regexp_replace(x, *ab), steps, c))


def csv_items(c: Column) -> Column:
    """Items of a comma list: trimmed, inner white space collapsed, empties gone, the first spelling of each kept."""
    items = F.filter(F.transform(F.split(c, ","), collapse), lambda x: x != "")
    return distinct_by(items, F.lower)


def distinct_by(items: Column, key: Callable[[Column], Column]) -> Column:
    """Items in order, without those whose key an earlier one has. Sorting by (key, position) keeps this n log n."""
    keyed = F.transform(items, lambda x, i: F.struct(key(x).alias("k"), i.alias("i"), x.alias("x")))
    ranked = F.transform(F.array(F.sort_array(keyed)), lambda s: F.filter(s, lambda e, j: (j == 0) | (F.get(s, j - 1)["k"] != e["k"])))[0]
    back = F.sort_array(F.transform(ranked, lambda e: F.struct(e["i"].alias("i"), e["x"].alias("x"))))
    return F.transform(back, lambda e: e["x"])


def csv_list(c: Column) -> Column:
    return F.array_join(csv_items(c), ",")


def merge_csv(a: Column, b: Column) -> Column:
    return csv_list(F.concat_ws(",", a, b))


def estimate_tokens(c: Column, chars_per_token: float = 3.2) -> Column:
    """Tokens of a text by its length, where a share of non-ASCII characters lowers the characters of a token."""
    n = F.length(c)
    other = F.length(F.regexp_replace(c, "[\\x00-\\x7F]+", ""))
    per = F.greatest(F.lit(1.0), F.lit(chars_per_token) * (1 - F.lit(0.45) * other / n))
    return F.when(n == 0, F.lit(0)).otherwise(F.ceil(n / per)).cast("long")


def chars_for_tokens(tokens: Column, chars_per_token: float = 3.2) -> Column:
    return F.greatest(F.lit(0), F.floor(tokens * F.lit(chars_per_token))).cast("long")


def short_hash(c: Column, n: int = 12) -> Column:
    return F.left(F.sha2(c, 256), F.lit(n))


def unit_key(c: Column) -> Column:
    return short_hash(trim_all(c), 8)


def structure_hash(fields: dict[str, Column], n: int = 16) -> Column:
    """Hash of a JSON object with its keys in order; absent values are left out."""
    return short_hash(F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)])), n)
