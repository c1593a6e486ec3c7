"""Partial dates: wide reading of authored forms, one canonical form out, and never a guess."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, trim_all

# Hedges before a date, filler words within one, and month stems by language, matched as beginnings.
HEDGE = "(?iu)^(?:c\\.?|ca\\.?|circa|about|around|~|ок\\.?|около|прибл\\.?|примерно|etwa|vers|hacia)\\s+"
FILLER = "г гг года году of the de del dell dello di der des el le la em no nel en".split()
MONTHS = (
    "январ феврал март апрел ма июн июл август сентябр октябр ноябр декабр",
    "jan feb mar apr may jun jul aug sep oct nov dec",
    "ener febrer marz abril may juni juli agost septiembr octubr noviembr diciembr",
    "januar februar märz april mai juni juli august september oktober november dezember",
    "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "gennaio febbraio marzo aprile maggio giugno luglio agosto settembre ottobre novembre dicembre",
    "janeiro fevereiro março abril maio junho julho agosto setembro outubro novembro dezembro",
)
RANK = {"day": 3, "month": 2, "year": 1}


def month_stems() -> list[tuple[str, int]]:
    """Stem and month in matching order; a stem that two languages share keeps its first place and its last month."""
    table: dict[str, int] = {}
    for line in MONTHS:
        for i, stem in enumerate(line.split()):
            table[stem] = i + 1
    return list(table.items())


def month_of(word: Column) -> Column:
    """Month of a lower-case word that begins with a stem; the first stem in order decides. One regex for each month
    boundary of that order keeps the expression small."""
    out = F.lit(None).cast("int")
    runs: list[tuple[int, list[str]]] = []
    for stem, month in month_stems():
        if runs and runs[-1][0] == month:
            runs[-1][1].append(stem)
        else:
            runs.append((month, [stem]))
    for month, stems in reversed(runs):
        out = F.when(word.rlike(f"^(?:{'|'.join(stems)})"), F.lit(month)).otherwise(out)
    return out


def _parts(day: Column, month: Column, year: Column) -> Column:
    return F.struct(day.alias("d"), month.alias("m"), year.alias("y"))


def _assemble(p: Column) -> Column:
    """The date struct if year, month and day exist in the calendar; parts that are null aren't stated."""
    n = F.struct(p["y"].try_cast("int").alias("y"), p["m"].try_cast("int").alias("m"), p["d"].try_cast("int").alias("d"))

    def of(x: Column) -> Column:
        y, m, d = x["y"], x["m"], x["d"]
        last = F.dayofmonth(F.last_day(F.make_date(y, F.when(m.between(1, 12), m), F.lit(1))))
        kind = (
            F.when(~F.coalesce(y.between(1000, 9999), F.lit(False)), None)
            .when(p["m"].isNull(), "year")
            .when(~m.between(1, 12), None)
            .when(p["d"].isNull(), "month")
            .when(d.between(1, last), "day")
        )
        return F.struct(kind.alias("kind"), y.alias("y"), m.alias("m"), d.alias("d"))

    def shown(x: Column) -> Column:
        month, day = (F.lpad(x[k].cast("string"), 2, "0") for k in ("m", "d"))
        value = F.when(x["kind"] == "year", p["y"]).when(x["kind"] == "month", F.concat_ws(".", month, p["y"])).otherwise(F.concat_ws(".", day, month, p["y"]))
        return F.when(x["kind"].isNotNull(), F.struct(
            value.alias("value"), x["kind"].alias("precision"), x["y"].alias("year"), F.when(x["kind"] != "year", x["m"]).alias("month"),
            F.when(x["kind"] == "day", x["d"]).alias("day")))

    return let(n, lambda x: let(of(x), shown))


def _spelled(v: Column) -> Column:
    """Parts of a date in words: two or three words that are a year, a day number or one month name, and nothing else."""
    words = F.filter(F.split(F.regexp_replace(F.lower(v), "[.,]", " "), "\\s+"), lambda w: (w != "") & ~w.isin(*FILLER))

    def read(ws: Column) -> Column:
        number = "^\\d{4}$|^\\d{1,2}(?:st|nd|rd|th|-?(?:го|е))?$"
        year = F.get(F.filter(ws, lambda w: w.rlike("^\\d{4}$")), F.lit(0))
        day = F.get(F.filter(ws, lambda w: w.rlike("^\\d{1,2}(?!\\d)")), F.lit(0))
        rest = F.filter(ws, lambda w: ~w.rlike(number))
        month = month_of(F.get(rest, F.lit(0)))
        found = _parts(F.regexp_replace(day, "\\D", ""), month.cast("string"), year)
        return let(found, lambda p: F.when(F.size(ws).between(2, 3) & (F.size(rest) == 1) & p["y"].isNotNull() & p["m"].isNotNull(), p))

    return let(words, read)


_FORMS = (
    ("^(\\d{4})[-.](\\d{1,2})[-.](\\d{1,2})$", 3, 2, 1),
    ("^(\\d{1,2})[.\\-/\\s](\\d{1,2})[.\\-/\\s](\\d{4})$", 1, 2, 3),
    ("^(\\d{4})[-.](\\d{1,2})$", None, 2, 1),
    ("^(\\d{1,2})[.\\-/](\\d{4})$", None, 1, 2),
)
_YEAR = "(?iu)^(\\d{4})(?:\\s*(?:г\\.?|года|year))?$"
_RANGE = "[–—]|\\s-\\s|\\d{4}\\s*[-–—/]\\s*\\d{4}"


def parse_date(raw: Column) -> Column:
    """``struct(value, precision, year, month, day)`` of an authored date, or null for ranges and anything else."""

    def read(v: Column) -> Column:
        none = F.lit(None).cast("string")
        part = lambda p, g: F.regexp_extract(v, p, g) if g else none
        last = F.coalesce(_spelled(v), F.when(v.rlike(_YEAR), _parts(none, none, F.regexp_extract(v, _YEAR, 1))))
        out = reduce(lambda x, f: F.when(v.rlike(f[0]), _parts(*(part(f[0], g) for g in f[1:]))).otherwise(x), reversed(_FORMS), last)
        return let(F.when((v != "") & ~v.rlike(_RANGE), out), _assemble)

    return let(F.trim(F.regexp_replace(F.regexp_replace(trim_all(raw), "[,;]+$", ""), HEDGE, "")), read)


def _rank(precision: Column) -> Column:
    return reduce(lambda x, kv: F.when(precision == kv[0], kv[1]).otherwise(x), RANK.items(), F.lit(0))


def normalize_date(raw: Column, least: str = "day") -> Column:
    return let(parse_date(raw), lambda d: F.when(_rank(d["precision"]) >= RANK[least], d["value"]))


def precision_of(c: Column) -> Column:
    """Precision of a canonical value by its parts."""
    t = trim_all(c)
    return F.when(t.rlike("^\\d{1,2}\\.\\d{1,2}\\.\\d{4}$"), "day").when(t.rlike("^\\d{1,2}\\.\\d{4}$"), "month").when(t.rlike("^\\d{4}$"), "year")


def is_valid_date(c: Column, least: str = "day") -> Column:
    """Grammar with days 1-31 and months 1-12: what a reader accepts, 31.02 too."""
    t, p = trim_all(c), precision_of(c)
    n = F.transform(F.split(t, "\\."), lambda x: x.try_cast("int"))
    day_ok = (p != "day") | F.get(n, F.lit(0)).between(1, 31)
    month_ok = F.when(p == "day", F.get(n, F.lit(1)).between(1, 12)).when(p == "month", F.get(n, F.lit(0)).between(1, 12)).otherwise(F.lit(True))
    return F.coalesce((_rank(p) >= RANK[least]) & day_ok & month_ok, F.lit(False))


def refines(current: Column, candidate: Column) -> Column:
    """Whether ``candidate`` is a strictly sharper reading of the same date."""
    both = F.struct(parse_date(current).alias("a"), parse_date(candidate).alias("b"))

    def sharper(x: Column) -> Column:
        a, b = x["a"], x["b"]
        return (_rank(b["precision"]) > _rank(a["precision"])) & (a["year"] == b["year"]) & (a["month"].isNull() | (a["month"] == b["month"]))

    return F.coalesce(let(both, sharper), F.lit(False))


def year_of(c: Column) -> Column:
    return parse_date(c)["year"]


def age_in(born: Column, year: Column) -> Column:
    """Years by subtraction of years."""
    return year - year_of(born)
