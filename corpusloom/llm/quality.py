"""Quality rules: a threshold table compiled into one projection of built-in expressions.

Every feature is a native expression over the text column, so the operator is a map without shuffle or user
functions. The sort behind ``n_repeat_words`` is inside one row's array, bounded by one text.

Defined cases: a null or empty text has zero words and fails ``min_words``; ratios with a zero denominator are 0;
repeated rows are judged alike; other columns pass through untouched, and columns of the result's names are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
_TRIM = ".,;:!?"

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = tuple(
    sorted(
        {
            *"a an and are as at be by for from in is it of on or that the this to was with".split(),
            *"auf das dem den der des die ein eine für ist mit nicht sich und von zu".split(),
            *"dans de des du en est et la le les par pas plus pour que qui sur un une".split(),
            *"al con de del el la las los no para por se su un una y".split(),
        }
    )
)


@dataclass(frozen=True)
class Rule:
    """A document fails the rule where ``feature`` is below ``least`` or above ``most``."""

    name: str
    feature: str
    least: float | None = None
    most: float | None = None


#: The production table. Ratios are a word's, line's or letter's share.
RULES = (
    Rule("word_length", "mean_word_chars", 2.5, 12.0),
    Rule("symbols", "symbol_ratio", most=0.1),
    Rule("stop_words", "stop_ratio", least=0.02),
    Rule("upper_case", "upper_ratio", most=0.4),
    Rule("duplicate_lines", "dup_line_ratio", most=0.5),
    Rule("ellipsis_lines", "ellipsis_line_ratio", most=0.3),
    Rule("bullet_lines", "bullet_line_ratio", most=0.9),
)
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: a lambda variable isn't inlined into inner lambdas."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more. A document's windows are compared by 64-bit hash."""

    def over(ws: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(0), F.size(ws) - 3), lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2))
        )
        return _let(hashes, among)

    def among(hs: Column) -> Column:
        ranked = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(_let(ranked, covered))

    def covered(s: Column) -> Column:
        starts = F.sort_array(
            F.array_compact(
                F.transform(
                    s,
                    lambda x, j: F.when(
                        F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                        | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)),
                        x["i"],
                    ),
                )
            )
        )
        zero = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(
            starts,
            zero,
            lambda a, x: F.struct((a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")),
            lambda a: a["n"],
        )

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(_let(words, over))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))


def _count(items: Column, test) -> Column:
    return F.size(F.filter(items, test)).cast("long")


def features(text: Column) -> Column:
    """Counts and ratios of a text as one struct. Words and lines are split once, whatever reads the struct."""
    t = F.coalesce(text, F.lit(""))

    def over(x: Column) -> Column:
        ws, ls, t = x["words"], x["lines"], x["t"]
        return F.struct(
            F.size(ws).cast("long").alias("n_words"), F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"), _repeat_words(ws).cast("long").alias("n_repeat_words"),
            _count(ws, lambda w: F.lower(F.rtrim(w, F.lit(_TRIM))).isin(*STOP_WORDS)).alias("n_stop"),
            F.length(F.regexp_replace(t, "[^A-ZÀ-ÖØ-Þ]+", "")).cast("long").alias("n_upper"), F.size(ls).cast("long").alias("n_lines"),
            _count(ls, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…")).alias("n_ellipsis"),
            _count(ls, lambda x: F.substring(F.ltrim(x), 1, 1).isin("-", "*", "•")).alias("n_bullets"),
        )

    split = F.struct(
        F.filter(F.split(t, WHITE), lambda w: w != "").alias("words"),
        F.filter(F.split(t, "\n"), lambda x: F.translate(x, " \t\x0b\x0c\r", "") != "").alias("lines"), t.alias("t"),
    )
    return _let(split, over)


def _verdict(f: Column, rules: tuple[Rule, ...], min_words: int, max_repeat_percent: int) -> tuple[Column, Column]:
    """Whether the base rules fail, and the names of the table's rules that do."""
    ratios = {
        "mean_word_chars": _ratio(f["word_chars"], f["n_words"]), "symbol_ratio": _ratio(f["n_symbols"], f["n_words"]), "stop_ratio": _ratio(f["n_stop"], f["n_words"]),
        "upper_ratio": _ratio(f["n_upper"], f["word_chars"]), "dup_line_ratio": _ratio(f["n_dup_lines"], f["n_lines"]),
        "ellipsis_line_ratio": _ratio(f["n_ellipsis"], f["n_lines"]), "bullet_line_ratio": _ratio(f["n_bullets"], f["n_lines"]),
    }
    failed = []
    for r in rules:
        x, bad = ratios[r.feature], F.lit(False)
        if r.least is not None:
            bad = bad | (x < r.least)
        if r.most is not None:
            bad = bad | (x > r.most)
        failed.append(F.when(bad, F.lit(r.name)))
    base = (f["n_words"] < min_words) | (100 * f["n_repeat_words"] > max_repeat_percent * f["n_words"])
    return base, F.array_compact(F.array(*failed))


def assess(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, min_words: int = MIN_WORDS,
           max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """``df`` with counts, ``failed_rules`` (names), ``base_failed`` and ``kept``."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    own = [*counts, "base_failed", "failed_rules", "kept"]
    rest = [F.col(f"`{c}`") for c in df.columns if c not in own]

    def judged(f: Column) -> Column:
        base, failed = _verdict(f, rules, min_words, max_repeat_percent)
        return F.struct(*[f[c].alias(c) for c in counts], base.alias("base_failed"), failed.alias("failed_rules"))

    a = df.select(*rest, _let(features(F.col(f"`{text_col}`")), judged).alias("__f"))
    a = a.select(*rest, *[F.col(f"__f.{c}").alias(c) for c in own[:-1]])
    return a.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def keep_good(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, min_words: int = MIN_WORDS,
              max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """Rows of ``df`` that every rule accepts, with the columns of ``df``: one filter, whose features are computed once."""

    def good(f: Column) -> Column:
        base, failed = _verdict(f, rules, min_words, max_repeat_percent)
        return ~base & (F.size(failed) == 0)

    return df.where(_let(features(F.col(f"`{text_col}`")), good))


def _sql_between(r: Rule, x: str) -> str:
    parts = ([f"{x} < {r.least}"] if r.least is not None else []) + ([f"{x} > {r.most}"] if r.most is not None else [])
    return "(" + " or ".join(parts) + ")"


def sql(source: str = "documents") -> str:
    """The same verdicts in DuckDB SQL: a relation of ``source``'s columns and the result's."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    ratio = lambda a, b: f"(case when {b} > 0 then {a}::double / {b} else 0.0 end)"
    ratios = {
        "mean_word_chars": ratio("word_chars", "n_words"),
        "symbol_ratio": ratio("n_symbols", "n_words"),
        "stop_ratio": ratio(f"len(list_filter(ws, lambda w: lower(rtrim(w, '{_TRIM}')) in ({stop})))", "n_words"),
        "upper_ratio": ratio("length(regexp_replace(t, '[^A-ZÀ-ÖØ-Þ]+', '', 'g'))", "word_chars"),
        "dup_line_ratio": ratio("n_dup_lines", "len(ls)"),
        "ellipsis_line_ratio": ratio(
            "len(list_filter(ls, lambda x: ends_with(rtrim(x, ' '), '...') or ends_with(rtrim(x, ' '), '…')))", "len(ls)"
        ),
        "bullet_line_ratio": ratio(
            "len(list_filter(ls, lambda x: ltrim(x, ' ')[1:1] in ('-', '*', '•')))", "len(ls)"
        ),
    }
    verdict = " or ".join(_sql_between(r, ratios[r.feature]) for r in RULES)
    return f"""
    with src as (select *, row_number() over () as __r, coalesce(text, '') as t from {source}),
    split as (select *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls from src),
    wins as (select __r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as win
        from (select __r, ws, unnest(range(1, len(ws) - 1)) as i from split)),
    again as (select __r, unnest([i, i + 1, i + 2]) as k from
        (select __r, i, count(*) over (partition by __r, win) as c from wins) where c > 1),
    rep as (select __r, count(distinct k) as n_repeat_words from again group by __r),
    counted as (select split.*, len(ws)::bigint as n_words,
        length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::bigint as word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
        (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
        coalesce(n_repeat_words, 0)::bigint as n_repeat_words
        from split left join rep using (__r)),
    judged as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed,
        ({verdict}) as rule_failed from counted)
    select * exclude (__r, t, ws, ls, rule_failed), not base_failed and not rule_failed as kept from judged"""
