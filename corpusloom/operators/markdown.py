"""Markdown structure: blocks, segments, skeletons, translatable spans and media, as generators over one text column.

These are state machines over lines (fences swallow containers, containers nest), which built-in expressions can't
say, so each runs in Arrow batches of Python; a text is one row's value and is never split over tasks.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame

FENCE = re.compile(r"\s*(`{3,}|~{3,})(.*)")
CONTAINER = re.compile(r"\s*:::\s*(\S*)\s*")
HEADING = re.compile(r"(#{1,6})\s+(\S.*)")
RULE = re.compile(r"\s*([-*_])(\s*\1){2,}\s*")
TABLE = re.compile(r"\s*\|.*\|\s*")
LINK = re.compile(r'(?<!!)\[([^\]]*)\]\(\s*([^)\s]+)(?:\s+"[^"]*")?\s*\)')
IMAGE = re.compile(r'!\[([^\]]*)\]\(\s*([^)\s]+)(?:\s+"[^"]*")?\s*\)')


@dataclass
class Line:
    text: str
    at: int
    #: fence (its delimiter), code, container, end, blank, rule, heading or text
    kind: str
    name: str = ""
    level: int = 0
    marker: str = ""


def lines(content: str, strict: bool = True) -> Iterator[Line]:
    """The lines of a text, classified. ``strict``: a fence ends with at least as many marks as it began with."""
    at, open_mark = 0, ""
    for raw in content.split("\n"):
        fence = FENCE.fullmatch(raw)
        if open_mark:
            ends = fence and fence[1][0] == open_mark[0] and (not strict or len(fence[1]) >= len(open_mark))
            yield Line(raw, at, "fence" if ends else "code", "end", marker=open_mark)
            open_mark = "" if ends else open_mark
        elif fence:
            open_mark = fence[1]
            yield Line(raw, at, "fence", fence[2].strip(), marker=open_mark)
        elif not raw.strip():
            yield Line(raw, at, "blank")
        elif box := CONTAINER.fullmatch(raw):
            yield Line(raw, at, "container" if box[1] else "end", box[1])
        elif head := HEADING.fullmatch(raw):
            yield Line(raw, at, "heading", head[2], len(head[1]))
        elif RULE.fullmatch(raw):
            yield Line(raw, at, "rule")
        else:
            yield Line(raw, at, "text")
        at += len(raw) + 1


@dataclass
class Block:
    kind: str
    start: int
    end: int
    text: str = ""
    level: int | None = None
    name: str | None = None


def blocks(content: str) -> list[Block]:
    """Atomic blocks. Fences and named containers are whole, to the text's end if they aren't closed."""
    out: list[Block] = []
    depth, current = 0, None

    def close(end: int) -> None:
        nonlocal current
        if current:
            current.end = end
            out.append(current)
            current = None

    last_end = 0
    for x in lines(content):
        end = x.at + len(x.text)
        if depth:  # inside a container: count openings and bare closings outside code
            depth += {"container": 1, "end": -1}.get(x.kind, 0)
            if not depth:
                close(end)
        elif current and current.kind == "fence":
            if x.kind == "fence":
                close(end)
        else:
            if current and not (current.kind == "text" and x.kind == "text"):
                close(last_end)
            if x.kind == "fence":
                current = Block("fence", x.at, end)
            elif x.kind == "container":
                current, depth = Block("container", x.at, end, name=x.name), 1
            elif x.kind in ("heading", "rule"):
                out.append(Block(x.kind, x.at, end, level=x.level or None))
            elif x.kind in ("text", "end") and not current:
                current = Block("text", x.at, end)
        last_end = end
    close(last_end)
    for b in out:
        b.text = content[b.start : b.end]
    return out


def estimate(text: str, per_token: float = 3.2) -> int:
    """Tokens of a text by its length and share of non-ASCII characters."""
    if not text:
        return 0
    other = sum(c > "\x7f" for c in text)
    return math.ceil(len(text) / max(1.0, per_token * (1 - 0.45 * other / len(text))))


@dataclass
class Segment:
    label: str
    text: str
    start: int
    end: int
    truncated: bool = False
    tokens: int = field(init=False)

    def __post_init__(self) -> None:
        self.tokens = estimate(self.text)


def _fitting(costs: list[int], most: int) -> int:
    """How many leading costs fit."""
    total = 0
    for i, c in enumerate(costs):
        total += c
        if total > most:
            return i
    return len(costs)


def full(content: str) -> Segment:
    return Segment("full", content, 0, len(content))


def head(content: str, most: int) -> Segment:
    """The leading blocks that fit; of one oversized block a cut by characters."""
    if estimate(content) <= most:
        end = len(content)
    else:
        parts = blocks(content)
        k = _fitting([estimate(b.text) for b in parts], most)
        end = parts[k - 1].end if k else min(len(content), max(0, math.floor(most * 3.2)))
    return Segment("head", content[:end], 0, end, end < len(content))


def head_and_tail(content: str, first: int, last: int) -> Segment:
    start = head(content, first).end
    parts = blocks(content)
    k = _fitting([estimate(b.text) for b in reversed(parts)], last) if last > 0 else 0
    tail = parts[-k].start if k else len(content)
    if tail <= start:
        return head(content, first + last)
    return Segment("head+tail", f"{content[:start]}\n\n[…]\n\n{content[tail:]}", 0, len(content), True)


def chunks(content: str, most: int, overlap: int = 0, at_headings: bool = True) -> list[Segment]:
    """Blocks packed in order, at most ``most`` tokens a chunk, broken early before a heading once half full; with
    ``overlap`` a chunk begins with the last blocks of the one before it."""
    groups: list[list[Block]] = []
    size = 0
    for b in blocks(content):
        cost = estimate(b.text)
        if not groups or size + cost > most or (at_headings and b.kind == "heading" and size >= most / 2):
            groups.append([])
            size = 0
        groups[-1].append(b)
        size += cost
    if not groups:
        return [full(content)]
    out = []
    for i, group in enumerate(groups):
        carried = groups[i - 1][len(groups[i - 1]) - _fitting([estimate(b.text) for b in reversed(groups[i - 1])], overlap) :] if i and overlap else []
        whole = carried + group
        out.append(Segment(f"chunk {i + 1}/{len(groups)}", "\n\n".join(b.text for b in whole), whole[0].start, whole[-1].end))
    return out


def attempts(content: str, strategy: str, budget: int, head_tokens: int = 800, tail_tokens: int = 0, chunk_tokens: int = 1200,
             overlap: int = 0, overhead: int = 0) -> list[dict]:
    """The ladder of contexts to try, cheapest first: ``rung, kind, segments, tokens, partial``."""
    whole = full(content)
    first = head(content, min(head_tokens, budget))
    if strategy == "full" or (strategy in ("truncation-first", "staged") and not first.truncated) or (strategy == "chunked" and whole.tokens <= budget):
        ladder = [("full", [whole])]
    elif strategy == "truncation-first":
        ladder = [("head", [first]), ("full", [whole])]
    elif strategy == "chunked":
        ladder = [("chunked", chunks(content, min(chunk_tokens, budget), overlap))]
    elif strategy == "staged":
        rest = ("full", [whole]) if whole.tokens <= budget else ("chunked", chunks(content, min(chunk_tokens, budget), overlap))
        n = min(head_tokens, budget)
        ladder = [("head", [first]), ("head-tail", [head_and_tail(content, n, tail_tokens or n // 2)]), rest]
    else:
        raise ValueError(f"unknown strategy {strategy}")
    return [{"rung": i, "kind": k, "segments": len(s), "tokens": sum(x.tokens for x in s) + overhead * len(s), "partial": any(x.truncated for x in s)}
            for i, (k, s) in enumerate(ladder)]


# Attribute keys that are syntax, and those whose values are prose.
SYNTAX_KEYS = frozenset("src position size align width height target type id".split())
PROSE_KEYS = frozenset("caption title alt label text".split())
KEY = re.compile(r"\s*([A-Za-z][\w-]*)\s*:\s*(.+)")


def skeleton(content: str) -> list[str]:
    """Structure tokens of a text; code adds nothing but its fences."""
    out: list[str] = []

    def inline(s: str) -> None:
        out.extend(f"img:{m[2]}" for m in IMAGE.finditer(s))
        out.extend(f"link:{m[2]}" for m in LINK.finditer(s))

    for x in lines(content, strict=False):
        if x.kind == "fence":
            out.append(f"fence:{x.name}")
        elif x.kind in ("container", "end"):
            out.append(f"container:{x.name or 'end'}")
        elif x.kind == "heading":
            out.append(f"h{x.level}")
            inline(x.name)
        elif x.kind == "rule":
            out.append("rule")
        elif x.kind == "text":
            t = x.text
            if TABLE.fullmatch(t):
                out.append(f"tr:{t.count('|') - 1}")
                continue
            key = KEY.fullmatch(t)
            forms = ((r"\s*>", "quote"), (r"\s*[-*+]\s", "li"), (r"\s*\d+[.)]\s", "oli"))
            kind = next((k for p, k in forms if re.match(p, t)), None)
            out.append(kind or (f"kv:{key[1]}" if key and key[1].lower() in SYNTAX_KEYS else "p"))
            inline(t)
    return out


def flowing(tokens: list[str]) -> list[str]:
    """A skeleton in which runs of paragraphs and quotes are one token."""
    out: list[str] = []
    for t in tokens:
        t = "text+" if t in ("p", "quote") else t
        if t != "text+" or out[-1:] != ["text+"]:
            out.append(t)
    return out


def differences(source: str, target: str, strict: bool = True, most: int = 5) -> list[str]:
    a, b = (skeleton(x) if strict else flowing(skeleton(x)) for x in (source, target))
    a, b = a + ["(end)"] * (len(b) - len(a)), b + ["(end)"] * (len(a) - len(b))
    return [f"#{i}: expected {x}, got {y}" for i, (x, y) in enumerate(zip(a, b, strict=True)) if x != y][:most]


@dataclass
class Span:
    start: int
    end: int
    text: str
    kind: str
    masks: dict[str, str]


# What is masked and how, and line prefixes.
_TARGET = re.compile(r'(!?\[[^\]]*\]\()([^)\s]+)((?:\s+"[^"]*")?\))')
_PREFIXES = ((re.compile(r"\s*#{1,6}\s+"), "heading"), (re.compile(r"\s*>\s?"), "quote"), (re.compile(r"\s*(?:[-*+]|\d+[.)])\s+"), "listItem"))


def _masked(text: str) -> tuple[str, dict[str, str]]:
    masks: dict[str, str] = {}

    def hide(m: re.Match) -> str:
        token = f"⟦{len(masks) + 1}⟧"
        masks[token] = m[2]
        return m[1] + token + m[3]

    return _TARGET.sub(hide, text), masks


def spans(content: str) -> list[Span]:
    """Translatable spans with their offsets; link targets are masked."""
    out: list[Span] = []

    def add(at: int, text: str, kind: str) -> None:
        shown, masks = _masked(text)
        out.append(Span(at, at + len(text), shown, kind, masks))

    for x in lines(content, strict=False):
        if x.kind not in ("text", "heading") or x.text.lstrip().startswith(":::"):
            continue
        t = x.text.rstrip()
        found = next(((m, k) for p, k in _PREFIXES if (m := p.match(t)) and m.end() < len(t)), None)
        key = re.match(r"\s*([A-Za-z][\w-]*)\s*:\s*(?=\S)", t)
        if found:
            add(x.at + found[0].end(), t[found[0].end() :], found[1])
        elif key:
            if key[1].lower() in PROSE_KEYS:
                add(x.at + key.end(), t[key.end() :], "attribute")
        elif TABLE.fullmatch(t):
            if not re.fullmatch(r"\s*\|[\s:|-]+\|\s*", t):
                for m in re.finditer(r"\|([^|\n]+)", t):
                    cell = m[1].strip()
                    if cell:
                        add(x.at + m.start(1) + m[1].index(cell), cell, "tableCell")
        else:
            lead = len(t) - len(t.lstrip())
            add(x.at + lead, t[lead:], "paragraph")
    return out


def apply_spans(content: str, found: list[Span], translated: dict[str, str]) -> str:
    """The text with spans replaced, and masked targets put back."""
    parts, at = [], 0
    for s in sorted(found, key=lambda s: s.start):
        new = translated.get(s.text)
        if new is None:
            continue
        for token, target in s.masks.items():
            new = new.replace(token, target)
        parts += [content[at : s.start], new]
        at = s.end
    return "".join([*parts, content[at:]])


def missing_masks(text: str, translation: str) -> list[str]:
    return [m for m in re.findall(r"⟦\d+⟧", text) if m not in translation]


AUDIO = frozenset(".mp3 .wav .ogg .oga .m4a .aac .flac .mid .midi".split())


def _plain(s: str) -> str:
    return " ".join(re.sub(r"\\([\[\]])", r"\1", re.sub(r"[*_`]", "", LINK.sub(r"\1", s))).split())


def _extension(target: str) -> str:
    name = re.split(r"[?#]", target)[0].rsplit("/", 1)[-1]
    return name[name.rfind(".") :].lower() if name.rfind(".") > 0 else ""


def media(content: str) -> list[tuple[str, str, str]]:
    """All ``photo`` and ``music`` items (kind, label, target) in order, each target once."""
    return harvest(content, None)[0]


def harvest(content: str, most: int | None = 60) -> tuple[list[tuple[str, str, str]], dict[str, bool]]:
    """Items as ``media`` gives them, at most ``most`` of a kind, and for each kind whether it was truncated."""
    out: dict[str, dict[str, str]] = {"photo": {}, "music": {}}
    truncated = dict.fromkeys(out, False)

    def add(kind: str, label: str, target: str) -> None:
        label, target = _plain(label), target.strip()
        if label and target and not target.startswith("#") and "/#/" not in target and target not in out[kind]:
            if most is not None and len(out[kind]) >= most:
                truncated[kind] = True
            else:
                out[kind][target] = label

    box: dict[str, str] | None = None

    def flush() -> None:
        nonlocal box
        if box and box.get("src"):
            add("photo", box.get("caption", box.get("alt", "")), box["src"])
        box = None

    for x in lines(content.replace("\r\n", "\n"), strict=False):
        if box is not None:
            if x.kind in ("container", "end"):
                flush()
            elif m := re.fullmatch(r"\s*([A-Za-z][\w-]*)\s*:\s*(.*)", x.text):
                box[m[1].lower()] = m[2].strip()
            continue
        if x.kind == "container" and x.name == "image":
            box = {}
        elif x.kind not in ("fence", "code"):
            for m in IMAGE.finditer(x.text):
                add("photo", m[1], m[2])
            row = x.text.strip()
            title = _plain(row[1:-1].split("|")[0].strip()) if row.startswith("|") and row.endswith("|") and len(row) > 1 else ""
            for m in LINK.finditer(x.text):
                target, label = m[2], m[1].strip()
                tab = _extension(target) == ".txt" and re.search(r"(?i)(?:^|/)(?:music|tab|tabs)/", target)
                if not target.startswith("#") and (_extension(target) in AUDIO or tab):
                    add("music", (f"{title} — {label}" if label and label != title else title) if title else label, target)
    flush()
    return [(k, label, target) for k in out for target, label in out[k].items()], truncated


def generate(df: DataFrame, key: str, text: str, rows: Callable[[str], list[tuple]], schema: str) -> DataFrame:
    """A row of ``schema`` after ``key`` for each tuple that ``rows`` makes of a text. Null texts make none."""
    kind = dict(df.dtypes)[key]
    names = [key, *[f.split()[0] for f in schema.split(",")]]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [(k, *r) for k, t in zip(frame[key], frame[text], strict=True) if t is not None for r in rows(t)]
            if made:
                yield pd.DataFrame(made, columns=names)

    return df.select(key, text).mapInPandas(run, f"{key} {kind}, {schema}")
