"""Token counts by prefix dynamic programming over a sentencepiece BPE vocabulary.

The encoding of a prefix ends in one piece that is compatible with the encoding of what precedes it (two pieces are
compatible when the merges leave their concatenation as just these two). So one left-to-right pass gives each
prefix's last piece and ``count[i] = count[i - len(last)] + 1``. No merge crosses a piece boundary that the vocabulary
can't hold: before a space mark that follows another character, around a line feed, and between letters and other
characters (each checked against the vocabulary when it is loaded). A text therefore is a run of
segments whose counts add up, and its prefix table is that of its segments, one after the other.

``prefix_tables`` stores the table, one byte a character: by how much the count changes there. A token has 127 characters
at most, so a byte is enough. ``n_tokens``, ``count_at`` and ``fit`` answer counts, truncation and budgets from the stored
table alone; neither text nor model is needed again.

Defined cases: null counts as empty; an empty text has no tokens; U+2581 in a text is the space mark, as in the library;
a very long text's table is one row; repeated rows have a table each; an empty table gives no rows; other columns are
dropped, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import Memo, Scratch, map_columns, prepare, with_columns

MARK = "▁"
#: Segments of a generation whose tables a worker remembers.
CACHE = 300_000
#: Pairs of pieces whose meeting a worker remembers.
PAIRS = 600_000


class PrefixCounter:
    """Exact token counts of prefixes for one BPE model with byte fallback and identity normalization."""

    def __init__(self, model_file: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(model_file, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or spec.name != "identity" or spec.remove_extra_whitespaces:
            raise ValueError("a BPE model with identity normalization and kept white space is needed")
        self.dummy = spec.add_dummy_prefix
        self.score = {p.piece: p.score for p in model.pieces if p.type in (1, 4, 5)}
        if any(MARK in p.lstrip(MARK) or "\n" in p or len(p) > 127 for p in self.score):
            raise ValueError("pieces must not cross words or lines, nor have over 127 characters")
        ends: dict[str, set[int]] = {}
        for p in self.score:
            ends.setdefault(p[-2:], set()).add(len(p))
        self.lengths = {k: sorted(v, reverse=True) for k, v in ends.items()}
        self.fallback = {p.piece for p in model.pieces if p.type == 6}
        self._pairs: dict[tuple[str, str], bool] = {}
        self._whole: dict[str, bool] = {}
        self._spines: dict[tuple[str, bool], tuple[list[str], list[float]]] = {}
        self._tables = Memo(CACHE, lambda segments: map(self._changes, segments))
        #: Letters; superscript two joins a full stop in some vocabularies.
        letters = "[^\\W\\d_²]"
        mixed = re.compile(f"{letters}(?!{letters})[^{MARK}]|(?!{letters})[^{MARK}]{letters}")
        if any(mixed.search(p) for p in self.score):
            self._segment = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
        else:
            self._segment = re.compile(f"\n|{MARK}*{letters}+|{MARK}*(?:(?!{letters})[^{MARK}\n])+|{MARK}+")

    def _merge(self, chars: list[str]) -> list[str]:
        """The merges themselves, for pairs of pieces: best score first, leftmost on ties."""
        out = list(chars)
        while len(out) > 1:
            best = max(((self.score[p], -i) for i in range(len(out) - 1) if (p := out[i] + out[i + 1]) in self.score),
                       default=None)
            if best is None:
                break
            i = -best[1]
            out[i : i + 2] = [out[i] + out[i + 1]]
        return out

    def _valid(self, piece: str) -> bool:
        v = self._whole.get(piece)
        if v is None:
            v = self._whole[piece] = self._merge(list(piece)) == [piece]
        return v

    def _compatible(self, a: str, b: str) -> bool:
        v = self._pairs.get((a, b))
        if v is None:
            if len(self._pairs) > PAIRS:
                self._pairs.clear()
            v = self._pairs[a, b] = self._meet(a, b)
        return v

    def _spine(self, piece: str, right: bool) -> tuple[list[str], list[float]]:
        """The parts of a piece that touch its right (left) edge, a character first, and when each arises: its rank.
        Times that don't rise are marked by an empty list."""
        v = self._spines.get((piece, right))
        if v is None:
            parts = [piece]
            while len(parts[-1]) > 1:
                parts.append(self._halves(parts[-1])[right])
            parts.reverse()
            times = [float("-inf"), *(-self.score[p] for p in parts[1:])]
            v = self._spines[piece, right] = parts, times if times == sorted(times) else []
        return v

    def _halves(self, piece: str) -> tuple[str, str]:
        """The two parts whose merge gives a piece."""
        out = list(piece)
        while len(out) > 2:
            i = -max((self.score.get(out[i] + out[i + 1], float("-inf")), -i) for i in range(len(out) - 1))[1]
            out[i : i + 2] = [out[i] + out[i + 1]]
        return out[0], out[1]

    def _meet(self, a: str, b: str) -> bool:
        """Whether no merge crosses the border of two valid pieces: both edges grow in the order of ranks, and the
        two parts that touch at a time mustn't have a better merge with each other."""
        (xs, x_times), (ys, y_times) = self._spine(a, True), self._spine(b, False)
        if not x_times or not y_times:
            return self._merge(list(a + b)) == [a, b]
        i = j = 0
        score, never = self.score, float("inf")
        while True:
            x_next = x_times[i + 1] if i + 1 < len(xs) else never
            y_next = y_times[j + 1] if j + 1 < len(ys) else never
            cross = score.get(xs[i] + ys[j])
            if cross is not None and -cross < x_next and -cross <= y_next:
                return False
            if x_next is never and y_next is never:
                return True
            if x_next <= y_next:
                i += 1
            else:
                j += 1

    def table(self, segment: str) -> list[int]:
        """Token counts of all prefixes of a segment, the empty one first."""
        counts, last = [0], [""]
        score, lengths, whole, pairs = self.score, self.lengths, self._whole, self._pairs
        for i in range(1, len(segment) + 1):
            c = segment[i - 1]
            if c not in score:  # an unknown character: its bytes, or one unknown piece; no merge touches it
                counts.append(counts[-1] + (len(c.encode("utf-8", "replace")) if self.fallback else 1))
                last.append("")
                continue
            for size in (*lengths.get(segment[i - 2 : i], ()), 1) if i > 1 else (1,):
                if size > i or (piece := segment[i - size : i]) not in score or not (whole.get(piece) or self._valid(piece)):
                    continue
                before = last[i - size]
                if before and (fits := pairs.get((before, piece))) is not True:
                    if fits is False or not self._compatible(before, piece):
                        continue
                counts.append(counts[i - size] + 1)
                last.append(piece)
                break
        return counts

    def _changes(self, segment: str) -> bytes:
        """The differences of a segment's table, a signed byte each."""
        counts = self.table(segment)
        return np.array([b - a for a, b in zip(counts, counts[1:], strict=False)], np.int8).tobytes()

    def segments(self, text: str | None) -> list[str]:
        if not text:
            return []
        return self._segment.findall(((MARK if self.dummy else "") + text).replace(" ", MARK))

    def changes(self, texts: Iterable[str | None]) -> list[bytes]:
        """A text's prefix table as differences, one signed byte a character of the text. What the model puts before a
        text counts with its first character."""
        runs = [self.segments(t) for t in texts]
        known = self._tables.fetch(set().union(*runs)).__getitem__
        out = [b"".join(map(known, r)) for r in runs]
        return [_first_two_as_one(x) for x in out] if self.dummy else out


def _first_two_as_one(changes: bytes) -> bytes:
    return (int.from_bytes(changes[:1], signed=True) + int.from_bytes(changes[1:2], signed=True)).to_bytes(1, signed=True) + changes[2:] if changes else changes


def prefix_counts(changes: bytes | None) -> np.ndarray:
    """Token counts of all prefixes, the empty one first, from a stored table."""
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(np.frombuffer(changes or b"", np.int8), dtype=np.int64)])


_counters: dict[str, PrefixCounter] = {}


def counter(model_file: str) -> PrefixCounter:
    """A worker's counter for a model; it outlives the task, so that segments are counted once."""
    if model_file not in _counters:
        _counters[model_file] = PrefixCounter(model_file)
    return _counters[model_file]


def prefix_tables(df: DataFrame, model_file: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``changes``, the text's prefix table."""
    prepare(df.sparkSession)

    def make():
        c = counter(model_file)
        return lambda cols: {"doc_id": cols["doc_id"], "n_bytes": [len(t.encode()) if t else 0 for t in cols["text"]], "changes": c.changes(cols["text"])}

    docs = df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return map_columns(docs, make, [("doc_id", "bigint"), ("n_bytes", "bigint"), ("changes", "binary")])


def count_at(tables: DataFrame, chars_col: str, out: str = "n_tokens_at") -> DataFrame:
    """``tables`` with the tokens of each text's first ``chars_col`` characters (null: all; beyond the text: all)."""

    def make():
        def one(changes, chars):
            return int(np.frombuffer((changes or b"")[: None if chars is None else max(0, chars)], np.int8).sum(dtype=np.int64))

        return lambda cols: {out: [one(t, n) for t, n in zip(cols["changes"], cols[chars_col], strict=True)]}

    return with_columns(tables, ["changes", chars_col], make, [(out, "bigint")])


def fit(tables: DataFrame, budget: int, out: str = "fit_chars") -> DataFrame:
    """``tables`` with ``n_tokens``, and in ``out`` the length of each text's longest prefix of at most ``budget`` tokens."""

    def make():
        def step(cols):
            counts = [prefix_counts(t) for t in cols["changes"]]
            return {"n_tokens": [int(c[-1]) for c in counts], out: [int(np.flatnonzero(c <= budget)[-1]) for c in counts]}

        return step

    return with_columns(tables, ["changes"], make, [("n_tokens", "bigint"), (out, "bigint")])


def with_token_counts(df: DataFrame, model_file: str, text_col: str = "text", limit: int = 4096, id_col: str = "doc_id") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit``, and ``fit_chars``, the longest prefix within ``limit``: all
    looked up in the tables, which are written to the shared folder first."""
    with Scratch(prepare(df.sparkSession)) as tmp:
        tables = tmp.keep(tmp.write(prefix_tables(df, model_file, text_col, id_col)))
    return fit(tables, limit).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fit_chars")
