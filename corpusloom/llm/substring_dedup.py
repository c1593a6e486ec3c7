"""Substring dedup with suffix automata: words under a window of ``WINDOW`` words that also starts elsewhere go.

The reference is the corpus itself, so its automata can't be broadcast whole; they are dealt out by content. A
window's anchor is the smallest hash among its ``K``-word runs, so equal windows have equal anchors, and consecutive
windows with one anchor form a context: the words that these windows span. Contexts are counted by anchor and hash.
A context that occurs twice is repeated as a whole. Where an anchor has several different contexts, they are the
reference shard of that anchor: they become one generalised suffix automaton with occurrence counts, the contexts are
streamed through it, and the spans whose match is at least a window long and occurs twice are removed. An anchor whose
contexts have more than ``SHARD`` words, such as a phrase of thousands of documents, would make a shard that grows with
the corpus; it is split to the end, where each shard is one window with its occurrences. An automaton of equal windows
is their number, so these shards are counted by the window's hash, which combines before its shuffle and has no bound.

Contexts are known by anchor and a 64-bit hash each, texts by a number until their hash is needed. Texts are shuffled
twice by that hash (context words, then removal); only narrow rows move otherwise. All joined tables grow with the
corpus, so every join is by sort and merge.

Defined cases: null is an empty text; texts shorter than a window keep all words; a text that occurs twice loses all
its words if it has a window; repeated rows count as copies; kept words are joined by one space; a very long text is one
row whose words are in memory at once, and its contexts are judged like others; an empty table gives no rows; columns
may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import Scratch, arrow_schema, ddl, map_columns, prepare, release, with_columns
from .words import hash_words, run_hashes, sliding_min, split_words

WINDOW = 35
K = 12
#: Words in the different contexts of one anchor that a task may hold as an automaton.
SHARD = 60_000


class SuffixAutomaton:
    """A generalised suffix automaton over integer words. ``count`` has how often a state's sequences end anywhere."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.count.append(0)
        return len(self.next) - 1

    def add(self, words: list[int]) -> None:
        """One more sequence."""
        moves, link, length, last = self.next, self.link, self.length, 0
        for c in words:
            q = moves[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, c, q)
            else:
                new, p = self._state(length[last] + 1, {}, 0), last
                while p != -1 and c not in moves[p]:
                    moves[p][c] = new
                    p = link[p]
                if p != -1:
                    q = moves[p][c]
                    link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
                last = new
            self.count[last] += 1

    def _split(self, p: int, c: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def finish(self) -> None:
        """Hand counts down the suffix links; call once, after the last ``add``."""
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[v] > 0:
                self.count[self.link[v]] += self.count[v]

    def repeated(self, words: list[int], window: int) -> Iterator[int]:
        """Starts of the windows that occur more than once, from matching statistics cut off at ``window``."""
        moves, link, length, count = self.next, self.link, self.length, self.count
        v = matched = 0
        for i, c in enumerate(words):
            while v and c not in moves[v]:
                v = link[v]
                matched = length[v]
            v = moves[v].get(c, 0)
            matched = matched + 1 if v else 0
            if matched >= window:
                while length[link[v]] >= window:
                    v = link[v]
                matched = min(matched, length[v])
                if count[v] > 1:
                    yield i - window + 1


def contexts(words: np.ndarray, window: int, k: int) -> list[np.ndarray]:
    """Of a text's word hashes, for each context: anchor, first window, number of windows, hash, and whether the anchor
    occurs in it twice, so that a window might recur inside."""
    m = len(words) - window + 1
    if m <= 0:
        none = np.zeros(0, np.int64)
        return [none, none, none, none, none.astype(bool)]
    runs = run_hashes(words, k)
    least = sliding_min(runs, window - k + 1)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    size = np.diff(np.append(first, m))
    raw = words.tobytes()
    hashes = [xxhash.xxh3_64_intdigest(raw[8 * a : 8 * (a + n + window - 1)]) for a, n in zip(first.tolist(), size.tolist(), strict=True)]
    anchor = least[first]
    twice = np.zeros(len(first), bool)
    values, seen = np.unique(runs, return_counts=True)
    if len(values) < len(runs):
        for i in np.flatnonzero(np.isin(anchor, values[seen > 1])):
            twice[i] = int((runs[first[i] : first[i] + size[i] + window - k] == anchor[i]).sum()) > 1
    return [anchor.view(np.int64), first, size, np.array(hashes, np.uint64).view(np.int64), twice]


def _keyed(df: DataFrame, text_col: str) -> DataFrame:
    return df.withColumn("__text", F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).withColumn("__key", F.unhex(F.md5("__text")))


def spans(df: DataFrame, tmp: Scratch, text_col: str = "text", window: int = WINDOW, k: int = K, shard: int = SHARD) -> DataFrame:
    """Repeated windows of each text with any: ``__key`` (of the text), ``starts`` and ``sizes`` (runs of windows), from
    tables of ``tmp``."""
    spark = prepare(df.sparkSession)
    docs = _keyed(df.select(F.col(f"`{text_col}`").alias("text")), "text").select("__key", "__text")
    fields = [("n", "bigint"), ("key", "binary"), ("h", "array<bigint>"), ("first", "array<bigint>"), ("size", "array<bigint>"),
              ("c", "array<bigint>"), ("twice", "array<int>")]

    def make_sketch():
        number = TaskContext.get().partitionId() << 40

        def step(cols):
            nonlocal number
            out: dict[str, list] = {n: [] for n, _ in fields}
            for key, text in zip(cols["__key"], cols["__text"], strict=True):
                h, first, size, c, twice = contexts(hash_words(split_words(text)), window, k)
                number += 1
                if len(h):
                    for (n, _), v in zip(fields, (number, key, h, first, size, c, twice.astype(np.int32)), strict=True):
                        out[n].append(v)
            return out

        return step

    sketch = tmp.write(map_columns(docs, make_sketch, fields))
    texts = tmp.write(sketch.groupBy("key").agg(F.min("n").alias("n")))  # of equal texts the first speaks for all
    rows = sketch.select("n", F.explode(F.arrays_zip("h", "c", "first", "size", "twice")).alias("x")).select("n", "x.*")
    kinds = tmp.write(rows.groupBy("h", "c").agg(F.count("*").alias("occurs"), F.max("twice").alias("twice"), F.max("size").alias("size")))
    anchors = (
        kinds.groupBy("h").agg(F.count("*").alias("kinds"), F.max("twice").alias("any"), F.sum(F.col("size") + (window - 1)).alias("words"))
        .where("kinds > 1 or any = 1").select("h", "words")
    )
    wanted = tmp.write(
        kinds.drop("size").join(anchors.hint("merge"), "h", "left").where("words is not null or occurs > 1")
        .select("h", "c", (F.col("occurs") > 1).alias("settled"), F.coalesce("words", F.lit(0)).alias("words"), F.col("words").isNotNull().alias("open"))
    )
    tmp.drop(kinds)
    release(spark)
    # Where wanted contexts lie. A context that occurs twice is repeated as a whole; it is also reference for others.
    places = tmp.write(rows.drop("twice").join(wanted.hint("merge"), ["h", "c"]))
    tmp.drop(sketch)
    tmp.drop(wanted)
    release(spark)
    shown = _context_words(docs, places.where("open").join(texts.hint("merge"), "n"), window, tmp)
    found = tmp.write(_by_automata(shown.where(F.col("words") <= shard), window).unionByName(_by_windows(shown.where(F.col("words") > shard), window)))
    tmp.drop(shown)
    release(spark)
    whole = places.where("settled").select("n", F.col("first").alias("start"), "size")
    parts = places.where("open and not settled").join(found.hint("merge"), ["h", "c"]).select("n", (F.col("first") + F.col("at")).alias("start"), F.col("span").alias("size"))
    return (
        whole.unionByName(parts).groupBy("n").agg(F.collect_list(F.struct("start", "size")).alias("x")).join(texts.hint("merge"), "n")
        .select(F.col("key").alias("__key"), F.col("x.start").alias("starts"), F.col("x.size").alias("sizes"))
    )


def _context_words(docs: DataFrame, places: DataFrame, window: int, tmp: Scratch) -> DataFrame:
    """``h, c, raw`` (64-bit word hashes) of each different open context, from one place of it, and its anchor's ``words``."""
    one = places.groupBy("h", "c").agg(F.min(F.struct("key", "first", "size", "words")).alias("p")).select("h", "c", "p.*")
    asked = one.groupBy("key").agg(F.collect_list(F.struct("h", "c", "first", "size", "words")).alias("x")).select(
        "key", *[F.col(f"x.{n}").alias(n) for n in ("h", "c", "first", "size", "words")])
    texts = docs.join(asked.hint("merge"), docs["__key"] == asked["key"])
    fields = [("h", "bigint"), ("c", "bigint"), ("words", "bigint"), ("raw", "binary")]

    def make():
        def step(cols):
            out: dict[str, list] = {n: [] for n, _ in fields}
            done = set()
            for i, (key, text) in enumerate(zip(cols["key"], cols["__text"], strict=True)):
                if key in done:
                    continue
                done.add(key)
                raw = hash_words(split_words(text)).tobytes()
                for h, c, first, size, words in zip(*(cols[x][i] for x in ("h", "c", "first", "size", "words")), strict=True):
                    for (n, _), v in zip(fields, (h, c, words, raw[8 * first : 8 * (first + size + window - 1)]), strict=True):
                        out[n].append(v)
            return out

        return step

    # A text with copies gives its contexts once a batch; what is left of repeats goes with the aggregate.
    got = map_columns(texts.select("key", "__text", "h", "c", "first", "size", "words"), make, fields)
    return tmp.write(got.groupBy("h", "c").agg(F.first("words").alias("words"), F.first("raw").alias("raw")))


_FOUND = [("h", "bigint"), ("c", "bigint"), ("at", "bigint"), ("span", "bigint")]


def _runs(starts) -> Iterator[tuple[int, int]]:
    """Maximal runs of consecutive numbers."""
    begin = last = None
    for s in starts:
        if begin is None or s != last + 1:
            if begin is not None:
                yield begin, last - begin + 1
            begin = s
        last = s
    if begin is not None:
        yield begin, last - begin + 1


def _by_automata(shown: DataFrame, window: int) -> DataFrame:
    """Runs of repeated windows in each context, by one automaton per anchor. Anchors stream in key order."""
    schema = arrow_schema(_FOUND)

    def judge(group: list[tuple[int, int, list[int]]], out: list[tuple]) -> None:
        automaton = SuffixAutomaton()
        for _, _, words in group:
            automaton.add(words)
        automaton.finish()
        for h, c, words in group:
            out += [(h, c, at, n) for at, n in _runs(automaton.repeated(words, window))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple[int, int, list[int]]] = []
        out: list[tuple] = []
        for batch in batches:
            for h, c, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if group and group[0][0] != h:
                    judge(group, out)
                    group = []
                group.append((h, c, np.frombuffer(raw, np.int64).tolist()))
            if len(out) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                out = []
        if group:
            judge(group, out)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    dealt = shown.select("h", "c", "raw").repartition("h").sortWithinPartitions("h")
    return dealt.mapInArrow(run, ddl(_FOUND))


def _by_windows(shown: DataFrame, window: int) -> DataFrame:
    """The same for anchors with too many words: a shard for each window, counted by its 128-bit hash. A window that a
    context repeats is one row, so periodic texts make no hot hash."""
    fields = [("h", "bigint"), ("c", "bigint"), ("w", "binary"), ("n", "bigint"), ("at", "array<bigint>")]

    def make():
        def step(cols):
            out: dict[str, list] = {n: [] for n, _ in fields}
            for h, c, raw in zip(cols["h"], cols["c"], cols["raw"], strict=True):
                places: dict[bytes, list[int]] = {}
                for at in range(len(raw) // 8 - window + 1):
                    places.setdefault(xxhash.xxh3_128_digest(raw[8 * at : 8 * (at + window)]), []).append(at)
                for w, at in places.items():
                    for (n, _), v in zip(fields, (h, c, w, len(at), at), strict=True):
                        out[n].append(v)
            return out

        return step

    every = map_columns(shown.select("h", "c", "raw"), make, fields)
    again = every.groupBy("w").agg(F.sum("n").alias("n")).where("n > 1").select("w")
    return every.join(again, "w", "left_semi").select("h", "c", F.explode("at").alias("at"), F.lit(1).cast("bigint").alias("span"))


def _marked(df: DataFrame, text_col: str, window: int, k: int, shard: int) -> DataFrame:
    """``df`` with ``__text``, ``__key``, and ``starts`` and ``sizes`` where its text has repeated windows. No column of
    ``df`` has one of these names."""
    with Scratch(df.sparkSession) as tmp:
        found = tmp.keep(tmp.write(spans(df, tmp, text_col, window, k, shard)))
    release(df.sparkSession)
    return _keyed(df, text_col).join(found.hint("merge"), "__key", "left")


def _kept(text: str, starts: list[int] | None, sizes: list[int] | None, window: int) -> tuple[int, list[bytes]]:
    """Number of words, and the words that stay."""
    words = split_words(text)
    if not starts:
        return len(words), words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.add(starts, sizes) + (window - 1), -1)
    gone = np.cumsum(edge[:-1]) > 0
    return len(words), [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def digests(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", window: int = WINDOW, k: int = K, shard: int = SHARD) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256`` of each row."""
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def make():
        def step(cols):
            got = [_kept(t, a, n, window) for t, a, n in zip(cols["__text"], cols["starts"], cols["sizes"], strict=True)]
            return {"n_words": [n for n, _ in got], "n_removed": [n - len(w) for n, w in got],
                    "kept_sha256": [hashlib.sha256(b" ".join(w)).hexdigest() for _, w in got]}

        return step

    fields = [("n_words", "bigint"), ("n_removed", "bigint"), ("kept_sha256", "string")]
    out = with_columns(_marked(docs, "text", window, k, shard), ["__text", "starts", "sizes"], make, fields)
    return out.select("doc_id", *[n for n, _ in fields])


def without_repeats(df: DataFrame, text_col: str = "text", chars_col: str | None = None, window: int = WINDOW, k: int = K,
                    shard: int = SHARD) -> DataFrame:
    """``df`` with its texts cut; a text without repeats, null included, stays as it is. ``chars_col``, if given,
    holds the new lengths."""
    name = {c: f"c{i}" for i, c in enumerate(df.columns)}
    text, chars = name[text_col], name[chars_col] if chars_col else None

    def make():
        def step(cols):
            out = []
            for old, t, a, n in zip(cols[text], cols["__text"], cols["starts"], cols["sizes"], strict=True):
                out.append(b" ".join(_kept(t, a, n, window)[1]).decode() if a else old)
            return {text: out} | ({chars: [len(t or "") for t in out]} if chars else {})

        return step

    fields = [(text, "string")] + ([(chars, "bigint")] if chars else [])
    named = df.select(*[F.col(f"`{c}`").alias(x) for c, x in name.items()])
    out = with_columns(_marked(named, text, window, k, shard), [text, "__text", "starts", "sizes"], make, fields)
    return out.select(*[F.col(x).alias(c) for c, x in name.items()])
