"""N-gram Jaccard self-join by a partitioned universe.

A document's set is its distinct word shingles. Sets fall in size bands. In a band's scheme, tokens are hashed into
``m`` segments; two sets with Jaccard similarity of at least the threshold differ in at most ``H`` tokens, so of the
segments that aren't empty in one of them more than ``H`` leave one whose tokens are the same in both: that segment's
hash is their common signature. A scheme of the other kind indexes one-deletion neighbourhoods, a segment's hash and
those of the segment without one token: of more than ``H / 2`` segments with two tokens or more, one differs by a token
at most. A set signs in its own band's scheme and, where a smaller partner can lie in the band below, in that one's.
``allocate`` picks each band's kind and segment count by cost, from the table's own sizes: signatures to shuffle, and
the verifications to expect because a set has too few filled segments, which grow with the number of sets it could
meet. Such sets (``needy``) also index their sparse segments, against which all others' are probed.

A partner shares at least ``s`` (filled segments less ``H``) signatures with a set, so sets with fewer repeated
signatures than that have none and leave. The others, mostly near copies, sign once more with ``DENSE`` times as many segments, and only the ``H + 1`` rarest
signatures of each, in an order that all share, are kept: two linked sets still have one of them in common, while sets
of a large group that differ too much keep signatures of their own and part. In each remaining bucket the members are
verified, exactly on the sets, against one leader. What a member and its leader don't share, its difference, decides
about pairs of members: their symmetric difference is that of their differences. Members that their leader doesn't link
are tested against the first of them, and so on for ``ROUNDS`` rounds, so a family with an odd leader finds one of its own.
A round's linked and unlinked members, and what is unlinked after the last one, are joined by the tokens of their
differences, under the prefix and position bounds of the overlap that a link needs, unless the links found so far connect
them, and these candidates are verified.
So no link is lost, a group of near copies costs a verification for each member and round and a few more, and equal
sets, one class from the start, none.

Defined cases: null or empty texts have size 0, no links, and themselves as component; fewer words than a shingle
form one shingle of their own kind; equal texts, whatever their ids, are in one component; rows that share an id are
one node; rows with a null id are in a component only by an equal text. A very long text is one set of 8 bytes a
shingle; an empty table gives no rows. Extra columns are dropped, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .runtime import Scratch, map_columns, prepare, release
from .words import hash_words, mixed, run_hashes, signed

#: Rows of a table that may be broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 20_000
#: Segments of the second signing, as a multiple of ``H``.
DENSE = 3
#: Rounds in which unlinked members of a leader get another.
ROUNDS = 4
#: What a verification costs, in signatures.
VERIFY = 40
_RATIO = 1.6
_MOST = 1 << 40


@dataclass(frozen=True)
class Spec:
    """Shingle length and the least similarity ``num / den``."""

    words: int = 5
    num: int = 80
    den: int = 100

    def linked(self, a: int, b: int, common: int) -> bool:
        return self.den * common >= self.num * (a + b - common)

    def differ(self, a: int, b: int) -> int:
        """Most tokens in just one of two linked sets of sizes ``a`` and ``b``; -1 if such sets can't be linked."""
        common = -(-self.num * (a + b) // (self.num + self.den))
        return a + b - 2 * common if common <= min(a, b) else -1

    def largest(self, a: int) -> int:
        return a * self.den // self.num

    def smallest(self, a: int) -> int:
        return -(-a * self.num // self.den)


@dataclass(frozen=True)
class Scheme:
    low: int
    high: int
    segments: int
    deletion: bool  # whether one-deletion neighbourhoods are indexed, else whole segments


def _too_few(size: int, m: int, need: int, least: int = 1) -> float:
    """Chance that fewer than ``need`` of ``m`` segments hold ``least`` tokens (1 or 2; normal approximation, Poisson filling)."""
    if m < need:
        return 1.0
    if m == 1:
        return float(size < least)
    at = size / m
    p = 1 - math.exp(-at) * (1 + at * (least - 1))
    sd = math.sqrt(max(m * p * (1 - p), 1e-9))
    return 0.5 * math.erfc((m * p - need + 0.5) / sd / math.sqrt(2))


def _most_apart(spec: Spec, size: int, low: int, high: int) -> int:
    """Most differing tokens between a set of ``size`` and any linked one whose size is in ``low`` to ``high``."""
    a, b = max(low, spec.smallest(size)), min(high, spec.largest(size))
    return max((spec.differ(size, x) for x in {*range(a, min(b, a + 3) + 1), *range(max(a, b - 3), b + 1)}), default=-1)


@lru_cache
def bands() -> tuple[tuple[int, int], ...]:
    """Sizes from and to of each band."""
    out, low = [], 1
    while low < _MOST:
        out.append((low, max(low, int(low * _RATIO)) if low > 8 else low))
        low = out[-1][1] + 1
    return tuple(out)


@lru_cache
def _lows() -> tuple[int, ...]:
    return tuple(low for low, _ in bands())


@lru_cache
def allocate(spec: Spec, counts: tuple[int, ...]) -> tuple[Scheme, ...]:
    """Schemes of all size bands of a table that has ``counts`` sets in each. A set costs its signatures, and where it is
    needy a verification with each set of its band and the one below."""
    out = []
    for k, (low, high) in enumerate(bands()):
        apart = _most_apart(spec, high, low, spec.largest(high))
        partners = 1 + counts[k] + (counts[k - 1] if k else 0)
        best = (math.inf, max(2, int((apart + 1) * 1.15)), False)
        if high <= 1 << 21:  # beyond any text's size a fixed share will do
            for deletion in (False, True):
                need, signs = (apart // 2 + 1, (low + high) // 2) if deletion else (apart + 1, 0)
                for m in range(need, 4 * need + 16, max(1, need // 50)):
                    risk = max(_too_few(x, m, _most_apart(spec, x, low, spec.largest(x)) // (1 + deletion) + 1 + 2 * (m > 1), 1 + deletion) for x in (low, high))
                    best = min(best, (signs + m + risk * VERIFY * partners, m, deletion))
        out.append(Scheme(low, high, best[1] if best[2] else max(2, best[1]), best[2]))
    return tuple(out)


@lru_cache
def densely(spec: Spec, schemes: tuple[Scheme, ...]) -> tuple[Scheme, ...]:
    """The schemes of the second signing: ``DENSE`` times as many segments where whole ones are indexed."""
    return tuple(s if s.deletion else Scheme(s.low, s.high, max(2, int((_most_apart(spec, s.high, s.low, spec.largest(s.high)) + 1) * DENSE)), False) for s in schemes)


def sizes(docs: DataFrame) -> tuple[int, ...]:
    """Texts in each band by their number of spaces: one row a band comes to the driver. Costs depend on it, results don't."""
    words = F.octet_length("text") - F.octet_length(F.replace("text", F.lit(" "), F.lit(""))) + 1
    half = F.floor(2 * F.log2(words.cast("double"))).cast("int").alias("half")
    out = [0] * len(bands())
    for r in docs.where("text <> ''").groupBy(half).agg(F.count("*").alias("n")).collect():
        out[bisect_right(_lows(), round(2 ** ((r["half"] + 0.5) / 2))) - 1] += r["n"]
    return tuple(out)


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted hashes of the distinct ``n``-word shingles of a text; ``bytes.lower`` changes A-Z alone."""
    h = hash_words(text.encode().lower().split() if text else [])
    if not len(h):
        return h
    return np.unique(run_hashes(h, min(n, len(h)), salt=min(n, len(h))))


def signatures(tokens: np.ndarray, spec: Spec, schemes: tuple[Scheme, ...]) -> list[tuple[int, int, bool, np.ndarray, np.ndarray]]:
    """For each scheme of a set: its index, ``s`` (signatures that it shares at least with a linked set), whether it is
    needy, signatures, and those of sparse segments."""
    size, out = len(tokens), []
    own = bisect_right(_lows(), size) - 1
    for k in (own, own - 1):
        if k < 0:
            break
        scheme = schemes[k]
        if k < own and spec.smallest(size) > scheme.high:
            break
        reach = spec.largest(size) if k == own else scheme.high
        apart = _most_apart(spec, size, scheme.low, reach)
        if apart < 1:  # only equal sets could be linked
            continue
        salt = 0x5851F42D4C957F2D * (k + 1)
        values = mixed(tokens, salt + 1)
        m = scheme.segments
        place = (mixed(tokens, salt) % np.uint64(m)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        filled = np.bincount(place, minlength=m)
        ends = np.cumsum(filled)
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[order], dtype=np.uint64)])
        number = np.arange(1, m + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
        sums = running[ends] - running[ends - filled] + number
        if scheme.deletion:
            solid = filled > 1
            mine = solid[place]
            signs = np.concatenate([sums[filled > 0], sums[place[mine]] - values[mine]])
            s, sparse = int(solid.sum()) - apart // 2, filled < 3
        else:
            signs = sums[filled > 0]
            s, sparse = len(signs) - apart, filled == 0
        out.append((k, max(1, s), s < 1, mixed(signs, salt), mixed(number[sparse], ~salt)))
    return out


def _sketch(docs: DataFrame, spec: Spec, schemes: tuple[Scheme, ...]) -> DataFrame:
    """A row for each document and scheme (one without scheme where it has none); ``first`` marks one per document."""
    fields = [("doc_id", "bigint"), ("n", "bigint"), ("key", "binary"), ("first", "boolean"), ("scheme", "int"), ("s", "bigint"),
              ("needy", "boolean"), ("signs", "array<bigint>"), ("voids", "array<bigint>")]

    def make():
        def step(cols):
            out: dict[str, list] = {n: [] for n, _ in fields}
            for doc, text in zip(cols["doc_id"], cols["text"], strict=True):
                tokens = shingles(text, spec.words)
                key = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
                rows = (signatures(tokens, spec, schemes) if len(tokens) else []) or [(-1, 0, False, tokens[:0], tokens[:0])]
                for i, (k, s, needy, signs, voids) in enumerate(rows):
                    row = (doc, len(tokens), key, not i, k, s, needy, signed(signs), signed(voids))
                    for (n, _), v in zip(fields, row, strict=True):
                        out[n].append(v)
            return out

        return step

    return map_columns(docs, make, fields)


def _small(df: DataFrame) -> DataFrame:
    """``df`` (a written table), marked for broadcast if its size allows that."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def verify(docs: DataFrame, pairs: DataFrame, spec: Spec, tmp: Scratch, apart: bool = False) -> DataFrame:
    """``pairs`` (``a``, ``b``) with ``linked``, decided on the sets themselves, the size of ``b``'s, and the number ``x`` of
    tokens that just one of them has. With ``apart`` these tokens follow, a row each (``t``, null in a pair's own row)."""
    nodes = tmp.write(pairs.selectExpr("a as node").union(pairs.selectExpr("b as node")).distinct())
    wanted = docs.join(_small(nodes), docs["doc_id"] == nodes["node"], "left_semi")

    def make_sets():
        return lambda cols: {"node": cols["doc_id"], "items": [shingles(t, spec.words).tobytes() for t in cols["text"]]}

    sets = map_columns(wanted, make_sets, [("node", "bigint"), ("items", "binary")])
    of_b = pairs.join(sets.select(F.col("node").alias("b"), F.col("items").alias("items_b")), "b")
    both = of_b.join(sets.select(F.col("node").alias("a"), F.col("items").alias("items_a")), "a")
    fields = [("a", "bigint"), ("b", "bigint"), ("linked", "boolean"), ("size_b", "bigint"), ("x", "bigint"), ("t", "bigint")]

    def make_test():
        def step(cols):
            linked, size_b, tokens = [], [], []
            for x, y in zip(cols["items_a"], cols["items_b"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                tokens.append(np.setxor1d(x, y, assume_unique=True))
                size_b.append(len(y))
                linked.append(spec.linked(len(x), len(y), (len(x) + len(y) - len(tokens[-1])) // 2))
            n = [len(t) for t in tokens]
            times = np.array(n) * apart + 1
            out = {c: np.repeat(v, times) for c, v in (("a", cols["a"]), ("b", cols["b"]), ("linked", linked), ("size_b", size_b), ("x", n))}
            own = np.zeros(times.sum(), bool)
            own[np.cumsum(times) - times] = True
            t = np.zeros(len(own), np.int64)
            if apart:
                t[~own] = signed(np.concatenate(tokens))
            return out | {"t": pa.array(t, mask=own)}

        return step

    return map_columns(both, make_test, fields)


def _shared(members: DataFrame) -> DataFrame:
    """Rows of buckets that hold more than one node, with the smallest as ``lead``."""
    lead = members.groupBy("sig").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead < last").select("sig", "lead")
    return members.join(lead, "sig")


def cluster(df: DataFrame, spec: Spec, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """A row per row of ``df``: ``doc_id``, ``n_shingles``, ``component_id``."""
    docs = df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    with Scratch(prepare(df.sparkSession)) as tmp:
        schemes = allocate(spec, sizes(docs))
        sketch = tmp.write(_sketch(docs, spec, schemes))
        narrow = sketch.where("first").select("doc_id", "n", "key")
        classes = tmp.write(narrow.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
                            .where("copies > 1").select("key", "rep"))
        signing = (
            sketch.where("scheme >= 0 and doc_id is not null").join(_small(classes), "key", "left")
            .where("rep is null or rep = doc_id").select(F.col("doc_id").alias("node"), "scheme", "s", "needy", "signs", "voids")
        )
        found = components(_links(docs, signing, spec, schemes, tmp), tmp)
        # A class's representative carries its class into the component; a document without links is its own.
        named = narrow.join(classes, "key", "left").withColumn("node", F.coalesce("rep", "doc_id"))
        return tmp.keep(tmp.write(named.join(found, "node", "left").select(
            "doc_id", F.col("n").alias("n_shingles"),
            F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("component", "node")).alias("component_id"),
        )))


def _links(docs: DataFrame, signing: DataFrame, spec: Spec, schemes: tuple[Scheme, ...], tmp: Scratch) -> DataFrame:
    """Links that connect all that is connected: a spanning part of all links between different sets."""
    spark = docs.sparkSession
    rows = signing.select(F.explode("signs").alias("sig"), "node", "scheme", "s")
    again = tmp.write(rows.groupBy("sig").agg(F.min("node").alias("n0"), F.max("node").alias("n1")).where("n0 < n1").select("sig"))
    release(spark)  # the first deal of all signatures goes before the second comes
    repeated = rows.join(again, "sig").groupBy("node", "scheme").agg(F.count("*").alias("g"), F.max("s").alias("s"))
    suspects = tmp.write(repeated.where("g >= s").select("node").distinct())
    tmp.drop(again)
    release(spark)
    near = docs.join(_small(suspects), docs["doc_id"] == suspects["node"], "left_semi")
    second = tmp.write(_sketch(near, spec, densely(spec, schemes)).where("scheme >= 0").select(F.col("doc_id").alias("node"), "scheme", "s", "needy", "signs", "voids"))
    members = _shared(_rarest(second))
    pairs = tmp.write(members.where("lead < node").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct())
    release(spark)
    links, rounds = [], []
    for r in range(ROUNDS):
        rounds.append(tmp.write(verify(docs, pairs, spec, tmp, apart=True)))
        links.append(rounds[-1].where("t is null and linked").select("a", "b"))
        loose = rounds[-1].where("t is null and not linked").select(F.col("a").alias("star"), F.col("b").alias("node"))
        heads = loose.groupBy("star").agg(F.min("node").alias("a"), F.max("node").alias("last")).where("a < last").select("star", "a")
        pairs = tmp.write(loose.join(heads, "star").where("a < node").select("a", F.col("node").alias("b")).distinct())
        release(spark)
        if pairs.isEmpty():
            break
    # What is connected by now needs no more links.
    labels = tmp.write(components(reduce(DataFrame.union, links), tmp).select("node", "component"))
    found = [_needy(signing), _needy(second)]
    for i, tested in enumerate(rounds):
        found.append(tmp.write(_among_members(tested, labels, spec, tmp, i + 1 == len(rounds))))
        release(spark)
    rest = tmp.write(reduce(DataFrame.union, found).distinct())
    if not rest.isEmpty():
        links.append(verify(docs, rest, spec, tmp).where("linked").select("a", "b"))
    return tmp.write(reduce(DataFrame.union, links).distinct())


def _rarest(signing: DataFrame) -> DataFrame:
    """``sig, node`` of each set's rarest signatures, as many as it has less ``s``, and one. Those that nothing shares are
    the rarest of all; they take up places, and need no rows."""
    rows = signing.select("node", "scheme", (F.size("signs") - F.col("s") + 1).alias("places"), F.size("signs").alias("filled"), F.explode("signs").alias("sig"))
    often = rows.groupBy("sig").agg(F.count("*").alias("df"), F.min("node").alias("n0"), F.max("node").alias("n1")).where("n0 < n1").select("sig", "df")
    own = Window.partitionBy("node", "scheme")
    ranked = rows.join(often, "sig").withColumn("rank", F.dense_rank().over(own.orderBy("df", "sig"))).withColumn("shared", F.max("rank").over(own))
    return ranked.where(F.col("rank") <= F.col("places") - (F.col("filled") - F.col("shared"))).select("sig", "node").distinct()


def _most(spec: Spec, a: Column, b: Column) -> Column:
    """``Spec.differ`` of two sizes as an expression (without its check of the smaller size)."""
    return a + b - 2 * F.ceil(spec.num * (a + b) / F.lit(spec.num + spec.den))


def _among_members(tested: DataFrame, labels: DataFrame, spec: Spec, tmp: Scratch, last: bool) -> DataFrame:
    """Candidate pairs of members of one leader that it doesn't link both; before the ``last`` round only those of which it
    links one, because the others meet again. Pairs of one component of ``labels`` are left out. With differences of sizes
    ``x`` and ``y`` and at most ``m`` tokens apart, a link needs ``o = (x + y - m) / 2`` common tokens; in the order of
    rarity the first common one is then among the first ``x - o + 1`` of one and ``y - o + 1`` of the other."""
    pairs = tested.where("t is null").select(F.col("a").alias("lead"), "linked", F.col("b").alias("node"), F.col("size_b").alias("n"), "x")
    pairs = pairs.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
    stars = pairs.groupBy("lead").agg(F.min("label").alias("first"), F.max("label").alias("second")).where("first < second").select("lead")
    reach = F.floor(F.col("n") * (spec.den - spec.num) / F.lit(spec.num)) + 1  # more than any partner of this size lets differ
    rows = pairs.join(stars, "lead", "left_semi").withColumn("reach", reach)
    if not last:  # a linked partner is within its own reach of the leader, so this one is within both
        rows = rows.where(F.col("linked") | (F.col("x") <= F.col("reach") + F.ceil(F.col("reach") * spec.den / F.lit(spec.num)) + 2))
    rows = tmp.write(rows)
    tokens = tested.where("t is not null").select(F.col("a").alias("lead"), F.col("b").alias("node"), "t").join(rows.select("lead", "node"), ["lead", "node"], "left_semi")
    often = tokens.groupBy("lead", "t").agg(F.count("*").alias("df")).where("df > 1")
    own = Window.partitionBy("lead", "node")
    ranked = tokens.join(often, ["lead", "t"]).withColumn("i", F.row_number().over(own.orderBy("df", "t"))).withColumn("shared", F.count("*").over(own))
    placed = tmp.write(
        ranked.join(rows, ["lead", "node"]).withColumn("place", F.col("x") - F.col("shared") + F.col("i")).where("place <= reach + 1")
        .select("lead", "linked", "label", "node", "n", "x", "place", "t")
    )
    p, q = placed.alias("p"), placed.alias("q")
    need = F.ceil((F.col("p.x") + F.col("q.x") - _most(spec, F.col("p.n"), F.col("q.n"))) / F.lit(2))
    loose = (F.col("p.label") != F.col("q.label")) & (F.lit(last) | (F.col("p.linked") != F.col("q.linked")))
    near = (F.col("p.place") <= F.col("p.x") - need + 1) & (F.col("q.place") <= F.col("q.x") - need + 1)
    by_token = p.join(q, (F.col("p.lead") == F.col("q.lead")) & (F.col("p.t") == F.col("q.t")) & (F.col("p.node") < F.col("q.node")) & loose & near)
    # Differences so small that no token need be common: by their size.
    small = rows.where(~F.col("linked") & (F.col("x") <= F.col("reach"))).select("lead", "label", "node", "n", "x", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("reach") - F.col("x"))).alias("y"))
    r, z = rows.select("lead", "label", "node", "n", "x", "linked").alias("r"), small.alias("z")
    by_size = z.join(r, (F.col("z.lead") == F.col("r.lead")) & (F.col("z.y") == F.col("r.x")) & (F.col("z.label") != F.col("r.label")) & (F.lit(last) | F.col("r.linked"))
                     & (F.col("z.x") + F.col("r.x") <= _most(spec, F.col("z.n"), F.col("r.n"))))
    return by_token.select(F.col("p.node").alias("a"), F.col("q.node").alias("b")).union(
        by_size.select(F.least("z.node", "r.node").alias("a"), F.greatest("z.node", "r.node").alias("b"))).distinct()


def _needy(signing: DataFrame) -> DataFrame:
    """Pairs that only a sparse segment shows: sets with too few filled ones against all that share a sparse one."""
    probe = signing.where("needy").select(F.explode("voids").alias("sig"), F.col("node").alias("x"))
    bands = [r[0] for r in signing.where("needy").select("scheme").distinct().collect()]
    voids = signing.where(F.col("scheme").isin(bands)).select(F.explode("voids").alias("sig"), F.col("node").alias("y"))
    return voids.join(probe, "sig").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def keep_one(df: DataFrame, spec: Spec = Spec(), text_col: str = "text", id_col: str = "doc_id") -> DataFrame:  # noqa: B008
    """One row of each component of ``df``, with its columns: that of the smallest id. Rows with a null id stay, and of
    rows that share id and text one does."""
    found = cluster(df, spec, text_col, id_col)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    kept = df.join(_small(gone), df[f"`{id_col}`"] == gone["gone"], "left_anti")
    if not found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates([id_col, text_col])
    return kept
