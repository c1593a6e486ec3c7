"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexicon transducer turns a clause's words into symbols with a weight. Small transducers read the symbols: insult (a
lexicon hit), threat (intent, then a harmful verb), target (a person addressed or named by a pronoun, anywhere in the
clause), negation (a scope of some words) and reported speech (a reporting verb or a quotation mark, to the clause's end).
Their arcs and final states carry weights: an event's weight lies on the arc that puts it out, a context's on all arcs of
its scope, the target's on the final state. Composition multiplies the weights of arcs taken together; the product's
states are built as they are met. A clause's score is the sum of its events' weights times the final weight, up to a cap,
and a document's score is a logistic function of the sum over its clauses.

The insult lexicon holds seed words and entries learned from labels: words or word beginnings that occur in toxic
training documents far more often than chance allows, counted by documents and by distinct neighbours, so that copies of
one document don't make an entry. Training uses at most ``TOXIC_SAMPLE`` and ``CLEAN_SAMPLE`` labelled documents (in
expectation), drawn by a hash of the id, never held-out ones (crc32 of the id as text, mod 5, is 0). Scores depend on texts alone.

Defined cases: null and empty texts have no clause and get the lowest score; a document labelled twice counts as toxic
if one label says so; without labels the seeds and a fixed logistic function decide; repeated rows score alike; a very
long text is read clause by clause, whole (those above ``TEXT_BYTES`` aren't in the training sample); an empty table gives
no rows; other columns are kept by ``with_scores`` and ``keep_clean``, whatever their names, and dropped by ``report``.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import prepare, with_columns

TOXIC_SAMPLE, CLEAN_SAMPLE = 1500, 3000
#: Bytes of a text that may be in the sample, so that what comes to the driver is bounded; longer ones aren't drawn.
TEXT_BYTES = 200_000
FOLDS = 5
#: Shortest and longest word beginning that may become an entry, and the most entries.
STEM, LONGEST, ENTRIES = 4, 12, 1000
#: Times that an entry is rather in toxic than in clean training texts at least, and from which its weight is full.
PURITY, SURE = 4, 30

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[\"“”«»„]")
_CLAUSE = re.compile(r"[.!?;\n]+")

SEEDS = """idiot idiots moron morons stupid loser losers pathetic worthless disgusting scum dumbass imbecile
    idiotisch trottel abschaum imbécile ordure idiota estúpido imbécil""".split()
INTENT = frozenset("will gonna shall should werde werden wirst vais va vas voy".split())
HARM = frozenset("kill hurt beat destroy burn strangle shoot stab töten umbringen tuer frapper matar golpear".split())
TARGET = frozenset("""you your you're yourself u he him she her they them du dich dir ihr euch sie tu te toi vous il elle
    tú ti usted ustedes él ella ellos""".split())
NEGATION = frozenset("""not no never none isn't aren't wasn't don't doesn't didn't nicht kein keine nie pas jamais ne nunca
    jamás tampoco""".split())
REPORT = frozenset("""said says say told wrote called claimed quoted sagte sagt schrieb dit disait écrit dijo dice
    escribió""".split())
QUOTES = frozenset('"“”«»„')

#: Weights: of an event without context, and of contexts.
WEIGHT = {"insult": 1.0, "threat": 2.0}
FACTOR = {"target": 1.5, "negated": 0.5, "reported": 0.6}
CLAUSE_CAP = 6.0
SCOPE = 3

#: What an arc leads to: the next state, the arc's weight, and whether it puts an event out.
Arc = tuple[int, float, bool]


class Transducer:
    """A deterministic weighted transducer over symbols. ``arcs[state][symbol]``; a state's ``None`` entry holds for
    symbols it doesn't name. ``final`` has the weights of final states other than 1."""

    def __init__(self, arcs: dict[int, dict[str | None, Arc]], final: dict[int, float] | None = None) -> None:
        self.arcs, self.final = arcs, final or {}

    def step(self, state: int, symbol: str) -> Arc:
        row = self.arcs[state]
        return row.get(symbol) or row[None]


def _machines() -> list[Transducer]:
    """Insult, threat, target, negation and reported speech."""
    stay: dict[str | None, Arc] = {None: (0, 1.0, False)}
    intent, harm = (1, 1.0, False), (0, WEIGHT["threat"], True)
    negated, reported, target = FACTOR["negated"], FACTOR["reported"], FACTOR["target"]
    return [
        Transducer({0: stay | {"insult": (0, WEIGHT["insult"], True)}}),
        Transducer({0: stay | {"intent": intent}, 1: {"harm": harm, "intent": intent, None: (2, 1.0, False)}, 2: stay | {"harm": harm, "intent": intent}}),
        Transducer({0: stay | {"target": (1, 1.0, False)}, 1: {None: (1, 1.0, False)}}, {1: target}),
        Transducer({0: stay | {"negation": (SCOPE, 1.0, False)}} | {
            k: {"negation": (SCOPE, negated, False), None: (k - 1, negated, False)} for k in range(1, SCOPE + 1)}),
        Transducer({0: stay | {"report": (1, 1.0, False), "quote": (1, 1.0, False)}, 1: {"quote": (0, reported, False), None: (1, reported, False)}}),
    ]


class Composed:
    """The product of weighted transducers, built state by state as clauses need it."""

    def __init__(self, machines: list[Transducer]) -> None:
        self.machines = machines
        self.ids: dict[tuple[int, ...], int] = {}
        self.states: list[tuple[int, ...]] = []
        self.table: dict[tuple[int, str], Arc] = {}
        self.start = self._id((0,) * len(machines))

    def _id(self, state: tuple[int, ...]) -> int:
        if state not in self.ids:
            self.ids[state] = len(self.states)
            self.states.append(state)
        return self.ids[state]

    def step(self, state: int, symbol: str) -> Arc:
        got = self.table.get((state, symbol))
        if got is None:
            arcs = [m.step(s, symbol) for m, s in zip(self.machines, self.states[state], strict=True)]
            weight = math.prod(w for _, w, _ in arcs)
            got = self.table[state, symbol] = self._id(tuple(s for s, _, _ in arcs)), weight, any(e for _, _, e in arcs)
        return got

    def final(self, state: int) -> float:
        return math.prod(m.final.get(s, 1.0) for m, s in zip(self.machines, self.states[state], strict=True))


@dataclass
class Grammar:
    """Insult entries (word or beginning -> weight), the composed machine, and the logistic function's coefficients."""

    words: dict[str, float] = field(default_factory=lambda: dict.fromkeys(SEEDS, 1.0))
    stems: dict[str, float] = field(default_factory=dict)
    bias: float = -4.0
    slope: float = 4.0

    def __post_init__(self) -> None:
        import ahocorasick

        self.machine = Composed(_machines())
        self.find = ahocorasick.Automaton()
        for w in {*self.words, *self.stems, *HARM}:
            self.find.add_word(w, len(w))
        self.find.make_automaton()
        self.lengths = sorted({len(s) for s in self.stems}, reverse=True)

    def __reduce__(self):  # the machine and the search automaton are built again on a worker
        return Grammar, (self.words, self.stems, self.bias, self.slope)

    def insult(self, word: str) -> float:
        w = self.words.get(word)
        if w is None:
            w = next((self.stems[word[:n]] for n in self.lengths if word[:n] in self.stems), 0.0)
        return w

    def symbol(self, word: str) -> tuple[str, float]:
        if word in QUOTES:
            return "quote", 0.0
        if weight := self.insult(word):
            return "insult", weight
        for name, words in (("harm", HARM), ("intent", INTENT), ("target", TARGET), ("negation", NEGATION), ("report", REPORT)):
            if word in words:
                return name, 1.0
        return "other", 0.0

    def clause(self, words: Iterable[str]) -> float:
        """A clause's score: the lexicon's weight of a word times its arc's, over all events, times the final weight."""
        state, total = self.machine.start, 0.0
        for word in words:
            symbol, weight = self.symbol(word)
            state, arc, event = self.machine.step(state, symbol)
            if event:
                total += weight * arc
        return min(CLAUSE_CAP, total * self.machine.final(state))

    def _hit(self, text: str) -> bool:
        """Whether any clause can score: an entry at the beginning of a word."""
        return any(last == n - 1 or not text[last - n].isalpha() for last, n in self.find.iter(text))

    def total(self, text: str | None) -> float:
        if not text:
            return 0.0
        low = text.lower()
        if not self._hit(low):
            return 0.0
        return sum(self.clause(_WORD.findall(c)) for c in _CLAUSE.split(low) if self._hit(c))

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-self.bias - self.slope * math.log1p(self.total(text))))


def learn_entries(texts: list[str], toxic: list[int]) -> tuple[dict[str, float], dict[str, float]]:
    """Words and word beginnings that mark toxic documents: a binomial test against the share of toxic documents, with
    log(number of candidates) and 3 as its bound. Of nested beginnings the longest with nearly all of the support stays."""
    n = [toxic.count(0), toxic.count(1)]
    if not n[0] or not n[1]:
        return {}, {}

    def fresh(only: tuple[int, ...]):
        """For each text of a class its pairs of a neighbour and a word that weren't in any before: copied passages,
        which bring the same pairs, count once."""
        seen: set[int] = set()
        for text, bad in zip(texts, toxic, strict=True):
            if bad in only:
                words = _WORD.findall(text.lower())
                yield bad, [p for p in zip(["", *words], words) if len(p[1]) >= STEM and (h := hash(p)) not in seen and not seen.add(h)]

    def marks(word: str) -> list[str]:
        return [word[:k] for k in range(STEM, min(LONGEST, len(word)) + 1)] + [word + "$"]

    # Three passes, so that only what toxic texts repeat is ever held.
    docs: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for _, pairs in fresh((1,)):
        for m in {m for _, w in pairs for m in marks(w)}:
            docs[m][1] += 1
    docs = {m: v for m, v in docs.items() if v[1] > 1}
    for _, pairs in fresh((0,)):
        for m in {m for _, w in pairs for m in marks(w) if m in docs}:
            docs[m][0] += 1
    bound = math.log(max(10, len(docs))) + 3
    base = n[1] / (n[0] + n[1])
    docs = {m: v for m, v in docs.items() if v[1] * n[0] > 2 * v[0] * n[1]}
    near: list[dict[str, set[int]]] = [defaultdict(set), defaultdict(set)]
    forms: dict[str, set[str]] = defaultdict(set)
    for bad, pairs in fresh((0, 1)):
        for before, word in pairs:
            for m in marks(word):
                if m in docs:
                    near[bad][m].add(hash(before))
                    if bad:
                        forms[m].add(word)
    strength: dict[str, float] = {}
    weight: dict[str, float] = {}
    for m, (clean, bad) in docs.items():
        hits, misses = len(near[1].get(m, ())), len(near[0].get(m, ()))
        if bad < 2 or hits < PURITY * misses:
            continue
        # Other neighbours and, for a beginning, other words count nearly as other documents do.
        kinds = min(hits, 3 * bad) if m.endswith("$") else min(hits, len(forms[m]) + bad, 5 * bad)
        support = bad + 0.6 * max(0, kinds - bad)
        p = support / (support + clean)
        gain = support * math.log(p / base) + (clean * math.log((1 - p) / (1 - base)) if clean else 0)
        if gain > bound:
            strength[m] = support
            weight[m] = min(1.0, math.log((hits + 0.5) / (misses + 0.5)) / math.log(SURE))
    chosen: dict[str, float] = {}
    heir: dict[str, str] = {}  # what a replaced beginning was replaced by
    for m in sorted(strength, key=lambda x: (len(x), x)):
        word = m.rstrip("$")
        parent = next((word[:k] for k in range(len(word) if m != word else len(word) - 1, STEM - 1, -1) if word[:k] in chosen or word[:k] in heir), None)
        if parent is None:
            chosen[m] = strength[m]
        elif parent in chosen and len(near[1][m]) >= 0.9 * len(near[1][parent]):
            del chosen[parent]
            chosen[m], heir[parent] = strength[m], m
    best = sorted(chosen, key=lambda m: (-chosen[m], m))[:ENTRIES]
    words = {m[:-1]: weight[m] for m in best if m.endswith("$")}
    words |= {next(iter(forms[m])): weight[m] for m in best if not m.endswith("$") and len(forms[m]) == 1}
    return words, {m: weight[m] for m in best if not m.endswith("$") and len(forms[m]) > 1}


def _logistic(x: list[float], y: list[int]) -> tuple[float, float]:
    """Ridge-regularised logistic regression on one feature, by Newton steps."""
    import numpy as np

    a = np.column_stack([np.ones(len(x)), x])
    t, w, ridge = np.array(y, float), np.zeros(2), np.array([1e-3, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ w))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + np.diag(ridge), a.T @ (t - p) - ridge * w)
        w = np.clip(w + step, -30, 30)
        if abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> Grammar:
    """A grammar from a bounded sample of labelled training documents."""
    prepare(docs.sparkSession)
    held = F.crc32(F.col("id").cast("string")) % FOLDS == 0
    known = (
        labels.select(F.col(f"`{id_col}`").alias("id"), F.col("toxic").cast("int").alias("toxic")).where("id is not null and toxic is not null")
        .where(~held).groupBy("id").agg(F.max("toxic").alias("toxic"))
    )
    count = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("id", F.lit("toxicity")), F.lit(1 << 20)) / float(1 << 20)
    share = F.when(F.col("toxic") == 1, TOXIC_SAMPLE / max(1, count.get(1, 0))).otherwise(CLEAN_SAMPLE / max(1, count.get(0, 0)))
    sample = known.where(draw < share)
    rows = (
        docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where(F.octet_length("text") <= TEXT_BYTES)
        .join(F.broadcast(sample), "id").groupBy("id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).collect()
    )  # one text an id, so the two sample sizes and TEXT_BYTES bound what comes to the driver
    rows.sort(key=lambda r: (r["id"], r["text"]))
    texts, toxic = [r["text"] for r in rows], [int(r["toxic"] == 1) for r in rows]
    words, stems = learn_entries(texts, toxic)
    grammar = Grammar(dict.fromkeys(SEEDS, 1.0) | words, stems)
    if len(set(toxic)) == 2:
        grammar.bias, grammar.slope = _logistic([math.log1p(grammar.total(t)) for t in texts], toxic)
    return grammar


def with_scores(df: DataFrame, grammar: Grammar, text_col: str = "text", out: str = "score") -> DataFrame:
    """``df`` with each text's score."""

    def make():
        g = grammar
        return lambda cols: {out: [g.score(t) for t in cols[text_col]]}

    return with_columns(df, [text_col], make, [(out, "double")])


def report(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``. A null id isn't held out."""
    grammar = train(docs, labels, text_col, id_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return with_scores(rows, grammar).select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_clean(df: DataFrame, grammar: Grammar, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that score below 0.5, with its columns."""
    named = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])
    scored = with_scores(named, grammar, f"c{df.columns.index(text_col)}", "score")
    return scored.where("score < 0.5").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)])
