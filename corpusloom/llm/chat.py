"""Chat formatting of reply trees.

Paths are found by iterative self-joins that double their reach: after round r a node knows its ancestor 2^r steps up
and the score of the way there, so depth d takes log2(d) joins of narrow rows keyed by (tree, node), which spread
however large one tree is. Branches are ranked by mean score; the ancestors of each chosen leaf are gathered with the
same jump tables, and each path is rendered as one conversation.

The template is ``### role: text</turn>`` and a line feed for each turn. In texts and roles a backslash, ``#`` and
``<`` become ``\\s``, ``\\h`` and ``\\l`` (in roles also ``:`` becomes ``\\c``), so no control string survives inside
a text, and ``read_back`` inverts this exactly. The loss mask is a list of code-point spans of assistant texts.

Defined cases: null roles and texts are empty; rows of a null tree form one conversation; turns with equal numbers are
ordered by role and text; repeated rows are turns of their own; null turns come first; an empty table gives no rows;
branches of equal score are ranked by their leaf; a very long text or conversation is one row of the result, in memory
at once; other columns are dropped, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import Scratch, map_columns, prepare

OPEN, AFTER_ROLE, CLOSE = "### ", ": ", "</turn>\n"
_ESCAPES = (("\\", "\\s"), ("#", "\\h"), ("<", "\\l"))


def escape(text: str, role: bool = False) -> str:
    for a, b in _ESCAPES:
        text = text.replace(a, b)
    return text.replace(":", "\\c") if role else text


def unescape(text: str, role: bool = False) -> str:
    if role:
        text = text.replace("\\c", ":")
    for a, b in reversed(_ESCAPES):
        text = text.replace(b, a)
    return text


def render(turns: Iterable[tuple[str | None, str | None]], learn: str = "assistant") -> tuple[str, list[int]]:
    """A conversation's string and its loss spans, as start, end, start, end and so on."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role or "", True) + AFTER_ROLE, escape(text or "")
        parts += [head, body, CLOSE]
        at += len(head)
        if role == learn:
            spans += [at, at + len(body)]
        at += len(body) + len(CLOSE)
    return "".join(parts), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    out = []
    for turn in formatted.split(CLOSE)[:-1]:
        role, text = turn.removeprefix(OPEN).split(AFTER_ROLE, 1)
        out.append((unescape(role, True), unescape(text)))
    return out


def _same(a: str, b: str, *cols: tuple[str, str]) -> Column:
    cond = F.lit(True)
    for x, y in cols:
        cond = cond & F.col(f"{a}.{x}").eqNullSafe(F.col(f"{b}.{y}"))
    return cond


def jumps(nodes: DataFrame, tmp: Scratch) -> tuple[list[DataFrame], DataFrame]:
    """From ``tree, node, parent, score`` the jump tables ``tree, node, up`` (table r reaches 2^r steps up; nodes nearer
    to the root aren't in it), and for all nodes ``tree, node, steps, total``, their paths' length and score. A round
    joins only what hasn't reached its root. Parents that don't exist count as none; a cycle raises an error."""
    known = nodes.select(F.col("tree").alias("t"), F.col("node").alias("p"))
    now = tmp.write(
        nodes.alias("n").join(known.alias("k"), _same("n", "k", ("tree", "t")) & (F.col("n.parent") == F.col("k.p")), "left")
        .select("n.tree", "n.node", F.col("k.p").alias("up"), F.lit(1).cast("long").alias("steps"), F.col("n.score").alias("total"))
    )
    tables, ended = [], now.where("up is null")
    while (active := now.where("up is not null")).limit(1).count():
        if len(tables) > 40:
            raise ValueError("the replies form a cycle")
        tables.append(active.select("tree", "node", "up"))
        reach = ended.unionByName(active).select(
            F.col("tree").alias("t"), F.col("node").alias("m"), F.col("up").alias("up2"), F.col("steps").alias("steps2"), F.col("total").alias("total2"))
        now = tmp.write(
            active.alias("a").join(reach.alias("b"), _same("a", "b", ("tree", "t")) & (F.col("a.up") == F.col("b.m")))
            .select("a.tree", "a.node", F.col("b.up2").alias("up"), (F.col("a.steps") + F.col("b.steps2")).alias("steps"),
                    (F.col("a.total") + F.col("b.total2")).alias("total"))
        )
        ended = ended.unionByName(now.where("up is null"))
    return tables, ended.select("tree", "node", "steps", "total")


def best_paths(nodes: DataFrame, tmp: Scratch, top: int = 1) -> DataFrame:
    """The ``top`` branches of each tree by mean score (ties: the smaller leaf): ``tree, leaf, branch, node, position``."""
    tables, last = jumps(nodes.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score")), tmp)
    leaves = last
    if tables:
        inner = tables[0].select(F.col("tree").alias("t"), F.col("up").alias("p")).distinct()
        leaves = last.alias("l").join(inner.alias("i"), _same("l", "i", ("tree", "t")) & (F.col("l.node") == F.col("i.p")), "left_anti")
    best = Window.partitionBy("tree").orderBy((F.col("total") / F.col("steps")).desc(), "node")
    chosen = leaves.withColumn("branch", F.row_number().over(best)).where(F.col("branch") <= top)
    members = chosen.select("tree", F.col("node").alias("leaf"), "branch", "node", F.col("steps").alias("depth"), F.lit(0).cast("long").alias("back"))
    for r, table in enumerate(tables):
        step = table.select(F.col("tree").alias("t"), F.col("node").alias("m"), "up")
        higher = members.alias("a").join(step.alias("b"), _same("a", "b", ("tree", "t")) & (F.col("a.node") == F.col("b.m")))
        members = tmp.write(members.unionByName(higher.select(
            "a.tree", "a.leaf", "a.branch", F.col("b.up").alias("node"), "a.depth", (F.col("a.back") + (1 << r)).alias("back"))))
    return members.select("tree", "leaf", "branch", "node", (F.col("depth") - 1 - F.col("back")).alias("position"))


def format_trees(nodes: DataFrame, top: int = 1, learn: str = "assistant") -> DataFrame:
    """``nodes`` (tree, node, parent, role, text, score) as conversations: ``tree, branch, formatted, loss_spans``, a table
    in the shared folder. Nodes are unique in a tree. A conversation's turns meet in one task because they are one row of
    the result."""

    def make():
        def step(cols):
            got = [render(zip(r, t, strict=True), learn) for r, t in zip(cols["roles"], cols["texts"], strict=True)]
            return {"tree": cols["tree"], "branch": cols["branch"], "formatted": [x for x, _ in got], "loss_spans": [s for _, s in got]}

        return step

    with Scratch(prepare(nodes.sparkSession)) as tmp:
        nodes = tmp.write(nodes.select("tree", "node", "parent", "role", "text", "score"))
        paths = best_paths(nodes, tmp, top)
        turns = (
            paths.alias("p").join(nodes.alias("n"), _same("p", "n", ("tree", "tree"), ("node", "node")))
            .groupBy("p.tree", "p.branch")
            .agg(F.sort_array(F.collect_list(F.struct("p.position", "n.role", "n.text"))).alias("turns"))
            .select("tree", "branch", F.transform("turns", lambda t: t["role"]).alias("roles"), F.transform("turns", lambda t: t["text"]).alias("texts"))
        )
        out = map_columns(turns, make, [("tree", "bigint"), ("branch", "int"), ("formatted", "string"), ("loss_spans", "array<bigint>")])
        return tmp.keep(tmp.write(out))


def as_trees(turns: DataFrame, tree_col: str = "conv_id") -> DataFrame:
    """Linear conversations as trees: each turn replies to the one before it."""
    order = Window.partitionBy(tree_col).orderBy("turn", "role", "text")
    return (
        turns.select(tree_col, "role", "text", F.row_number().over(order).cast("long").alias("node"))
        .select(F.col(tree_col).cast("long").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                "role", "text", F.lit(1.0).alias("score"))
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What ``read_back`` and the loss mask give of ``format_trees``' rows."""
    fields = [("conv_id", "bigint"), ("n_turns", "bigint"), ("turns_sha256", "string"), ("loss_chars", "bigint"),
              ("loss_sha256", "string"), ("formatted_chars", "bigint")]

    def make():
        def step(cols):
            out: dict[str, list] = {n: [] for n, _ in fields}
            for tree, text, spans in zip(cols["tree"], cols["formatted"], cols["loss_spans"], strict=True):
                turns = read_back(text)
                loss = "".join(unescape(text[a:b]) for a, b in zip(spans[::2], spans[1::2], strict=True))
                row = (tree, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                       len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text))
                for (n, _), v in zip(fields, row, strict=True):
                    out[n].append(v)
            return out

        return step

    return map_columns(formatted.select("tree", "formatted", "loss_spans"), make, fields)
