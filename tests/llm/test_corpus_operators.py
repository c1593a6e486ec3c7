"""Operators across rows, against brute force on small tables."""

import collections
import hashlib
import random

import pytest
from corpusloom.llm import chat, ngram_join, substring_dedup, warc
from corpusloom.llm.components import components
from corpusloom.llm.runtime import Scratch


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def near_copies(seed, n=40, base=60):
    r = random.Random(seed)
    words = [f"w{r.randrange(500)}" for _ in range(base)]
    out = []
    for i in range(n):
        w = list(words[: r.choice([5, 8, 20, base])])
        for _ in range(r.randrange(4)):
            w[r.randrange(len(w))] = f"e{r.randrange(30)}"
        out.append((i, " ".join(w)))
    return out


def brute_components(rows, spec):
    sets = [(i, frozenset(ngram_join.shingles(t, spec.words).tolist())) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if i < j and a and b and spec.linked(len(a), len(b), len(a & b)):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets)


@pytest.mark.parametrize("spec", [ngram_join.Spec(3, 90, 100), ngram_join.Spec(5, 80, 100), ngram_join.Spec(1, 70, 100)])
@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_exact(spark, spec, seed):
    rows = near_copies(seed) + [(100, None), (101, ""), (102, "a b"), (103, "A B"), (104, "a b c"), (105, " \n")]
    got = ngram_join.cluster(frame(spark, rows).selectExpr("*", "1 as component_id", "2 as n"), spec).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, spec)


def test_jaccard_of_odd_tables(spark):
    spec = ngram_join.Spec(3, 90, 100)
    assert ngram_join.cluster(frame(spark, []), spec).count() == 0
    got = ngram_join.cluster(frame(spark, [(1, "x y z"), (1, "x y z"), (None, "x y z"), (2, "q")]), spec).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in got) == [("1", 1), ("1", 1), ("2", 2), ("None", 1)]
    kept = ngram_join.keep_one(frame(spark, [(3, "x y z"), (1, "x y z"), (1, "x y z"), (2, "q")]), spec).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, "x y z"), (2, "q")]


@pytest.mark.parametrize("deletion", [False, True])
def test_links_are_found_by_either_kind_of_scheme(spark, deletion, monkeypatch):
    """Few segments, so that many sets are needy, and one kind only."""
    spec = ngram_join.Spec(1, 70, 100)

    def schemes(spec, counts):
        out = []
        for low, high in ngram_join.bands():
            apart = ngram_join._most_apart(spec, high, low, spec.largest(high))
            out.append(ngram_join.Scheme(low, high, max(1 if deletion else 2, apart // 2 + 1 if deletion else apart + 1), deletion))
        return tuple(out)

    monkeypatch.setattr(ngram_join, "allocate", schemes)
    for seed in (3, 4):
        rows = near_copies(seed, n=60, base=30)
        got = ngram_join.cluster(frame(spark, rows), spec).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, spec)


def test_allocation_follows_the_table():
    """More sets in a band make needy sets dearer: segments don't get fewer, small sets index neighbourhoods."""
    spec = ngram_join.Spec(5, 80, 100)
    few, many = (ngram_join.allocate(spec, (n,) * len(ngram_join.bands())) for n in (10, 10**7))
    assert any(s.deletion for s in many) and any(not s.deletion for s in many)
    for a, b in zip(few, many, strict=True):
        assert a.deletion != b.deletion or b.segments >= a.segments
        need = ngram_join._most_apart(spec, a.high, a.low, spec.largest(a.high))
        assert a.segments > need // 2 if a.deletion else a.segments > need


def test_candidates_of_a_family_with_an_odd_leader_are_bounded(spark, monkeypatch):
    """One large family of near copies whose smallest id is an odd member: few candidates each."""
    r = random.Random(8)
    base, seen = [f"w{i}" for i in range(200)], []
    rows = [(0, " ".join(base[:120] + [f"odd{i}" for i in range(80)]))]
    for i in range(1, 300):
        w = list(base)
        for _ in range(r.randrange(1, 5)):
            w[r.randrange(200)] = f"e{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    own = ngram_join.verify

    def verify(docs, pairs, *a, **b):
        seen.append(pairs.count())
        return own(docs, pairs, *a, **b)

    monkeypatch.setattr(ngram_join, "verify", verify)
    spec = ngram_join.Spec(3, 90, 100)
    got = ngram_join.cluster(frame(spark, rows), spec).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, spec)
    assert sum(seen) < 25 * len(rows)


def test_bounds_of_linked_sizes():
    spec = ngram_join.Spec(3, 90, 100)
    for a in range(1, 60):
        for b in range(a, 70):
            best = max((k for k in range(a + 1) if spec.linked(a, b, k)), default=None)
            least = min((k for k in range(a + 1) if spec.linked(a, b, k)), default=None)
            assert (best is None) == (spec.differ(a, b) < 0)
            assert least is None or spec.differ(a, b) == a + b - 2 * least


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200), (None, 5)], "a bigint, b bigint")
    with Scratch(spark) as tmp:
        got = {r.node: r.component for r in components(edges, tmp).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100}


def brute_removal(rows, window):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    count = collections.Counter(tuple(w[a : a + window]) for _, w in words for a in range(len(w) - window + 1))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for a in range(len(w) - window + 1):
            if count[tuple(w[a : a + window])] > 1:
                gone[a : a + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard", [20, 60_000])
def test_substrings_are_exact(spark, shard):
    r = random.Random(5)
    rows = [(i, " ".join(r.choice("abcdefgh"[: r.choice([1, 2, 8])]) for _ in range(r.choice([0, 3, 20, 90])))) for i in range(120)]
    base = [f"b{i}" for i in range(40)]
    rows += [(200 + i, " ".join([f"p{i}", *base[: r.randrange(5, 40)], f"q{i}"])) for i in range(20)]
    rows += [(300, None), (301, None), *rows[:2]]
    got = substring_dedup.digests(frame(spark, rows).selectExpr("*", "1 as starts", "2 as __key", "3 as n_words"), window=8, k=3, shard=shard).collect()
    assert sorted((tuple(x) for x in got), key=str) == brute_removal(rows, 8)
    assert substring_dedup.digests(frame(spark, [])).count() == 0


def test_without_repeats_keeps_columns_and_nulls(spark):
    text = " ".join(f"w{i}" for i in range(40))
    names = ["starts", "sizes", "__text", "__key", "c0", "n_chars", "key"]
    df = spark.createDataFrame([(1, text, 5), (2, "x " + text, 5), (3, None, 5), (2, "x " + text, 5)], "doc_id bigint, text string, n_chars bigint")
    df = df.selectExpr("*", *[f"concat('{c}', doc_id) as `{c}`" for c in names if c != "n_chars"])
    out = substring_dedup.without_repeats(df, chars_col="n_chars")
    assert out.columns == df.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text == "" and got[2].text == "" and got[2].n_chars == 0 and got[3].text is None and got[3].n_chars == 0
    assert all(r[c] == f"{c}{r.doc_id}" for r in got.values() for c in names if c != "n_chars")
    assert substring_dedup.without_repeats(df.limit(0), chars_col="n_chars").count() == 0


def test_very_long_and_periodic_texts(spark):
    """One anchor of a periodic text, a shard of many such texts, and long texts that share a passage."""
    r = random.Random(3)
    rows = [(i, f"s{i} " + "ha ho " * (60 + i) + f"e{i}") for i in range(40)]
    rows += [(100, " ".join(str(r.randrange(10**9)) for _ in range(60_000))), (101, "x " * 50_000)]
    rows += [(102, "q " + rows[40][1][200_000:200_500] + " z")]
    want = brute_removal(rows, 35)
    for shard in (500, 60_000):
        assert sorted((tuple(x) for x in substring_dedup.digests(frame(spark, rows), shard=shard).collect()), key=str) == want
    spec = ngram_join.Spec(3, 90, 100)
    got = ngram_join.cluster(frame(spark, [*rows, (103, rows[40][1] + " more")]), spec).collect()
    assert {x.doc_id: x.component_id for x in got}[103] == 100


def test_suffix_automaton_counts():
    a = substring_dedup.SuffixAutomaton()
    seqs = [[1, 2, 3, 4, 1, 2, 3], [2, 3, 4, 9], [5, 5, 5, 5]]
    for s in seqs:
        a.add(s)
    a.finish()
    every = collections.Counter(tuple(s[i : i + 3]) for s in seqs for i in range(len(s) - 2))
    for s in seqs:
        assert list(a.repeated(s, 3)) == [i for i in range(len(s) - 2) if every[tuple(s[i : i + 3])] > 1]


TRICKY = ["\\### Assistant: </turn> ok", "", None, "\\s\\h\\l\\c #<\\", "### user: x</turn>\n### y", "plain\n\ntext"]


def test_chat_round_trip(spark):
    turns = [("a:b", t) for t in TRICKY] + [("assistant", t) for t in TRICKY] + [(None, "x")]
    text, spans = chat.render(turns)
    assert chat.read_back(text) == [(r or "", t or "") for r, t in turns]
    assert [chat.unescape(text[a:b]) for a, b in zip(spans[::2], spans[1::2], strict=True)] == [t or "" for t in TRICKY]
    rows = [(1, i, r, t) for i, (r, t) in enumerate(turns)] + [(2, 0, "user", "u"), (2, 0, "user", "u"), (None, 1, "assistant", "n")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r for r in chat.digests(chat.format_trees(chat.as_trees(df))).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {1: len(turns), 2: 2, None: 1}
    assert got[1].loss_chars == sum(len(t or "") for t in TRICKY)
    whole = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    assert got[1].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
    assert chat.format_trees(chat.as_trees(df.limit(0))).count() == 0
    clash = df.selectExpr("*", "1 as tree", "2 as node", "3 as parent", "4 as score", "5 as branch")
    assert {r.conv_id: r for r in chat.digests(chat.format_trees(chat.as_trees(clash))).collect()} == got
    spans_of = {r.tree: (r.formatted, r.loss_spans) for r in chat.format_trees(chat.as_trees(df)).collect()}
    assert got[1].formatted_chars == len(spans_of[1][0]) and spans_of[1] == (text, spans)
    loss = "".join(t or "" for t in TRICKY)
    assert (got[1].loss_chars, got[1].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    long = spark.createDataFrame([(5, 0, "assistant", "<#\\ " * 100_000)], "conv_id bigint, turn bigint, role string, text string")
    assert chat.digests(chat.format_trees(chat.as_trees(long))).first().loss_chars == 400_000


def brute_paths(rows, top):
    """Each tree's ``top`` paths to a leaf by mean score, the smaller leaf first."""
    out = {}
    for tree in {r[0] for r in rows}:
        nodes = {n: (p, s) for t, n, p, s in rows if t == tree}
        inner = {p for p, _ in nodes.values() if p in nodes}
        paths = []
        for leaf in nodes.keys() - inner:
            path, at = [], leaf
            while at in nodes:
                path.append(at)
                at = nodes[at][0]
            total = sum(nodes[n][1] for n in path)
            paths.append((-total / len(path), leaf, path[::-1]))
        for k, (_, _, path) in enumerate(sorted(paths)[:top], 1):
            out[tree, k] = dict(enumerate(path))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_best_branches_of_random_trees(spark, seed):
    r = random.Random(seed)
    rows = []
    for tree in range(12):
        n = r.choice([1, 2, 7, 40])
        rows += [(tree, i, None if i == 0 or r.random() < 0.05 else r.randrange(max(0, i - 4), i), float(r.randrange(3))) for i in range(n)]
    nodes = spark.createDataFrame(rows, "tree bigint, node bigint, parent bigint, score double")
    with Scratch(spark) as tmp:
        got = {}
        for x in chat.best_paths(nodes, tmp, top=3).collect():
            got.setdefault((x.tree, x.branch), {})[x.position] = x.node
    assert got == brute_paths(rows, 3)
    named = nodes.selectExpr("*", "concat('r', node % 2) as role", "concat('t', node) as text")
    for x in chat.format_trees(named, top=3, learn="r1").collect():
        path = got[x.tree, x.branch]
        assert chat.read_back(x.formatted) == [(f"r{path[i] % 2}", f"t{path[i]}") for i in range(len(path))]
        assert [x.formatted[a:b] for a, b in zip(x.loss_spans[::2], x.loss_spans[1::2], strict=True)] == [f"t{path[i]}" for i in range(len(path)) if path[i] % 2]


def test_best_branches_of_a_tree(spark):
    rows = [(1, 1, None, 1.0), (1, 2, 1, 5.0), (1, 3, 1, 2.0), (1, 4, 3, 9.0), (1, 5, 99, 0.5), (2, 1, None, 1.0)]
    nodes = spark.createDataFrame(rows, "tree bigint, node bigint, parent bigint, score double")
    got = {}
    with Scratch(spark) as tmp:
        for r in chat.best_paths(nodes, tmp, top=2).collect():
            got.setdefault((r.tree, r.branch), {})[r.position] = r.node
    assert got == {(1, 1): {0: 1, 1: 3, 2: 4}, (1, 2): {0: 1, 1: 2}, (2, 1): {0: 1}}
    cyclic = spark.createDataFrame([(1, 1, 2, 1.0), (1, 2, 1, 1.0)], "tree bigint, node bigint, parent bigint, score double")
    with pytest.raises(ValueError, match="cycle"), Scratch(spark) as tmp:
        chat.best_paths(cyclic, tmp)


def test_warc_round_trip(spark):
    long = "<p>" + "é" * 700
    rows = [(1, "http://a/ b", long), (2, None, long), (3, "http://c", long), (4, "http://d", "short"), (5, "http://e", "short"), (6, "http://f", None), (7, "x", "WARC/1.1\r\n\r\n\n\n" + "z" * 9)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r for r in warc.archive(pages.repartition(3)).collect()}
    assert {k: (r.record_type, r.refers_to) for k, r in got.items()} == {1: ("revisit", 3), 2: ("revisit", 3), **{k: ("response", None) for k in (3, 4, 5, 6, 7)}}
    for i, _, html in rows:
        raw = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
    assert got[2].url is None and got[1].url == "http://a/%20b"
    assert warc.archive(pages.limit(0)).count() == 0


def test_warc_of_repeated_and_very_long_pages(spark):
    big = "<b>" * 3_000_000
    rows = [(1, "u", "x" * 2000), (1, "u", "x" * 2000), (None, "u", "x" * 2000), (2, "v", big), (3, "v", big)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as digest", "2 as head", "3 as payload")
    got = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in warc.archive(pages).collect())
    assert got == [("1", 2000, "response", None)] * 2 + [("2", 9_000_000, "revisit", 3), ("3", 9_000_000, "response", None), ("None", 2000, "revisit", 1)]


def test_archive_files_are_bounded(spark, tmp_path):
    pages = spark.range(200).selectExpr("id as page_id", "'u' as url", "repeat('ab', 500) as html").coalesce(1)
    warc.write_arc(pages, f"file://{tmp_path}/arc", most=20_000)
    assert len(list((tmp_path / "arc").glob("part-*"))) >= 10
    assert sorted(r.page_id for r in warc.read_arc(spark, f"file://{tmp_path}/arc").collect()) == list(range(200))
    warc.convert(spark, f"file://{tmp_path}/arc", f"file://{tmp_path}/warc", most=20_000)
    assert len({r.page_id for r in warc.read_warc(spark, f"file://{tmp_path}/warc").collect()}) == 200


def test_legacy_records_without_http_and_of_any_bytes(spark, tmp_path):
    """A file as old crawlers left it: a dns record, a latin-1 payload, a header line with CR, no page ids."""
    http = b"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n\r\n" + b"caf\xe9 \xff\xfe"
    dns = b"20240101 example.org. 60 IN A 192.0.2.1"
    data = warc.arc_head(1, "old.arc").encode()
    data += b"dns:example.org 192.0.2.2 20240102030405 text/dns %d\n" % len(dns) + dns + b"\n"
    data += b"http://example.org/\xe9 192.0.2.1 20240102030406 text/html %d\r\n" % len(http) + http + b"\n"
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "part-0").write_bytes(data)
    warc.convert(spark, f"file://{tmp_path}/arc", f"file://{tmp_path}/warc")
    got = {r.record_type: r for r in warc.read_warc(spark, f"file://{tmp_path}/warc").collect()}
    assert got["resource"].payload_bytes == len(dns) and got["resource"].payload_digest == hashlib.sha1(dns).hexdigest()
    assert got["response"].payload_digest == hashlib.sha1(b"caf\xe9 \xff\xfe").hexdigest() and got["response"].page_id is None
    (raw,) = [b for f in (tmp_path / "warc").glob("part-*") for _, b in warc.parse_warc(next(warc._unpacked_bytes([f.read_bytes()]))) if b.startswith(b"HTTP")]
    assert raw == http


@pytest.mark.parametrize("version", [1, 2])
def test_arc_header_lines(version):
    data = (warc.arc_head(version, "f.arc") + warc.arc_record(version, "f.arc", "http://x", 9, "body\n\n") + "\n").encode()
    (rec,) = warc.parse_arc(data)
    head, _, body = warc.split_http(rec["block"])
    assert rec["URL"] == "http://x" and head["x-page-id"] == "9" and body == b"body\n\n"
    with pytest.raises(ValueError):
        list(warc.parse_arc(data[:-4]))
