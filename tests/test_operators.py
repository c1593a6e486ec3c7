from corpusloom.operators import journal, markdown

ARTICLE = "# T\n\n::: box\na\n::: in\nb\n:::\n```\n:::\n```\n:::\n\ntext *one*\nline two\n## H\n~~~~\n~~~\n# no\n~~~~\n---\n| a | [b](m/x.mp3) |\nsrc: x\ncaption: A [l](http://q) here"


def test_blocks_are_atomic_and_cover():
    got = markdown.blocks(ARTICLE)
    assert [b.kind for b in got] == ["heading", "container", "text", "heading", "fence", "rule", "text"]
    assert all(ARTICLE[b.start : b.end] == b.text for b in got)
    assert got[1].name == "box" and got[1].text.endswith("```\n:::")


def test_unclosed_fence_takes_the_rest():
    assert [b.kind for b in markdown.blocks("a\n```\nb\n\nc")] == ["text", "fence"]


def test_spans_round_trip():
    article = ARTICLE.replace("~~~\n# no", "# no")  # for spans a fence ends with any run of its mark
    found = markdown.spans(article)
    assert markdown.apply_spans(article, found, {s.text: s.text for s in found}) == article
    assert "⟦1⟧" in found[-1].text and found[-1].kind == "attribute"
    assert markdown.missing_masks("a ⟦1⟧ ⟦2⟧", "⟦2⟧") == ["⟦1⟧"]


def test_chunks_fit_and_overlap():
    text = "\n\n".join(f"# H{i}\n\n" + "word " * 40 for i in range(6))
    got = markdown.chunks(text, 150)
    assert len(got) > 1 and all(s.tokens <= 160 for s in got)
    assert markdown.chunks(text, 150, overlap=80)[1].start < got[1].start


def test_ladder():
    text = "\n\n".join("word " * 60 for _ in range(20))
    assert [a["kind"] for a in markdown.attempts(text, "staged", 5000, head_tokens=200)] == ["head", "head-tail", "full"]
    assert [a["kind"] for a in markdown.attempts(text, "staged", 500, head_tokens=200)][-1] == "chunked"
    assert [a["kind"] for a in markdown.attempts("short", "truncation-first", 500)] == ["full"]


def test_skeletons():
    assert markdown.differences("a\n\nb", "a\n\nb\n\nc") == ["#2: expected (end), got p"]
    assert markdown.differences("a\n\nb", "a", strict=False) == []


def test_breaker_opens_and_probes(spark):
    rows = [(1, i, float(t), o) for i, (t, o) in enumerate([(0, "failure"), (1, "failure"), (2, "success"), (70, "failure"), (140, "success"), (141, "success")])]
    df = spark.createDataFrame(rows, "target bigint, seq bigint, t double, outcome string").selectExpr("target", "seq", "timestamp_seconds(t) as ts", "outcome")
    got = [(r["state"], r["passed"]) for r in journal.breaker(df, threshold=2, cooldown_s=60).orderBy("seq").collect()]
    assert got == [("closed", True), ("closed", True), ("open", False), ("half-open", True), ("half-open", True), ("closed", True)]
