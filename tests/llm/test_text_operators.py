"""Operators on single texts: exact against the libraries, and defined on odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from corpusloom.llm import byte_bpe, media, packing, quality, token_counts, toxicity
from corpusloom.llm.queries import tokenizer_path

LETTERS = ["a", "B", "the ", " ", "  ", "\n", "\t", "é", "ß", "中", "🙂", "\x1c", " ", "'s", "'LL", "1", "²", "<|endoftext|>", "<s>", "\0", "ñ", "́", "▁", "Σ", "İ", "</w>", ".", ",", "anthe", "\r"]
ODD = [(1, None), (2, ""), (3, "x " * 30000), (4, "same text"), (4, "same text"), (None, " \n\t"), (5, "🙂 é\x00 ﬁ")]


def texts(n, seed=1, most=16):
    r = random.Random(seed)
    return ["".join(r.choice(LETTERS) for _ in range(r.randint(0, most))) for _ in range(n)]


def frame(spark, rows=ODD):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_prefix_counts_are_the_librarys():
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    lib, own = sentencepiece.SentencePieceProcessor(model_file=path), token_counts.counter(path)
    some = texts(3000)
    for t, changes in zip(some, own.changes(some), strict=True):
        assert len(changes) == len(t) and token_counts.prefix_counts(changes)[-1] == len(lib.encode(t)), t
    for t in ("Anthe of thing. Unlikely,  words\nhere été 12", *some[:40]):
        counts = token_counts.prefix_counts(own.changes([t])[0])
        assert counts.tolist() == [len(lib.encode(t[:k])) for k in range(len(t) + 1)], t


def test_truncation_is_answered_by_stored_tables(spark):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(i, t) for i, t in enumerate(texts(60, 6, 30))] + [(100, None), (101, "")]
    text = {i: t or "" for i, t in rows}
    tables = token_counts.prefix_tables(frame(spark, rows), path)
    assert tables.columns == ["doc_id", "n_bytes", "changes"]  # no text
    for r in token_counts.count_at(tables.selectExpr("*", "doc_id % 17 as chars"), "chars").collect():
        assert r.n_tokens_at == len(lib.encode(text[r.doc_id][: r.chars]))
    for budget in (0, 1, 7):
        for r in token_counts.fit(tables, budget).collect():
            t = text[r.doc_id]
            assert r.fit_chars == max(k for k in range(len(t) + 1) if len(lib.encode(t[:k])) <= budget)


def test_token_counts_of_odd_rows(spark):
    df = frame(spark).selectExpr("*", "7 as n_tokens", "8 as over_limit", "9 as changes")
    got = token_counts.with_token_counts(df, tokenizer_path("piece_bpe_32k.model"), limit=5).collect()
    assert len(got) == len(ODD)
    assert {(r.doc_id, r.n_bytes, r.n_tokens) for r in got} >= {(1, 0, 0), (2, 0, 0)}
    assert all(r.over_limit == (r.n_tokens > 5) for r in got)
    assert token_counts.with_token_counts(df.limit(0), tokenizer_path("piece_bpe_32k.model")).count() == 0


def test_byte_bpe_is_tiktokens():
    import tiktoken
    from public_tokenizers import PATTERN

    c = byte_bpe.codec(tokenizer_path("byte_bpe_50k.tiktoken"), PATTERN)
    lib = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=c.ranks, special_tokens={})
    assert c.bytes_of == [t for t, _ in sorted(c.ranks.items(), key=lambda x: x[1])]  # from the pieces, the rank file's bytes
    for t in texts(3000, 2):
        ids = c.encode_batch([t])[0]
        assert ids == lib.encode_ordinary(t) and c.decode(ids) == t.encode()


def test_byte_bpe_round_trip_of_odd_rows(spark):
    from public_tokenizers import PATTERN

    path = tokenizer_path("byte_bpe_50k.tiktoken")
    ids = byte_bpe.with_ids(frame(spark), path, PATTERN)
    got = [bytes(r.bytes).decode() for r in byte_bpe.decoded(ids, path, PATTERN).collect()]
    assert sorted(got) == sorted(t or "" for _, t in ODD)
    clash = frame(spark).selectExpr("*", "1 as n_tokens", "2 as ids_sha256", "3 as ids")
    assert byte_bpe.digests(clash, path, PATTERN).count() == len(ODD) and byte_bpe.digests(clash.limit(0), path, PATTERN).count() == 0
    d = byte_bpe.digests(frame(spark, [(1, None)]), path, PATTERN).first()
    assert d.n_tokens == 0 and d.ids_sha256 == d.decoded_sha256 == hashlib.sha256(b"").hexdigest()


def test_packing_ids_are_the_librarys():
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    lib, own = Tokenizer.from_file(path), packing.encoder(path)
    for t in texts(3000, 3):
        assert own.encode_batch([t])[0].tolist() == lib.encode(t, add_special_tokens=False).ids, t
    many = [*texts(500, 5, 60), None, "", "x<|endoftext|>. <|ENDOFTEXT|>, é: ×; ÷! İ? _a_ 1-"]
    for t, ids in zip(many, own.encode_batch(many), strict=True):
        assert ids.tolist() == lib.encode(t or "", add_special_tokens=False).ids, t


def test_packing_is_gapless_and_whole(spark):
    rows = [(i, t) for i, t in enumerate(texts(300, 4, 60))] + ODD
    path = tokenizer_path("word_bpe_49k.json")
    got = packing.pack(frame(spark, rows).selectExpr("*", "1 as n", "2 as ids", "3 as part", "4 as length").repartition(5), path, length=64, with_ids=True).collect()
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length > 0
    for k, pieces in by_sequence.items():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == list(np.cumsum([0] + [p.length for p in pieces[:-1]]))
        assert sum(p.length for p in pieces) == 64 or k == max(by_sequence)
    assert sum(r.length for r in got) == sum(r.doc_tokens for r in got if r.start == 0)
    assert packing.pack(frame(spark, []), path).count() == 0


def test_media_digests_are_those_of_the_payload(spark):
    rows = [(i, t) for i, t in enumerate(texts(200, 7, 900))] + ODD + [(6, "RIFF BM P5 P6 GIF89a %PDF-1 " * 40)]
    df = frame(spark, rows).selectExpr("*", "1 as media", "2 as declared", "3 as feature")
    kept, kinds = set(), set()
    for r in media.probe(media.store(df)).collect():
        kept.add((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32))
        declared, _, kind = r.feature.partition(";")[0].partition(">")
        kinds.add((declared, kind))
    want = set()
    for i, t in rows:
        raw = (t or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 or (0 if raw else 576))
        want.add((i, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:])))
    assert kept == want
    assert {k for _, k in kinds} == {"audio/wav", "image/x-portable-anymap", "image/bmp"} and any(d != k for d, k in kinds) and any(d == k for d, k in kinds)
    stored = {bytes(r.media) for r in media.store(df).collect()}
    seen = {(r.media_bytes, r.media_sha256) for r in media.probe(media.store(df)).collect()}
    assert seen == {(len(x), hashlib.sha256(x).hexdigest()) for x in stored}
    assert media.probe(media.store(df.limit(0))).count() == 0


def test_media_round_trip_and_sniffing(spark):
    got = media.carve(media.store(frame(spark))).collect()
    assert {r.media_type for r in got} <= {"audio/wav", "image/x-portable-anymap", "image/bmp"}
    assert sorted(bytes(r.payload).rstrip(b"\xff").decode() for r in got) == sorted(t or "" for _, t in ODD)
    s = media.Sniffer()
    png = b"\x89PNG\r\n\x1a\n"
    for kind, body in ((b"IHDR", b"\0\0\0\1\0\0\0\1\x08\0\0\0\0"), (b"IDAT", zlib.compress(b"\0\0")), (b"IEND", b"")):
        png += len(body).to_bytes(4, "big") + kind + body + zlib.crc32(kind + body).to_bytes(4, "big")
    assert s.kind(png, "text/plain")[0] == "image/png"
    assert s.kind(png[:-3], "text/plain")[0] == "text/plain"  # cut off
    assert s.kind(b"BM GIF89a \xff\xd8\xff RIFF", "text/plain") == ("text/plain", None, [])
    _, whole, inside = s.kind(media.to_wav(media.padded(b"xx" + png + b"yy")), "?")
    assert whole.kind == "audio/wav" and [f.kind for f in inside] == ["image/png"]
    assert media.probe(spark.createDataFrame([(None, None)], "media binary, declared string")).first().payload_bytes == 0


def brute_quality(t):
    w = [x for x in (t or "").encode().split()]
    seen, rep = {}, set()
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i : i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            rep |= {j + k for j in at for k in range(3)}
    lines = [x for x in (t or "").split("\n") if x.encode().split()]
    return len(w), len((t or "").encode().decode()) - sum(c in " \t\n\x0b\x0c\r" for c in t or ""), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(rep)


def test_quality_counts(spark):
    r = random.Random(9)
    rows = [(i, " ".join(r.choice(["the", "of", "x#", "a|b", "Ab.\nAb.", "é"]) for _ in range(r.choice([0, 2, 5, 60])))) for i in range(60)] + ODD
    got = quality.assess(frame(spark, rows).selectExpr("*", "1 as kept", "2 as n_words")).collect()
    assert sorted(((x.doc_id, x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) for x in got), key=str) == sorted(
        ((i, *brute_quality(t)) for i, t in rows), key=str)
    assert quality.keep_good(frame(spark, [])).count() == 0


def test_quality_keeps_good_documents(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.assess(docs).where("n_words >= 50").join(labels, "doc_id").groupBy("quality").agg({"*": "count", "kept": "max"}).collect()
    rows = quality.assess(docs).where("not base_failed").join(labels, "doc_id").select("quality", "kept").collect()
    assert got and all(r.kept for r in rows if r.quality == 1)


def test_grammar_scores_clauses():
    g = toxicity.Grammar()
    plain, aimed, denied, told = (g.total(t) for t in ("an idiot there", "you are an idiot", "he is not an idiot", "he said: an idiot"))
    assert aimed > plain > 0 and denied < aimed and g.total("nobody idiotically here") == 0
    assert g.total("I will kill you") > g.total("they kill time") == 0
    assert told > 0 and g.score(None) == g.score("") < 0.5


def brute_clause(g, words):
    """A clause's score by plain rules, without machines."""
    total, negated, reported, intent = 0.0, 0, False, 99
    for w in words:
        kind, weight = g.symbol(w)
        value = weight if kind == "insult" else 2.0 * weight if kind == "harm" and intent <= 2 else 0.0
        total += value * (0.5 if negated else 1) * (0.6 if reported else 1)
        intent = 1 if kind == "intent" else 99 if kind == "harm" else intent + 1
        negated = 3 if kind == "negation" else max(0, negated - 1)
        reported = not reported if kind == "quote" else reported or kind == "report"
    return min(6.0, total * (1.5 if any(g.symbol(w)[0] == "target" for w in words) else 1.0))


def test_composed_weights_are_the_rules():
    r, g = random.Random(4), toxicity.Grammar(stems={"blork": 0.7})
    words = ["idiot", "blorkish", "will", "kill", "you", "not", "said", '"', "tree", "a"]
    for _ in range(3000):
        clause = [r.choice(words) for _ in range(r.randrange(12))]
        assert g.clause(clause) == pytest.approx(brute_clause(g, clause))
    assert len(g.machine.states) > 20


def test_toxicity_of_odd_tables(spark):
    g = toxicity.Grammar()
    df = frame(spark, [*ODD, (9, "you are an idiot. " * 20_000), (9, "you are an idiot. " * 20_000)]).selectExpr("*", "'s' as score", "1 as held_out", "2 as c0")
    kept = toxicity.keep_clean(df, g)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in ODD)
    assert toxicity.keep_clean(df.limit(0), g).count() == 0
    assert toxicity.report(df.limit(0), spark.createDataFrame([], "doc_id bigint, toxic int")).count() == 0


def test_toxicity_on_held_out_documents(spark, sf):
    big = sf.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.report(docs, labels).where("held_out").join(labels, "doc_id").select("toxic", "predicted").collect()
    wrong = sum(r.toxic != r.predicted for r in got)
    assert len(got) > 30 and wrong <= 2
    none = toxicity.report(frame(spark), labels.limit(0)).collect()
    assert len(none) == len(ODD) and all(0 <= r.score <= 1 for r in none)


@pytest.mark.parametrize("doc", [0, 7])
def test_held_out_is_by_id(spark, doc):
    row = toxicity.report(frame(spark, [(doc, "x")]), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).first()
    assert row.held_out == (zlib.crc32(str(doc).encode()) % 5 == 0)
