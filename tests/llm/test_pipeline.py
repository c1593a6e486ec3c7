"""The pipeline's stages against brute force on the smallest tables."""

import corpus_pipeline
import numpy as np
from corpusloom.llm import ngram_join, quality, toxicity

from .test_corpus_operators import brute_components, brute_removal


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = {name: None for name, _ in corpus_pipeline.STAGES}
    seen = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen, sf)
        if name != "packing":
            assert out.columns == docs.columns
        rows[name] = (seen.collect(), out.collect())
        seen = spark.createDataFrame(rows[name][1], out.schema)
    before, after = rows["quality_rules"]
    verdict = {r.doc_id: r.kept for r in quality.assess(docs).collect()}
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if verdict[r.doc_id])
    before, after = rows["toxicity"]
    grammar = toxicity.train(spark.createDataFrame(before, docs.schema), labels)
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if grammar.score(r.text) < 0.5)
    before, after = rows["near_duplicates"]
    heads = {c for _, _, c in brute_components([(r.doc_id, r.text) for r in before], ngram_join.Spec(5, 80, 100))}
    assert sorted(r.doc_id for r in after) == sorted(heads)
    before, after = rows["substring_dedup"]
    removed = {i: n for i, _, n, _ in brute_removal([(r.doc_id, r.text) for r in before], 35)}
    words = {r.doc_id: len(r.text.encode().split()) for r in before}
    assert {r.doc_id: len(r.text.encode().split()) for r in after} == {i: words[i] - removed[i] for i in words}
    assert all(r.n_chars == len(r.text) for r in after)
    before, after = rows["packing"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    assert sum(r.length for r in after) == max(r.sequence_id * 4096 + r.offset + r.length for r in after)
    assert all(np.diff(sorted(r.offset for r in after if r.sequence_id == s)).min(initial=1) > 0 for s in {r.sequence_id for r in after})


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0
