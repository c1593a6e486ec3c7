"""From raw documents to packed training sequences, stage by stage.

Each stage takes and returns a table; all but the last keep the columns of ``documents``. Quality rules and toxicity
drop documents, the n-gram join keeps one document of each group of near duplicates (shingles of five words, a
similarity of 0.8), substring dedup replaces texts by what is left of them (``n_chars`` follows), and packing cuts the
rest into sequences. Nulls, empty tables and repeated rows are handled as the operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import ngram_join, packing, quality, substring_dedup, toxicity
from corpusloom.llm.queries import tokenizer_path
from corpusloom.llm.runtime import Scratch, load, prepare, release


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.keep_good(docs)


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity.train(docs, load(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return ngram_join.keep_one(docs, ngram_join.Spec(words=5, num=80, den=100))


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return substring_dedup.without_repeats(docs, chars_col="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("toxicity", toxic_documents),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", repeated_substrings),
    ("packing", packed),
]

#: Tokenization and the learned grammar have no SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is a table in the shared folder until the next is written."""
    docs = load(spark, sf_dir, "documents")
    with Scratch(spark) as tmp:
        for name, stage in STAGES[:-1]:
            before, docs = docs, tmp.write(stage(spark, docs, sf_dir))
            if name != STAGES[0][0]:
                tmp.drop(before)
            release(spark)
        return STAGES[-1][1](spark, docs, sf_dir)  # what packing returns reads its own table alone
