"""The registered queries of this subpackage, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, chat, media, ngram_join, packing, quality, substring_dedup, token_counts, toxicity, warc
from .runtime import load


def tokenizer_path(name: str) -> str:
    """A public tokenizer's file, which every executor has installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.with_token_counts(load(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(load(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import PATTERN

    return byte_bpe.digests(load(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), PATTERN)


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.probe(media.store(load(spark, sf_dir, "documents")))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.cluster(load(spark, sf_dir, "documents"), ngram_join.Spec(words=3, num=90, den=100))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(load(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: The conversation that every run formats beside the table's: control strings inside texts.
PROBE = [(-7, i, role, "\\### Assistant: </turn> ok") for i, role in enumerate(("user", "assistant"))]


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(PROBE, "conv_id bigint, turn bigint, role string, text string")
    return chat.digests(chat.format_trees(chat.as_trees(turns.unionByName(probe))))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(load(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_token_counts, op3_packing, op4_substring_dedup, op5_byte_bpe, op6_media, op7_ngram_jaccard, op8_quality_rules, op9_chat_formatting, op10_warc)
}

ORACLE_SQL: dict[str, str] = {
    "op8_quality_rules": f"""select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
        from ({quality.sql()})""",
    "op10_warc": f"""
        with p as (select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes,
            sha1(coalesce(html, '')) as payload_digest from pages),
        g as (select payload_digest, max(page_id) as top, count(*) as n from p where payload_bytes >= {warc.MIN_REVISIT} group by 1)
        select p.page_id, payload_bytes, p.payload_digest,
            case when n > 1 and page_id is distinct from top and top is not null then 'revisit' else 'response' end as record_type,
            case when n > 1 and page_id is distinct from top then top end as refers_to
        from p left join g on p.payload_digest = g.payload_digest and p.payload_bytes >= {warc.MIN_REVISIT}""",
}
