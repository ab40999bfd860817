"""The operators of this package as queries over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import align, bestfit, chat, extract, langid, minhash, mixing, packing, quality, resample, rules, secrets, vectors
from tidemark.llm.common import table


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: A conversation whose texts look like the template.
CONTROL = r"\### Assistant: </turn> ok"


def op1_extract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_pages(table(spark, sf_dir, "pages"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op3_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame([(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)], "conv_id bigint, turn bigint, role string, text string")
    return chat.format_conversations(rows.unionByName(control), RANKS)


def op5_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op6_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("first")


def op11_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align_tokens(table(spark, sf_dir, "documents"), BYTES, PIECES, RANKS)


def op12_pack_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack_best_fit(table(spark, sf_dir, "documents"), TOKENIZER)


def op13_resample_to_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_extract_pages, op2_mix_sources, op3_near_vectors, op4_format_chats, op5_pack_sequences,
        op6_quality_score, op7_language_id, op8_secret_scan, op9_quality_rules, op10_minhash_near_dedup,
        op11_align_tokens, op12_pack_best_fit, op13_resample_to_target,
    )
}
ORACLES: dict[str, str] = {
    "op2_mix_sources": mixing.ORACLE,
    "op3_near_vectors": vectors.ORACLE,
    "op10_minhash_near_dedup": minhash.ORACLE,
    "op13_resample_to_target": resample.ORACLE,
}
