"""Queries of this package: each applies its operator to the whole given table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (bpe, chat, decontaminate, lines, packing, pii, quality, ranked, secrets, simhash, spelling,
               tokenfile, vafile)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digests(table(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_digests(table(spark, sf_dir, "conversations"))


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.token_offsets(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_vafile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.nearest(table(spark, sf_dir, "embeddings"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_spans(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_decontaminate, op2_secrets, op3_lines, op4_chat, op5_tokens, op6_bpe, op7_quality,
    op8_vafile, op9_simhash, op10_pii, op11_spelling, op12_ranked, op13_packing)}

ORACLE: dict[str, str] = {"op3_lines": lines.ORACLE, "op8_vafile": vafile.ORACLE,
                          "op12_ranked": ranked.ORACLE}
