"""Corpus pipeline: five stages over ``documents``, each written and read again.

A stage takes ``(spark, docs, sf_dir)``, works on all rows that its predecessor
kept, and returns the columns of ``documents``; the last returns token counts and
digests of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.llm import bpe, decontaminate, lines, quality, simhash
from lakeledger.llm.common import materialise, table
from lakeledger.llm.registry import vocabulary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, but for one document's; ``n_chars`` follows the text."""
    out = lines.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: 3-word shingles, 2 bits."""
    return simhash.keep_one(docs, 3, 2)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of what is left, as counts and digests."""
    return bpe.encode_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("BPE encoding and decoding", bpe_encoding),
]

#: A tree model and a tokenizer are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = materialise(docs, f"stage{n}")
    return docs
