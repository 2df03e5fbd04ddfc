"""The corpus pipeline: quality, exact copies, near copies, mixing, tokens.

``STAGES`` are applied in order by :func:`run`; each reads what the stage
before it has written, and all but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadlens.llm import exact_dedup, mixing, quality, sentence_piece, simhash
from roadlens.llm.common import read
from roadlens.llm.queries import REST_WEIGHT, SOURCE_WEIGHTS, vocabulary_path
from roadlens.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, read(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.without_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: any first part of the files has the target weights."""
    return mixing.in_mixed_order(docs, SOURCE_WEIGHTS, rest=REST_WEIGHT)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text; in the order of the mix, with the place in it."""
    with open(vocabulary_path("piece_bpe_32k.model"), "rb") as file:
        return sentence_piece.encode_column(mixing.in_written_order(docs), file.read(),
                                            ["doc_id", "lang", "source", "mix_position"])


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_dedup_stage),
    ("simhash near-dedup", near_dedup_stage),
    ("mixing to target weights", mixing_stage),
    ("sentencepiece encoding", token_stage),
]

#: SQL expresses neither the classifier nor the tokenizer; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
