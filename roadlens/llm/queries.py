"""The registered queries of this subpackage, one per operator, and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from roadlens.llm.collocations import COLLOCATIONS_SQL, collocations
from roadlens.llm.common import read
from roadlens.llm.contamination import CONTAMINATION_SQL, contamination
from roadlens.llm.exact_dedup import exact_dedup
from roadlens.llm.filter_audit import FILTER_AUDIT_SQL, filter_audit
from roadlens.llm.language_id import languages
from roadlens.llm.licenses import document_files, document_licence_sql, licence_scan
from roadlens.llm.mixing import mixed
from roadlens.llm.ngram_lm import lm_scores
from roadlens.llm.quality import quality_scores
from roadlens.llm.sentence_piece import encode_column
from roadlens.llm.simhash import near_dedup
from roadlens.llm.token_count import token_counts
from roadlens.llm.topk_search import top_k


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_sentence_piece(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(vocabulary_path("piece_bpe_32k.model"), "rb") as file:
        return encode_column(read(spark, sf_dir, "documents"), file.read(), ["doc_id"])


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))

#: Target weights of the mix: sources 0 to 19, every fourth at four times the first one's weight.
SOURCE_WEIGHTS = {f"src{i}": 1.0 + i % 4 for i in range(20)}
REST_WEIGHT = 1.0


def vocabulary_path(name: str) -> str:
    """Where a public vocabulary file is; ``ROADLENS_VOCABULARIES`` names another folder."""
    folder = os.environ.get("ROADLENS_VOCABULARIES")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source")
    return mixed(docs, SOURCE_WEIGHTS, REST_WEIGHT)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(vocabulary_path("word_bpe_49k.json"), encoding="utf-8") as file:
        return token_counts(read(spark, sf_dir, "documents"), file.read())


def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(document_files(read(spark, sf_dir, "documents")))


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read(spark, sf_dir, "documents"))


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(read(spark, sf_dir, "documents"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


QUERIES = {q.__name__: q for q in (op1_quality_classifier, op2_sentence_piece, op3_exact_dedup, op4_licence_scan,
                                   op5_topk_search, op6_mixing,
                                   op7_token_counts,
                                   op8_simhash_near_dedup, op9_lm_scores,
                                   op10_language_id, op11_decontamination, op12_filter_audit, op13_collocations)}

ORACLE_SQL = {
    "op11_decontamination": CONTAMINATION_SQL,
    "op12_filter_audit": FILTER_AUDIT_SQL,
    "op13_collocations": COLLOCATIONS_SQL,
    "op3_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents),
        g AS (
            SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
                   first_value(doc_id) OVER (PARTITION BY text_sha256
                                             ORDER BY chars DESC, doc_id ASC NULLS LAST) AS keep_id
            FROM n)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""",
    "op4_licence_scan": document_licence_sql(),
    "op5_topk_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0),
        r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
}
