"""The registered queries of this package and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import line_dedup, mixing, url_filter
from ledgerline.llm.alignment import alignment_summary
from ledgerline.llm.fingerprint import fingerprints
from ledgerline.llm.line_dedup import repeated_lines
from ledgerline.llm.mixing import mix_sources
from ledgerline.llm.near_dedup import near_duplicates
from ledgerline.llm.packing import pack_documents
from ledgerline.llm.pii import pii_summary
from ledgerline.llm.quality import quality_scores
from ledgerline.llm.spelling import spelling_variants
from ledgerline.llm.substring import repeated_passages
from ledgerline.llm.tables import table
from ledgerline.llm.topk import exact_top_k
from ledgerline.llm.url_filter import PAGES_VOCABULARY, url_verdicts
from ledgerline.llm.zip_warc import archive_round_trip

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


def op2_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"), vocabulary=PAGES_VOCABULARY)


def op3_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op4_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, threshold=(85, 100))


def op6_fair_queueing_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).figures()


def op7_deletion_neighbourhood_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_lines(table(spark, sf_dir, "documents"))


def op8_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages"))


def op9_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_summary(table(spark, sf_dir, "documents"))


def op10_branch_and_bound_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"))


def op11_relative_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op12_variable_gram_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), drop_every=97)


def op13_shared_cut_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_summary(table(spark, sf_dir, "documents"), TOKENIZER, PIECE_MODEL)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sum_of_squares_packing,
        op2_url_vocabulary,
        op3_multiset_fingerprints,
        op4_compression_classifier,
        op5_minmax_near_dedup,
        op6_fair_queueing_mix,
        op7_deletion_neighbourhood_lines,
        op8_zip_warc,
        op9_pii_spans,
        op10_branch_and_bound_top_k,
        op11_relative_lempel_ziv,
        op12_variable_gram_spelling,
        op13_shared_cut_alignment,
    )
}

ORACLES: dict[str, str] = {
    "op2_url_vocabulary": url_filter.ORACLE,
    "op6_fair_queueing_mix": mixing.ORACLE,
    "op7_deletion_neighbourhood_lines": line_dedup.ORACLE,
    # Whole vectors against whole vectors, without the bounds.
    "op10_branch_and_bound_top_k": """
WITH v AS (
  SELECT DISTINCT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(coalesce(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank,
    vec_id, score
  FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
""",
}
