"""A training corpus from raw documents: each stage reads what the one before it wrote.

Every stage takes nulls in any column, empty and very long texts, repeated rows, empty
tables and further columns of any name; all but the last return the columns they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm.line_dedup import deduplicate_lines
from ledgerline.llm.mixing import mix_sources
from ledgerline.llm.near_dedup import keep_one
from ledgerline.llm.packing import pack_documents
from ledgerline.llm.quality import keep_good
from ledgerline.llm.queries import TOKENIZER
from ledgerline.llm.tables import prepare, table
from ledgerline.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go.

    Each row is judged by its own text: a null or empty one is scored too, repeated rows
    go or stay together, ties at the threshold stay.
    """
    return keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that occurred before go, and documents of which nothing is left.

    The first in the order of doc_id and line stays.  Rows without a doc_id or text stay
    as they are, and equal rows are one document.
    """
    return deduplicate_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words, 0.8 or more.

    It is the one with the smallest doc_id.  Of equal rows, with or without a doc_id, one
    stays; rows without words are in no group and all stay.
    """
    prepare(spark)
    return keep_one(docs, words=5, threshold=(80, 100))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them.

    A null source is a source, a null or empty text has no words and is taken with the
    others; equal rows are taken equally often.
    """
    return mix_sources(docs).documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 1024: the last stage, with columns of its own.

    A null or empty text is its end token; a repeated row is packed each time.
    """
    prepare(spark)
    return pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near dedup", near_duplicates),
    ("source mix", mix),
    ("packing", pack),
]

# Compression, min-max hashing and tokenisation have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
