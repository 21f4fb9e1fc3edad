"""A cleaned, mixed and tokenized corpus from the documents table, stage by stage.

Every stage reads what the one before it wrote. All but the last return the columns of documents; the last gives a row
of token counts and digests for each document of the mix.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stayledger.llm import bpe, language, line_runs, mixing, near_text
from stayledger.llm.query_book import BYTE_RANKS
from stayledger.session import shared_folder

# A text whose longest matches with its best language are this short is written in none of the learned ones: unknown
# letters match with length 1, while prose of a learned language matches over several letters.
LEAST_MATCH = 2.0


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language. Rejected are texts without a letter and texts that fit none of them."""
    return language.in_known_language(docs, language.learn(docs), LEAST_MATCH)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted, and with them documents that held nothing else."""
    return line_runs.without_repeats(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_text.one_of_each(docs)


def mixed_by_source(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a row for each time a document is taken."""
    return mixing.mixed_documents(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the text decoded from them."""
    return bpe.token_digests(docs, BYTE_RANKS, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_duplicates),
    ("source_mix", mixed_by_source),
    ("byte_bpe", tokenized),
]

# Language ID by cross-parsing, MinHash and BPE have no SQL form; tests/llm/test_pipeline.py has the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each result is written to the shared folder and read again."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
