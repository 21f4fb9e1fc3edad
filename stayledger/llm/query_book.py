"""The registered queries of the operators for training data: each applies one operator, with the parameters it has in
production, to its whole table. The contract columns come first; more may follow."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import shared_folder
from . import bpe, cells, context_mixing, conversation_repair, language, lexical_search, line_runs, mixing, near_text, posting_lists, run_index, secret_scan, token_files

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_posting_lists(spark: SparkSession, folder: str) -> DataFrame:
    return posting_lists.nearest(read(spark, folder, "embeddings"))


def op2_near_text(spark: SparkSession, folder: str) -> DataFrame:
    return near_text.near_duplicates(read(spark, folder, "documents"))


def op3_run_index(spark: SparkSession, folder: str) -> DataFrame:
    left = run_index.without_repeats(read(spark, folder, "documents"))
    # Cuts may fall inside a character; its bytes are counted and hashed as they are, and shown as U+FFFD.
    return left.withColumn("kept_text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.token_digests(read(spark, folder, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op5_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    return line_runs.line_report(read(spark, folder, "documents"))


def op6_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents"))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return language.identify(docs, language.learn(docs)).select("doc_id", "held_out", "lang_pred", "score", "mean_match")


def op8_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return cells.near_vectors(read(spark, folder, "embeddings"))


def op9_context_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return context_mixing.score(read(spark, folder, "documents"))


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write_token_files(read(spark, folder, "documents"), WORD_TOKENIZER, 1, files)
    return token_files.read_token_files(spark, files).drop("ids")


def op11_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secret_report(read(spark, folder, "documents"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = read(spark, folder, "conversations")
    return conversation_repair.repair_report(conversation_repair.damaged(conversations), conversations)


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.best_documents(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: made for name, made in globals().items() if name.startswith("op") and callable(made)}
