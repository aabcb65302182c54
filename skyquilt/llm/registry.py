"""Queries of the training-data operators: name to callable, and name to SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyquilt.llm import chat, licenses, lines, neardup, neighbours, packing, search, tokens, toxicity, warc

PIECES, WORDS = "piece_bpe_32k.model", "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return search.top_k(docs, docs.where("doc_id % 100 = 0"), kind="lang").withColumn("score", F.round("score", 6))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(licenses.as_files(_table(spark, sf_dir, "documents")))
    return found.withColumnRenamed("file_id", "doc_id")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), 3, 85)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_digest(_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_digest(_table(spark, sf_dir, "pages"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_digest(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_nearest, op2_top_k, op3_licenses, op4_near_duplicates, op5_line_dedup, op6_toxicity, op7_sentencepiece, op8_packing, op9_warc, op10_chat_format)
}
ORACLE_SQL = {"op2_top_k": search.ORACLE, "op4_near_duplicates": neardup.ORACLE, "op5_line_dedup": lines.ORACLE, "op9_warc": warc.ORACLE, "op10_chat_format": chat.ORACLE}
