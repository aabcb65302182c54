"""The corpus pipeline: toxic documents go, repeated lines go, one document of each near-duplicate group stays,
and what is left is packed. Each stage's rows are written as Parquet and are the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skyquilt.llm.lines import dedup_lines
from skyquilt.llm.neardup import drop_near_duplicates
from skyquilt.llm.packing import pack_documents
from skyquilt.llm.registry import WORDS
from skyquilt.llm.toxicity import drop_toxic
from skyquilt.plans.scratch import Scratch


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; a document of which nothing but blank lines is left goes with them."""
    return dedup_lines(docs, drop_emptied=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, a similarity of 0.8. Rows without a doc_id, and rows that repeat a kept one, stay."""
    return drop_near_duplicates(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path(WORDS))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("packing", packing)]
#: Linear models, connected components and subset sums aren't said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark)
    for _, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
