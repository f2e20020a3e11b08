"""The corpus pipeline: quality rules, line deduplication, near-duplicate removal, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir), where docs has the columns of ``documents``,
and returns a DataFrame: the documents that stay, with what stays of their texts (and n_chars of that), the last stage the
packed pieces. Each stage works on everything its predecessor kept.

A document that loses all of its words to line deduplication goes: all it had stands in earlier documents. Documents
without an id are linked with nothing and stay; rows that repeat an id are one document and stay or go together. Null texts
count as empty and go with the quality rules. An empty table passes all stages as an empty table. Texts are whole at any
length. Further columns, whatever their names, come through the first three stages as they are.

What a stage stages on its way is deleted when the next stage begins, since its output has been written by then.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import recorded, release, staged
from stratamart.llm.line_dedup import dedup_lines
from stratamart.llm.ngram_join import ngram_components
from stratamart.llm.packing import pack_documents
from stratamart.llm.quality_rules import quality_filter

ORACLE_SQL = None
"""Packing needs a tokenizer, which SQL cannot express; tests/llm holds each stage against a brute-force version."""

WORD = r"[^ \t-\r]"


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_staged: list[str] = []


def _stage(work: Stage) -> Stage:
    @wraps(work)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _staged)
        with recorded(_staged):
            return work(spark, docs, sf_dir)

    return stage


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*columns)


@_stage
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(quality_filter(docs), docs.columns)


@_stage
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = dedup_lines(docs, counts=("__n_lines", "__n_removed")).where((F.col("__n_removed") == 0) | F.col("text").rlike(WORD))
    return _counted(left, docs.columns)


@_stage
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = ngram_components(docs, words=5, num=80, den=100)
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component"))).select(F.col("doc_id").alias("stays"))
    return docs.join(first, docs["doc_id"].eqNullSafe(first["stays"]), "left_semi")


@_stage
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
