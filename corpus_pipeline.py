"""The training-data pipeline: quality, exact dedup, near-dedup, mixing, BPE.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's rows to the shared folder and reads them back as the next stage's
documents, so a lost executor never costs more than one stage. All stages but
the last return the columns of their input. There is no SQL for the classifier
and the tokenizer, hence no oracle; tests/llm compares ``run`` with brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from featlab.llm import bpe, exact_dedup, line_crf, mixing, near_text
from featlab.llm.shared import written
from featlab.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier rejects go."""
    return line_crf.keep_good(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest id stays."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return near_text.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents inside their source's share of the token budget stay."""
    return mixing.drop_unmixed(docs, mixing.ONCE)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids`` (little-endian 32-bit) and digests of ids and decoded text."""
    return bpe.digests(bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json")), "ids")


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("tokens", tokens)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
