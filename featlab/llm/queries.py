"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featlab.llm import (bpe, chat_format, collocations, context_tree, exact_dedup, line_crf, mixing, near_text, near_vectors, packing, token_count, token_files,
                         turn_repair)
from featlab.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return wrap


@query("op5_exact_dedup", exact_dedup.ORACLE_SQL)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


@query("op4_chat_format", chat_format.ORACLE_SQL)
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(sample).alias("text"))
    rows = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.digests(chat_format.formatted(rows))


@query("op1_mix_sources", mixing.oracle_sql())
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "lang", "source", "text")
    return mixing.select_prefixes(mixing.items_of(docs), mixing.PRODUCTION)


@query("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    manifest, folder = token_files.write_token_files(
        read_table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_token_files(manifest, folder)


@query("op8_bpe_round_trip")
def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.digests(bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json")))


@query("op3_token_count")
def op3_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return token_count.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=512)


@query("op2_near_vectors", near_vectors.ORACLE_SQL)
def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"), cosine=0.98)


@query("op9_odd_sketch_near_dedup")
def op9_odd_sketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_text.near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op10_line_crf_quality")
def op10_line_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.quality_of(read_table(spark, sf_dir, "documents", "doc_id", "text"), read_table(spark, sf_dir, "labels", "doc_id", "quality"))


@query("op6_context_tree")
def op6_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score_all(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op11_sum_of_squares_packing")
def op11_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.digests(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), window=2048, end_id=1))


@query("op12_son_collocations", collocations.ORACLE_SQL)
def op12_son_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents", "lang", "text"), least=100, longest=5, top=2000)


@query("op13_turn_repair")
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return turn_repair.repair(turn_repair.damaged(rows), present="present")
