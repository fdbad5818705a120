"""Vocabularies, lookups and dictionary tables.

A vocabulary is a DataFrame ``(term, id)``. Lookups are joins: broadcast
only when the vocabulary size is a fixed, known bound (top-k), otherwise
left to AQE. Sequences are (id, pos, value) long rows; arrays are rebuilt
per text with ``array_sort(collect_list(struct(pos, ...)))`` - a group is
one text, never a whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featlab.functions.arrays import explode_values, posexplode_values
from featlab.operators.text_features import term_counts, top_terms


def build_vocab(df: DataFrame, tokens: Column | str, size: int, reserve_zero: bool = True) -> DataFrame:
    """The ``size`` most frequent terms (ties: term ascending),
    ids from 1 when id 0 is reserved for padding / unknown."""
    return top_terms(term_counts(df, tokens), size, reserve_zero=reserve_zero).select("term", "id", "count")


def token_rows(df: DataFrame, keys: Sequence[str], tokens: Column) -> DataFrame:
    """(keys..., pos, term) rows of a token array, empty arrays dropped."""
    return (df.select(*keys, posexplode_values(tokens).alias("pos", "term"))
            .filter(F.col("term").isNotNull()))


def _sized(v: DataFrame, bound: int | None) -> DataFrame:
    """Broadcast a lookup that really has at most ``bound`` rows (checked by
    reading at most one row more); any other joins as Spark plans it."""
    if bound is None or v.limit(bound + 1).count() > bound:
        return v
    return F.broadcast(v)


def lookup_ids(rows: DataFrame, vocab: DataFrame, keep_unknown: bool = True, unknown_id: int = 0,
               vocab_size_bound: int | None = None) -> DataFrame:
    """J03 (``keep_unknown``: misses -> ``unknown_id``) or J02 (misses
    dropped): term -> id for (…, pos, term) rows."""
    v = _sized(vocab.select("term", "id"), vocab_size_bound)
    j = rows.join(v, "term", "left" if keep_unknown else "inner")
    return j.withColumn("id", F.coalesce(F.col("id"), F.lit(unknown_id)))


def to_sequences(rows: DataFrame, keys: Sequence[str], value: str = "id", out_col: str = "seq") -> DataFrame:
    """Q02: per text, values in position order as an array."""
    return (rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", value))).alias("_fl_s"))
            .select(*keys, F.transform("_fl_s", lambda x: x[value]).alias(out_col)))


def ids_to_tokens(id_rows: DataFrame, vocab: DataFrame, vocab_size_bound: int | None = None) -> DataFrame:
    """(…, pos, id) -> (…, pos, term) through the reverse lookup
    (ids outside the vocabulary are dropped)."""
    return id_rows.join(_sized(vocab.select("id", "term"), vocab_size_bound), "id")


def remove_words(rows: DataFrame, words: DataFrame, col: str = "term") -> DataFrame:
    """Stop-word removal as a left-anti join (positions kept)."""
    return rows.join(words.select(F.col(words.columns[0]).alias(col)).distinct(), col, "left_anti")


def keep_words(rows: DataFrame, col: str = "term", stop_words: DataFrame | None = None, tags: DataFrame | None = None,
               prefix: str = "n", min_len: int = 2, tag_col: str = "tag") -> DataFrame:
    """Rows whose word has at least ``min_len`` characters, is no stop
    word and, with a (word, tag) table, has a tag that starts with ``prefix``
    (words without a tag go). NULL words go; rows are never multiplied."""
    out = rows.filter(F.length(col) >= min_len)
    if stop_words is not None:
        out = remove_words(out, stop_words, col)
    if tags is not None:
        wanted = tags.filter(F.startswith(F.col(tag_col), F.lit(prefix))).select(F.col(tags.columns[0]).alias(col)).distinct()
        out = out.join(wanted, col, "left_semi")
    return out


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, value) distinct values of many columns in one pass."""
    st = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols]
    return df.select(F.explode(F.array(*st)).alias("s")).select("s.*").distinct()


def value_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """U04 (value form): distinct key tuples of ``left`` absent from ``right``."""
    return left.select(*keys).distinct().join(right.select(*keys), list(keys), "left_anti")


def edit_dictionary(dictionary: DataFrame, add: DataFrame | None = None, delete: DataFrame | None = None,
                    col: str = "word") -> DataFrame:
    """load/add words (union) and delete words (left-anti)."""
    out = dictionary
    if add is not None:
        out = out.unionByName(add, allowMissingColumns=True)
    out = out.dropDuplicates([col])
    if delete is not None:
        out = out.join(delete.select(col), col, "left_anti")
    return out


def word_rows(df: DataFrame, tokens: Column, col: str = "word") -> DataFrame:
    """Words of a token array as rows (for dictionary building)."""
    return df.select(explode_values(tokens).alias(col)).filter(F.col(col).isNotNull())
