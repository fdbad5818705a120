"""Operator 5, exact dedup: group by a 128-bit content hash, compare bytes inside groups.

Plan (DataFrame functions only)
    1. one scan hashes every normalised text; the (id, hash) rows are written
       to the shared folder, so texts are not moved at all;
    2. ``groupBy(hash)`` with map-side partial aggregation gives group size and
       smallest id: a hot text becomes one partial row per task;
    3. the bytes are compared only where a hash occurs more than once:
       ``groupBy(hash, text)`` compares whole keys and again combines map-side,
       so thousands of copies travel as one row per task. A hash that turns out
       to hold several texts (a collision) is regrouped by its text;
    4. only groups of several rows are joined back, broadcast if they are few
       (counted), else by a shuffle join that splits hot hashes.

Defined results: NULL text counts as empty; rows of equal (id, text) share one
decision except that only one of them is kept; a NULL id sorts after all
others; an empty table gives an empty result. Columns other than the id and
text are never touched, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featlab.llm.shared import SPACE, one_of_each, sized, text_or_empty, without, written


def normalised(text: Column) -> Column:
    """Runs of ASCII white space as one space."""
    return F.regexp_replace(text, SPACE, " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 content_hash: Callable[[Column], Column] = lambda t: F.unhex(F.md5(t))) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``content_hash`` maps the normalised text to its group hash (128-bit md5);
    a weaker one only makes more collisions for the byte comparison to undo.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), normalised(text_or_empty(text_col)).alias("norm"))
    base = base.withColumn("h", content_hash(F.col("norm")))
    ids = written(base.select("doc_id", "h", F.sha2("norm", 256).alias("text_sha256"),
                              F.monotonically_increasing_id().alias("rid")), "dedup-hashes")
    # NULL ids last, then the smallest id, then one row among equals
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "rid"))
    groups = written(ids.groupBy("h").agg(F.count("*").alias("group_size"), first.alias("first")).filter("group_size > 1"), "dedup-groups")
    repeated = groups.select("h")
    texts = base.join(sized(repeated), "h", "left_semi").groupBy("h", "norm").agg(F.count("*").alias("n"))
    collided = written(texts.groupBy("h").agg(F.count("*").alias("texts")).filter("texts > 1").select("h"), "dedup-collided")

    def result(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
        """Rows with their group; a row without one is alone."""
        grouped = F.col("first").isNotNull()
        return rows.join(groups, keys, "left").select(
            "doc_id", F.when(grouped, F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).alias("group_size"),
            F.coalesce(F.col("rid") == F.col("first.rid"), F.lit(True)).alias("kept"), "text_sha256")

    if collided.isEmpty():
        return result(ids, sized(groups), ["h"])
    # several texts under one hash: those hashes are grouped by the text itself
    apart = ids.join(sized(collided), "h", "left_anti")
    clash = written(base.join(sized(collided), "h", "left_semi")
                    .select("doc_id", "norm", F.sha2("norm", 256).alias("text_sha256"),
                            F.monotonically_increasing_id().alias("rid")), "dedup-clash")
    by_text = clash.groupBy("norm").agg(F.count("*").alias("group_size"), first.alias("first"))
    return result(apart, sized(groups), ["h"]).unionByName(result(clash, by_text, ["norm"]))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text an earlier id already holds; other
    rows of the same id, with other texts, stay."""
    dropped = exact_groups(docs, id_col, text_col).filter("doc_id <> keep_id").select("doc_id", "text_sha256")
    return without(docs, id_col, dropped, "dedup-dropped", F.sha2(normalised(text_or_empty(text_col)), 256))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` does not keep: one row of each
    text stays, also where rows repeat with the same id (or without one)."""
    text_hash = F.sha2(normalised(text_or_empty(text_col)), 256)
    extra = written(exact_groups(docs, id_col, text_col).filter("not kept").select("doc_id", "keep_id", "text_sha256").distinct(), "dedup-extra")
    same_id = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    rest = without(docs, id_col, extra.filter(~same_id).select("doc_id", "text_sha256"), "dedup-dropped", text_hash)
    return one_of_each(rest, id_col, extra.filter(same_id).select("doc_id", "text_sha256"), text_hash, "dedup-repeated")


ORACLE_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM n
"""
