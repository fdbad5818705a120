"""Categorical encoders (E01-E03, E08-E10) as fit/transform pairs.

Fitted state is a lookup DataFrame ``(value, code)`` plus per-field sizes
in rows and bytes. Lookups are joins: tables are broadcast, smallest first,
while their fitted bytes fit one budget for all fields together, the others
are joined by a shuffle on the value.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featlab.functions.hashing import md5_bin
from featlab.operators.ordering import global_rank
from featlab.session import reliable_checkpoint

BROADCAST_BYTES = 64 << 20   # all lookup tables of a transform together


def _broadcast_some(n_bytes: dict[str, int], limit: int = BROADCAST_BYTES) -> set[str]:
    """The fields, smallest table first, whose tables together stay within ``limit``."""
    chosen, used = set(), 0
    for name in sorted(n_bytes, key=lambda k: (n_bytes[k], k)):
        used += n_bytes[name]
        if used > limit:
            break
        chosen.add(name)
    return chosen


# ---- E01: label encoder -----------------------------------------------------------------
@dataclass
class LabelEncoderModel:
    col: str
    classes: DataFrame        # value, code  (sorted value -> 0..n-1)
    size: int
    n_bytes: int = 0

    def _table(self, t: DataFrame) -> DataFrame:
        return F.broadcast(t) if _broadcast_some({self.col: self.n_bytes}) else t

    def transform(self, df: DataFrame, out_col: str | None = None) -> DataFrame:
        out_col = out_col or f"{self.col}_code"
        t = self.classes.select(F.col("value").alias(self.col), F.col("code").alias(out_col))
        return df.join(self._table(t), self.col, "left")

    def inverse_transform(self, df: DataFrame, code_col: str, out_col: str) -> DataFrame:
        t = self.classes.select(F.col("code").alias(code_col), F.col("value").alias(out_col))
        return df.join(self._table(t), code_col, "left")


def fit_label_encoder(df: DataFrame, col: str) -> LabelEncoderModel:
    """Classes sorted ascending, codes 0..n-1; NULL is not a class."""
    vals = df.select(F.col(col).alias("value")).filter(F.col("value").isNotNull()).distinct()
    ranked = global_rank(vals, [F.col("value")], "code")
    fitted = ranked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_row_bytes("value")), F.lit(0)).alias("bytes")).first()
    return LabelEncoderModel(col, ranked.select("value", (F.col("code") - 1).cast("bigint").alias("code")), int(fitted["n"]), int(fitted["bytes"]))


def _row_bytes(value: str) -> Column:
    """Upper estimate of a lookup row in memory: the value and 64 bytes."""
    return F.coalesce(F.octet_length(F.col(value).cast("string")), F.lit(0)) + 64


# ---- E02 / E03: one-hot, dummy and effect coding ----------------------------------------
def one_hot_vector(code: Column, size: int, drop_first: bool = False, effect: bool = False) -> Column:
    """Array form of one-hot (E02), dummy (reference level 0 dropped) and
    effect coding (reference level row is all -1) for a code column."""
    if not (drop_first or effect):
        return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: (i == code).cast("int"))
    levels = F.sequence(F.lit(1), F.lit(size - 1))
    if effect:
        return F.transform(levels, lambda i: F.when(code == 0, -1).otherwise((i == code).cast("int")))
    return F.transform(levels, lambda i: (i == code).cast("int"))


def one_hot_ml(df: DataFrame, code_col: str, out_col: str, drop_last: bool = False):
    """MLlib sparse-vector variant (unseen codes raise, as the usual one-hot
    encoder does)."""
    from pyspark.ml.feature import OneHotEncoder
    enc = OneHotEncoder(inputCols=[code_col], outputCols=[out_col], dropLast=drop_last, handleInvalid="error")
    return enc.fit(df).transform(df)


# ---- E08: libffm lines ------------------------------------------------------------------
def libffm_line(label: str, fields: Sequence[str], numeric: Sequence[str] = (),
                multi_sep: str = "$", nr_bins: int = 1_000_000) -> Column:
    """``label f:bin:1 ... f:1:value``. Field id = position in ``fields``;
    categorical value -> md5 bin of ``"<field>-<value>"``; a cell with
    ``multi_sep`` gives one feature per item; numeric fields keep the value."""
    def feature(i: int, f: str):
        # one-argument lambda (a second one would be bound to the index)
        return lambda it: F.concat(F.lit(f"{i}:"), md5_bin(F.concat(F.lit(f"{f}-"), it), nr_bins).cast("string"),
                                   F.lit(":1"))

    sep = "\\" + multi_sep if multi_sep in ".$|?*+^()[]{}\\" else multi_sep
    parts = []
    for i, f in enumerate(fields):
        v = F.col(f).cast("string")
        if f in numeric:
            parts.append(F.array(F.concat(F.lit(f"{i}:1:"), v)))
        else:
            parts.append(F.transform(F.split(v, sep), feature(i, f)))
    return F.concat_ws(" ", F.col(label).cast("int").cast("string"), F.flatten(F.array(*parts)))


# ---- E09 / E10: FM feature dictionary and parser -------------------------------------------
@dataclass
class FeatureDictionary:
    fields: list[str]            # encoded fields in frame order
    numeric: list[str]
    table: DataFrame             # field, value, idx   (value NULL for numeric fields)
    sizes: dict                  # field -> number of distinct values (1 for numeric)
    offsets: dict                # field -> first idx
    dim: int
    n_bytes: dict                # field -> bytes of its lookup table

    def parse(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Per row ``xi`` (feature indices) and ``xv`` (values: numeric
        value kept, categorical 1.0), fields in dictionary order. One lookup
        join per categorical field (NULL is a value with an index of its own);
        the smaller tables are broadcast within one budget."""
        out = df
        small = _broadcast_some({f: self.n_bytes[f] for f in self.fields if f not in self.numeric})
        xi, xv = [], []
        for f in self.fields:
            if f in self.numeric:
                xi.append(F.lit(self.offsets[f]).cast("bigint"))
                xv.append(F.col(f).cast("double"))
                continue
            t = (self.table.filter(F.col("field") == f)
                 .select(F.col("value").alias(f"_fl_v_{f}"), F.col("idx").alias(f"_fl_i_{f}")))
            out = out.join(F.broadcast(t) if f in small else t,
                           F.col(f).cast("string").eqNullSafe(F.col(f"_fl_v_{f}")), "left")
            xi.append(F.col(f"_fl_i_{f}"))
            xv.append(F.lit(1.0))
        return out.select(*keep, F.array(*xi).alias("xi"), F.array(*xv).alias("xv"))


def fit_feature_dictionary(df: DataFrame, numeric: Sequence[str] = (), ignore: Sequence[str] = (),
                           others: DataFrame | None = None) -> FeatureDictionary:
    """Numeric field -> one index; every other field -> one index per
    distinct value (sorted), indices running over fields in frame order.
    ``others`` (e.g. the test frame) is unioned by name first (U01)."""
    src = df if others is None else df.unionByName(others, allowMissingColumns=True)
    fields = [c for c in df.columns if c not in ignore]
    cats = [c for c in fields if c not in numeric]
    if cats:
        st = [F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in cats]
        vals = src.select(F.explode(F.array(*st)).alias("s")).select("s.*").distinct()
        # the dictionary is written once; sizes and lookups read that copy
        ranked = reliable_checkpoint(global_rank(vals, [F.col("value")], "_fl_r", partition_by=["field"]))
        fitted = ranked.groupBy("field").agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes("value")).alias("bytes")).collect()   # a row per field
        sizes, n_bytes = {r["field"]: int(r["n"]) for r in fitted}, {r["field"]: int(r["bytes"]) for r in fitted}
    else:
        ranked, sizes, n_bytes = None, {}, {}
    sizes = {c: 1 if c in numeric else sizes.get(c, 0) for c in fields}
    # every field starts where the fields before it end
    ends = list(itertools.accumulate((sizes[c] for c in fields), initial=0))
    offsets, dim = dict(zip(fields, ends)), ends[-1]
    off_df = df.sparkSession.createDataFrame([(k, int(v)) for k, v in offsets.items()], "field string, off bigint")
    parts = []
    if ranked is not None:
        parts.append(ranked.join(F.broadcast(off_df), "field")   # one row per field
                     .select("field", "value", (F.col("off") + F.col("_fl_r") - 1).alias("idx")))
    num_rows = [(c, offsets[c]) for c in fields if c in numeric]
    if num_rows:
        parts.append(df.sparkSession.createDataFrame(num_rows, "field string, idx bigint")
                     .select("field", F.lit(None).cast("string").alias("value"), "idx"))
    table = parts[0]
    for p in parts[1:]:
        table = table.unionByName(p)
    return FeatureDictionary(fields, list(numeric), table, sizes, offsets, dim, {c: n_bytes.get(c, 0) for c in fields})
