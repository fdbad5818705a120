"""Context windows and skip-gram pairs straight from token arrays.

A document's array is cut into chunks of ``CHUNK`` tokens with the neighbours a
window needs on both sides, so every window is local to its row: no shuffle, no
ranking, and a very long document is many rows. Documents without tokens give
no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featlab.functions.arrays import explode_values

#: Tokens of a chunk.
CHUNK = 2000


def _chunks(df: DataFrame, keep: Sequence[str], tokens: str, around: int, chunk: int) -> DataFrame:
    """``keep, _fl_at`` (tokens before the chunk), ``_fl_size`` (of the document), ``_fl_first`` (tokens
    before the part), ``_fl_part`` (the chunk's tokens with up to ``around`` on both sides)."""
    n = F.size(tokens)
    chunks = F.when(n > 0, F.sequence(F.lit(0), F.expr(f"cast((size(`{tokens}`) - 1) div {chunk} as int)")))
    cut = df.select(*keep, F.col(tokens).alias("_fl_tokens"), n.alias("_fl_size"), explode_values(chunks).alias("_fl_chunk")).filter(F.col("_fl_chunk").isNotNull())
    at = F.col("_fl_chunk") * chunk
    first = F.greatest(at - around, F.lit(0))
    return cut.select(*keep, at.alias("_fl_at"), "_fl_size", first.alias("_fl_first"),
                      F.slice("_fl_tokens", first + 1, F.least(at + chunk + around, F.col("_fl_size")) - first).alias("_fl_part"))


def _places(chunk: int) -> Column:
    """Positions (from 0, in the document) of the chunk's own tokens."""
    return F.sequence(F.col("_fl_at"), F.least(F.col("_fl_at") + chunk, F.col("_fl_size")) - 1)


def _token(place: Column) -> Column:
    return F.get(F.col("_fl_part"), place - F.col("_fl_first"))


def windows(df: DataFrame, keep: Sequence[str], tokens: str, h: int, chunk: int = CHUNK) -> DataFrame:
    """``keep, pos`` (from 1), ``token`` and its ``h`` neighbours on either side,
    ``ctx_m1 ... ctx_p1 ...``, NULL past the ends."""
    def neighbour(p: Column, offset: int) -> Column:
        inside = (p + offset >= 0) & (p + offset < F.col("_fl_size"))
        return F.when(inside, _token(p + offset))
    names = [(f"ctx_{'m' if o < 0 else 'p'}{abs(o)}", o) for k in range(1, h + 1) for o in (-k, k)]
    rows = F.transform(_places(chunk), lambda p: F.struct((p + 1).alias("pos"), _token(p).alias("token"), *[neighbour(p, o).alias(n) for n, o in names]))
    return _chunks(df, keep, tokens, h, chunk).select(*keep, F.explode(rows).alias("_fl_row")).select(*keep, "_fl_row.*")


def skipgrams(df: DataFrame, keep: Sequence[str], tokens: str, window: int, num_skips: int | None = None,
              seed: int = 42, id_col: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """``keep, c_pos`` (from 1), ``offset, centre, context``. With ``num_skips`` each centre has that many
    of its neighbours, drawn without replacement: those with the least md5 of ``"seed:id:c_pos:offset"``
    (``id``: the column ``id_col``, the first of ``keep`` if not given)."""
    doc = F.coalesce(F.col(id_col or keep[0]).cast("string"), F.lit(""))
    offsets = [o for o in range(-window, window + 1) if o]
    # the part with ``window`` places on both sides, so that the neighbours at one offset are one slice; slices are
    # zipped and exploded, which leaves hashing and choosing to compiled row expressions
    places, size = _places(chunk), F.col("_fl_size")
    none = lambda n: F.array_repeat(F.lit(None).cast("string"), F.greatest(n.cast("int"), F.lit(0)))
    own = F.least(F.col("_fl_at") + chunk, size) - F.col("_fl_at")
    before = window - (F.col("_fl_at") - F.col("_fl_first"))
    after = own + 2 * window - before - F.size("_fl_part")
    cut = _chunks(df, keep, tokens, window, chunk).select(
        *keep, doc.alias("_fl_doc"), "_fl_size", places.alias("_fl_places"), own.cast("int").alias("_fl_own"),
        F.concat(none(before), "_fl_part", none(after)).alias("_fl_part"))
    shifted = [F.slice("_fl_part", window + o + 1, F.col("_fl_own")).alias(f"t{window + o}") for o in [0, *offsets]]
    rows = cut.select(*keep, "_fl_doc", "_fl_size", F.explode_outer(F.arrays_zip(F.col("_fl_places").alias("p"), *shifted)).alias("_fl_z")) \
        .filter(F.col("_fl_z").isNotNull()).select(*keep, "_fl_doc", "_fl_size", "_fl_z.*")
    inside = lambda o: (F.col("p") + o >= 0) & (F.col("p") + o < F.col("_fl_size"))
    drawn = num_skips is not None and num_skips < 2 * window

    def neighbour(o: int) -> Column:
        h = F.md5(F.concat_ws(":", F.lit(str(seed)), "_fl_doc", (F.col("p") + 1).cast("string"), F.lit(str(o)))) if drawn else F.lit("")
        # "~" sorts after every digest
        return F.struct(F.when(inside(o), h).otherwise(F.lit("~")).alias("h"), F.lit(o).alias("o"), F.col(f"t{window + o}").alias("context"))
    found = F.sort_array(F.array(*[neighbour(o) for o in offsets]))
    known = sum((F.when(inside(o), 1).otherwise(0) for o in offsets), F.lit(0))
    chosen = F.slice(found, F.lit(1), F.least(F.lit(num_skips), known) if drawn else known)
    return rows.select(*keep, (F.col("p") + 1).alias("c_pos"), F.col(f"t{window}").alias("centre"), explode_values(chosen).alias("_fl_row")) \
        .filter(F.col("_fl_row").isNotNull()).select(*keep, "c_pos", F.col("_fl_row.o").alias("offset"), "centre", F.col("_fl_row.context").alias("context"))
