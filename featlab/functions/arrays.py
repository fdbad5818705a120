"""Array, set, index and vector functions (C01-C11) as ``Column -> Column``.

Vectors are ``array<double>``; the math is done by higher-order functions
(``aggregate``, ``zip_with``, ``transform``) inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- C01 / C02 ---------------------------------------------------------------
def slice0(a, begin: int, size: int) -> Column:
    """0-based slice like a tensor slice."""
    return F.slice(_c(a), begin + 1, size)


def split_even(a, parts: int) -> Column:
    """Split an array into ``parts`` equal chunks (array of arrays)."""
    arr = _c(a)
    n = F.size(arr) / parts
    return F.transform(F.sequence(F.lit(0), F.lit(parts - 1)),
                       lambda i: F.slice(arr, (i * n + 1).cast("int"), n.cast("int")))


def gather(a, indices) -> Column:
    """Elements at 0-based ``indices`` (NULL where out of range)."""
    arr = _c(a)
    return F.transform(_c(indices), lambda i: F.try_element_at(arr, i + 1))


def reshape(a, cols: int) -> Column:
    """Cut a flat array into rows of ``cols`` values (``F.flatten`` first
    for nested input)."""
    flat = _c(a)
    n = F.size(flat)
    return F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(n / cols).cast("int") - 1, F.lit(0))),
                       lambda i: F.slice(flat, i * cols + 1, cols))


def expand_dims(a) -> Column:
    return F.array(_c(a))


# ---- C03 -------------------------------------------------------------------
def one_hot_indices(indices, depth: int, on=1.0, off=0.0) -> Column:
    """Each index becomes a one-hot row: array<array<double>>."""
    return F.transform(_c(indices), lambda k: F.transform(
        F.sequence(F.lit(0), F.lit(depth - 1)),
        lambda i: F.when(i == k, F.lit(on)).otherwise(F.lit(off))))


# ---- C06 / C07 / C08 ---------------------------------------------------------
def argmax(a) -> Column:
    """0-based position of the first maximum."""
    arr = _c(a)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def argmin(a) -> Column:
    arr = _c(a)
    return (F.array_position(arr, F.array_min(arr)) - 1).cast("int")


def invert_permutation(a) -> Column:
    """y[x[i]] = i for a permutation of 0..n-1."""
    pairs = F.transform(_c(a), lambda v, i: F.struct(v.cast("int").alias("v"), i.alias("i")))
    return F.transform(F.array_sort(pairs), lambda p: p["i"])


def edit_distance(a, b, normalize: bool = False) -> Column:
    d = F.levenshtein(_c(a), _c(b))
    return F.try_divide(d.cast("double"), F.length(_c(b))) if normalize else d


# ---- C09 -------------------------------------------------------------------
def pad_sequence(a, maxlen: int, value=0, padding: str = "pre", truncating: str = "pre") -> Column:
    """Fixed length: pad with ``value`` and cut, each at the front ("pre")
    or the back ("post"), like the common sequence-padding helper."""
    arr = _c(a)
    n = F.size(arr)
    if truncating == "pre":
        cut = F.slice(arr, F.greatest(n - maxlen, F.lit(0)) + 1, maxlen)
    else:
        cut = F.slice(arr, 1, maxlen)
    pad = F.array_repeat(F.lit(value), F.greatest(F.lit(maxlen) - F.size(cut), F.lit(0)))
    return F.concat(pad, cut) if padding == "pre" else F.concat(cut, pad)


# ---- C10 / C11 ---------------------------------------------------------------
def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def l2_norm(a) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0), lambda s, x: s + x * x))


def l2_normalize(a) -> Column:
    arr = _c(a)
    n = l2_norm(arr)
    return F.when(n > 0, F.transform(arr, lambda x: x / n)).otherwise(arr)


def mean_of_normalized(a, b) -> Column:
    """Unit-length mean of two vectors after each is L2-normalised."""
    return l2_normalize(F.zip_with(l2_normalize(a), l2_normalize(b), lambda x, y: (x + y) / 2))


def cosine(a, b) -> Column:
    """Cosine similarity; 0 when either norm is 0."""
    na, nb = l2_norm(a), l2_norm(b)
    return F.when((na * nb) != 0, dot(a, b) / (na * nb)).otherwise(F.lit(0.0))


def to_double_array(a) -> Column:
    return F.transform(_c(a), lambda x: x.cast("double"))


def explode_values(a) -> Column:
    """``explode`` for computed arrays. Plain ``explode`` lets the optimizer
    infer a ``size(array) > 0`` filter and push it below the projection,
    which re-evaluates the whole array expression (tokenizer, n-gram
    lambdas) a second time; ``explode_outer`` is exempt. Drop the NULL row it
    emits for empty arrays with ``.filter(col.isNotNull())``."""
    return F.explode_outer(_c(a))


def posexplode_values(a) -> Column:
    """``posexplode`` counterpart of :func:`explode_values`."""
    return F.posexplode_outer(_c(a))
