"""Text normalisation and tokenisation (X01-X07, X10, P10, P11) as columns.

Everything except accent stripping is a native regex expression. Spark SQL
has no Unicode NFD, so ``strip_accents`` is an Arrow-batched pandas UDF
(C-implemented ``unicodedata`` per value, no per-row JVM round trip).
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values ------------------------------------------------------------
# Code-point ranges of the CJK ideograph blocks that get blanks around them
# (CJK Unified Ideographs and extensions A-E, compatibility ideographs and
# their supplement), as in the usual BERT-style basic tokenizer.
CJK_RANGES = (
    (0x4E00, 0x9FFF), (0x3400, 0x4DBF), (0x20000, 0x2A6DF), (0x2A700, 0x2B73F),
    (0x2B740, 0x2B81F), (0x2B820, 0x2CEAF), (0xF900, 0xFAFF), (0x2F800, 0x2FA1F),
)
# ASCII characters treated as punctuation: every non-alphanumeric printable
# character (33-47, 58-64, 91-96, 123-126) plus Unicode category P*.
PUNCT_CLASS = r"[\p{P}!-/:-@\[-`{-~]"
WORD_CLASS = r"[\p{L}\p{N}_]+"
# -------------------------------------------------------------------------------

CJK_CLASS = "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in CJK_RANGES) + "]"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_text(x) -> Column:
    """Whitespace (tab, newline, CR, Zs) -> blank, then drop NUL,
    U+FFFD and every other control/format character (category C)."""
    spaced = F.regexp_replace(_c(x), r"[\t\n\r\p{Zs}]", " ")
    return F.regexp_replace(spaced, r"[\x{0}\x{FFFD}\p{C}]", "")


def space_cjk(x) -> Column:
    """Blank around each CJK ideograph so it becomes its own token."""
    return F.regexp_replace(_c(x), f"({CJK_CLASS})", " $1 ")


def split_punct(x) -> Column:
    """Blank around every punctuation mark (split happens in X06)."""
    return F.regexp_replace(_c(x), f"({PUNCT_CLASS})", " $1 ")


def whitespace_tokens(x) -> Column:
    """Split on runs of white space; empty text gives []."""
    return F.filter(F.split(F.trim(_c(x)), r"[\s\p{Z}]+"), lambda t: t != F.lit(""))


def word_tokens(x, lowercase: bool = True) -> Column:
    """Runs of letters, digits and underscore (single chars kept)."""
    c = F.lower(_c(x)) if lowercase else _c(x)
    return F.regexp_extract_all(c, F.lit(WORD_CLASS), 0)


def _strip_accents_py(s: str) -> str:
    return "".join(ch for ch in unicodedata.normalize("NFD", s) if unicodedata.category(ch) != "Mn")


@F.pandas_udf(T.StringType())
def strip_accents(s: pd.Series) -> pd.Series:
    """X03 helper: NFD then drop non-spacing marks (Arrow batches)."""
    return s.map(lambda v: None if v is None else _strip_accents_py(v))


def basic_tokens(x, lower: bool = True, cjk: bool = True) -> Column:
    """Clean -> CJK blanks -> lower + strip accents -> punctuation
    split -> whitespace tokens. Lower-casing and accent stripping per token
    equal doing them on the whole text, so the text is processed once."""
    t = clean_text(x)
    if cjk:
        t = space_cjk(t)
    if lower:
        t = strip_accents(F.lower(t))
    return whitespace_tokens(split_punct(t))


def to_unicode(x) -> Column:
    """Bytes -> text, dropping undecodable bytes; strings pass."""
    return F.replace(F.make_valid_utf8(_c(x).cast("string")), F.lit("�"), F.lit(""))


# ---- P10 / P11 ------------------------------------------------------------------
def has_numbers(x) -> Column:
    return _c(x).rlike(r"\p{Nd}")


def is_symbol(x) -> Column:
    """First character is not a word character."""
    return _c(x).rlike(r"^[^\p{L}\p{N}_]")


def keep_token(x) -> Column:
    """P10 ``check`` without the stop list: no digit, no leading symbol."""
    return ~has_numbers(x) & ~is_symbol(x)


def drop_short(tokens, min_len: int = 2) -> Column:
    """Keep tokens of at least ``min_len`` characters."""
    return F.filter(_c(tokens), lambda t: F.length(t) >= min_len)


def drop_words(tokens, words) -> Column:
    """Remove a small, fixed word list from a token array (the list is a
    literal, so it is bounded by the caller; large lists use an anti-join)."""
    lit = F.array(*[F.lit(w) for w in sorted(set(words))])
    return F.filter(_c(tokens), lambda t: ~F.array_contains(lit, t))


def ngrams(tokens, n_min: int = 1, n_max: int = 3) -> Column:
    """Word n-grams joined by one blank, all n in [n_min, n_max], in the
    order (n, position)."""
    arr = _c(tokens)

    def gram(n: int):
        # one-argument lambda: a second parameter would be read as the index
        return lambda i: F.array_join(F.slice(arr, i + 1, n), " ")

    parts = [F.transform(F.sequence(F.lit(0), F.size(arr) - n), gram(n))
             for n in range(n_min, n_max + 1)]
    # sequence(0, -1) counts down; guard short arrays
    parts = [F.when(F.size(arr) >= n, p).otherwise(F.array().cast("array<string>"))
             for n, p in zip(range(n_min, n_max + 1), parts)]
    return F.concat(*parts) if len(parts) > 1 else parts[0]
