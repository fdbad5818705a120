"""Helper of the token operators: cut texts at provably safe spaces, encode each distinct piece once.

``encode(text)`` of a tokenizer equals the concatenation of ``encode(piece)``
when every cut is a boundary of its pre-tokenisation whatever stands around:

* ``word`` vocabularies drop white space and never match across it, so every
  space or newline is such a cut (and belongs to no piece);
* ``byte`` vocabularies attach one space to the following word. A cut before
  a space between two non-space characters is always a boundary: no
  alternative of the pattern continues over it from the left, and a match that
  starts there depends on the text to its right only. Other spaces (doubled,
  or beside a newline or tab) are not cut.

Special strings hold no space, so they stay inside one piece.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes that are cut and encoded together, and pieces remembered between such blocks.
BLOCK_BYTES = 8 << 20
MEMO_PIECES = 500_000

#: encode(list of pieces) -> (ids of all pieces, number of ids of each)
Encode = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


def safe_pieces(text: str) -> list[str]:
    """``text`` cut before every single space between two non-space characters."""
    out: list[str] = []
    for part in text.split(" "):
        if out and out[-1] and part and not out[-1][-1].isspace() and not part[0].isspace():
            out.append(" " + part)
        elif out:
            out[-1] += " " + part
        else:
            out.append(part)
    return out


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, slice) with about ``most`` bytes of text each, one row at least."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        upto = (sizes[at - 1] if at else 0) + most
        end = max(at + 1, int(np.searchsorted(sizes, upto, side="right")))
        yield at, texts.slice(at, end - at)
        at = end


def text_array(column: pa.Array) -> pa.Array:
    """A text column as non-null ``large_string``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def _letters_and_mark(words: pa.Array, normalised: bool) -> pa.Array:
    """Which words are letters and one final ``.`` or ``,``. ``normalised``: the
    vocabulary composes and lower-cases first, and must still find letters only
    (some letters become a letter and a mark, which joins the punctuation)."""
    found = pc.match_substring_regex(words, r"^\pL+[.,]$")
    if not normalised:
        return found
    found = found.to_numpy(zero_copy_only=False).copy()
    for k in np.flatnonzero(found & ~pc.string_is_ascii(words).to_numpy(zero_copy_only=False)):
        found[k] = unicodedata.normalize("NFC", words[int(k)].as_py()).lower()[:-1].isalpha()
    return pa.array(found)


def _shifted(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices of the runs ``starts[k] .. starts[k] + lens[k] - 1``, back to back."""
    ends = np.cumsum(lens, dtype=np.int32)
    where = np.repeat(starts - (ends - lens), lens)
    where += np.arange(len(where), dtype=np.int32)
    return where


class PieceEncoder:
    """Ids of whole texts; each distinct piece of a block is encoded once, frequent ones are remembered.

    A piece of letters and one final ``.`` or ``,`` is two: letters and
    punctuation are never matched together (letters as the vocabulary sees them:
    see ``_letters_and_mark``). ASCII pieces of vocabularies that
    lower-case (``word``) are looked up in lower case, unless they could hold a
    special string.
    """

    def __init__(self, encode: Encode, byte_level: bool, memo_pieces: int = MEMO_PIECES):
        self.encode, self.byte_level, self.memo_pieces = encode, byte_level, memo_pieces
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.lens = self.starts = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, pieces: list[str]) -> np.ndarray:
        """Places in the memo of ``pieces``; new ones are encoded."""
        place = self.place
        at = np.fromiter(map(place.get, pieces, repeat(-1)), np.int32, len(pieces))
        missing = np.flatnonzero(at < 0).tolist()
        if not missing:
            return at
        new = list(dict.fromkeys(pieces[k] for k in missing))
        if place and len(place) + len(new) > self.memo_pieces:
            self._forget()
            return self._learn(pieces)
        ids, lens = self.encode(new)
        lens = lens.astype(np.int32)
        first = len(place)
        place.update(zip(new, range(first, first + len(new))))
        self.starts = np.concatenate([self.starts, np.int32(len(self.ids)) + np.cumsum(lens, dtype=np.int32) - lens])
        self.ids, self.lens = np.concatenate([self.ids, ids.astype(np.uint32)]), np.concatenate([self.lens, lens])
        at[missing] = [place[pieces[k]] for k in missing]
        return at

    def _cut(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(pieces, number in that list of every piece in order, pieces of each text)."""
        if not self.byte_level:
            texts = pc.replace_substring(texts, "\n", " ")
        parts = pc.split_pattern(texts, " ")
        coded = pc.dictionary_encode(parts.flatten())
        ends = np.asarray(parts.offsets).astype(np.int64)
        ends = ends - ends[0]
        codes = np.array(coded.indices, np.int32)
        words = coded.dictionary
        whole = words
        if not self.byte_level:
            plain = pc.and_(pc.string_is_ascii(words), pc.invert(pc.match_substring(words, "<")))
            words = pc.if_else(plain, pc.ascii_lower(words), words)
        two = _letters_and_mark(words, not self.byte_level)
        comma = pc.ends_with(words, ",").to_numpy(zero_copy_only=False)
        words = pc.if_else(two, pc.utf8_slice_codeunits(words, 0, -1), words)
        two = two.to_numpy(zero_copy_only=False)
        if self.byte_level:
            words = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), words, pa.scalar("", pa.large_string()))
        table = words.to_pylist()
        n = len(table)
        table += [".", ","]
        heads = np.zeros(0, np.int64)
        if self.byte_level:
            # the first piece of a text has no space before it and is kept whole
            heads = ends[:-1]
            head_words, head_code = np.unique(codes[heads], return_inverse=True)
            odd = pc.or_(pc.not_equal(pc.utf8_trim_whitespace(whole), whole), pc.equal(pc.binary_length(whole), 0)).to_numpy(zero_copy_only=False)
            odd_text = np.add.reduceat(odd[codes], heads) > 0 if len(codes) else np.zeros(0, bool)
            first = len(table)
            table += whole.take(pa.array(head_words)).to_pylist()
            codes[heads] = 0
        split = two[codes]
        split[heads] = False
        after = np.cumsum(split, dtype=np.int32)
        counts = np.diff(ends) + np.diff(np.concatenate([[0], after])[ends])
        out = np.repeat(codes, 1 + split)
        tails = np.flatnonzero(split)
        out[tails + after[tails]] = n + comma[codes[tails]]
        if self.byte_level:
            out[heads + after[heads]] = first + head_code
            if odd_text.any():
                # doubled spaces or spaces beside other white space: cut in Python
                cut_at = np.cumsum(counts)[:-1]
                runs = np.split(out, cut_at)
                for row in np.flatnonzero(odd_text):
                    cut = safe_pieces(texts[int(row)].as_py())
                    runs[row] = np.arange(len(table), len(table) + len(cut), dtype=np.int32)
                    table += cut
                    counts[row] = len(cut)
                out = np.concatenate(runs)
        return table, out, counts

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        return np.concatenate([np.zeros(0, np.int64), *(self._sums(*self._places(b)) for _, b in blocks(texts))])

    def __call__(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per block of texts: (ids of all its texts, number of ids of each text)."""
        for _, block in blocks(texts):
            at, counts = self._places(block)
            yield self.ids[_shifted(self.starts[at], self.lens[at])], self._sums(at, counts)
            pa.default_memory_pool().release_unused()

    def _places(self, block: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces, codes, counts = self._cut(block)
        return self._learn(pieces)[codes], counts

    def _sums(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(self.lens[at], dtype=np.int64)])
        ends = np.cumsum(counts)
        return sums[ends] - sums[ends - counts]
