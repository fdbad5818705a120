"""Opening the public vocabularies on a worker and encoding pieces with their libraries."""

from __future__ import annotations

import json
import os
import re

import numpy as np

from featlab.llm.pieces import PieceEncoder
from featlab.llm.shared import remembered

#: Pieces handed to the library at a time.
BATCH = 512


@remembered(4)
def tokenizer(path: str):
    """The ``tokenizers`` object for a .json file: no truncation, no padding, single-threaded."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


#: Pieces that a normaliser of these kinds leaves as they are, also with a space between them.
_PLAIN = re.compile("[a-z]+").fullmatch
_KEEPS_PLAIN = ("NFC", "NFKC", "Lowercase")


def plain_encode(path: str):
    """``encode`` for lists of a-z pieces, or None: the library without the normaliser (which would
    not change them), on many pieces with a space between them; the end of a word is seen by
    its suffix in the vocabulary. It gives None for a list whose ends do not come out."""
    config = json.loads(tokenizer(path).to_str())
    steps = config["normalizer"] or {"type": "Sequence", "normalizers": []}
    steps = steps["normalizers"] if steps["type"] == "Sequence" else [steps]
    suffix = config["model"].get("end_of_word_suffix")
    if not suffix or not all(n["type"] in _KEEPS_PLAIN or (n["type"], n.get("pattern"), n.get("content")) == ("Replace", {"Regex": r"\s+"}, " ") for n in steps):
        return None
    t = tokenizer.__wrapped__(path)
    t.normalizer = None
    vocabulary = t.get_vocab()
    last = np.zeros(max(vocabulary.values()) + 1, bool)
    last[[i for w, i in vocabulary.items() if w.endswith(suffix)]] = True

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        ids = np.concatenate([np.zeros(0, np.uint32), *[np.asarray(t.encode_batch_fast([" ".join(pieces[k:k + BATCH])], add_special_tokens=False)[0].ids, np.uint32)
                                                        for k in range(0, len(pieces), BATCH)]])
        ends = np.flatnonzero(last[ids])
        return (ids, np.diff(ends, prepend=-1)) if len(ends) == len(pieces) and (not len(ids) or ends[-1] == len(ids) - 1) else None
    return encode if (probe := encode(["a", "the", "zqxjkvb"])) and all(
        probe[0][b - n:b].tolist() == tokenizer(path).encode(w, add_special_tokens=False).ids for w, n, b in zip(["a", "the", "zqxjkvb"], probe[1], np.cumsum(probe[1]))) else None


def library_encode(path: str):
    """``encode`` for PieceEncoder: the library on lists of pieces, without added special tokens.

    With a special string in the vocabulary, many pieces go into one call with
    that string between them: it cuts the text before everything else, so the
    pieces are encoded apart, and its id marks where each ends. Pieces that
    hold the start of such a string go by themselves. a-z pieces are encoded by ``plain_encode``."""
    t = tokenizer(path)
    plain = plain_encode(path)
    special = next((a for a in t.get_added_tokens_decoder().items() if a[1].special and not (a[1].lstrip or a[1].rstrip or a[1].single_word or a[1].normalized)), None)

    def apart(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for k in range(0, len(pieces), BATCH) for e in t.encode_batch_fast(pieces[k:k + BATCH], add_special_tokens=False)]
        return np.asarray([i for f in found for i in f], np.uint32), np.fromiter(map(len, found), np.int64, len(found))

    def marked(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if special is None or any(special[1].content[0] in p for p in pieces):
            return apart(pieces)
        ids, lens = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for k in range(0, len(pieces), BATCH):
            found = np.asarray(t.encode_batch_fast([special[1].content.join(pieces[k:k + BATCH])], add_special_tokens=False)[0].ids, np.uint32)
            mark = found == special[0]
            lens.append(np.diff(np.flatnonzero(mark), prepend=-1, append=len(found)) - 1)
            ids.append(found[~mark])
        return np.concatenate(ids), np.concatenate(lens)

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        is_plain = np.fromiter((_PLAIN(p) is not None for p in pieces), bool, len(pieces)) if plain else np.zeros(len(pieces), bool)
        found = plain([p for p, yes in zip(pieces, is_plain.tolist()) if yes]) if is_plain.any() else None
        if found is None:
            return marked(pieces)
        if is_plain.all():
            return found
        parts = [found, marked([p for p, yes in zip(pieces, is_plain.tolist()) if not yes])]
        lens, starts, before = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64), 0
        for where, (ids, n) in zip((is_plain, ~is_plain), parts):
            lens[where], starts[where] = n, before + np.cumsum(n) - n
            before += len(ids)
        at = np.repeat(starts - (np.cumsum(lens) - lens), lens) + np.arange(before)
        return np.concatenate([ids for ids, _ in parts])[at], lens
    return encode


@remembered(4)
def piece_encoder(path: str, byte_level: bool) -> PieceEncoder:
    return PieceEncoder(library_encode(path), byte_level)
