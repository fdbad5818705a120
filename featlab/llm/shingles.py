"""Helper: sets of word shingles of a block of texts, as sorted arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from featlab.llm.pieces import blocks

BLOCK_BYTES = 4 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (shift, multiply, shift)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text (large_string, non-null) the distinct hashes of its
    ``width``-word shingles, ascending. A-Z are lower-cased, words are runs of
    anything but ASCII white space; fewer words than ``width`` make one
    shingle, no words none."""
    place = mixed(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    for _, block in blocks(texts, BLOCK_BYTES):
        parts = pc.ascii_split_whitespace(pc.ascii_lower(block))
        coded = pc.dictionary_encode(parts.flatten())
        words = coded.dictionary.to_pylist()
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
        codes = np.asarray(coded.indices, np.int64)
        real = np.fromiter(map(bool, words), bool, len(words))[codes] if len(codes) else np.zeros(0, bool)
        ends = np.asarray(parts.offsets).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(real)])[ends - ends[0]]
        h = hashes[codes[real]]
        n = max(0, len(h) - width + 1)
        full = np.zeros(n, np.uint64)
        for j in range(width):
            full += h[j:j + n] * place[j]
        full = mixed(full)
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
            if b - a >= width:
                yield np.unique(full[a:b - width + 1])
            elif b > a:
                # a scramble of its own, so that it meets other short texts only
                yield mixed((h[a:b] * place[:b - a]).sum(dtype=np.uint64, keepdims=True) ^ np.uint64(b - a))
            else:
                yield full[:0]
