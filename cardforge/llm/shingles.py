"""Word shingles of a chunk of texts as 64-bit hashes, over whole arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from cardforge.llm.common import mix64, words_of

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def word_hashes(flat: pa.Array) -> np.ndarray:
    coded = flat.dictionary_encode()
    digest = xxhash.xxh3_64_intdigest
    table = np.fromiter((digest(w) for w in coded.dictionary.to_pylist()), dtype=np.uint64, count=len(coded.dictionary))
    return table[np.asarray(coded.indices)]


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``width`` lower-cased words of each text, flat and
    sorted within a text, and the bounds of each text's shingles.  A text of
    fewer words has its whole sequence as its only shingle, one without words
    none."""
    flat, offsets = words_of(texts, lower=True)
    h = word_hashes(flat)
    words = np.diff(offsets)
    n = np.where(words == 0, 0, np.maximum(words - width + 1, 1))
    bounds = np.concatenate(([0], np.cumsum(n)))
    doc = np.repeat(np.arange(len(words)), n)
    at = np.arange(bounds[-1]) - bounds[doc] + offsets[doc]
    length = np.minimum(words, width)[doc]
    out = mix64(length.astype(np.uint64) * _ODD[0])
    for k in range(width):
        short = length <= k
        step = h[np.minimum(at + k, len(h) - 1)] if len(h) else h
        mixed = mix64(out ^ (step * _ODD[1] + _ODD[2]))
        out = np.where(short, out, mixed)
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        out[lo:hi].sort()
    if not len(out):
        return out, bounds
    new = np.ones(len(out), dtype=bool)
    new[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    return out[new], np.concatenate(([0], np.cumsum(new)))[bounds]


def set_digests(sets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set, the same for the same set."""
    out = []
    for odd in _ODD[:2]:
        total = np.concatenate(([np.uint64(0)], np.cumsum(mix64(sets * odd), dtype=np.uint64)))
        out.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return out[0], out[1]
