"""Byte-level BPE encoding and decoding (operator 5).

Documents are encoded where they lie (no shuffle): a chunk of texts is cut by
the pre-tokenisation scan, the slices of the chunk are dictionary-encoded, and
only slices not in the worker's cache run pair merging.  Token ids and byte
offsets come out as flat arrays.

Defined results: a null or empty text has no tokens; repeated rows are encoded
each; extra columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardforge.llm.common import chunks, text_batches
from cardforge.llm.pretokenize import boundaries

#: slices of one generation of a worker's cache (it keeps two), and their ids
CACHE_SLICES = 300_000
CACHE_IDS = 4_000_000
#: text that is cut and encoded at a time
CHUNK_BYTES = 2 << 20


class _Generation:
    """Ids of some distinct slices, flat, and where those of each begin and end."""

    def __init__(self) -> None:
        self.index: dict[bytes, int] = {}
        self.ids, self.ends, self.used = np.empty(1 << 16, dtype=np.int32), np.zeros(1 << 14, dtype=np.int64), 0

    def places(self, keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.index.get, keys, repeat(-1)), dtype=np.int64, count=len(keys))

    def add(self, keys: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        n, used = len(self.index), self.used + len(ids)
        if used > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.used], np.empty(2 * used, dtype=np.int32)])
        if n + len(keys) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends[:n + 1], np.empty(2 * (n + len(keys)), dtype=np.int64)])
        self.ids[self.used:used] = ids
        self.ends[n + 1:n + 1 + len(keys)] = self.used + np.cumsum(lengths)
        self.used = used
        self.index.update(zip(keys, range(n, n + len(keys))))
        return np.arange(n, n + len(keys))

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some slices, flat, and how many each has."""
        lengths = self.ends[at + 1] - self.ends[at]
        ends = np.cumsum(lengths)
        return self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.ends[at] - (ends - lengths), lengths)], lengths


class SliceCache:
    """Ids of distinct slices.  ``encode`` maps a list of slices to their ids,
    flat, and the number of ids of each.

    There are two generations.  When the young one is full it becomes the old one;
    a slice that is used again moves from the old one to the young one, so that
    frequent slices stay and those seen once go."""

    def __init__(self, encode, most: int | None = None):
        self.encode, self.most = encode, most
        self.young, self.old = _Generation(), _Generation()

    def lookup(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each slice's ids begin, how many they are, and the ids."""
        keys = pieces.to_pylist()
        at = self.young.places(keys)
        missing = np.flatnonzero(at < 0)
        if len(missing) and (len(self.young.index) + len(missing) > (self.most or CACHE_SLICES) or self.young.used > CACHE_IDS):
            self.young, self.old = _Generation(), self.young
            missing = np.arange(len(keys))
        if len(missing):
            wanted = [keys[i] for i in missing] if len(missing) < len(keys) else keys
            before = self.old.places(wanted)
            known, new = np.flatnonzero(before >= 0), np.flatnonzero(before < 0)
            if len(known):
                at[missing[known]] = self.young.add([wanted[i] for i in known], *self.old.take(before[known]))
            if len(new):
                fresh = [wanted[i] for i in new] if len(known) else wanted
                at[missing[new]] = self.young.add(fresh, *self.encode(fresh))
        ends = self.young.ends
        return ends[at], ends[at + 1] - ends[at], self.young.ids


class Vocabulary:
    """Ranks of byte strings, read from a rank file (base64 and rank a line)."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        size = max(self.ranks.values(), default=-1) + 1
        table = [b""] * size
        for piece, rank in self.ranks.items():
            table[rank] = piece
        self.pieces = pa.array(table, type=pa.large_binary())
        self.lengths = np.array([len(x) for x in table], dtype=np.int64)
        self.names = pa.array([f"{i} " for i in range(size)], type=pa.large_string())
        self.slices = SliceCache(self.merge_all)

    def merge_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lists = [self.merge(p) for p in pieces]
        lengths = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        return np.fromiter(chain.from_iterable(lists), dtype=np.int32, count=int(lengths.sum())), lengths

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one slice: the pair of lowest rank is merged first, the
        leftmost of equal pairs first."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        n = len(piece)
        after, before, parts = list(range(1, n + 1)), list(range(-1, n - 1)), [piece[i:i + 1] for i in range(n)]
        heap = []
        for i in range(n - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None:
                heap.append((r, i, parts[i] + parts[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i] if parts[i] else n
            if j >= n or parts[i] + parts[j] != both:
                continue  # one of the two was merged meanwhile
            parts[i], parts[j] = both, b""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                r = ranks.get(both + parts[k])
                if r is not None:
                    heapq.heappush(heap, (r, i, both + parts[k]))
            h = before[i]
            if h >= 0:
                r = ranks.get(parts[h] + both)
                if r is not None:
                    heapq.heappush(heap, (r, h, parts[h] + both))
        return [ranks[p] for p in parts if p]


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_chunk(texts: pa.Array, cache: SliceCache) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of a chunk of texts, flat, and the bounds of each text's ids."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if not len(texts):
        return np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = memoryview(texts.buffers()[2] or b"")[int(offsets[0]):int(offsets[-1])]
    bounds, first = boundaries(data, offsets - offsets[0])
    slices = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1,
                                   [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    coded = slices.dictionary_encode()
    codes = np.asarray(coded.indices)
    begins, lengths, flat = cache.lookup(coded.dictionary)
    counts = lengths[codes]
    ends = np.concatenate(([0], np.cumsum(counts)))
    ids = flat[np.arange(ends[-1]) + np.repeat(begins[codes] - ends[:-1], counts)]
    return ids, ends[first]


def joined(table: pa.Array, ids: np.ndarray, bounds: np.ndarray):
    """The table's entries for ``ids`` put together, text by text."""
    taken = table.take(pa.array(ids))
    at = np.frombuffer(taken.buffers()[1], dtype=np.int64)[taken.offset:taken.offset + len(taken) + 1] \
        if len(ids) else np.zeros(1, dtype=np.int64)
    data = memoryview(taken.buffers()[2] or b"") if len(ids) else memoryview(b"")
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        yield data[int(at[lo]):int(at[hi])]


def _list(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def encode_documents(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
                     digests: bool = False, offsets: bool = True) -> DataFrame:
    """``(doc_id, n_tokens, ids, offsets)``: token ids of each whole text and
    (unless ``offsets`` is false) the byte offset of each token in it.  With
    ``digests``, instead of the two
    lists: ``ids_sha256`` of the decimal ids joined by a space, and
    ``decoded_sha256`` of the bytes that the ids decode to."""
    text_batches(docs.sparkSession)
    key = docs.schema[id_col].dataType.simpleString()
    lists = ["ids", "offsets"] if offsets else ["ids"]
    names = ["ids_sha256", "decoded_sha256"] if digests else lists
    tail = ", ".join(f"{x} {'string' if digests else 'array<int>'}" for x in names)

    def run(batches):
        vocab = vocabulary(vocabulary_path)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for lo, hi in chunks(texts, CHUNK_BYTES):
                ids, bounds = encode_chunk(texts.slice(lo, hi - lo), vocab.slices)
                n = pa.array(np.diff(bounds))
                if digests:
                    cols = [[hashlib.sha256(x[:-1]).hexdigest() for x in joined(vocab.names, ids, bounds)],
                            [hashlib.sha256(x).hexdigest() for x in joined(vocab.pieces, ids, bounds)]]
                    cols = [pa.array(c, type=pa.string()) for c in cols]
                else:
                    cols = [_list(ids, bounds)]
                    if offsets:
                        ends = np.concatenate(([0], np.cumsum(vocab.lengths[ids])))
                        cols.append(_list((ends[:-1] - np.repeat(ends[bounds[:-1]], np.diff(bounds))).astype(np.int32), bounds))
                yield pa.RecordBatch.from_arrays([keys.slice(lo, hi - lo), n, *cols], ["doc_id", "n_tokens", *names])

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"doc_id {key}, n_tokens long, {tail}"))


def decode_documents(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, ids)``; bytes that are not UTF-8 (cut
    token sequences) become U+FFFD, a null list the empty text."""
    text_batches(encoded.sparkSession)
    key = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches):
        vocab = vocabulary(vocabulary_path)
        for batch in batches:
            lists = batch.column(1)
            bounds = np.concatenate(([0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))))
            ids = np.asarray(lists.flatten(), dtype=np.int32)
            texts = [str(x, "utf-8", "replace") for x in joined(vocab.pieces, ids, bounds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, type=pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {key}, text string")
