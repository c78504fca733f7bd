"""A Bloom filter of bounded size, to keep rows that a join would drop out of
its shuffle.  It never decides: rows that it lets through by mistake are
dropped by the join, and when it is too small for its keys it lets all pass."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardforge.llm.common import mix64

#: at most 2^27 bits, 16 MB
MOST_BITS = 1 << 27
HASHES = 2


class Bloom:
    def __init__(self, words: np.ndarray):
        self.words = words

    def __contains__(self, key):
        return bool(self.hits(np.array([key], dtype=np.int64))[0])

    def hits(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), dtype=bool)
        for bit in _bits(keys, len(self.words) * 64):
            out &= (self.words[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        return out


def _bits(keys: np.ndarray, size: int):
    h = mix64(keys.view(np.uint64))
    for k in range(HASHES):
        yield (h >> np.uint64(32 * k)) & np.uint64(size - 1)


def build(keys: DataFrame, count: int) -> Bloom:
    """Filter of the one long column of ``keys`` (about ``count`` of them)."""
    name = keys.columns[0]
    size = 1 << 12
    while size < 12 * count and size < MOST_BITS:
        size <<= 1

    def run(batches):
        words = np.zeros(size // 64, dtype=np.uint64)
        for batch in batches:
            for bit in _bits(np.asarray(batch.column(0), dtype=np.int64), size):
                np.bitwise_or.at(words, bit >> np.uint64(6), np.uint64(1) << (bit & np.uint64(63)))
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at].view(np.int64))], ["w", "m"])

    # at most size / 64 rows reach the driver
    rows = (keys.select(F.col(name).cast("long")).mapInArrow(run, "w long, m long")
            .groupBy("w").agg(F.expr("bit_or(m)").alias("m")).toArrow())
    words = np.zeros(size // 64, dtype=np.uint64)
    if rows.num_rows:
        words[np.asarray(rows.column(0))] = np.asarray(rows.column(1)).astype(np.int64).view(np.uint64)
    return Bloom(words)


def maybe_in(df: DataFrame, column: str, bloom: Bloom, negate: bool = False) -> DataFrame:
    """The rows whose (non-null) key may be in the filter, or surely is not."""

    def run(batches):
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(column))
            keep = bloom.hits(np.asarray(keys, dtype=np.int64)) != negate
            yield batch.filter(pa.array(keep))

    return df.mapInArrow(run, df.schema)
