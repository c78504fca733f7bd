"""Helpers shared by the operators: tables, word splitting on Arrow buffers,
connected components.  Lineage is cut by ``cardforge.session.materialize``."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardforge.session import checkpoint_dir, materialize

#: rows of text handed to Python at a time (texts may be long)
TEXT_BATCH_ROWS = 1500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` in one struct ``row``, so that no name of theirs
    clashes with columns that an operator adds; ``select("row.*")`` undoes it."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]).alias("row")


def text_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of text small (a session option, lowered only)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > TEXT_BATCH_ROWS:
        spark.conf.set(key, str(TEXT_BATCH_ROWS))


def shared_path(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/cardforge-{label}-{uuid.uuid4().hex}"


def chunks(texts: pa.Array, most_bytes: int = 4 << 20):
    """``(start, stop)`` row ranges of at most ``most_bytes`` of text (one row
    at least)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    start, n = 0, len(texts)
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most_bytes, side="right")))
        yield start, stop
        start = stop


#: bytes with A-Z lower-cased
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[ord("A"):ord("Z") + 1] += 32


def mapped_bytes(texts: pa.Array, table: np.ndarray) -> pa.Array:
    """Large strings without nulls, each byte replaced by ``table`` (ASCII for ASCII)."""
    if not len(texts) or texts.buffers()[2] is None:
        return texts
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return pa.Array.from_buffers(pa.large_string(), len(texts),
                                 [None, pa.py_buffer(offsets - offsets[0]), pa.py_buffer(table[data])])


def ascii_lowered(texts: pa.Array) -> pa.Array:
    """Large strings with A-Z lower-cased (Arrow's own kernel misreads slices)."""
    return mapped_bytes(texts, LOWERED)


def words_of(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a chunk of texts (null: none), flat, and the offsets of
    each text's words in it."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if lower:
        texts = ascii_lowered(texts)
    parts = pc.ascii_split_whitespace(texts)
    offsets = np.asarray(parts.offsets, dtype=np.int64)
    flat = parts.flatten()
    offsets = offsets - offsets[0]
    full = np.asarray(pc.binary_length(flat)) > 0
    if not full.all():
        before = np.concatenate(([0], np.cumsum(full)))
        flat, offsets = flat.filter(pa.array(full)), before[offsets]
    return flat, offsets


def mix64(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads 64-bit values (xor-shift and multiply rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (the least member's index) after linking ``i`` with ``j``."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` with the smallest node reachable over undirected
    ``edges(a, b)``; nodes without edges get no row.

    Alternating large-star / small-star rounds (each node links its larger,
    then its smaller neighbours to the smallest one it sees).  Every round is
    aggregates and joins on the edge table, written to the shared folder; the
    driver sees one count and one checksum a round.  A hub's neighbours meet
    their minimum in a join (split when skewed), never in one array.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .distinct(), "cc")
    mark = None
    for _ in range(max_rounds):
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.where("m < u").select("u", F.col("m").alias("v")))
                 .where("u <> v").distinct())
        large = materialize(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).where("u <> v")
        now = materialize(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "cc")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError("components did not settle")
    stars = now.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())
