"""Mixing sources to target weights by pivotal dependent rounding (operator 2).

Each source's target is its weight's share of all words, at most ``cap`` times
its words; what is cut off is shared out anew by weight.  A document is then
wanted target / source words times: its whole part is certain, the fractional
part a copy probability.  Pivotal rounding pairs two documents with fractional
probabilities and moves words from one to the other, in a random direction that
keeps both expectations, until one of them is integral.  The words taken of a
source are kept at every step, so they end within one document of the target.

Documents of a source are dealt by hash into chunks.  Each chunk leaves at most
one fractional document; those meet in groups of ``FAN`` chunks, level by level
(a reduction tree), and the last one of a source is drawn.  Order and random
numbers come from hashes of ids and texts: reruns and other partitionings agree.

Defined results: a null text has size 0; documents of size 0 are taken 0 times;
a null source is a source of its own, last in order; rows that agree in id,
source and text share one decision; null ids are ordinary values; an empty
table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardforge.llm.common import materialize, packed, text_batches

CHUNK_ROWS = 4096
FAN = 16
SEED = 2

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def count_words(texts: pa.Array) -> np.ndarray:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if not len(texts):
        return np.zeros(0, dtype=np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    gap = np.ones(len(data) + 1, dtype=bool)
    gap[1:] = _SPACE[data]
    start = ~gap[1:] & gap[:-1]
    filled = offsets[:-1][np.diff(offsets) > 0]
    start[filled] = ~gap[1:][filled]
    return np.concatenate(([0], np.cumsum(start)))[offsets[1:]] - np.concatenate(([0], np.cumsum(start)))[offsets[:-1]]


def sized(documents: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``(doc_id, source, h, size)`` of each document."""
    text_batches(documents.sparkSession)
    key = documents.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(count_words(batch.column(3)))],
                                             ["doc_id", "source", "h", "size"])

    return (documents.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                             F.xxhash64(text_col).alias("h"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"doc_id {key}, source string, h long, size long"))


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """``(source, source_size, rows, target)`` of ``(source, source_size, rows)``."""
    order = F.col("source").asc_nulls_last()
    # the id counts rows within a range partition above the partition's number
    placed = materialize(sources.repartitionByRange(order).sortWithinPartitions(order)
                         .withColumn("at", F.monotonically_increasing_id()), "sources")
    part = F.shiftrightunsigned("at", 33)
    parts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    # a row a partition
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    rank = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    placed = materialize(placed.withColumn("part", part).join(before, "part").withColumn("w", weight)
                         .select("source", "source_size", "rows", "w"), "sources")
    most = F.col("source_size") * cap
    total, all_w = placed.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0))).first()
    level = total / all_w if all_w else 0.0
    while True:  # a round caps at least one more source, or is the last
        full, w = placed.agg(F.sum(F.when(most < F.col("w") * level, most).otherwise(0)),
                             F.sum(F.when(most < F.col("w") * level, 0).otherwise(F.col("w")))).first()
        new = (total - full) / w if w else level
        if not new > level:
            break
        level = new
    return placed.select("source", "source_size", "rows", F.least(most.cast("double"), F.col("w") * F.lit(level)).alias("target"))


def _unit(*parts: int) -> float:
    """A number in [0, 1) from integers, by a 64-bit mix."""
    x = SEED
    for p in parts:
        x = ((x ^ (p & 0xFFFFFFFFFFFFFFFF)) * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF
        x ^= x >> 29
    x = (x * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    return ((x ^ (x >> 32)) & ((1 << 53) - 1)) / (1 << 53)


def pivot(keys: list[int], mass: list[int], p: list[float], last: bool) -> list[float]:
    """Rounds copy probabilities ``p`` of items of ``mass`` words one after the
    other, keeping sum(mass * p); at most one stays fractional, none if ``last``."""
    p, held = list(p), -1
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, b = held, i
        up = min(mass[a] * (1 - p[a]), mass[b] * p[b])  # words that may move to a
        down = min(mass[a] * p[a], mass[b] * (1 - p[b]))  # words that may move to b
        to_a = _unit(keys[a], keys[b]) * (up + down) < down
        if to_a:
            full = mass[a] * (1 - p[a]) <= mass[b] * p[b]
            moved = up
        else:
            full = mass[a] * p[a] <= mass[b] * (1 - p[b])
            moved = -down
        if full:  # a becomes integral
            p[b] = min(1.0, max(0.0, p[b] - moved / mass[b]))
            p[a] = 1.0 if to_a else 0.0
            held = b if 0.0 < p[b] < 1.0 else -1
        else:
            p[a] = min(1.0, max(0.0, p[a] + moved / mass[a]))
            p[b] = 0.0 if to_a else 1.0
            held = a if 0.0 < p[a] < 1.0 else -1
    if last and held >= 0:
        p[held] = 1.0 if _unit(keys[held], mass[held]) < p[held] else 0.0
    return p


def _rounded(items: DataFrame, last: bool) -> DataFrame:
    """One level: items of each (source, chunk) rounded."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        # large documents first: the one left over is then small, and the words taken near the target
        group = group.sort_values(["mass", "key"], ascending=[False, True], kind="stable")
        group["p"] = pivot(group["key"].tolist(), group["mass"].tolist(), group["p"].tolist(), last)
        return group

    return materialize(items.groupBy("sid", "chunk").applyInPandas(run, items.schema), "mix")


def decisions(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """``(doc_id, source, h, size, source_size, target, copies)``: one row for
    rows that agree in id, source and text, from ``rows(doc_id, source, h, size)``."""
    items = rows.groupBy("doc_id", "source", "h", "size").agg(F.count(F.lit(1)).alias("times"))
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    goal = targets(sources, weights, cap)
    goal = materialize(goal.withColumn("sid", F.monotonically_increasing_id()), "goals")
    items = items.join(goal.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    items = items.withColumn("base", F.when(F.col("size") > 0, F.floor(rate)).otherwise(0).cast("int"))
    items = items.withColumn("p", F.when(F.col("size") > 0, rate - F.floor(rate)).otherwise(0.0))
    items = items.withColumn("mass", F.col("size") * F.col("times")).withColumn("key", F.xxhash64("doc_id", "source", "h", "size"))
    chunk = F.pmod(F.xxhash64("key"), F.ceil(F.col("rows") / CHUNK_ROWS))
    items = materialize(items.withColumn("chunk", chunk.cast("long")).drop("rows", "times"), "mix")
    levels = math.ceil((goal.agg(F.max("rows")).first()[0] or 1) / CHUNK_ROWS)
    open_ = items.select("sid", "chunk", "key", "mass", "p").where("p > 0")
    done = None
    while True:
        level = _rounded(open_, last=levels <= 1)
        settled = level.where("p = 0 or p = 1")
        done = settled if done is None else done.union(settled)
        if levels <= 1:
            break
        open_ = level.where("p > 0 and p < 1").withColumn("chunk", F.floor(F.col("chunk") / FAN).cast("long"))
        levels = math.ceil(levels / FAN)
    extra = done.select("sid", "key", F.col("p").cast("int").alias("extra"))
    return (items.join(extra, ["sid", "key"], "left")
            .select("doc_id", "source", "h", "size", "source_size", "target",
                    (F.col("base") + F.coalesce("extra", F.lit(0))).alias("copies")))


def mix(documents: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)``, one row a
    document."""
    rows = materialize(sized(documents, id_col, text_col, source_col), "sizes")
    made = materialize(decisions(rows, weights, cap), "decisions")
    d = made.select(*[F.col(c).alias(f"_{c}") for c in ("doc_id", "source", "h")], "source_size", "target", "copies")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("doc_id", "source", "h")]
    return rows.join(d, same).select("doc_id", "source", "size", "source_size", "target", "copies",
                                     (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(documents: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, id_col: str = "doc_id",
                    text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``documents``, each as often as the mix takes it."""
    rows = materialize(sized(documents, id_col, text_col, source_col), "sizes")
    made = materialize(decisions(rows, weights, cap).where("copies > 0"), "decisions")
    d = made.select(F.struct("doc_id", "source", "h").alias("_k"), F.col("copies").alias("_copies"))
    key = F.struct(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.xxhash64(text_col).alias("h"))
    return (documents.select(packed(documents), key.alias("_key")).join(d, F.col("_key").eqNullSafe(F.col("_k")))
            .select("row", F.explode(F.sequence(F.lit(1), "_copies"))).select("row.*"))
