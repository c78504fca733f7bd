"""Running totals of a stream that merge on read (STR-3).

Each micro-batch writes the counts of its own rows under its batch id, and nothing
else: no batch rewrites the table.  A replayed batch replaces its own folder, so it
counts once.  Readers add up; ``compact`` folds the batches so far into one base and
names the last of them, and batches up to that one are then left out by readers,
so that a late replay of one still counts once.

Layout: ``partial/batch=<n>/`` and ``base/upto=<n>/``; a base counts once its
``_SUCCESS`` file is there.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardforge.sinks.published import path_names

COUNT = "n_items"


def write_partial(batch: DataFrame, keys: dict[str, Column], path: str, batch_id: int) -> None:
    """The counts of one micro-batch by ``keys`` (name -> expression)."""
    counts = batch.groupBy(*[c.alias(name) for name, c in keys.items()]).agg(F.count(F.lit(1)).alias(COUNT))
    counts.write.mode("overwrite").parquet(f"{path.rstrip('/')}/partial/batch={batch_id}")


def stream_totals(stream: DataFrame, keys: dict[str, Column], path: str, checkpoint: str, available_now: bool = True):
    """Starts the query that keeps the totals of ``stream`` under ``path``."""
    writer = stream.writeStream.foreachBatch(lambda batch, batch_id: write_partial(batch, keys, path, batch_id))
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")).start()


def _newest_base(spark: SparkSession, path: str) -> int | None:
    found = [int(re.search(r"/upto=(-?\d+)/", p).group(1)) for p in path_names(spark, f"{path.rstrip('/')}/base/upto=*/_SUCCESS")]
    return max(found, default=None)


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Written batches (as many as there are folders since the last compaction)."""
    return sorted(int(re.search(r"/batch=(\d+)/", p).group(1)) for p in path_names(spark, f"{path.rstrip('/')}/partial/batch=*/_SUCCESS"))


def read_totals(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame | None:
    """The totals by key, of all batches (or those up to ``upto``); ``None`` before the first."""
    base, root = _newest_base(spark, path), path.rstrip("/")
    after = -1 if base is None else base
    newer = [f"{root}/partial/batch={n}" for n in _batches(spark, path) if n > after and (upto is None or n <= upto)]
    parts = [spark.read.parquet(p) for p in ([] if base is None else [f"{root}/base/upto={base}"])]
    if newer:
        parts.append(spark.read.parquet(*newer))
    if not parts:
        return None
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.groupBy(*[c for c in rows.columns if c != COUNT]).agg(F.sum(COUNT).alias(COUNT))


def compact(spark: SparkSession, path: str) -> int | None:
    """Folds the batches so far into a new base; returns the last of them.  Folders of
    folded batches may be removed once no reader uses an older base."""
    batches, base = _batches(spark, path), _newest_base(spark, path)
    last = max(batches, default=None)
    if last is None or (base is not None and last <= base):
        return base
    read_totals(spark, path, upto=last).write.mode("overwrite").parquet(f"{path.rstrip('/')}/base/upto={last}")
    return last
