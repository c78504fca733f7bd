"""Stateful streams: a stop rule that lasts over runs (TRV-3) and answers with a deadline (EXT-2)."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def entry_store(spark: SparkSession):
    """Streams started inside keep their state entry by entry (in RocksDB); the
    session's setting comes back after."""
    before = spark.conf.get(STORE_KEY, None)
    spark.conf.set(STORE_KEY, ROCKS_DB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STORE_KEY)
        else:
            spark.conf.set(STORE_KEY, before)


def _until_repeat() -> StatefulProcessor:
    """Per part: the hashes seen so far, one entry each, and a flag once one came again.
    (A local class travels whole: Spark's stream runner need not find this package.)"""

    class UntilRepeat(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            yes = T.StructType([T.StructField("yes", T.BooleanType())])
            self.seen = handle.getMapState("seen", T.StructType([T.StructField("hash", T.StringType())]), yes)
            self.stopped = handle.getValueState("stopped", yes)

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            if self.stopped.exists():
                return
            # order and hash of the part's rows in this batch
            batch = pd.concat([r[["order_key", "content_hash"]] for r in rows], ignore_index=True).sort_values("order_key", kind="stable")
            kept = 0
            for content in batch["content_hash"]:
                if self.seen.containsKey((content,)):
                    self.stopped.update((True,))
                    self.seen.clear()  # never asked again
                    break
                self.seen.updateValue((content,), (True,))
                kept += 1
            if kept:
                yield pd.DataFrame({"part_key": [key[0]] * kept, "order_key": batch["order_key"].iloc[:kept].reset_index(drop=True)})

        def close(self) -> None:
            pass

    return UntilRepeat()


def stream_until_repeat(stream: DataFrame, part: str, order: str, content: str) -> DataFrame:
    """TRV-3 over all runs: ``(part, order)`` of the rows of each ``part`` up to (excluding)
    the first whose content came before in that part.  A repeat ends its part for good:
    no row after it comes in this micro-batch or a later one, also after a restart from
    the checkpoint.  Micro-batches must follow each other in ``order`` (within one,
    rows may come in any order); null contents equal each other, as in the batch operator.

    State: one entry of a hash a row of a part that is still going, then a flag.
    Inside a micro-batch a part's (order, hash) pairs are sorted in one task; its rows'
    other columns are not carried (join them by the two keys).  Start the query inside
    ``entry_store``."""
    narrow = stream.select(F.col(part).alias("part_key"), F.col(order).alias("order_key"),
                           F.coalesce(F.md5(F.col(content).cast("string")), F.lit("")).alias("content_hash"))
    out = T.StructType([f for f in narrow.schema.fields if f.name != "content_hash"])
    kept = narrow.groupBy("part_key").transformWithStateInPandas(statefulProcessor=_until_repeat(), outputStructType=out,
                                                                 outputMode="Append", timeMode="None")
    return kept.toDF(part, order)


def stream_answers(requests: DataFrame, responses: DataFrame, deadline: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """EXT-2 as a stream: ``requests(request_id, asked_at, ...)`` joined to
    ``responses(request_id, answered_at, output_text)``: the columns of the requests,
    ``concept_and_mnemonic`` and ``answered_at``.

    A request is answered in the micro-batch that has its answer, and comes out
    unanswered (nulls) once the watermark passes its deadline.  One answer a request:
    of repeated ones the first to arrive counts; null answers and those outside
    ``[asked_at, asked_at + deadline]`` are none.  Rows later than the watermark
    (``delay`` behind the newest event of its side) are dropped.  State is bounded by
    deadline and delay."""
    asked = requests.withWatermark("asked_at", delay)
    given = (responses.where(F.col("output_text").isNotNull() & F.col("request_id").isNotNull())
             .select(F.col("request_id").alias("_id"), "answered_at", F.col("output_text").alias("concept_and_mnemonic"))
             .withWatermark("answered_at", delay).dropDuplicatesWithinWatermark(["_id"]))
    in_time = F.expr(f"request_id = _id AND answered_at >= asked_at AND answered_at <= asked_at + INTERVAL {deadline}")
    return asked.join(given, in_time, "left_outer").drop("_id")
