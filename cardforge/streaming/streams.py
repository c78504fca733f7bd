"""Incremental runs as Structured Streaming (STR-1 .. STR-3).

Append-and-resume becomes a streaming query over a folder of page
snapshots: the checkpoint remembers which files were processed (replacing
the "already scraped" set), and each micro-batch is extracted with the same
batch operators through ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardforge.functions.urls import subject_of
from cardforge.operators.dom import extract_lessons


def page_stream(spark: SparkSession, pages_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New page files in ``pages_dir`` as a stream (schema from the folder)."""
    schema = spark.read.parquet(pages_dir).schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(pages_dir)


def write_batch(batch: DataFrame, path: str, n_files: int, key: str) -> None:
    """Append ``batch`` to the folder of a :func:`batch_stream` as exactly ``n_files`` files,
    each written by its own task (rows by the hash of ``key``).  A row a file that
    marks it, and the stream drops again, keeps files without other rows from being left out.
    Batches must be written one after the other: the stream reads files by their age."""
    spark, name = batch.sparkSession, F.xxhash64(key)
    rows = batch.select("*", F.lit(True).alias("_row"), F.pmod(name, F.lit(n_files)).cast("int").alias("_file"))
    marks = spark.range(n_files).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in batch.schema.fields],
                                        F.lit(False).alias("_row"), F.col("id").cast("int").alias("_file"))
    rows.union(marks).repartitionById(n_files, "_file").drop("_file").write.mode("append").parquet(path)


def batch_stream(spark: SparkSession, path: str, n_files: int) -> DataFrame:
    """The batches that :func:`write_batch` wrote, one a micro-batch and in their order."""
    return page_stream(spark, path, max_files_per_trigger=n_files).where("_row").drop("_row")


def batch_files(table: DataFrame, n_batches: int) -> int:
    """Files a batch, if ``table`` (read from files) is dealt over ``n_batches``: as many in all
    as tasks read the table."""
    return -(-table.rdd.getNumPartitions() // n_batches)


def stream_extract(spark: SparkSession, pages_dir: str, out_dir: str, checkpoint: str,
                   extractor=extract_lessons, available_now: bool = True, max_files_per_trigger: int | None = None):
    """STR-1: every new page file becomes lesson rows once.

    Each micro-batch is written under ``batch_id=<n>`` with dynamic
    partition overwrite, so a batch replayed after a failure (foreachBatch is
    at-least-once) replaces its own output instead of duplicating it."""
    def run(batch: DataFrame, batch_id: int) -> None:
        (extractor(batch).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out_dir))

    w = page_stream(spark, pages_dir, max_files_per_trigger).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def stream_dedup(stream: DataFrame, key: list[str], event_time: str | None = None,
                 delay: str = "1 hour") -> DataFrame:
    """STR-2: drop rows whose key was already seen, in this or an earlier
    micro-batch.  Without an event time a key is dropped for ever and the state
    grows with the distinct keys.  With one, a key is dropped for ``delay`` after
    its first event (the state is bounded by the watermark), and may come again
    after that."""
    if event_time:
        return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(key)
    return stream.dropDuplicates(key)


def content_key(stream: DataFrame, content: str, alias: str = "content_md5") -> DataFrame:
    return stream.withColumn(alias, F.md5(F.col(content)))


def stream_subject_counts(stream: DataFrame, url_col: str = "url") -> DataFrame:
    """STR-3: running item count per subject (update / complete mode)."""
    return stream.groupBy(subject_of(F.col(url_col)).alias("subject")).agg(F.count(F.lit(1)).alias("n_items"))


def run_to_table(spark: SparkSession, stream: DataFrame, out_dir: str, checkpoint: str,
                 mode: str = "append") -> DataFrame:
    """Drive a stream over the files present now into a Parquet table and return
    it.  ``append`` writes each micro-batch under its id (a replayed one replaces
    itself); ``complete`` replaces the table, the last batch has it all."""
    def run(batch: DataFrame, batch_id: int) -> None:
        if mode == "complete":
            batch.write.mode("overwrite").parquet(out_dir)
        else:
            (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out_dir))

    q = (stream.writeStream.foreachBatch(run).outputMode(mode).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_dir).select(stream.columns)
