"""Numbers that go on over runs (NUM-1).

A ledger keeps, for each record that ever got numbers, the interval of its items'
numbers, and for each batch how many numbers were given up to its end.  A later batch
goes on from there without a recount, and a record that is delivered again gets the
numbers it had.

Layout: ``intervals/batch=<id>/`` rows ``(row_no, first, n)`` in order of ``row_no``, and
``totals/batch=<id>/`` one row ``(upto)``; a batch counts once its total is there, which
is written last, so a batch that failed midway is simply done again.

Defined results: new records are numbered in order of ``row_no`` after all former ones;
a record without items has an empty interval; a record given twice in one batch, or
again with another number of items, keeps the first interval it got (of two in a batch,
the one with more items); null row numbers are left out.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardforge.operators.items import prefix_offsets
from cardforge.sinks.published import path_names

INTERVAL = "row_no long, first long, n long"


def batches(spark: SparkSession, path: str) -> list[str]:
    """Ids of the batches that count."""
    return sorted(re.search(r"/batch=([^/]+)/", p).group(1) for p in path_names(spark, f"{path.rstrip('/')}/totals/batch=*/_SUCCESS"))


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """``(row_no, first, n)`` of all records numbered so far (numbers ``first`` to ``first + n - 1``)."""
    known = [f"{path.rstrip('/')}/intervals/batch={b}" for b in batches(spark, path)]
    return spark.read.schema(INTERVAL).parquet(*known) if known else spark.createDataFrame([], INTERVAL)


def numbered_upto(spark: SparkSession, path: str) -> int:
    """The last number given: a maximum over one row a batch."""
    known = [f"{path.rstrip('/')}/totals/batch={b}" for b in batches(spark, path)]
    return (spark.read.parquet(*known).agg(F.max("upto")).first()[0] or 0) if known else 0


def number_batch(sizes: DataFrame, path: str, batch: str) -> DataFrame:
    """Gives numbers to the records of ``sizes(row_no, n)`` and returns ``(row_no, first, n)`` of all of
    them, old or new.  One batch at a time."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
        raise ValueError("a batch id of letters, digits and _.-")
    spark, root = sizes.sparkSession, path.rstrip("/")
    given = sizes.where(F.col("row_no").isNotNull()).groupBy(F.col("row_no").cast("long").alias("row_no")).agg(F.max("n").cast("long").alias("n"))
    span = given.agg(F.min("row_no").alias("lo"), F.max("row_no").alias("hi")).first()
    if span["lo"] is None:
        return spark.createDataFrame([], INTERVAL)
    # only row groups of the ledger that overlap the batch are read
    old = ledger(spark, path).where(F.col("row_no").between(span["lo"], span["hi"]))
    if batch not in batches(spark, path):
        new = given.join(old.select("row_no"), "row_no", "left_anti")
        upto = numbered_upto(spark, path)
        offsets = prefix_offsets(new, "row_no", "n")
        rows = new.join(offsets, "row_no").select("row_no", (F.col("offset") + upto + 1).alias("first"), "n")
        (rows.repartitionByRange("row_no").sortWithinPartitions("row_no").write.mode("overwrite")
         .parquet(f"{root}/intervals/batch={batch}"))
        total = spark.read.schema(INTERVAL).parquet(f"{root}/intervals/batch={batch}").agg(
            F.coalesce(F.max(F.col("first") + F.col("n") - 1), F.lit(upto)).alias("upto"))
        total.write.mode("overwrite").parquet(f"{root}/totals/batch={batch}")
    now = ledger(spark, path).where(F.col("row_no").between(span["lo"], span["hi"]))
    return given.select("row_no").join(now, "row_no").select("row_no", "first", "n")
