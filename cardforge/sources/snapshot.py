"""Page snapshots that are read by URL (SRC-1).

A snapshot is written in order of a hash of the URL: files hold consecutive ranges,
rows are sorted inside, row groups are small, and an index table names the range of
each file.  A reader turns the wanted URLs into hashes, finds by the index the files
that can hold them, opens only those, and, when few are wanted, passes their hashes
to the scan, where row groups and pages without one of them are skipped.

Defined results: a page row that comes several times is returned as often; wanted URLs
that are null or that the snapshot lacks give no row; other columns of the pages are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardforge.session import materialize

#: wanted hashes that are passed to the scan as a list
MOST_LISTED = 1_000
HASH = "url_hash"
#: options of the Parquet writer (fixed values): row groups and pages
FILE_OPTIONS = {"parquet.block.size": str(8 << 20), "parquet.page.size": str(64 << 10), "parquet.page.row.count.limit": "200"}


def write_snapshot(pages: DataFrame, path: str, files: int | None = None) -> None:
    """Writes ``pages(url, ...)`` as a snapshot of ``files`` files (as many as the session's
    shuffle partitions by default).  Pages with equal URLs lie in one file."""
    spark, root = pages.sparkSession, path.rstrip("/")
    hashed = pages.withColumn(HASH, F.xxhash64("url"))
    placed = hashed.repartitionByRange(files, HASH) if files else hashed.repartitionByRange(HASH)
    placed.sortWithinPartitions(HASH).write.mode("overwrite").options(**FILE_OPTIONS).parquet(f"{root}/pages")
    index = spark.read.parquet(f"{root}/pages").groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(HASH).alias("lo"), F.max(HASH).alias("hi"), F.count(F.lit(1)).alias("n"))
    index.coalesce(1).write.mode("overwrite").parquet(f"{root}/index")


def read_urls(spark: SparkSession, path: str, urls: DataFrame) -> DataFrame:
    """The pages of the snapshot whose ``url`` is among ``urls(url)``."""
    root = path.rstrip("/")
    wanted = materialize(urls.where("url is not null").select("url", F.xxhash64("url").alias(HASH)).distinct(), "wanted")
    index = spark.read.parquet(f"{root}/index")
    # a row a file; ranges of files do not overlap but at their ends
    met = wanted.select(HASH).join(F.broadcast(index), F.col(HASH).between(F.col("lo"), F.col("hi")))
    files = [r["file"] for r in met.select("file").distinct().collect()]
    schema = spark.read.parquet(f"{root}/pages").schema
    pages = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    few = wanted.select(HASH).distinct().limit(MOST_LISTED + 1).collect()
    if len(few) <= MOST_LISTED:
        pages = pages.where(F.col(HASH).isin([r[HASH] for r in few]))
    return pages.join(wanted, [HASH, "url"], "left_semi").select([c for c in schema.names if c != HASH])
