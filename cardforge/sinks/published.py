"""Outputs published by manifest (SNK-1, SNK-2, CAT-4).

A run first stages its rows under its own id, then publishes: a new manifest
names the runs that are live, and readers go through the newest one.  So

* a run that fails while it writes leaves the former output as it was;
* a run that is replayed adds nothing: an id that is live is neither staged nor
  published again;
* readers see all of a run or nothing of it.

Layout: ``data/run=<id>/`` (with ``subject=`` folders if given), ``manifest/v=<n>/``, a small
table ``(run, subject)``: null subject, the whole run; else only that subject of it.  A
manifest counts once its ``_SUCCESS`` file is there, which Spark's committer writes
last.  One publisher at a time: versions are not locked.

Defined results: an output without manifest is empty (no table: ``None``); a run without
rows publishes nothing but counts as done; a null subject is ``unknown``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardforge.sinks import files

#: subjects in a manifest that are broadcast to the reader (some 50 bytes each)
BROADCAST_ENTRIES = 100_000
ENTRY = "run string, subject string"


def path_names(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, by Hadoop's file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [f.getPath().toString() for f in found or []]


def versions(spark: SparkSession, path: str) -> list[int]:
    """Published versions, oldest first."""
    marks = path_names(spark, f"{path.rstrip('/')}/manifest/v=*/_SUCCESS")
    return sorted(int(re.search(r"/v=(\d+)/_SUCCESS$", m).group(1)) for m in marks)


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """``(run, subject)`` of a version (the newest): what is live."""
    known = versions(spark, path)
    if not known:
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).parquet(f"{path.rstrip('/')}/manifest/v={known[-1] if version is None else version}")


def _is_done(spark: SparkSession, path: str, run: str) -> bool:
    """Whether the run was published, now live or not."""
    known = [f"{path.rstrip('/')}/manifest/v={v}" for v in versions(spark, path)]
    return bool(known) and not spark.read.schema(ENTRY).parquet(*known).where(F.col("run") == run).isEmpty()


def _folder(path: str, run: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run):
        raise ValueError("a run id of letters, digits and _.-")
    return f"{path.rstrip('/')}/data/run={run}"


def stage(rows: DataFrame, path: str, run: str, by_subject: bool = False) -> None:
    """Writes the rows under the run's id; what an earlier attempt left there is replaced."""
    if by_subject:
        rows = files.by_subject(rows.withColumn("subject", F.coalesce(F.col("subject").cast("string"), F.lit("unknown"))))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy("subject") if by_subject else writer).parquet(_folder(path, run))


def publish(spark: SparkSession, path: str, entries: DataFrame) -> int:
    """Makes ``entries(run, subject)`` the live ones; returns the version."""
    known = versions(spark, path)
    version = known[-1] + 1 if known else 1
    entries.select("run", "subject").coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/manifest/v={version}")
    return version


def _entry(spark: SparkSession, run: str) -> DataFrame:
    return spark.createDataFrame([(run, None)], ENTRY)


def append_run(rows: DataFrame, path: str, run: str) -> bool:
    """SNK-1: adds the rows once, however often the run is repeated; returns whether it did."""
    spark = rows.sparkSession
    if _is_done(spark, path, run):
        return False
    stage(rows, path, run)
    publish(spark, path, manifest(spark, path).union(_entry(spark, run)))
    return True


def refresh_run(rows: DataFrame, path: str, run: str) -> bool:
    """SNK-2: replaces the output; until it is published, readers see the former one."""
    spark = rows.sparkSession
    if _is_done(spark, path, run):
        return False
    stage(rows, path, run)
    publish(spark, path, _entry(spark, run))
    return True


def write_subjects_run(items: DataFrame, path: str, run: str) -> bool:
    """CAT-4: subjects of this run replace their former items, older subjects stay; all
    of them change at once."""
    spark = items.sparkSession
    if _is_done(spark, path, run):
        return False
    stage(items, path, run, by_subject=True)
    new = _subjects_of(spark, path, run)
    old = manifest(spark, path).join(new.select("subject"), "subject", "left_anti").select("run", "subject")
    # a run without items is marked done by a subject that no row has
    mark = spark.createDataFrame([(run, "")], ENTRY)
    publish(spark, path, old.where("subject <> ''").union(new).union(mark))
    return True


def _subjects_of(spark: SparkSession, path: str, run: str) -> DataFrame:
    """``(run, subject)`` of a staged run (its folder names decide, no row is read)."""
    marks = path_names(spark, f"{_folder(path, run)}/subject=*")
    if not marks:
        return spark.createDataFrame([], ENTRY)
    found = spark.read.parquet(_folder(path, run)).select(F.col("subject").cast("string").alias("subject")).distinct()
    return found.select(F.lit(run).alias("run"), "subject")


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The live rows, with column ``run``; ``None`` if nothing was published or no live run has rows."""
    live = manifest(spark, path, version).where("subject is null or subject <> ''").cache()
    try:
        # names of runs, and of their folders that hold files: as many as the reader lists anyway
        runs = [r["run"] for r in live.select("run").distinct().collect()]
        folders = [_folder(path, r) for r in runs if path_names(spark, f"{_folder(path, r)}/*.parquet") or path_names(spark, f"{_folder(path, r)}/subject=*")]
        if not folders:
            return None
        rows = spark.read.option("basePath", f"{path.rstrip('/')}/data").option("mergeSchema", True).parquet(*folders)
        rows = rows.withColumn("run", F.col("run").cast("string"))
        if "subject" not in rows.columns or live.where("subject is not null").isEmpty():
            return rows
        rows = rows.withColumn("subject", F.col("subject").cast("string"))
        n = live.count()
        wanted = spark.createDataFrame(live.collect(), ENTRY) if n <= BROADCAST_ENTRIES else manifest(spark, path, version)
        wanted = F.broadcast(wanted) if n <= BROADCAST_ENTRIES else wanted
        return rows.join(wanted, ["run", "subject"], "left_semi")
    finally:
        live.unpersist()


def expired_runs(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Folders of runs that none of the newest ``keep`` manifests names: staged by
    runs that failed, or replaced since.  The caller removes them."""
    kept = set()
    for v in versions(spark, path)[-keep:]:
        kept |= {r["run"] for r in manifest(spark, path, v).select("run").distinct().collect()}
    return sorted(f for f in path_names(spark, f"{path.rstrip('/')}/data/run=*") if f.rsplit("run=", 1)[1] not in kept)
