"""Session helpers.

Library code never creates its own session: every operator takes DataFrames
and returns DataFrames.  These helpers exist for tests, the bench and the
command-line plans, and for the one place that needs a shared folder
(lineage cuts in iterative operators).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written against.  AQE re-plans joins and
# coalesces small shuffle partitions at runtime; duplicate JSON keys resolve
# "last wins" like Python's json module.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # joins keyed by (page_id, pos) reuse the page_id hash partitioning
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "cardforge") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = (SparkSession.builder.master(f"local[{cores}]")
               .appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g")
               .config("spark.ui.showConsoleProgress", "false"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Set the runtime SQL options the operators rely on."""
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Only a local session
    without it gets a scratch folder; any other master must name shared storage,
    as executors cannot see each other's disks.
    """
    sc = spark.sparkContext
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    current = sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError(f"set spark.checkpoint.dir to shared storage (master {sc.master})")
        current = tempfile.mkdtemp(prefix="cardforge-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back:
    a lineage cut that survives lost executors, and one evaluation for several
    readers."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/cardforge-{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
