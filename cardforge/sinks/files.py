"""Sinks (SNK-1 .. SNK-3) and the per-subject writers (CAT-4 .. CAT-6).

Paths are shared storage on a cluster.  Nothing is collected to the
driver: every writer is a distributed ``DataFrameWriter`` call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType


def _csv_safe(df: DataFrame) -> DataFrame:
    """CSV holds only scalars: nested and VARIANT columns become JSON text."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _writer(df: DataFrame, fmt: str, mode: str):
    data = _csv_safe(df) if fmt == "csv" else df
    w = data.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = (w.option("header", True).option("quote", '"').option("escape", '"')
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    return w


def append_rows(df: DataFrame, path: str, fmt: str = "parquet", columns: list[str] | None = None) -> None:
    """SNK-1: append (the header is written with each file).  ``columns``
    keeps only those (the model extractors persist ``url`` and
    ``concept_and_mnemonic``; the rule extractor all six)."""
    _writer(df.select(*columns) if columns else df, fmt, "append").save(path)


def refresh_rows(df: DataFrame, path: str, fmt: str = "parquet", columns: list[str] | None = None) -> None:
    """SNK-2: replace the previous output."""
    _writer(df.select(*columns) if columns else df, fmt, "overwrite").save(path)


def rewrite_records(df: DataFrame, path: str, column: str, fn, fmt: str = "csv") -> DataFrame:
    """SNK-3: same-schema rewrite through one column transform ``fn(col)``;
    all other fields kept."""
    out = df.withColumn(column, fn(F.col(column)))
    _writer(out, fmt, "overwrite").save(path)
    return out


def rewrite_positional(rows: DataFrame, path: str, fn, at: int = 1) -> DataFrame:
    """SNK-3 for rows without header handling (``read_records_positional``):
    field ``at`` through ``fn(col)``, all other fields and short rows as they are.
    Written as CSV lines in ``row_no`` order."""
    new = F.transform("fields", lambda x, i: F.when(i == at, fn(x)).otherwise(x))
    out = rows.withColumn("fields", new)
    quoted = F.transform("fields", lambda x: F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"')))
    out.orderBy("row_no").select(F.array_join(quoted, ",").alias("value")).write.mode("overwrite").text(path)
    return out


def by_subject(rows: DataFrame) -> DataFrame:
    """``rows`` dealt by subject over tasks of bounded size (a large subject over several): a writer
    of a folder a subject sorts all rows of its task."""
    return rows.hint("rebalance", "subject")


def write_by_subject(items: DataFrame, path: str, fmt: str = "json") -> None:
    """CAT-4: one output directory per subject, items as JSON objects.  Dynamic
    partition overwrite: subjects present in this run are replaced, older
    subjects stay."""
    (by_subject(items).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("subject").format(fmt).save(path))


def write_all_subjects(grouped: DataFrame, path: str) -> None:
    """CAT-5: all subjects in one output, which replaces the previous one whole:
    a directory a subject of JSON lines with the in-subject ``ordinal`` (from
    ``group_by_subject``) that orders the subject's list."""
    (by_subject(grouped).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("subject").json(path))


def flat_output_path(base: str) -> str:
    """``<base>_converted.json`` for an input ``<base>.<ext>``."""
    stem = base.rsplit(".", 1)[0] if "." in base.rsplit("/", 1)[-1] else base
    return f"{stem}_converted.json"


def write_flat(items: DataFrame, path: str) -> None:
    """CAT-6: all items in file order (row_no, pos) as JSON lines, items as
    objects; a global sort is a range-partitioned shuffle, files are in order."""
    items.orderBy("row_no", "pos").write.mode("overwrite").json(path)
