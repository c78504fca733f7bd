"""Sources (SRC-1 .. SRC-5).

Fetching is re-aimed as reading a page snapshot; record files are CSV (the
import format) or Parquet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardforge.functions.text import is_blank
from cardforge.session import materialize
from cardforge.sources.csv_rows import read_csv_rows

#: different column names of all header lines together
MOST_COLUMNS = 10_000


def read_pages(spark: SparkSession, path: str, urls: DataFrame | None = None) -> DataFrame:
    """SRC-1: ``pages(page_id, url, html)``.  With a URL list, only the
    listed URLs that the snapshot holds are returned (a page that cannot be
    fetched yields no row); column pruning and filters reach the scan."""
    pages = spark.read.parquet(path)
    if urls is None:
        return pages
    listed = urls.select("url").distinct()
    j = listed.join(pages, "url", "left")
    return j.filter(F.col("html").isNotNull()).select("page_id", "url", "html")


def _apart(names: list[str], taken: set[str]) -> list[str]:
    """Output names that differ also without regard to case: a clash gets ``_2``, ``_3``, ..."""
    out = []
    for name in names:
        new, k = name, 1
        while new.lower() in taken:
            k += 1
            new = f"{name}_{k}"
        taken.add(new.lower())
        out.append(new)
    return out


def read_records(spark: SparkSession, path: str, columns: tuple[str, ...] = ("url", "concept_and_mnemonic")
                 ) -> DataFrame:
    """SRC-2: CSV with a header line in each file: ``row_no``, ``columns``, then
    every other column of any file.  Fields are found by the header of their own
    file, so column order may differ between files; a column that a file or a
    short row lacks is null.  Fields beyond the header are dropped.

    A name that a header has twice means its last field.  Names that clash with
    ``row_no``, ``columns`` or each other (names of a table do not differ by case) get
    ``_2``, ``_3``, ... in order of code points."""
    rows = read_csv_rows(spark, path)
    heads = materialize(rows.where("line = 0").select(F.col("file").alias("f"), F.col("fields").alias("head")), "csv-heads")
    # the columns of the result, so the driver must know them
    found = [r["c"] for r in heads.select(F.explode("head").alias("c")).distinct().orderBy("c").limit(MOST_COLUMNS + 1).collect()]
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} different column names")
    names = list(dict.fromkeys([*columns, *found]))
    j = rows.where("line > 0").join(heads, F.col("file") == F.col("f"))

    def field(name: str) -> Column:
        from_end = F.array_position(F.reverse("head"), F.lit(name))
        return F.when(from_end > 0, F.get("fields", (F.size("head") - from_end).cast("int")))

    return j.select("row_no", *[field(c).alias(out) for c, out in zip(names, _apart(names, {"row_no"}))])


def read_records_positional(spark: SparkSession, path: str) -> DataFrame:
    """SRC-3: no header handling - a header line is a data row; rows may have
    fewer or more than two fields, all of which are kept:
    ``(row_no, n_fields, fields, _c0, _c1)`` (the first two, null if absent)."""
    rows = read_csv_rows(spark, path)
    return rows.select("row_no", F.size("fields").alias("n_fields"), "fields", F.get("fields", 0).alias("_c0"), F.get("fields", 1).alias("_c1"))


def enumerate_urls(spans: DataFrame, template: str, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """SRC-4: for every row, URLs ``template % n`` for n in [lo, hi)
    (upper bound exclusive): ``(*row columns, n, url)``.  The template uses
    ``%s`` / ``%d`` placeholders (``format_string``); extra row columns can be
    placed with further placeholders via ``args``."""
    rows = spans.withColumn("n", F.explode(F.sequence(F.col(lo), F.col(hi) - 1)))
    rows = rows.filter(F.col(hi) > F.col(lo))
    return rows.withColumn("url", F.format_string(template, F.col("n")))


def url_range(spark: SparkSession, template: str, lo: int, hi: int) -> DataFrame:
    """SRC-4 for one literal range (``?p={n}`` for n in 2..26 is
    ``url_range(spark, '...?p=%d', 2, 27)``)."""
    return spark.range(lo, hi).select(F.col("id").alias("n"), F.format_string(template, F.col("id")).alias("url"))


def read_done_urls(spark: SparkSession, path: str | None, fmt: str = "parquet") -> DataFrame:
    """SRC-5: the resume set - distinct non-null ``url`` of a previous
    output; a missing or unreadable output is an empty set."""
    empty = spark.createDataFrame([], "url string")
    if not path:
        return empty
    try:
        reader = spark.read.option("header", True) if fmt == "csv" else spark.read
        prior = reader.format(fmt).load(path)
        if "url" not in prior.columns:
            return empty
    except Exception:  # noqa: BLE001 - unreadable output = nothing done yet
        return empty
    return done_urls(prior)


def done_urls(prior: DataFrame) -> DataFrame:
    """SRC-5 on a DataFrame: distinct non-null, non-blank ``url``."""
    return prior.select("url").filter(~is_blank(F.col("url"))).distinct()
