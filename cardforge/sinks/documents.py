"""One JSON document from parallel parts (CAT-5, CAT-6).

The parts of a document are text files whose contents, put together in order of
their names, are one valid JSON value: ``{"subject": [item, ...], ...}`` or
``[item, ...]``.  Each row is written with the punctuation before and after it,
which follows from its place alone: the first item of a subject opens the list, the
last one closes it, the first and last row of all open and close the document.  So
rows are sorted over range partitions and every task writes its own part; no task
holds a subject, and a subject of any size spreads over many parts.

Beside the parts lie two small tables, ``_parts`` (byte range of each file in the
whole) and ``_subjects`` (byte range of each ``"subject": [...]``), by which one
subject can be fetched without reading the rest.

Defined results: no items give ``{}`` or ``[]``; a null subject is the key
``unknown``; equal places keep one line each; a previous document is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardforge.operators.items import ordinals, prefix_offsets
from cardforge.session import materialize

PARTS, SUBJECTS = "_parts", "_subjects"


def _quoted(text: Column) -> Column:
    """``text`` as a JSON string."""
    listed = F.to_json(F.array(text))
    return F.substr(listed, F.lit(2), F.length(listed) - 2)


def _write_lines(lines: DataFrame, order: list[str], path: str, empty: str) -> DataFrame:
    """Writes ``piece`` of each row in order, or ``empty`` if there are no rows, and
    the table of parts; returns it."""
    spark = lines.sparkSession
    none = lines.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit(empty).alias("piece"))
    text = lines.orderBy(*order).select(F.col("piece").alias("value"))
    # the union keeps the parts' order: the one row comes only when there is no other
    text.union(none).write.mode("overwrite").text(path)
    written = spark.read.text(path, lineSep="\n", pathGlobFilter="part-*")
    parts = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.sum(F.octet_length("value") + 1).alias("bytes"), F.count(F.lit(1)).alias("lines"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    parts = parts.select("file", F.coalesce(F.sum("bytes").over(before), F.lit(0)).cast("long").alias("start"), "bytes", "lines")
    parts.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{PARTS}")
    return spark.read.parquet(f"{path.rstrip('/')}/{PARTS}")


def write_subjects_document(grouped: DataFrame, path: str, item: str = "item") -> None:
    """CAT-5: ``grouped(subject, ordinal, item)`` (see ``group_by_subject``) as one
    document, a list of items a subject; subjects in order, items by ``ordinal``."""
    rows = grouped.select(F.coalesce(F.col("subject").cast("string"), F.lit("unknown")).alias("subject"), "ordinal",
                          F.to_json(F.col(item)).alias("json"))
    # places counted anew: equal or missing ordinals still give each row one place
    rows = materialize(ordinals(rows, ["subject"], ["ordinal", "json"], "place"), "document")
    sizes = materialize(rows.groupBy("subject").agg(F.max("place").alias("n"), F.sum(F.octet_length("json")).alias("json_bytes")), "document")
    ends = sizes.agg(F.min("subject").alias("first"), F.max("subject").alias("last"))  # one row
    rows = rows.join(sizes.select("subject", "n"), "subject").join(F.broadcast(ends))
    opening = F.concat(F.when(F.col("subject") == F.col("first"), "{").otherwise(","), _quoted(F.col("subject")), F.lit(":["))
    closing = F.concat(F.lit("]"), F.when(F.col("subject") == F.col("last"), "}").otherwise(""))
    piece = F.concat(F.when(F.col("place") == 1, opening).otherwise(F.lit(",")), F.col("json"),
                     F.when(F.col("place") == F.col("n"), closing).otherwise(F.lit("")))
    _write_lines(rows.select("subject", "place", piece.alias("piece")), ["subject", "place"], path, "{}")

    # bytes of a subject's lines: an opening brace or comma, key, colon and bracket, the items, the commas and line
    # feeds between them, a bracket (the last one: and a brace), a line feed
    key = F.octet_length(_quoted(F.col("subject")))
    sized = sizes.join(F.broadcast(ends)).select(
        "subject", "n", (key + 2 + F.col("json_bytes") + 2 * (F.col("n") - 1) + 1).alias("bytes"),
        (F.when(F.col("subject") == F.col("last"), 1).otherwise(0) + 2).alias("around"))
    sized = materialize(sized.withColumn("lines", F.col("bytes") + F.col("around")), "document")
    ranges = sized.join(prefix_offsets(sized, "subject", "lines"), "subject")
    (ranges.select("subject", (F.col("offset") + 1).alias("start"), "bytes", F.col("n").alias("items"))
     .write.mode("overwrite").parquet(f"{path.rstrip('/')}/{SUBJECTS}"))


def write_flat_document(items: DataFrame, path: str, item: str = "item") -> None:
    """CAT-6: all items of ``items(row_no, pos, item)`` in file order as one array."""
    rows = ordinals(items.select("row_no", "pos", F.to_json(F.col(item)).alias("json")), [], ["row_no", "pos", "json"], "place")
    rows = materialize(rows, "document")
    total = rows.agg(F.max("place").alias("n"))  # one row
    piece = F.concat(F.when(F.col("place") == 1, "[").otherwise(","), F.col("json"), F.when(F.col("place") == F.col("n"), "]").otherwise(""))
    _write_lines(rows.join(F.broadcast(total)).select("place", piece.alias("piece")), ["place"], path, "[]")


def document_parts(spark: SparkSession, path: str) -> DataFrame:
    """``(file, start, bytes, lines)``: the byte range of each part in the document."""
    return spark.read.parquet(f"{path.rstrip('/')}/{PARTS}")


def document_subjects(spark: SparkSession, path: str) -> DataFrame:
    """``(subject, start, bytes, items)``: the bytes ``"subject":[...]`` of each subject."""
    return spark.read.parquet(f"{path.rstrip('/')}/{SUBJECTS}")


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """``(subject, ordinal, json)`` of a document written by this module (``subject``
    is null for an array).  Lines are read in splits; the subject of a line is that
    of the last opening at or before it, found inside each split and carried over
    from the splits before by one row a split."""
    lines = spark.read.text(path, lineSep="\n", pathGlobFilter="part-*").select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value").where(~F.col("value").isin("{}", "[]"))
    opened = F.regexp_extract("value", r'^[{,]("(?:[^"\\]++|\\.)*+"):\[', 1)
    opened = F.when(opened != "", opened)
    lines = materialize(lines.select("file", "block", "at", "value", opened.alias("opened")), "document-lines")
    split = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    inside = lines.withColumn("key", F.last("opened", ignorenulls=True).over(split))
    tops = lines.groupBy("file", "block").agg(F.max_by("opened", F.when(F.col("opened").isNotNull(), F.col("at"))).alias("last"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)  # a row a split
    carried = tops.select("file", "block", F.last("last", ignorenulls=True).over(before).alias("carried"))
    d = inside.join(carried, ["file", "block"]).withColumn("key", F.coalesce("key", "carried"))
    body = F.substr("value", F.when(F.col("opened").isNotNull(), F.length("opened") + 4).otherwise(F.lit(2)))
    # an item is an object, array or scalar; what follows it closes the list or the document
    closing = F.when(F.col("key").isNotNull(), F.regexp_replace("body", r"\]\}?$", "")).otherwise(F.regexp_replace("body", r"\]$", ""))
    d = d.withColumn("body", body)
    d = d.withColumn("next", F.lead(F.coalesce("opened", F.lit(""))).over(Window.partitionBy("file", "block").orderBy("at")))
    firsts = lines.groupBy("file", "block").agg(F.min_by(F.coalesce("opened", F.lit("")), "at").alias("first"))
    after = firsts.select("file", "block", F.lead("first").over(Window.orderBy("file", "block")).alias("after"))
    d = d.join(after, ["file", "block"]).withColumn("next", F.coalesce("next", "after"))
    ends = F.col("next").isNull() | (F.col("next") != "")  # the last line of a subject, or of all
    d = d.select("file", "block", "at", F.get(F.from_json(F.concat(F.lit("["), "key", F.lit("]")), "array<string>"), 0).alias("subject"),
                 F.when(ends, closing).otherwise(F.col("body")).alias("json"))
    return ordinals(d, ["subject"], ["file", "block", "at"]).select("subject", "ordinal", "json")
