"""CSV rows by parallel line splits (SRC-2, SRC-3).

A quoted field may hold line breaks, so whether a line begins a record depends on
all lines before it.  That is a prefix scan over two states (inside a quoted field or
not): each line maps the state before it to the state after it, and is one of four
maps: to either state, the same, or the other one.  Lines are read in splits; maps
are composed inside each split by windows, over splits by one row a split, and
every line learns the state before it.  A file of any size is read by many tasks.

Fields follow the usual rules: separated by commas; one that begins with a quote
ends with it, ``""`` inside stands for a quote, text after the closing quote is
appended; a quote elsewhere is text.  Records end at a line feed (with or without a
carriage return before it) outside quotes; an unclosed quote ends with its file;
blank lines are no records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardforge.functions._col import let
from cardforge.session import materialize

_INSIDE = r'(?:[^"]++|"")*+'
_FIELD = rf'(?:[^",][^,]*+|"{_INSIDE}"[^,]*+)?+'
# a rest of a line, from the start of a field, that ends inside quotes
_OPENS = rf'(?:{_FIELD},)*+"{_INSIDE}'
#: lines that end inside quotes if they begin outside, and if they begin inside
FROM_OUTSIDE, FROM_INSIDE = rf"^{_OPENS}\z", rf'^{_INSIDE}(?:"[^,]*+,{_OPENS})?\z'


def fields_of(record: Column) -> Column:
    """``array<string>`` of the fields of a whole record."""
    def unquoted(raw):
        text = F.replace(F.regexp_extract(raw, rf'^"({_INSIDE})"', 1), F.lit('""'), F.lit('"'))
        return F.when(raw.startswith('"'), F.concat(text, F.regexp_extract(raw, rf'(?s)^"{_INSIDE}"(.*)\z', 1))).otherwise(raw)
    return F.transform(F.regexp_extract_all(F.concat(record, F.lit(",")), F.lit(f"({_FIELD}),"), 1), unquoted)


def _composed(rows: DataFrame, window, maps: tuple[Column, Column]) -> DataFrame:
    """Adds ``fixed`` (0, 1, or null) and ``odd``: the state after the rows up to each one
    is ``fixed``, or if null that before them, turned round if ``odd``.

    ``maps`` are the states (0 outside, 1 inside) that a row gives after either."""
    a, b = maps
    rows = rows.withColumn("_turns", F.sum(F.when((a == 1) & (b == 0), 1).otherwise(0)).over(window))
    last = F.last(F.when(a == b, F.struct(a.alias("to"), F.col("_turns").alias("turns"))), ignorenulls=True).over(window)
    rows = rows.withColumn("_last", last)
    fixed = F.when(F.col("_last").isNotNull(), (F.col("_last.to") + F.col("_turns") - F.col("_last.turns")) % 2)
    return rows.withColumns({"fixed": fixed, "odd": F.col("_turns") % 2}).drop("_turns", "_last")


def _after(before: Column) -> Column:
    return F.coalesce(F.col("fixed"), (before + F.col("odd")) % 2)


def read_csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """``(row_no, file, line, fields)`` of all CSV files under ``path``: every
    field of every row, whatever their number, an empty field as ''.  ``line`` counts
    the rows of a file from 0; ``row_no`` counts over files in order of their paths,
    without gaps."""
    text = spark.read.text(path, lineSep="\n")
    lines = materialize(text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value",
        F.col("value").rlike(FROM_OUTSIDE).cast("int").alias("a"), F.col("value").rlike(FROM_INSIDE).cast("int").alias("b")), "csv-lines")

    split = Window.partitionBy("file", "block").orderBy("at")
    lines = _composed(lines, split.rowsBetween(Window.unboundedPreceding, 0), (F.col("a"), F.col("b")))
    # one row a split: its map, and from that of those before it the state that it begins in
    splits = lines.groupBy("file", "block").agg(F.max_by(F.struct("fixed", "odd"), "at").alias("m"))
    outside, inside = F.coalesce("m.fixed", "m.odd"), F.coalesce("m.fixed", 1 - F.col("m.odd"))
    before = Window.partitionBy("file").orderBy("block")
    splits = _composed(splits.withColumns({"sa": outside, "sb": inside}), before.rowsBetween(Window.unboundedPreceding, 0), (F.col("sa"), F.col("sb")))
    splits = splits.select("file", "block", F.coalesce(F.lag(_after(F.lit(0))).over(before), F.lit(0)).alias("begin"))
    lines = lines.join(splits, ["file", "block"]).withColumn("after", _after(F.col("begin")))
    lines = lines.withColumn("opens", F.coalesce(F.lag("after").over(split), F.col("begin")) == 0)
    lines = lines.withColumn("top", F.last(F.when(F.col("opens"), F.struct("block", "at")), ignorenulls=True)
                             .over(split.rowsBetween(Window.unboundedPreceding, 0)))
    lines = materialize(lines.select("file", "block", "at", "value", "after", "opens", "top"), "csv-lines")
    # a record that began in an earlier split
    tops = lines.groupBy("file", "block").agg(F.max("top").alias("top"))
    carried = tops.select("file", "block", F.last("top", ignorenulls=True).over(before.rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))

    whole = F.col("opens") & (F.col("after") == 0)
    one = lines.where(whole).select("file", "block", "at", "value", "after")
    many = lines.where(~whole).join(carried, ["file", "block"]).withColumn("top", F.coalesce("top", "carried"))
    many = many.groupBy("file", "top").agg(F.sort_array(F.collect_list(F.struct("block", "at", "value", "after"))).alias("parts"))
    many = many.select("file", "top.block", "top.at", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"),
                       F.element_at("parts", -1)["after"].alias("after"))
    record = F.when(F.col("after") == 1, F.concat("value", F.lit('"'))).otherwise(F.regexp_replace("value", r"\r\z", ""))
    records = one.union(many).select("file", "block", "at", record.alias("record")).where("record <> ''")
    records = materialize(records.select("file", "block", "at", fields_of(F.col("record")).alias("fields")), "csv-rows")

    # places: inside a split by a window, over splits by one row each
    sizes = records.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    all_before = F.sum("n").over(Window.orderBy("file", "block")) - F.col("n")
    in_file = F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")
    starts = sizes.select("file", "block", all_before.alias("_all"), in_file.alias("_file"))
    placed = records.withColumn("_at", F.row_number().over(split) - 1).join(starts, ["file", "block"])
    return placed.select((F.col("_all") + F.col("_at")).alias("row_no"), "file", (F.col("_file") + F.col("_at")).alias("line"), "fields")
