"""Records -> items: validation, parsing, flattening, numbering
(JSN-5 .. JSN-10, EXT-3, NUM-1).

A *record* is ``(row_no, url, concept_and_mnemonic)``: model output, JSON in a
Markdown fence.  An *item* is one JSON object of that output, carried as a
VARIANT so unknown keys survive, with a typed view for the known ones.

Parsing follows Python's ``json.loads``: the cleaned text is wrapped in
``[ ... ]`` and must parse to an array of exactly one value, which rejects
trailing junk ("[1] x", "[1],[2]") and empty text.  NaN / Infinity are
rejected (they are not JSON).  Duplicate keys resolve last-wins when
``spark.sql.variant.allowDuplicateKeys`` is set (see ``session.DEFAULT_CONF``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardforge.functions._col import as_col, let
from cardforge.functions.fences import strip_fence, wrap_fence
from cardforge.functions.text import is_blank, strip_ws
from cardforge.session import materialize

TEXT = "concept_and_mnemonic"


def try_parse_value(text) -> Column:
    """VARIANT of the JSON text, or null when it is not exactly one JSON value.

    The text wrapped in ``[...]`` must parse to one element.  The parser ignores what follows
    a text that closes the wrapper early (``1]x``); such a text does not parse
    inside ``{"v":...}``, as its first closing bracket too many is no ``}``."""
    def parse(t):
        arr = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), t, F.lit("]"))), "$", "array<variant>")
        sound = F.try_parse_json(F.concat(F.lit('{"v":'), t, F.lit("}"))).isNotNull()
        return let(arr, lambda a: F.when((F.size(a) == 1) & sound, a[0]))
    return let(as_col(text), parse)


def is_json_array(v) -> Column:
    return F.try_variant_get(as_col(v), "$", "array<variant>").isNotNull()


def is_json_object(v) -> Column:
    return F.coalesce(F.schema_of_variant(as_col(v)).startswith("OBJECT"), F.lit(False))


def as_item_array(v) -> Column:
    """JSN-6: an array gives its elements; any other value a one-element list."""
    col = as_col(v)
    return F.coalesce(F.try_variant_get(col, "$", "array<variant>"), F.array(col))


def drop_incomplete(records: DataFrame, url_col: str = "url", text_col: str = TEXT) -> tuple[DataFrame, DataFrame]:
    """JSN-7: strip both columns; rows where either is empty (or null) are
    skipped and reported.  Returns (kept, rejects)."""
    trimmed = records.withColumn(url_col, strip_ws(F.col(url_col))).withColumn(text_col, strip_ws(F.col(text_col)))
    missing = F.coalesce(F.col(url_col) == "", F.lit(True)) | F.coalesce(F.col(text_col) == "", F.lit(True))
    rejects = records.filter(is_blank(F.col(url_col)) | is_blank(F.col(text_col))).select(
        "row_no", F.col(url_col).alias("url"), F.col(text_col).alias("raw"), F.lit("missing").alias("reason"))
    return trimmed.filter(~missing), rejects


def parse_items(records: DataFrame, mode: str = "strict", text_col: str = TEXT) -> tuple[DataFrame, DataFrame]:
    """JSN-5: clean the fence (``mode``) and parse.  Returns
    ``(parsed, rejects)``: parsed rows gain ``value`` (VARIANT); rejects are
    ``(row_no, url, raw, reason='invalid_json')``.  A reject does not stop the
    batch.  The parsed table is written once and both results read it."""
    withv = materialize(records.withColumn("value", try_parse_value(strip_fence(F.col(text_col), mode))), "parsed")
    rejects = withv.filter(F.col("value").isNull()).select(
        "row_no", "url", F.col(text_col).alias("raw"), F.lit("invalid_json").alias("reason"))
    return withv.filter(F.col("value").isNotNull()), rejects


def explode_items(parsed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """JSN-8: one row per item ``(row_no, pos, item, ...)``, arrays flattened
    and objects kept as one item; empty arrays give no rows."""
    keep = keep or ["url"]
    return parsed.select("row_no", *keep, F.posexplode(as_item_array(F.col("value"))).alias("pos", "item"))


def records_to_items(records: DataFrame, mode: str = "strict", text_col: str = TEXT) -> tuple[DataFrame, DataFrame]:
    """JSN-7 -> JSN-5 -> JSN-6/8 as one call: ``(items, rejects)``.  Each record
    is cleaned and parsed once."""
    kept, missing = drop_incomplete(records, text_col=text_col)
    parsed, bad = parse_items(kept, mode, text_col)
    return explode_items(parsed), missing.unionByName(bad)


# The item keys of the extraction templates and their aliases.
TERM_KEYS = ("term", "name", "concept")
STRING_FIELDS = ("definition", "mnemonic", "image", "question")


def item_field(item, key: str, typ: str = "string") -> Column:
    return F.try_variant_get(as_col(item), f"$.{key}", typ)


def harmonise_items(items: DataFrame, item_col: str = "item") -> DataFrame:
    """EXT-3: the typed view over the item shapes ({term, definition,
    mnemonic, image, keywords}, {name, mnemonic}, {concept, definition,
    mnemonic}): term = coalesce(term, name, concept); absent fields null;
    non-objects give all nulls."""
    it = F.col(item_col)  # of a value that is no object every field is null
    cols = [F.coalesce(*[item_field(it, k) for k in TERM_KEYS]).alias("term")]
    cols += [item_field(it, k).alias(k) for k in STRING_FIELDS]
    cols += [item_field(it, "keywords", "array<string>").alias("keywords"), item_field(it, "count", "bigint").alias("count")]
    return items.select("*", *cols)


def ordered_items_json(item_col: str = "item", pos_col: str = "pos") -> Column:
    """Aggregate: JSON array text of a group's items in ``pos`` order."""
    pieces = F.array_sort(F.collect_list(F.struct(F.col(pos_col).alias("p"), F.to_json(item_col).alias("j"))))
    return F.concat(F.lit("["), F.array_join(F.transform(pieces, lambda x: x["j"]), ","), F.lit("]"))


def rewrap(arr_json) -> Column:
    """JSN-9: back to a ```json fenced block.  Layout differs from an
    indent-4 dump; compare parsed values, not bytes."""
    return wrap_fence(as_col(arr_json))


def validity_report(records: DataFrame, text_col: str = TEXT) -> DataFrame:
    """JSN-10: clean with the ``collapse`` rule, check validity, keep every
    row: ``(row_no, url, cleaned, is_valid)``."""
    cleaned = strip_fence(F.col(text_col), "collapse")
    return records.select("row_no", "url", cleaned.alias("cleaned"),
                          try_parse_value(cleaned).isNotNull().alias("is_valid"))


# ---------------------------------------------------------------- NUM-1

_LOW = (1 << 33) - 1


def _placed(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` sorted over range partitions and written once, with ``_part`` (the
    partition's place) and ``_at`` (the row's place in it).  Bounds follow the data: any spacing of keys gives even parts, and
    a key that holds most rows spreads over many."""
    p = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    p = materialize(p, "ordered")
    return p.withColumn("_part", F.shiftright("_id", 33)).withColumn("_at", F.col("_id").bitwiseAND(F.lit(_LOW))).drop("_id")


def ordinals(df: DataFrame, keys: list[str], order: list[str], name: str = "ordinal") -> DataFrame:
    """``df`` with its 1-based place by ``order`` within ``keys``.  One range
    shuffle; windows run over one row a partition, and over nothing else."""
    p = _placed(df, [*keys, *order])
    sizes = p.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"))
    ranked = p.join(before, "_part").withColumn("_rank", F.col("_before") + F.col("_at"))
    if keys:
        start = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
        base = ranked.groupBy(*start).agg(F.min("_rank").alias("_base"))
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        ranked = ranked.join(base, same).withColumn("_rank", F.col("_rank") - F.col("_base")).drop("_base", *[f"_k{i}" for i in range(len(keys))])
    return ranked.withColumn(name, F.col("_rank") + 1).drop("_rank", "_before", "_part", "_at")


def prefix_offsets(df: DataFrame, order_col: str, n_col: str) -> DataFrame:
    """``(order_col, offset)``: the exclusive running sum of ``n_col`` in order of
    the unique ``order_col``.  Running sums are taken inside range partitions, and
    over the totals of the partitions."""
    p = _placed(df.select(order_col, n_col), [order_col])
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    totals = p.groupBy("_part").agg(F.sum(n_col).alias("n"))
    before = totals.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"))
    p = p.withColumn("_inside", F.coalesce(F.sum(n_col).over(inside), F.lit(0))).join(before, "_part")
    return p.select(order_col, (F.col("_before") + F.col("_inside")).cast("long").alias("offset"))


def number_items(records: DataFrame, mode: str = "symmetric", text_col: str = TEXT) -> tuple[DataFrame, DataFrame]:
    """NUM-1: number every object item 1..N over rows in ``row_no`` order,
    then item order.

    * rows whose JSON is an array: each object item gets ``count``; the row
      text is rewritten (fenced) with the numbers; non-object elements get no
      number and stay as they are
    * rows whose JSON is a bare object (or scalar): dropped and reported
    * unparseable rows: kept untouched, no numbers

    Returns ``(rows, items)``: rows ``(row_no, url, concept_and_mnemonic)``
    and items ``(row_no, pos, count)`` for the numbered items.  Each record is
    parsed once (the parsed table is written).
    """
    v = try_parse_value(strip_fence(F.col(text_col), mode))
    r = records.select("row_no", "url", F.col(text_col).alias("text"), v.alias("value"))
    is_list = is_json_array(F.col("value"))
    arr = F.when(is_list, F.try_variant_get(F.col("value"), "$", "array<variant>"))
    # places of the elements that are no objects: few or none
    other = F.filter(F.transform(F.col("arr"), lambda x, i: F.when(~is_json_object(x), i)), lambda i: i.isNotNull())
    r = r.select("row_no", "url", "text", is_list.alias("is_list"), F.col("value").isNull().alias("bad"), arr.alias("arr"))
    r = materialize(r.withColumn("other", other), "parsed").where("bad or is_list")
    n = r.select("row_no", F.when(F.col("is_list"), F.size("arr") - F.size("other")).otherwise(0).alias("n"))
    numbered = r.join(prefix_offsets(n, "row_no", "n"), "row_no")

    def number(i):
        return F.when(~F.array_contains("other", i), F.col("offset") + i + 1 - F.size(F.filter("other", lambda o: o < i)))

    counted = F.transform(F.col("arr"), lambda x, i: F.when(is_json_object(x), _with_key(x, "count", number(i))).otherwise(x))
    new_text = F.when(F.col("is_list"), rewrap(F.to_json(counted))).otherwise(F.col("text"))
    rows = numbered.select("row_no", "url", new_text.alias(text_col))
    counts = F.transform(F.sequence(F.lit(0), F.size("arr") - 1), lambda i: F.struct(i.alias("pos"), number(i).alias("count")))
    items = (numbered.where("is_list and size(arr) > 0").select("row_no", F.explode(counts).alias("c"))
             .where("c.count is not null").select("row_no", "c.pos", "c.count"))
    return rows, items


def _with_key(obj: Column, key: str, value: Column) -> Column:
    """The VARIANT object with ``key`` set to ``value`` (replaced when present)."""
    m = F.try_variant_get(obj, "$", "map<string,variant>")
    addition = F.try_variant_get(F.to_variant_object(F.struct(value.alias(key))), f"$.{key}", "variant")
    merged = F.map_concat(F.map_filter(m, lambda k, _: k != key), F.create_map(F.lit(key), addition))
    return F.to_variant_object(merged)


def with_key(obj, key: str, value) -> Column:
    return _with_key(as_col(obj), key, as_col(value))


def dropped_bare_objects(records: DataFrame, mode: str = "symmetric", text_col: str = TEXT) -> DataFrame:
    """Rows NUM-1 drops (valid JSON that is not an array), as rejects."""
    v = try_parse_value(strip_fence(F.col(text_col), mode))
    return records.filter(v.isNotNull() & ~is_json_array(v)).select(
        "row_no", "url", F.col(text_col).alias("raw"), F.lit("not_a_list").alias("reason"))
