"""Source divergence audit by frequent-pattern trees of term rows (operator 13).

For each language, how far the use of words differs between its sources, and which
terms each source uses more than its language.  A term's smoothed share of a source
is ``p = 1 + floor(10^9 (count + 2) / (N + 2 V))``; two shares differ by ``f =
floor((p - q)^2 / (p + q))``.  All arithmetic is exact.

The divergence of two sources sums ``f`` over all kept terms, most of which one or
both of them never use.  It is put together from three parts:

* as if neither used any term: ``V f(b_s, b_t)``, ``b`` the share of an unused term;
* for each source alone, what its used terms change while the other's stay unused;
  a source's terms with equal shares are taken together;
* the correction of each term that both use:
  ``f(p_s, p_t) - f(p_s, b_t) - f(b_s, p_t) + f(b_s, b_t)``.

The corrections come from a tree.  A term's row is its sources and shares there,
sources in order of how many terms they use (most first).  Equal rows are counted
once with their multiplicity.  Rows are inserted as paths, so that rows with a
common beginning share nodes; a node counts the terms that pass through it, and each
pair of a node and an ancestor gives one correction times that count, for all rows
that share both.  Rows are dealt by ranges of sorted paths, and sorted rows are
the tree in depth-first order: a row's new nodes are those beyond the beginning
that it shares with the row before.  Counts add up over tasks, so a branch that
many rows share may be cut anywhere.

Words are counted by document in Arrow batches and summed before each shuffle;
after that, rows are (language, source, term) and fewer.  The table of sources is
broadcast up to ``BROADCAST_GROUPS`` rows, else joined by shuffles.

Defined results: null text, lang or source count as ''; a group without terms has
``N = 0``; a language without kept terms gives pairs of value 0 and no terms;
repeated rows count as documents of their own; an empty table gives no rows; the
input's other columns are not read, so names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardforge.llm.common import LOWERED, chunks, mapped_bytes, materialize, text_batches, words_of

#: documents of its language that a term must occur in
LEAST_DOCS = 10
#: terms reported a source
TOP_TERMS = 10
#: groups (language, source) up to which their table is broadcast (some 100 bytes a row)
BROADCAST_GROUPS = 50_000
#: sources of a block, in the join that takes the place of the broadcast
BLOCK = 256
#: path items of one tree
TREE_ITEMS = 1 << 20

#: bytes of terms ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+``, lower-cased; other bytes separate
_TERM_BYTES = LOWERED.copy()
_TERM_BYTES[:128] = [b if chr(b).isalpha() else ord(" ") for b in LOWERED[:128]]


# ---------------------------------------------------------------- counts


def _batch_counts(lang: pa.Array, source: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """A row a (lang, source, term) of some documents: occurrences and documents."""
    words, offsets = words_of(mapped_bytes(pc.fill_null(texts.cast(pa.large_string()), ""), _TERM_BYTES))
    pair = pa.StructArray.from_arrays([lang, source], ["lang", "source"])
    lang_code, source_code = lang.dictionary_encode(), source.dictionary_encode()
    group = np.asarray(lang_code.indices).astype(np.int64) * max(len(source_code.dictionary), 1) + np.asarray(source_code.indices)
    groups, first, group = np.unique(group, return_index=True, return_inverse=True)
    coded = words.dictionary_encode()
    terms, n = coded.dictionary, max(len(coded.dictionary), 1)
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    in_doc, times = np.unique(doc * n + np.asarray(coded.indices), return_counts=True)
    key, back = np.unique(group[in_doc // n] * n + in_doc % n, return_inverse=True)
    # sums of counts of one batch are far below 2^53
    tf = np.bincount(back, weights=times, minlength=len(key)).astype(np.int64)
    of = pair.take(pa.array(first[key // n]))
    return pa.RecordBatch.from_arrays([of.field(0), of.field(1), terms.take(pa.array(key % n)).cast(pa.string()), pa.array(tf),
                                       pa.array(np.bincount(back, minlength=len(key)))], ["lang", "source", "term", "tf", "df"])


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, tf, df)``: occurrences of each term in a group, and
    the group's documents that hold it."""
    text_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for lo, hi in chunks(batch.column(2)):
                yield _batch_counts(*(batch.column(i).slice(lo, hi - lo) for i in range(3)))

    rows = docs.mapInArrow(run, "lang string, source string, term string, tf long, df long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def _share(count: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(10^9 (count + 2) / (total + 2 kept))``; null where there are no kept terms."""
    def exact(c):
        return c.cast("decimal(24,0)")
    ratio = F.call_function("div", (exact(count) + 2) * F.lit(1000000000).cast("decimal(10,0)"), exact(total) + 2 * exact(kept))
    return F.when(kept > 0, ratio + 1)


def difference(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / (p + q))`` of shares (at most 10^9 + 1, so the square fits a long)."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _group_table(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``(lang, source, v, n, base, place)``, one row a group: kept terms of the
    language, occurrences of kept terms in the group, the share of an unused term,
    and the source's place by the number of terms that it uses."""
    used = kept.groupBy("lang", "source").agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("used"))
    vocabulary = kept.groupBy("lang", "term").agg(F.lit(1)).groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    g = docs.select("lang", "source").distinct().join(used, ["lang", "source"], "left").join(vocabulary, "lang", "left")
    g = g.select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("v", "n", "used")])
    order = Window.partitionBy("lang").orderBy(F.desc("used"), "source")
    return g.select("lang", "source", "v", "n", _share(F.lit(0), F.col("n"), F.col("v")).alias("base"),
                    (F.row_number().over(order) - 1).cast("long").alias("place"))


# ---------------------------------------------------------------- tree


def tree_corrections(paths: list[tuple[np.ndarray, np.ndarray, np.ndarray]], lengths: np.ndarray, times: np.ndarray,
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(a, b, value)``, one row a pair of places: the corrections of the tree of
    some sorted paths.  ``paths`` holds flat places, shares and bases, ``lengths``
    the items of each path, ``times`` its multiplicity."""
    place, share, base = paths
    at = np.concatenate(([0], np.cumsum(lengths)))
    begin = at[:-1]
    # items that a row shares with the row before it
    shared = np.zeros(len(lengths), dtype=np.int64)
    going = np.arange(1, len(lengths))
    depth = 0
    while len(going):
        going = going[(lengths[going] > depth) & (lengths[going - 1] > depth)]
        i, j = begin[going] + depth, begin[going - 1] + depth
        going = going[(place[i] == place[j]) & (share[i] == share[j])]
        depth += 1
        shared[going] = depth
    upto = np.concatenate(([0], np.cumsum(times)))
    width = int(place.max()) + 1 if len(place) else 1
    keys, values = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]

    def f(p, q):
        return (p - q) * (p - q) // (p + q)

    for depth in range(1, int(lengths.max()) if len(lengths) else 0):
        first = np.flatnonzero(shared <= depth)  # a node of this depth ends where the next row shares less
        count = np.diff(upto[np.append(first, len(lengths))])
        node = lengths[first] > depth
        first, count = first[node], count[node]
        step = max(1, TREE_ITEMS // depth)
        for lo in range(0, len(first), step):
            row, n = first[lo:lo + step], count[lo:lo + step, None]
            own, above = (begin[row] + depth)[:, None], begin[row][:, None] + np.arange(depth)
            p, q, b, c = share[above], share[own], base[above], base[own]
            value = n * (f(p, q) - f(p, c) - f(b, q) + f(b, c))
            key, back = np.unique((place[above] * width + place[own]).ravel(), return_inverse=True)
            total = np.zeros(len(key), dtype=np.int64)
            np.add.at(total, back.ravel(), value.ravel())
            keys.append(key)
            values.append(total)
    key, back = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(key), dtype=np.int64)
    np.add.at(total, back, np.concatenate(values))
    return key // width, key % width, total


def _corrections(rows: DataFrame) -> DataFrame:
    """``(lang, a, b, value)`` of term rows ``(lang, path, times)``; ``a`` is before ``b``."""
    def build(batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches).combine_chunks()
        langs = table.column(0).combine_chunks().dictionary_encode()
        of = np.asarray(langs.indices)
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(of)) + 1, [len(of)]))
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            lists = table.column(1).chunk(0).slice(lo, hi - lo)
            items = lists.flatten()
            flat = [np.asarray(items.field(i)) for i in range(3)]
            a, b, value = tree_corrections(flat, np.asarray(pc.list_value_length(lists)).astype(np.int64),
                                           np.asarray(table.column(2).chunk(0).slice(lo, hi - lo)))
            lang = pa.array([langs.dictionary[of[lo]].as_py()] * len(a), pa.string())
            yield pa.RecordBatch.from_arrays([lang, pa.array(a), pa.array(b), pa.array(value)], ["lang", "a", "b", "value"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += len(batch.column(1).flatten())
            if size >= TREE_ITEMS:
                yield from build(held)
                held, size = [], 0
        if held:
            yield from build(held)

    ordered = rows.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    return ordered.mapInArrow(run, "lang string, a long, b long, value long")


# ---------------------------------------------------------------- audit


def _small(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def _pairs(items: DataFrame, groups: DataFrame, small: bool) -> DataFrame:
    """``(lang, a, b, value)``, places ``a < b``: the divergence of each pair of sources."""
    paths = items.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("place", "p", "base"))).alias("path"))
    rows = materialize(paths.where(F.size("path") > 1).groupBy("lang", "path").agg(F.count(F.lit(1)).alias("times")), "divergence")
    corrections = _corrections(rows)

    other = groups.select("lang", F.col("place").alias("o"), F.col("base").alias("q"), F.floor(F.col("place") / BLOCK).alias("block"), "v")
    alone = items.groupBy("lang", "place", "p", "base").agg(F.count(F.lit(1)).alias("times"))
    if small:
        met = alone.join(F.broadcast(other), "lang")
    else:  # blocks of sources instead of all of a language at one key
        blocks = groups.groupBy("lang").agg((F.floor(F.max("place") / BLOCK)).alias("last"))
        alone = alone.join(blocks, "lang").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), "last"))).drop("last")
        met = alone.join(other, ["lang", "block"])
    met = met.where("place <> o").select(
        "lang", F.least("place", "o").alias("a"), F.greatest("place", "o").alias("b"),
        (F.col("times") * (difference(F.col("p"), F.col("q")) - difference(F.col("base"), F.col("q")))).alias("value"))

    mine = groups.select("lang", F.col("place").alias("a"), "base")
    unused = mine.join(_small(other, small), "lang").where("a < o").select(
        "lang", "a", F.col("o").alias("b"), F.coalesce(F.col("v") * difference(F.col("base"), F.col("q")), F.lit(0)).cast("long").alias("value"))
    return corrections.union(met).union(unused).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of ``docs(text, lang, source)``.

    Part ``pair``: the divergence from each other source of the language.  Part
    ``term``: the ``top`` terms whose share is above the language's, by difference.
    Ranks by value (descending), then item."""
    d = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
                    F.col("text").cast("string").alias("text"))
    term = Window.partitionBy("lang", "term")
    counts = term_counts(d).withColumn("docs", F.sum("df").over(term)).withColumn("all", F.sum("tf").over(term))
    kept = materialize(counts.where(F.col("docs") >= least_docs).select("lang", "source", "term", "tf", "all"), "divergence")
    groups = materialize(_group_table(d, kept), "divergence")
    small = groups.count() <= BROADCAST_GROUPS
    totals = groups.groupBy("lang").agg(F.sum("n").alias("total"))
    with_total = materialize(groups.join(totals, "lang"), "divergence")
    items = kept.join(_small(with_total, small), ["lang", "source"])
    items = materialize(items.select("lang", "source", "term", "place", "base", _share(F.col("tf"), F.col("n"), F.col("v")).alias("p"),
                                     _share(F.col("all"), F.col("total"), F.col("v")).alias("q")), "divergence")

    pairs = materialize(_pairs(items, groups, small), "divergence")
    both = pairs.union(pairs.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = groups.select("lang", F.col("place").alias("a"), "source")
    others = groups.select("lang", F.col("place").alias("b"), F.col("source").alias("item"))
    pair = both.join(_small(names, small), ["lang", "a"]).join(_small(others, small), ["lang", "b"]).select("lang", "source", "item", "value")

    of = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    above = items.where("p > q").select("lang", "source", F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value"))
    best = above.withColumn("rank", F.row_number().over(of)).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (pair.withColumn("rank", F.row_number().over(of)).withColumn("part", F.lit("pair")).select(*columns)
            .union(best.withColumn("part", F.lit("term")).select(*columns)))
