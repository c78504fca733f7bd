"""Sharding by a hierarchical weighted hash tree (operator 12).

Shards hang under racks and racks under regions.  A row descends from the root: at
each level every child draws ``-ln(u) / weight``, with ``u`` in (0, 1) hashed from
the row's key and the child's name, and the least draw wins.  A child's weight is
the sum of its shards' weights, so a shard gets rows in proportion to its weight.
A draw depends on the key, the child and its weight alone: when weights change,
draws change only of nodes on the way to a changed shard, and rows move only
into or out of their subtrees.  ``grown`` hangs a new shard into a region of its own:
all old draws stay, and rows move to the new shard only.

The law is ``key``: a row's id and the tree decide, so rows with equal ids
share a shard, reruns and other files agree, and nothing is counted or
shuffled to assign.  Equal texts with different ids are not kept together.

Places inside shards (``slot``) are numbered by id over range partitions of
narrow rows; a shard of any size spreads over many tasks.

Defined results: null ids share a shard (all hash alike) and come first in it; a null
text has size 1 and the crc32 of no bytes, 0, like an empty one; repeated rows get
neighbouring slots; columns of the input are kept in a struct, so names cannot
clash; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardforge.llm.common import materialize, packed
from cardforge.operators.items import ordinals

#: (region, rack, shard, weight)
Leaf = tuple[str, str, int, float]

#: children of a region, and of a rack, in a balanced tree
FAN_OUT = 2


def balanced(shards: int, fan_out: int = FAN_OUT) -> list[Leaf]:
    """Shards of weight 1, ``fan_out`` to a rack and as many racks to a region."""
    return [(f"region{s // fan_out ** 2}", f"rack{s // fan_out}", s, 1.0) for s in range(shards)]


def grown(tree: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """``tree`` with one more shard, in a region of its own."""
    def free(kind: str, taken: set[str]) -> str:
        return next(name for k in range(len(taken) + 1) if (name := f"{kind}{k}") not in taken)

    shard = 1 + max((leaf[2] for leaf in tree), default=-1)
    return [*tree, (free("region", {x[0] for x in tree}), free("rack", {x[1] for x in tree}), shard, weight)]


def draw(key: Column, name: str, weight: float) -> Column:
    """The draw of a child: exponential with rate ``weight``."""
    top = F.shiftrightunsigned(F.xxhash64(F.lit(name), key), 11).cast("double")  # 53 bits
    return -F.log((top + 0.5) / float(1 << 53)) / F.lit(float(weight))


def _least(key: Column, children: list[tuple[str, float, Column]]) -> Column:
    """The value of the child with the least draw (the first name on a tie)."""
    if len(children) == 1:
        return children[0][2]
    picks = F.array_min(F.array(*[F.struct(draw(key, name, weight).alias("draw"), F.lit(k).alias("child"))
                                  for k, (name, weight, _) in enumerate(children)]))["child"]
    out = F.when(picks == 0, children[0][2])
    for k, (_, _, value) in enumerate(children[1:], 1):
        out = out.when(picks == k, value)
    return out


def shard_of(key: Column, tree: list[Leaf]) -> Column:
    """Struct ``(region, rack, shard)`` that ``key`` descends to.  Only the draws
    of the chosen subtree are evaluated."""
    if not tree or any(leaf[3] <= 0 for leaf in tree) or len({leaf[2] for leaf in tree}) < len(tree):
        raise ValueError("a tree needs shards with distinct numbers and positive weights")
    regions: dict[str, dict[str, list[Leaf]]] = defaultdict(lambda: defaultdict(list))
    for leaf in sorted(tree):
        regions[leaf[0]][leaf[1]].append(leaf)

    def weight(leaves) -> float:
        return sum(leaf[3] for leaf in leaves)

    def of_rack(path: str, leaves: list[Leaf]) -> Column:
        return _least(key, [(f"{path}/{shard}", w, F.struct(F.lit(region).alias("region"), F.lit(rack).alias("rack"),
                                                            F.lit(shard).alias("shard"))) for region, rack, shard, w in leaves])

    def of_region(region: str, racks: dict[str, list[Leaf]]) -> Column:
        return _least(key, [(f"{region}/{rack}", weight(leaves), of_rack(f"{region}/{rack}", leaves))
                            for rack, leaves in racks.items()])

    return _least(key, [(region, sum(weight(x) for x in racks.values()), of_region(region, racks))
                        for region, racks in regions.items()])


def assign(docs: DataFrame, tree: list[Leaf], id_col: str = "doc_id") -> DataFrame:
    """``row`` (the columns of ``docs``) and ``place`` ``(region, rack, shard)``; no shuffle."""
    return docs.select(packed(docs), shard_of(F.col(id_col), tree).alias("place"))


def moves(docs: DataFrame, old: list[Leaf], new: list[Leaf], id_col: str = "doc_id") -> DataFrame:
    """``(old, new, n_rows)``: rows of each pair of shards that differ."""
    d = docs.select(shard_of(F.col(id_col), old)["shard"].alias("old"), shard_of(F.col(id_col), new)["shard"].alias("new"))
    return d.where("old <> new").groupBy("old", "new").agg(F.count(F.lit(1)).alias("n_rows"))


def write_shards(docs: DataFrame, path: str, tree: list[Leaf], id_col: str = "doc_id") -> None:
    """The rows as Parquet folders ``region=/rack=/shard=``; each task writes its
    rows of every shard, so nothing is shuffled and no task holds a shard."""
    a = assign(docs, tree, id_col)
    a.select(F.col("place.region").alias("region"), F.col("place.rack").alias("rack"), F.col("place.shard").alias("shard"), "row") \
        .write.partitionBy("region", "rack", "shard").parquet(path)


def shard_table(docs: DataFrame, tree: list[Leaf], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``, one row a
    document: size in UTF-8 bytes plus 1, the crc32 of the text, its shard, its
    place there by id, and its shard with one more in the tree."""
    data = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    key = F.col(id_col)
    rows = docs.select(key.alias("doc_id"), (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
                       shard_of(key, tree)["shard"].alias("shard"), shard_of(key, grown(tree))["shard"].alias("grown_shard"),
                       F.monotonically_increasing_id().alias("tie"))  # spreads many copies of one row over the ranges
    # narrow rows, written once: the bounds of the ranges need them a second time
    placed = ordinals(materialize(rows, "shards"), ["shard"], ["doc_id", "size", "text_crc32", "tie"], "slot")
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("slot") - 1).cast("long").alias("slot"),
                         "grown_shard")
