import math
import zlib
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from cardforge.llm import hash_tree as H
from cardforge.llm.queries import op12_hash_tree

TREE = [("eu", "r1", 0, 1.0), ("eu", "r1", 1, 2.0), ("eu", "r2", 2, 1.0), ("us", "r3", 3, 3.0), ("us", "r3", 4, 1.0)]


def draw(doc_id, name, weight):
    """Spark's xxhash64 of (name, id): seeds are chained, a null leaves the seed."""
    seed = xxhash.xxh64_intdigest(name.encode(), seed=42)
    if doc_id is not None:
        seed = xxhash.xxh64_intdigest((doc_id & (1 << 64) - 1).to_bytes(8, "little"), seed=seed)
    return -math.log(((seed >> 11) + 0.5) / (1 << 53)) / weight


def descend(doc_id, tree):
    regions = {}
    for leaf in sorted(tree):
        regions.setdefault(leaf[0], {}).setdefault(leaf[1], []).append(leaf)

    def least(children):
        return children[0][2] if len(children) == 1 else min(children, key=lambda c: draw(doc_id, c[0], c[1]))[2]

    region, racks = least([(r, sum(x[3] for v in racks.values() for x in v), (r, racks)) for r, racks in regions.items()])
    rack, leaves = least([(f"{region}/{r}", sum(x[3] for x in v), (r, v)) for r, v in racks.items()])
    return least([(f"{region}/{rack}/{x[2]}", x[3], (region, rack, x[2])) for x in leaves])


def placed(spark, ids, tree):
    d = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    return {r.doc_id: tuple(r.p) for r in d.select("doc_id", H.shard_of(F.col("doc_id"), tree).alias("p")).collect()}


def test_descent_against_brute_force(spark):
    ids = [None, -1, 0, *range(1, 2000), 2 ** 62]
    for tree in (TREE, H.balanced(8), H.grown(TREE), H.balanced(1)):
        assert placed(spark, ids, tree) == {i: descend(i, tree) for i in ids}


def test_rows_follow_weights(spark):
    n = 40_000
    got = Counter(p[2] for p in placed(spark, range(n), TREE).values())
    for _, _, shard, weight in TREE:
        share = weight / 8
        assert abs(got[shard] - n * share) < 5 * math.sqrt(n * share * (1 - share))


def test_growth_moves_rows_into_the_new_shard_only(spark):
    docs = spark.range(20_000).withColumnRenamed("id", "doc_id")
    tree = H.balanced(8)
    for _ in range(3):
        new = H.grown(tree)
        moved = H.moves(docs, tree, new).collect()
        assert {r.new for r in moved} == {max(x[2] for x in new)}
        assert abs(sum(r.n_rows for r in moved) - 20_000 / len(new)) < 5 * math.sqrt(20_000 / len(new))
        tree = new
    assert H.grown(H.balanced(8)) == H.balanced(9)


def test_a_changed_weight_moves_rows_of_its_subtree_only(spark):
    new = [(*leaf[:3], 5.0 if leaf[2] == 1 else leaf[3]) for leaf in TREE]
    before, after = placed(spark, range(20_000), TREE), placed(spark, range(20_000), new)
    moved = {(before[i], after[i]) for i in before if before[i] != after[i]}
    # a heavier subtree only takes: rows enter the region, the rack inside it, the shard inside that
    assert moved and all(b[0] != a[0] == "eu" or b[1] != a[1] == "r1" or (b[1] == a[1] == "r1" and a[2] == 1) for b, a in moved)


def expected(rows, tree):
    out = []
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        out.append((doc_id, len(data) + 1, zlib.crc32(data), "key", descend(doc_id, tree)[2], descend(doc_id, H.grown(tree))[2]))
    return out


def check_table(rows, got, tree):
    plain = [(r.doc_id, r["size"], r.text_crc32, r.law, r.shard, r.grown_shard) for r in got]
    assert Counter(plain) == Counter(expected(rows, tree))
    for shard in {r.shard for r in got}:
        inside = sorted((r.slot, r.doc_id is not None, r.doc_id or 0) for r in got if r.shard == shard)
        assert [x[0] for x in inside] == list(range(len(inside)))
        assert [x[1:] for x in inside] == sorted(x[1:] for x in inside)


def test_table_of_edge_rows(edge_docs, edge_rows, no_docs):
    check_table(edge_rows, H.shard_table(edge_docs, H.balanced(8)).collect(), H.balanced(8))
    check_table(edge_rows, H.shard_table(edge_docs, TREE).collect(), TREE)
    assert H.shard_table(no_docs, TREE).count() == 0


def test_whole_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = op12_hash_tree(spark, sf)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    check_table(rows, got.collect(), H.balanced(8))


def test_many_copies_of_one_row(spark):
    docs = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("doc_id"), F.lit("copy").alias("text"))
    got = H.shard_table(docs, H.balanced(4)).collect()
    check_table([(r, "copy") for r in [None] * 2000 + list(range(0, 3000, 3))], got, H.balanced(4))


def test_written_shards(spark, edge_docs, edge_rows, tmp_path):
    H.write_shards(edge_docs, str(tmp_path / "out"), TREE)
    got = spark.read.parquet(str(tmp_path / "out")).select("row.doc_id", "region", "rack", "shard").collect()
    assert Counter(tuple(r) for r in got) == Counter((r[0], *descend(r[0], TREE)) for r in edge_rows)
