"""Near-duplicate embeddings by a subspace pigeonhole join (operator 10).

cosine >= c of two vectors means a squared distance of at most 2 (1 - c) of
their unit vectors.  A fixed rotation spreads that over ``BLOCKS`` blocks of
dimensions, so some block holds at most its proportional share of the budget.
In each block a range join finds all pairs within that radius: space is cut by
a k-d tree into leaves; a vector lives in one leaf and is sent to the later
leaves that its ball touches.  Leaves larger than a tile are dealt into slots
whose pairs are separate tiles, so no task holds an unbounded leaf.

A tile compares blocks first and verifies the survivors by the cosine in double
precision; a pair counts in the first block that finds it, so the union needs
no shuffle of pairs.  Tiles return link counts and a spanning forest of their
links, both linear in the tile's rows.

Equal vectors form one class that is compared once.  The k-d splits come from a
sample of at most ``SAMPLE`` vectors; they steer the routing only, every vector
is indexed and compared.

Defined results: a vector that is null, empty, zero, or has null or non-finite
components links with nothing; vectors of different length never link; rows are
vectors (a repeated row is another vector of the same id); a null id keeps its
row and is not compared; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardforge.llm.common import connected_components, materialize, unite

BLOCKS = 8
TILE = 4096
MAX_DEPTH = 12
SAMPLE = 16384
SEED = 10


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def block_bounds(dim: int) -> list[tuple[int, int]]:
    cuts = np.linspace(0, dim, min(BLOCKS, dim) + 1).astype(int)
    return list(zip(cuts[:-1], cuts[1:]))


def budgets(dim: int, threshold: float) -> list[float]:
    """Squared-distance budget of each block, in proportion to its dimensions."""
    total = 2 * (1 - threshold) + 1e-9
    return [total * (hi - lo) / dim for lo, hi in block_bounds(dim)]


def unit_rows(lists: pa.Array, dim: int) -> np.ndarray:
    x = np.asarray(lists.flatten(), dtype=np.float64).reshape(-1, dim)
    # norms of components scaled by the largest: no overflow, no underflow
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def kd_tree(points: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Split dimensions and values of a full binary tree in heap order."""
    dims, values = np.zeros((1 << depth) - 1, dtype=np.int64), np.zeros((1 << depth) - 1)
    rows = {0: points}
    for node in range((1 << depth) - 1):
        p = rows.pop(node)
        if len(p):
            dims[node] = int(np.argmax(p.max(axis=0) - p.min(axis=0)))
            values[node] = float(np.median(p[:, dims[node]]))
        low = p[:, dims[node]] < values[node] if len(p) else np.zeros(0, dtype=bool)
        rows[2 * node + 1], rows[2 * node + 2] = p[low], p[~low]
    return dims, values


def route(y: np.ndarray, dims: np.ndarray, values: np.ndarray, depth: int, radius2: float):
    """``(row, leaf, home)``: the leaf of each row, and the later leaves its
    ball of squared radius ``radius2`` touches."""
    n = len(y)
    row, node, home = np.arange(n), np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    off, far = np.zeros_like(y), np.zeros(n)
    for _ in range(depth):
        d, v = dims[node], values[node]
        x = y[row, d]
        right = x >= v
        gap = (x - v) ** 2
        # the ball reaches the other side; homes right of the split need no earlier leaf
        other = far - off[np.arange(len(row)), d] + gap
        cross = (other <= radius2) & ~(home & right)
        off2 = off[cross].copy()
        off2[np.arange(len(off2)), d[cross]] = gap[cross]
        row = np.concatenate([row, row[cross]])
        far = np.concatenate([far, other[cross]])
        off = np.concatenate([off, off2])
        home = np.concatenate([home, np.zeros(int(cross.sum()), dtype=bool)])
        node = np.concatenate([2 * node + 1 + right, 2 * node[cross] + 1 + ~right[cross]])
    return row, node - ((1 << depth) - 1), home


def _compare(u, y, cnt, left, right, same, block, bounds, budget, threshold):
    """Weighted link counts of a tile's rows, and labels of its link graph."""
    n = np.zeros(len(u), dtype=np.int64)
    label = np.arange(len(u))
    lo, hi = bounds[block]
    flat = y[:, lo:hi].astype(np.float32)
    sq = (flat * flat).sum(axis=1)
    for s in range(0, len(left), 512):
        a = left[s:s + 512]
        d = sq[a][:, None] + sq[right][None, :] - 2 * (flat[a] @ flat[right].T)
        near = d <= budget[block] + 1e-5
        if same:
            near &= right[None, :] > a[:, None]
        ra, cb = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        if not len(ra):
            continue
        i, j = np.nonzero(near[np.ix_(ra, cb)] & (u[a[ra]] @ u[right[cb]].T >= threshold))
        i, j = a[ra][i], right[cb][j]
        for k in range(0, len(i), 100_000):
            p, q = i[k:k + 100_000], j[k:k + 100_000]
            diff = (y[p, :hi] - y[q, :hi]) ** 2
            here = np.ones(len(p), dtype=bool)
            for b in range(block + 1):
                within = diff[:, slice(*bounds[b])].sum(axis=1) <= budget[b]
                here &= within if b == block else ~within
            p, q = p[here], q[here]
            n += np.bincount(p, weights=cnt[q], minlength=len(u)).astype(np.int64)
            n += np.bincount(q, weights=cnt[p], minlength=len(u)).astype(np.int64)
            label = unite(label, p, q)
    return n, label


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id",
                    vector_col: str = "embedding", tile: int = TILE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row a vector."""
    spark = vectors.sparkSession
    v = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("e"))
    ok = (F.col("vec_id").isNotNull() & (F.size("e") > 0)
          & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
          & F.exists("e", lambda x: x != 0))
    v = v.withColumn("ok", F.coalesce(ok, F.lit(False)))
    v = v.withColumn("h1", F.when(F.col("ok"), F.xxhash64("e"))).withColumn("h2", F.when(F.col("ok"), F.xxhash64(F.lit(1), "e")))
    classes = (v.where("ok").groupBy("h1", "h2").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("cnt"),
                                                     F.first("e").alias("e"))
               .withColumn("cid", F.monotonically_increasing_id()))
    classes = materialize(classes, "vectors")
    sizes = {r["d"]: r["n"] for r in classes.groupBy(F.size("e").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
    links, edges = None, None
    for dim, total in sorted(sizes.items()):
        found = _links(classes.where(F.size("e") == dim), dim, total, threshold, tile)
        found = materialize(found, "links")
        n = found.where("n > 0").groupBy("cid").agg(F.sum("n").alias("n"))
        e = found.where("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b"))
        links, edges = (n, e) if links is None else (links.union(n), edges.union(e))
    if links is None:
        return v.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                        F.lit(True).alias("kept"))
    comp = connected_components(edges).select(F.col("node").alias("cid"), F.col("component").alias("root"))
    rated = (classes.select("cid", "h1", "h2", "first", "cnt").join(links, "cid", "left").join(comp, "cid", "left")
             .withColumn("root", F.coalesce("root", "cid")))
    least = rated.groupBy("root").agg(F.min("first").alias("least"))
    rated = rated.join(least, "root").select("h1", "h2", (F.col("cnt") - 1 + F.coalesce("n", F.lit(0))).alias("n"), "least")
    component = F.coalesce("least", "vec_id")
    return (v.select("vec_id", "h1", "h2").join(rated, ["h1", "h2"], "left")
            .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                    F.col("vec_id").eqNullSafe(component).alias("kept")))


def _links(classes: DataFrame, dim: int, total: int, threshold: float, tile: int) -> DataFrame:
    """``(cid, n, root)`` partial results of all tiles of vectors of one length."""
    bounds, budget, rot = block_bounds(dim), budgets(dim, threshold), rotation(dim)
    depth = min(MAX_DEPTH, max(0, int(np.ceil(np.log2(max(total, 1) / tile)))))
    sample = classes.select("e").orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE).toArrow() if depth else None
    trees = [(np.zeros(0, dtype=np.int64), np.zeros(0))] * len(bounds)
    if depth:
        points = unit_rows(sample.column(0).combine_chunks(), dim) @ rot
        trees = [kd_tree(points[:, lo:hi], depth) for lo, hi in bounds]

    def send(batches):
        for batch in batches:
            y = unit_rows(batch.column(1), dim) @ rot
            for b, (lo, hi) in enumerate(bounds):
                row, leaf, home = route(y[:, lo:hi], *trees[b], depth, budget[b] + 1e-9)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), b, dtype=np.int32)), pa.array(leaf.astype(np.int32)), pa.array(home),
                     batch.column(0).take(at), batch.column(2).take(at), batch.column(1).take(at)],
                    ["block", "leaf", "home", "cid", "cnt", "e"])

    kind = classes.schema["e"].dataType.simpleString()
    rows = classes.select("cid", "e", "cnt").mapInArrow(
        send, f"block int, leaf int, home boolean, cid long, cnt long, e {kind}")
    # rows of each leaf (at most 2^MAX_DEPTH a block): how many slots its two kinds are dealt into
    sent = materialize(rows, "route") if depth else rows
    if depth:
        slots = sent.groupBy("block", "leaf").agg(
            F.greatest(F.ceil(F.sum(F.col("home").cast("long")) / tile), F.lit(1)).cast("int").alias("hs"),
            F.ceil(F.sum((~F.col("home")).cast("long")) / tile).cast("int").alias("ps"))
        sent = sent.join(slots, ["block", "leaf"])
    else:
        sent = sent.withColumn("hs", F.lit(max(1, -(-total // tile)))).withColumn("ps", F.lit(0))
    slot = F.when(F.col("home"), F.pmod(F.xxhash64("cid"), "hs")).otherwise(F.pmod(F.xxhash64("cid"), "ps")).cast("int")
    # tile (s, t): home slots s <= t, or home slot s with probe slot t (counted after the home slots)
    sent = sent.withColumn("slot", slot)
    other = F.sequence(F.lit(0), F.col("hs") - 1)
    tiles = F.when(F.col("home"), F.concat(
        F.transform(other, lambda o: F.struct(F.least(o, F.col("slot")).alias("s"), F.greatest(o, F.col("slot")).alias("t"))),
        F.when(F.col("ps") > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.col("ps") - 1, F.lit(0))),
                                            lambda o: F.struct(F.col("slot").alias("s"), (o + F.col("hs")).alias("t"))))
        .otherwise(F.array().cast("array<struct<s:int,t:int>>")))).otherwise(
        F.transform(other, lambda o: F.struct(o.alias("s"), (F.col("slot") + F.col("hs")).alias("t"))))
    sent = sent.select("block", "leaf", "home", "slot", "cid", "cnt", "e", F.explode(tiles).alias("at"))
    sent = sent.select("block", "leaf", "home", "slot", "cid", "cnt", "e", "at.s", "at.t")

    def join(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        b, s, t = (group.column(c)[0].as_py() for c in ("block", "s", "t"))
        home, slot_of = np.asarray(group.column("home")), np.asarray(group.column("slot"))
        cid, cnt = np.asarray(group.column("cid")), np.asarray(group.column("cnt")).astype(np.float64)
        u = unit_rows(group.column("e").combine_chunks(), dim)
        first = np.flatnonzero(home & (slot_of == s))
        probes = not home.all()
        second = np.flatnonzero(~home) if probes else np.flatnonzero(home & (slot_of == t))
        n, label = _compare(u, u @ rot, cnt, first, second, not probes and s == t, b, bounds, budget, threshold)
        hit = np.flatnonzero((n > 0) | (label != np.arange(len(label))))
        return pa.table({"cid": cid[hit], "n": n[hit], "root": cid[label[hit]]})

    return sent.groupBy("block", "leaf", "s", "t").applyInArrow(join, "cid long, n long, root long")
