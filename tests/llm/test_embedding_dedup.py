import numpy as np
import pytest

from cardforge.llm import embedding_dedup as ed
from cardforge.llm.common import unite


def brute(rows, threshold=0.95):
    ok = [i for i, (v, e) in enumerate(rows) if v is not None and e and None not in e and np.isfinite(e).all() and np.any(np.array(e))]
    n, label = [0] * len(rows), np.arange(len(rows))
    for x, i in enumerate(ok):
        for j in ok[:x]:
            a, b = np.array(rows[i][1], dtype=float), np.array(rows[j][1], dtype=float)
            if len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= threshold:
                n[i] += 1
                n[j] += 1
                label = unite(label, np.array([i]), np.array([j]))
    least = {}
    for i in range(len(rows)):
        if rows[i][0] is not None:
            least[label[i]] = min(least.get(label[i], rows[i][0]), rows[i][0])
    return sorted(((v, n[i], None if v is None else least[label[i]], v is None or least[label[i]] == v) for i, (v, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("dim,tile", [(16, 8), (64, 16), (3, 1000)])
def test_equals_brute_force(spark, dim, tile):
    rng = np.random.default_rng(dim)
    centres = rng.standard_normal((12, dim))
    x = [centres[rng.integers(12)] + rng.standard_normal(dim) * rng.choice([0.05, 0.2, 0.25, 1.0]) for _ in range(150)]
    x += [x[0]] * 20 + [x[1] * 3.5, x[1] * 1e-3]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    got = ed.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), tile=tile)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (10, [1e300, 1e290]), (11, [5e-300, 0.0])]
    d = spark.createDataFrame([(v, e, "x", 1) for v, e in rows], "vec_id long, embedding array<double>, e string, cid long")
    assert sorted(map(tuple, ed.near_duplicates(d).collect()), key=repr) == sorted(
        [(1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True),
         (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True), (None, 0, None, True), (10, 4, 1, False), (11, 4, 1, False)], key=repr)
    assert ed.near_duplicates(d.limit(0)).collect() == []


def test_route_sends_to_every_leaf_in_reach():
    rng = np.random.default_rng(1)
    y = rng.standard_normal((400, 4))
    depth, r2 = 4, 0.3
    tree = ed.kd_tree(y[:200], depth)
    row, leaf, home = ed.route(y, *tree, depth, r2)
    at = dict(zip(row[home], leaf[home]))
    sent = set(zip(row.tolist(), leaf.tolist()))
    for i in range(400):
        for j in range(i):
            if ((y[i] - y[j]) ** 2).sum() <= r2:
                a, b = (i, j) if at[i] <= at[j] else (j, i)
                assert (a, at[b]) in sent
