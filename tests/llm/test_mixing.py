import random
import re
from collections import defaultdict

import pyarrow as pa

from cardforge.llm import mixing

WORD = re.compile("[^\x20\x09-\x0d]+")


def expected_targets(sizes):
    """Shares by weight, the excess over three times a source's size shared anew."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        level = (total - sum(3 * sizes[s] for s in full)) / max(1, sum(weight[s] for s in rest))
        more = {s for s in rest if 3 * sizes[s] < level * weight[s]}
        if not more:
            return {s: 3.0 * sizes[s] if s in full else level * weight[s] for s in names}
        full |= more


def check(docs, rows):
    got = [r.asDict() for r in mixing.mix(docs).collect()]
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len(WORD.findall(t or ""))
    want = expected_targets(size)
    assert sorted(((r["doc_id"], r["size"]) for r in got), key=repr) == sorted(((d, len(WORD.findall(t or ""))) for d, t, _ in rows), key=repr)
    for r in got:
        assert r["source_size"] == size[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        assert r["size"] == 0 or abs(r["copies"] - r["target"] / r["source_size"]) < 1
    return got


def test_counts_of_slices():
    texts = pa.array(["a b", None, "", " x\ty\x0b z ", "é à", "q\u00a0r"])
    for k in range(6):
        assert mixing.count_words(texts.slice(k)).tolist() == [len(WORD.findall(t or "")) for t in texts.to_pylist()[k:]]


def test_many_documents_meet_their_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 20)
    monkeypatch.setattr(mixing, "FAN", 2)
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "a", "a", "b", "c", None, "Z"]) if i else "tiny") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = check(docs, rows)
    taken, goal = defaultdict(int), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        goal[r["source"]] = r["target"]
    for s in goal:
        assert abs(taken[s] - goal[s]) <= 60
    again = {r["doc_id"]: r["copies"] for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {r["doc_id"]: r["copies"] for r in got}
    assert mixing.mixed_documents(docs).count() == sum(r["copies"] for r in got)


def test_expectations_are_kept():
    n, runs = 6, 4000
    total = [0.0] * n
    for k in range(runs):
        out = mixing.pivot([k * 31 + i for i in range(n)], [5, 3, 9, 1, 7, 4], [0.3, 0.5, 0.2, 0.9, 0.4, 0.6], True)
        assert all(x in (0.0, 1.0) for x in out)
        total = [a + b for a, b in zip(total, out)]
    for got, p in zip(total, [0.3, 0.5, 0.2, 0.9, 0.4, 0.6]):
        assert abs(got / runs - p) < 0.04


def test_edges(edge_docs, edge_rows, no_docs):
    check(edge_docs, [(r[0], r[1], r[3]) for r in edge_rows])
    mixed = mixing.mixed_documents(edge_docs)
    assert mixed.columns == edge_docs.columns
    assert {tuple(r) for r in mixed.collect()} <= set(edge_rows)
    assert mixing.mix(no_docs).collect() == [] and mixing.mixed_documents(no_docs).collect() == []
