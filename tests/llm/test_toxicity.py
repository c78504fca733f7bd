import random

import numpy as np

from cardforge.llm import toxicity as tx

from samples import words

BAD = ["scummy", "idiotic", "pathetic", "disgusting"]


def corpus(n=900, seed=6):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        w = words(rng, rng.randint(30, 120), "abcdefghijklm")
        toxic = int(rng.random() < 0.2)
        for _ in range(rng.randint(1, 5) * toxic):
            w[rng.randrange(len(w))] = rng.choice(BAD) + rng.choice(["", "!", ","])
        rows.append((i, " ".join(w), toxic))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows if i % 3], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in tx.rate(docs, labels).collect()}
    held = [r for r in rows if r[0] % 3 == 0]
    assert sum(got[i]["toxic"] == bool(t) for i, _, t in held) >= 0.98 * len(held)
    hits = {i: sum(any(b in w for b in BAD) for w in text.split()) for i, text, _ in held}
    mean = [np.mean([got[i]["severity"] for i in hits if lo <= hits[i] <= hi]) for lo, hi in ((0, 0), (1, 1), (2, 3), (4, 9))]
    assert mean == sorted(mean) and mean[0] < 0.2 and mean[3] > 2


def test_gradient_reaches_the_maximum():
    """Thresholds are ordered and the grades are predicted."""
    rng = np.random.default_rng(0)
    x = rng.standard_normal(600)
    grade = np.digitize(x + 0.1 * rng.standard_normal(600), [-0.5, 0.3, 1.2])
    w, t = tx.fit_ordinal(np.arange(600), np.zeros(600, dtype=int), x, 1, grade)
    assert w[0] > 0 and (np.diff(t) > 0).all() and np.allclose(t / w[0], [-0.5, 0.3, 1.2], atol=0.15)
    chances = tx.Model(["a"], w, t).grade_chances(x * w[0])
    assert np.allclose(chances.sum(axis=1), 1) and (chances.argmax(axis=1) == grade).mean() > 0.9


def test_hidden_grades_are_found():
    """Severity follows planted grades, of which the labels tell only whether they are 0."""
    rng = np.random.default_rng(3)
    n, width = 3000, 30
    planted = rng.choice(4, size=n, p=[0.7, 0.15, 0.1, 0.05])
    strength = rng.uniform(0.3, 1.5, size=10)  # features that toxic documents prefer, of different weight
    x = rng.poisson(0.3, size=(n, width)).astype(float)
    x[:, :10] = rng.poisson(planted[:, None] * strength[None, :] * 0.5)
    row, col = np.nonzero(x)
    w, t = tx.fit_hidden(row, col, np.log1p(x[row, col]), width, (planted > 0).astype(np.int64))
    score = np.log1p(x) @ w
    severity = tx.Model([], w, t).grade_chances(score) @ np.arange(4)
    means = [severity[planted == g].mean() for g in range(4)]
    assert means == sorted(means) and means[0] < 0.3 and means[3] > 2 and (np.diff(t) > 0).all()
    # as a plain logistic regression would, the first threshold tells toxic from clean
    assert ((score > t[0]) == (planted > 0)).mean() > 0.9
    assert np.abs(w[10:]).max() < np.abs(w[:10]).min()


def test_equal_scores_get_equal_grades():
    toxic = np.array([0, 1, 1, 1, 1, 0, 1, 1])
    assert tx.dealt_grades(np.zeros(8), toxic).tolist() == [0, 1, 1, 1, 1, 0, 1, 1]
    assert tx.dealt_grades(np.array([9, 1, 2, 3, 4, 0, 5, 6.0]), toxic).tolist() == [0, 1, 1, 1, 2, 0, 2, 3]


def test_scores_against_plain_python(spark):
    """Severity of every document by the formulas, word by word."""
    import math

    rows = corpus(300, 9)
    model = tx.Model(["scummy", "idiotic", "path*", "good"], np.array([2.0, 1.5, 1.0, -1.0]), np.array([0.5, 1.0, 2.0]))
    docs = spark.createDataFrame([(i, t if i % 7 else t + " Good, good!") for i, t, _ in rows], "doc_id long, text string")
    for r, d in zip(sorted(tx.score(docs, model).collect(), key=lambda r: r.doc_id), sorted(docs.collect())):
        score = 0.0
        bare = [w.lower().strip(tx.EDGES) for w in d.text.split()]
        for word, weight in zip(model.words, model.weights):
            n = sum(w[:tx.START] + "*" == word for w in bare) if word.endswith("*") else bare.count(word)
            score += weight * math.log1p(n)
        above = [1.0, *(1 / (1 + math.exp(t - score)) for t in model.thresholds), 0.0]
        assert abs(r.severity - sum(k * (above[k] - above[k + 1]) for k in range(4))) < 1e-9
        assert abs(r.toxic_probability - above[1]) < 1e-9


def test_edges(edge_docs, edge_rows, no_docs, spark):
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1), (6, 1), (6, 1), (7, 0)], "doc_id long, toxic int")
    assert len(tx.rate(edge_docs, labels).collect()) == len(edge_rows)
    none = tx.rate(edge_docs, labels.limit(0)).collect()
    assert {(r["severity"], r["grade"], r["toxic"]) for r in none} == {(0.0, 0, False)} and len(none) == len(edge_rows)
    assert tx.rate(no_docs, labels).collect() == []
    assert len(tx.rate(edge_docs.drop("lang"), labels).collect()) == len(edge_rows)
