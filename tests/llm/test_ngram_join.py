import random
import re

import pytest

from cardforge.llm import ngram_join

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, width):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute_force(rows, width, percent):
    """Every pair compared."""
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if None not in (rows[i][0], rows[j][0]) and a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), None if d is None else least[find(i)]) for i, (d, _) in enumerate(rows)), key=repr)


def corpus(seed, n=160):
    """Copies, near copies in large and small groups, texts of shared passages, short texts."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(400)]
    bases = [[rng.choice(vocab) for _ in range(rng.choice([9, 12, 40, 150, 260]))] for _ in range(12)]
    passage = [rng.choice(vocab) for _ in range(60)]
    rows = []
    for i in range(n):
        kind = rng.random()
        w = list(bases[0] if kind < 0.35 else rng.choice(bases))
        if kind > 0.15:
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
        if kind > 0.8:
            w = passage + [rng.choice(vocab) for _ in range(rng.randint(0, 30))]
        if rng.random() < 0.1:
            w = w[:rng.randint(0, 6)]
        rows.append((i, " ".join(w).upper() if rng.random() < 0.1 else " ".join(w)))
    return rows


@pytest.mark.parametrize("seed,width,percent,rare", [(1, 3, 90, 32), (2, 3, 90, 2), (3, 5, 80, 4), (4, 2, 85, 1)])
def test_equals_brute_force(spark, monkeypatch, seed, width, percent, rare):
    # low bounds, so that combinations, tiles and slots all have work here
    monkeypatch.setattr(ngram_join, "RARE", rare)
    monkeypatch.setattr(ngram_join, "VERY_FREQUENT", 3 * rare)
    monkeypatch.setattr(ngram_join, "TILE_SETS", 20)
    rows = corpus(seed)
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), width, percent)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_force(rows, width, percent)


def test_edges(edge_docs, edge_rows, no_docs):
    got = ngram_join.jaccard_components(edge_docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_force([r[:2] for r in edge_rows], 3, 90)
    assert ngram_join.jaccard_components(no_docs).collect() == []


def test_keep_one(edge_docs, edge_rows, no_docs):
    kept = ngram_join.keep_one(edge_docs, 3, 90)
    assert kept.columns == edge_docs.columns
    want = sorted({d for d, _, c in brute_force([r[:2] for r in edge_rows], 3, 90) if d == c and d is not None})
    got = sorted((r[0] for r in kept.collect()), key=repr)
    assert got == sorted([*want, None], key=repr)
    assert ngram_join.keep_one(no_docs).collect() == []


def test_low_thresholds_are_refused(no_docs):
    with pytest.raises(ValueError):
        ngram_join.jaccard_components(no_docs, 3, 50)


def test_links_without_ansi_mode(spark):
    """Nine shingles of ten are linked also where no token of the slice is shared and ANSI mode is off."""
    rng = random.Random(7)
    rows = []
    for i in range(60):
        w = ["".join(rng.choice("abcdefghijkl") for _ in range(5)) for _ in range(12)]
        rows += [(2 * i, " ".join(w[:11])), (2 * i + 1, " ".join(w))]
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(i, i // 2 * 2) for i in range(120)]
