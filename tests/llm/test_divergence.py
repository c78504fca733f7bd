import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SCHEMA
from samples import words

from cardforge.llm import divergence as D

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def f(p, q):
    return (p - q) ** 2 // (p + q)


def brute(rows, least=10, top=10):
    count, docs, groups = Counter(), Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = [t.translate(LOWER) for t in TERM.findall(text or "")]
        for t in terms:
            count[lang, source, t] += 1
        for t in set(terms):
            docs[lang, t] += 1
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted((t for (x, t), n in docs.items() if x == lang and n >= least), key=str.encode)
        sources = sorted(s for x, s in groups if x == lang)
        if kept:
            total = {s: sum(count[lang, s, t] for t in kept) for s in sources}
            p = {s: [1 + 10 ** 9 * (count[lang, s, t] + 2) // (total[s] + 2 * len(kept)) for t in kept] for s in sources}
            n = sum(total.values())
            q = [1 + 10 ** 9 * (sum(count[lang, s, t] for s in sources) + 2) // (n + 2 * len(kept)) for t in kept]
        for s in sources:
            pair = [(x, sum(map(f, p[s], p[x])) if kept else 0) for x in sources if x != s]
            term = [(t, f(a, b)) for t, a, b in zip(kept, p[s], q) if count[lang, s, t] and a > b] if kept else []
            for part, found, most in (("pair", pair, len(pair)), ("term", term, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def made(spark, rows, parts=4):
    return spark.createDataFrame([(i, *r, None, "r", 1, "t", 2, "k") for i, r in enumerate(rows)], SCHEMA).repartition(parts)


def some_rows(seed, n=300):
    rng = random.Random(seed)
    vocabulary = words(rng, 60) + ["É", "é", "ÀB", "x_y", "don't", "ＡＢ", "日本"]
    rows = []
    for _ in range(n):
        source = rng.choice(["s0", "s0", "s0", "s1", "s2", "s3", None, ""])
        pool = vocabulary[:20] if source == "s0" else vocabulary
        text = rng.choice([" ", "\n", "-", "1"]).join(rng.choice(pool).title() for _ in range(rng.randint(0, 40)))
        rows.append((rng.choice([text, text, text, None, ""]), rng.choice(["en", "en", "de", None, "rare" if rng.random() < 0.02 else "fr"]), source))
    return rows + rows[:20]


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_against_brute_force(spark, seed):
    rows = some_rows(seed)
    assert sorted(tuple(r) for r in D.audit(made(spark, rows)).collect()) == brute(rows)


def test_audit_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_GROUPS", 0)
    monkeypatch.setattr(D, "BLOCK", 2)
    rows = some_rows(3)
    assert sorted(tuple(r) for r in D.audit(made(spark, rows)).collect()) == brute(rows)


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    rows = [r[1:4] for r in edge_rows]
    assert sorted(tuple(r) for r in D.audit(edge_docs).collect()) == brute(rows)
    assert sorted(tuple(r) for r in D.audit(edge_docs, least_docs=1, top=3).collect()) == brute(rows, 1, 3)
    assert D.audit(no_docs).count() == 0


def test_ties_and_a_language_without_terms(spark):
    rows = [("same words", "en", s) for s in ("b", "a", "c") for _ in range(5)] + [("other", "de", "x"), (None, "de", "y")]
    got = sorted(tuple(r) for r in D.audit(made(spark, rows)).collect())
    assert got == brute(rows)
    assert ("en", "b", "pair", "a", 0, 1) in got and ("de", "x", "pair", "y", 0, 1) in got


def test_shares_are_exact_for_large_counts(spark):
    n, v, c = 5 * 10 ** 15, 10 ** 9, 3 * 10 ** 14
    d = spark.createDataFrame([(c, n, v)], "c long, n long, v long")
    from pyspark.sql import functions as F
    got = d.select(D._share(F.col("c"), F.col("n"), F.col("v"))).first()[0]
    assert got == 1 + 10 ** 9 * (c + 2) // (n + 2 * v)


def test_tree_against_rows(monkeypatch):
    rng = random.Random(4)
    for limit in (1 << 20, 3):
        monkeypatch.setattr(D, "TREE_ITEMS", limit)
        base = [rng.randint(1, 50) for _ in range(6)]
        rows = Counter(tuple((s, rng.choice([60, 70])) for s in sorted(rng.sample(range(6), rng.randint(1, 6)))) for _ in range(400))
        want = defaultdict(int)
        for path, n in rows.items():
            for j, (t, q) in enumerate(path):
                for s, p in path[:j]:
                    want[s, t] += n * (f(p, q) - f(p, base[t]) - f(base[s], q) + f(base[s], base[t]))
        paths = sorted(rows)
        flat = [np.array(x, dtype=np.int64) for x in zip(*[(s, p, base[s]) for path in paths for s, p in path])]
        a, b, value = D.tree_corrections(flat, np.array([len(p) for p in paths]), np.array([rows[p] for p in paths]))
        assert {(x, y): z for x, y, z in zip(a.tolist(), b.tolist(), value.tolist())} == want
