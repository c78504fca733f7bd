import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from conftest import SCHEMA

from cardforge.llm import periodic_runs as P
from cardforge.llm.queries import op11_periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=P.LEAST):
    """All runs by comparing the words with themselves at every distance."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, q, e) for (s, e), q in found.items())


def with_repeats(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digests(doc_id, text):
    words = with_repeats(doc_id, WORD.findall(text or ""))
    runs = brute(words)
    gone = {i for s, q, e in runs for i in range(s + q, e)}
    listing = "".join(f"{s},{e - s},{q}\n" for s, q, e in runs)
    best = min(runs, key=lambda r: (r[0] - r[2], r[0], r[1])) if runs else None
    longest = (best[0], best[2] - best[0], best[1], 1000 * (best[2] - best[0]) // best[1]) if best else (None,) * 4
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *longest, hashlib.sha256(listing.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def key(row):
    return tuple((x is None, x) for x in row)


def random_words(rng):
    n, k = rng.choice([0, 1, 5, 12, 30, 100, 400]), rng.choice([1, 2, 3, 8, 50])
    words = [rng.randrange(k) for _ in range(n)]
    if n > 10 and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(2, 9)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(n)] = rng.randrange(k)
    return words


def found(texts):
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    start, stop, period = P.periodic_runs(np.array([w for t in texts for w in t], dtype=np.int32), offsets)
    return [(s, d, e) for s, d, e in zip(start.tolist(), period.tolist(), stop.tolist())], offsets.tolist()


def expected(texts, offsets):
    return [(s + o, q, e + o) for t, o in zip(texts, offsets) for s, q, e in brute(t)]


def test_transform_multiplies_polynomials():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, P.PRIME, (3, 16)).astype(np.uint64), rng.integers(0, P.PRIME, (3, 16)).astype(np.uint64)
    got = P.ntt(P._mod(P.ntt(a) * P.ntt(b)), inverse=True)
    for x, y, z in zip(a.tolist(), b.tolist(), got.tolist()):
        assert z == [sum(x[i] * y[(k - i) % 16] for i in range(16)) % P.PRIME for k in range(16)]


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_texts(seed):
    rng = random.Random(seed)
    for _ in range(40):
        texts = [random_words(rng) for _ in range(rng.randint(0, 5))]
        got, offsets = found(texts)
        assert got == expected(texts, offsets)


def test_long_runs_and_words_of_two_letters():
    rng = random.Random(3)
    texts = [[0] * 5000, [i % 777 for i in range(6000)], [rng.randrange(2) for _ in range(3000)], list(range(4000)) * 2, [0, 1] * 7 + [0]]
    got, offsets = found(texts)
    assert got == [(0, 1, 5000), (5000, 777, 11000), *[(s + 11000, q, e + 11000) for s, q, e in brute(texts[2])],
                   (14000, 4000, 22000), (22000, 2, 22015)]


def test_a_hash_that_misleads_is_caught(monkeypatch):
    monkeypatch.setattr(P, "HASHES", ((2, 1), (2, 1)))
    rng = random.Random(9)
    for _ in range(30):
        texts = [random_words(rng) for _ in range(3)]
        got, offsets = found(texts)
        assert got == expected(texts, offsets)


def test_edge_rows(edge_docs, edge_rows, no_docs):
    got = [tuple(r) for r in P.digests(P.find_runs(P.with_repeats(edge_docs))).collect()]
    assert sorted(got, key=key) == sorted((digests(r[0], r[1]) for r in edge_rows), key=key)
    runs = P.find_runs(edge_docs).where("doc_id = 13").first()
    assert [tuple(r) for r in runs.runs] == [(0, 120, 3)] and runs.collapsed == "a b c" and runs.n_words == 120
    assert P.digests(P.find_runs(P.with_repeats(no_docs))).count() == 0


def test_ids_of_any_value(spark):
    rows = [(i, "a b c d e " * 9) for i in range(300)] + [(None, "a b " * 9), (-5, "x " * 40)]
    docs = spark.createDataFrame([(*r, None, None, None, "r", 1, "t", 2, "k") for r in rows], SCHEMA)
    got = [tuple(r) for r in P.digests(P.find_runs(P.with_repeats(docs))).collect()]
    assert sorted(got, key=key) == sorted((digests(*r) for r in rows), key=key)


def test_whole_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in op11_periodic_runs(spark, sf).collect()]
    assert sorted(got, key=key) == sorted((digests(r.doc_id, r.text) for r in rows), key=key)
