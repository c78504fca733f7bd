import random

import numpy as np
import pyarrow as pa
import pytest

from cardforge.llm import bloom, pretokenize
from cardforge.llm.common import ascii_lowered, chunks, connected_components, unite, words_of
from cardforge.llm.shingles import shingle_sets


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)]
    edges += [(5000, 5001 + i) for i in range(60)]
    label = unite(np.arange(6000), *(np.array(x) for x in zip(*edges)))
    want = {x: int(label[x]) for a, b in edges for x in (a, b) if a != b}
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_slices_of_texts():
    texts = pa.array(["Q Ä", "a B", None, " x  Y ", "", "é À  z"])
    for k in range(7):
        flat, offsets = words_of(texts.slice(k), lower=True)
        want = [[w.translate({c: c + 32 for c in range(65, 91)}) for w in (t or "").split()] for t in texts.to_pylist()[k:]]
        assert [flat.to_pylist()[a:b] for a, b in zip(offsets[:-1], offsets[1:])] == want
    assert ascii_lowered(pa.array(["AÄz"], type=pa.large_string())).to_pylist() == ["aÄz"]
    assert [b for _, b in chunks(pa.array(["x" * 10, None, "y" * 3, ""]), 5)] == [1, 4]


def test_shingle_sets_of_slices():
    texts = pa.array(["a b c d", None, "a  b c", "A B", "a b c a b c", "", "b"])
    whole, at = shingle_sets(texts, 3)
    assert np.diff(at).tolist() == [2, 0, 1, 1, 3, 0, 1]
    for k in range(7):
        part, b = shingle_sets(texts.slice(k, 2), 3)
        assert [part[x:y].tolist() for x, y in zip(b[:-1], b[1:])] == [whole[x:y].tolist() for x, y in zip(at[k:k + 2], at[k + 1:k + 3])]


def test_bloom(spark):
    keys = list(range(0, 50_000, 7))
    f = bloom.build(spark.createDataFrame([(k,) for k in keys], "k long"), len(keys))
    assert f.hits(np.array(keys)).all()
    assert f.hits(np.arange(1, 50_000, 7)).mean() < 0.1
    d = spark.range(1000).toDF("k")
    sure, maybe = bloom.maybe_in(d, "k", f, negate=True).count(), bloom.maybe_in(d, "k", f).count()
    assert sure + maybe == 1000 and maybe >= len([k for k in keys if k < 1000])


def test_scan_equals_a_walk():
    """The block scan gives what the automaton gives one character at a time."""
    rng = np.random.default_rng(3)
    symbols = rng.integers(0, 8, 5000).astype(np.uint8)
    symbols[rng.random(5000) < 0.02] += pretokenize.RESET
    state, want = pretokenize.END, []
    for s in symbols.tolist():
        if s >= pretokenize.RESET:
            state = pretokenize._step(pretokenize.END, s - pretokenize.RESET)[0]
            want.append(True)
        else:
            state, starts = pretokenize._step(state, s)
            want.append(starts)
    assert pretokenize.token_starts(symbols).tolist() == want
