import random

import pytest
from samples import words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, size long, tokens string, _q int, key string"


def extra(i):
    """Values of the columns whose names clash with operators' own."""
    return (i, f"r{i}", i, "t", i, "k")


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and long texts, copies, near copies, repeated rows."""
    rng = random.Random(5)
    base = words(rng, 120)
    near = [w if k % 60 else "zzz" for k, w in enumerate(base)]
    texts = [None, "", "  \n\t ", "one", "one two", "One TWO", " ".join(base), " ".join(near), " ".join(base) + "\n",
             " ".join(words(rng, 80)), "é à ü ñ " * 30, "x" * 30_000, " ".join(words(rng, 20_000)), "a b c " * 40,
             "line one here\nline one here\n\nother\n", "''s 's don't we'll\u3000x  y\r\n", "!!! ### $$ 100% | < >"]
    rows = []
    for i, t in enumerate(texts):
        rows.append((i, t, ["en", "de", None][i % 3], ["s0", "s1", None, "s0"][i % 4], None if i % 5 == 0 else 7, *extra(i)[1:]))
    rows.append(rows[6])  # a repeated row
    rows.append((None, "no id here", "en", "s0", 1, *extra(99)[1:]))
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
