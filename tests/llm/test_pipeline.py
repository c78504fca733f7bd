import random

import pytest

import corpus_pipeline
from cardforge.llm import queries

from samples import words


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(4)
    rows = []
    for i in range(120):
        lang = ["en", "de"][i % 2]
        rows.append((i, " ".join(words(rng, rng.randint(60, 150), ["abcdef", "uvwxyz"][i % 2])), lang, f"s{i % 3}", 1))
    rows += [(200 + i, rows[i][1] + (" end" if i % 2 else ""), rows[i][2], rows[i][3], 1) for i in range(10)]
    rows += [(300, None, None, None, None), (301, "", "en", "s0", 0), (302, "short", "en", "s0", 5), (303, "1 2 3 " * 40, "en", "s0", 5)]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return str(path), rows


def test_stages(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, path).cache()
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
        if name != names[-1]:
            assert docs.columns == before.columns
    assert kept[0] == {r[0] for r in rows} - {300, 301, 302, 303}  # the base rules
    assert kept[1] == kept[0]
    assert kept[2] == set(range(120))  # the least of each group of copies
    assert kept[3] <= kept[2] and kept[4] == kept[3]
    assert sorted(map(tuple, corpus_pipeline.run(spark, path).collect())) == sorted(map(tuple, docs.collect()))


def test_edge_rows_go_through_every_stage(spark, edge_docs, edge_rows, no_docs, tmp_path):
    """Null ids, repeated rows, columns whose names clash with operators' own, an empty table."""
    for name, rows in (("edge", edge_docs), ("none", no_docs)):
        path = str(tmp_path / name)
        rows.write.parquet(f"{path}/documents.parquet")
        docs = spark.read.parquet(f"{path}/documents.parquet")
        for stage, function in corpus_pipeline.STAGES[:-1]:
            kept = function(spark, docs, path)
            assert kept.columns == rows.columns, stage
            before = {tuple(r) for r in docs.collect()}
            assert {tuple(r) for r in kept.collect()} <= before, stage
            docs = kept
        out = corpus_pipeline.run(spark, path)
        assert out.columns == ["doc_id", "n_tokens", "ids"]
        if name == "none":
            assert out.count() == 0
        else:  # the long clean text stays whole, texts of too few words go
            assert {r.doc_id for r in out.collect()} <= {r[0] for r in edge_rows}


def test_registered():
    assert sorted(q.split("_")[0] for q in queries.QUERIES) == sorted(f"op{n}" for n in range(1, 14))
