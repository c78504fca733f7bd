"""CAT-5 / CAT-6 as one JSON document of parallel parts."""
import glob
import json
import random

import pytest
from pyspark.sql import functions as F

from cardforge.sinks import documents


def joined(path):
    return b"".join(open(f, "rb").read() for f in sorted(glob.glob(f"{path}/part-*")))


def rows(n=400, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        subject = rng.choice(["art", "art", "art", "bio", 'q"uo\\te', "é", "z"])
        out.append((subject, i, json.dumps({"term": rng.choice(["a", "x]}", 'say "hi"', "line\nfeed", "日本", ""]), "n": i, "k": [i, [1]]})))
    return out


def grouped(spark, data, parts=5):
    d = spark.createDataFrame(data, "subject string, ordinal long, j string").repartition(parts)
    return d.select("subject", "ordinal", F.parse_json("j").alias("item"))


def expected(data):
    out = {}
    for subject, _, j in sorted(data, key=lambda r: ((r[0] or "unknown").encode(), r[1])):
        out.setdefault(subject or "unknown", []).append(json.loads(j))
    return out


def test_one_document_of_many_parts(spark, tmp_path):
    data = rows() + [(None, 5, '{"n":1}')]
    path = str(tmp_path / "doc")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        documents.write_subjects_document(grouped(spark, data), path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    whole = joined(path)
    assert len(glob.glob(f"{path}/part-*")) > 2
    assert json.loads(whole) == expected(data) and list(json.loads(whole)) == list(expected(data))
    parts = sorted(tuple(r) for r in documents.document_parts(spark, path).collect())
    assert [p[1] for p in parts] == [sum(p[2] for p in parts[:i]) for i in range(len(parts))] and sum(p[2] for p in parts) == len(whole)
    for r in documents.document_subjects(spark, path).collect():
        one = json.loads(b"{" + whole[r.start:r.start + r.bytes] + b"}")
        assert one == {r.subject: expected(data)[r.subject]} and r["items"] == len(one[r.subject])
    back = {}
    for r in sorted(documents.read_document(spark, path).collect(), key=lambda r: r.ordinal):
        back.setdefault(r.subject, []).append(json.loads(r.json))
    assert back == expected(data)


def test_a_flat_array(spark, tmp_path):
    data = rows(120, 2)
    d = grouped(spark, data).select(F.col("ordinal").alias("row_no"), F.lit(0).alias("pos"), "item")
    path = str(tmp_path / "flat")
    documents.write_flat_document(d, path)
    assert json.loads(joined(path)) == [json.loads(j) for _, _, j in data]
    got = sorted(documents.read_document(spark, path).collect(), key=lambda r: r.ordinal)
    assert [json.loads(r.json) for r in got] == [json.loads(j) for _, _, j in data] and {r.subject for r in got} == {None}


@pytest.mark.parametrize("data", [[], [("only", 1, "{}")], [("same", 1, '{"a":1}')] * 3, [("s", 1, "[[1]]"), ("s", 2, '"]}"'), ("t", 1, "3")]])
def test_small_documents(spark, tmp_path, data):
    path = str(tmp_path / "doc")
    g = grouped(spark, data, 1)
    documents.write_subjects_document(g, path)
    documents.write_subjects_document(g, path)  # replaces itself
    assert json.loads(joined(path)) == expected(data)
    documents.write_flat_document(g.select(F.col("ordinal").alias("row_no"), F.lit(0).alias("pos"), "item"), path + "f")
    assert sorted(map(json.dumps, json.loads(joined(path + "f")))) == sorted(json.dumps(json.loads(j)) for _, _, j in data)
    assert documents.read_document(spark, path).count() == len(data)
    if not data:
        assert joined(path) == b"{}\n" and joined(path + "f") == b"[]\n"
