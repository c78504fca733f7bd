"""Stateful streams: the stop rule over runs, answers with a deadline."""
import random
from datetime import datetime, timedelta

import pytest

from cardforge.operators.crawl import until_first_repeat
from cardforge.streaming import stateful, streams

SCHEMA = "part string, n long, content string"


def run(spark, tmp_path, batches, restarts):
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))
    result = None
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).repartition(1 if k == 0 else 1).write.mode("append").parquet(src)
        if k in restarts or k == len(batches) - 1:
            with stateful.entry_store(spark):
                stream = streams.page_stream(spark, src, max_files_per_trigger=1)
                result = streams.run_to_table(spark, stateful.stream_until_repeat(stream, "part", "n", "content"), out, ckpt)
    return sorted(((r.part or "", r.n) for r in result.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_into_batches_equals_the_batch_operator(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "a", "b", "c", None]), i, rng.choice([None, *map(str, range(60))])) for i in range(90)]
    cuts = sorted(rng.sample(range(1, 90), 3))
    batches = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, 90])]
    for b in batches:
        rng.shuffle(b)  # order inside a batch does not matter
    want = until_first_repeat(spark.createDataFrame(rows, SCHEMA), "part", "n", "content")
    assert run(spark, tmp_path, batches, {1}) == sorted(((r.part or "", r.n) for r in want.collect()))


def test_batches_of_several_files_stay_whole_and_in_order(spark, tmp_path):
    rows = [[("p", k, str(k)) for k in range(a, b)] for a, b in ((0, 40), (40, 41), (41, 90))]
    path, sizes = str(tmp_path / "src"), []
    for batch in rows:  # one of them has fewer rows than files
        streams.write_batch(spark.createDataFrame(batch, SCHEMA), path, 4, "n")
        assert len(spark.read.parquet(path).inputFiles()) == 4 * (len(sizes) + 1)
        sizes.append(len(batch))
    streams.run_to_table(spark, streams.batch_stream(spark, path, 4), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    got = sorted((r.batch_id, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(k, r[1]) for k, batch in enumerate(rows) for r in batch]


def test_no_task_of_the_query_writes_a_whole_batch(spark, tmp_path):
    from cardforge.plans import catalog
    docs = [(k, f"text {k}" if k != 170 else "text 3", "en", "web", 6) for k in range(200)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(20).write.parquet(
        str(tmp_path / "documents.parquet"))
    paths, scratch = {}, catalog.scratch
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(catalog, "scratch", lambda s, tag: paths.setdefault(tag, scratch(s, tag)))
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        try:
            got = catalog.QUERIES["stream_until_repeat"](spark, str(tmp_path)).collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r.doc_id for r in got) == list(range(170))
    sizes = sorted(r["count"] for r in spark.read.parquet(paths["docs"]).where("doc_id is not null").groupBy("_metadata.file_path").count().collect())
    assert len(sizes) > 10 and sizes[-1] < 40  # a batch has 40 rows


def test_a_repeat_ends_its_part_for_good(spark, tmp_path):
    batches = [[("p", 1, "x"), ("q", 2, "x")], [("p", 3, "x"), ("p", 4, "new")], [("p", 5, "newer"), ("q", 6, "y")], [("p", 7, "z"), ("q", 8, "x")]]
    assert run(spark, tmp_path, batches, {0, 1, 2}) == [("p", 1), ("q", 2), ("q", 6)]


def test_answers_late_missing_and_repeated(spark, tmp_path):
    begin = datetime(2024, 1, 1)
    at = lambda m: begin + timedelta(minutes=m)
    far = 10_000
    asked = [[("a", at(0)), ("b", at(1))], [("c", at(20))], [("d", at(40)), ("e", at(41))], [("f", at(100))], [("end", at(far))]]
    given = [[("a", at(5), "one"), ("a", at(6), "two")], [("a", at(22), "three"), ("b", at(21), None)], [("c", at(52), "too late"), ("d", at(45), "yes")],
             [("d", at(101), "again"), ("e", at(71), "on the minute")], [("end", at(far), "x"), ("nobody", at(far), "y"), (None, at(far), "z")]]
    folders = []
    for name, side, schema in (("asked", asked, "request_id string, asked_at timestamp"),
                               ("given", given, "request_id string, answered_at timestamp, output_text string")):
        folders.append(str(tmp_path / name))
        for rows in side:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folders[-1])
    sides = [streams.page_stream(spark, f, 1) for f in folders]
    out = streams.run_to_table(spark, stateful.stream_answers(*sides, deadline="30 MINUTES", delay="60 minutes"),
                               str(tmp_path / "out"), str(tmp_path / "ckpt"))
    got = sorted((r.request_id, r.concept_and_mnemonic) for r in out.where("request_id <> 'end'").collect())
    assert [g for g in got if g[0] != "a"] == [("b", None), ("c", None), ("d", "yes"), ("e", "on the minute"), ("f", None)]
    assert [g for g in got if g[0] == "a"] in ([("a", "one")], [("a", "two")])  # of two in one batch, either comes first
