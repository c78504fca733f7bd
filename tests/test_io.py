"""Sources, sinks and streams on small local folders."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from cardforge.functions.fences import strip_fence
from cardforge.sinks import files
from cardforge.sources import readers
from cardforge.streaming import streams


def _tmp():
    return tempfile.mkdtemp(prefix="cardforge-test-")


def test_csv_round_trip_keeps_quotes_newlines_and_blanks(spark):
    rows = [("https://a.example/x", '```json\n[{"a": "say ""hi"""}]\n```'), ("  ", "   "), ("u", "")]
    df = spark.createDataFrame(rows, "url string, concept_and_mnemonic string")
    path = os.path.join(_tmp(), "rec")
    files.refresh_rows(df.coalesce(1), path, fmt="csv")  # one CSV file, one header line
    back = readers.read_records(spark, path)
    assert sorted((r.url, r.concept_and_mnemonic) for r in back.collect()) == sorted(rows)
    pos = readers.read_records_positional(spark, path)
    assert pos.count() == 4  # the header line is a data row
    assert pos.filter(F.col("_c0") == "url").count() == 1


def test_done_urls_and_ranges(spark):
    assert readers.read_done_urls(spark, "/nonexistent/path").count() == 0
    df = spark.createDataFrame([("a",), (None,), ("a",), ("b",)], "url string")
    path = os.path.join(_tmp(), "done")
    files.refresh_rows(df, path)
    assert sorted(r.url for r in readers.read_done_urls(spark, path).collect()) == ["a", "b"]
    urls = [r.url for r in readers.url_range(spark, "https://x.example/list?p=%d", 2, 27).orderBy("n").collect()]
    assert len(urls) == 25 and urls[0].endswith("p=2") and urls[-1].endswith("p=26")


def test_subject_writer_keeps_untouched_subjects(spark):
    path = os.path.join(_tmp(), "subjects")
    a = spark.createDataFrame([("chemistry", 1), ("biology", 2)], "subject string, row_no long")
    files.write_by_subject(a, path)
    b = spark.createDataFrame([("chemistry", 3)], "subject string, row_no long")
    files.write_by_subject(b, path)
    got = sorted((r.subject, r.row_no) for r in spark.read.json(path).collect())
    assert got == [("biology", 2), ("chemistry", 3)]


def test_rewrite_and_flat_name(spark):
    df = spark.createDataFrame([(0, "u", '```json\n[{"a": ""}]\n```')], "row_no long, url string, c string")
    out = files.rewrite_records(df, os.path.join(_tmp(), "rw"), "c", lambda c: strip_fence(c, "collapse"))
    assert out.first().c == '[{"a": "}]'
    assert files.flat_output_path("/d/cards.csv") == "/d/cards_converted.json"


def test_stream_extract_is_idempotent_per_batch(spark):
    src, out, ck = (os.path.join(_tmp(), n) for n in ("pages", "out", "ck"))
    html = ('<html><body><h1>Neon – a gas</h1><div id="mainContent"><p><span style="color:#ff0000">'
            'Knee on</span> the gas</p></div></body></html>')
    spark.createDataFrame([(1, "https://a.example/chemistry/neon.html", html)],
                          "page_id long, url string, html string").write.parquet(src)
    streams.stream_extract(spark, src, out, ck).awaitTermination()
    streams.stream_extract(spark, src, out, ck).awaitTermination()  # nothing new: no second copy
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 1 and rows[0].word == "Neon" and rows[0].mnemonic == ["Knee on the gas"]


def test_stream_dedup_by_content(spark):
    base = _tmp()
    src = os.path.join(base, "pages")
    for i, html in enumerate(["<p>same</p>", "<p>same</p>", "<p>other</p>", "<p>same</p>"]):  # a file, so a micro-batch, each
        spark.createDataFrame([(i, f"u{i}", html)], "page_id long, url string, html string").coalesce(1).write.mode("append").parquet(src)
    s = streams.content_key(streams.page_stream(spark, src, max_files_per_trigger=1), "html")
    out = streams.run_to_table(spark, streams.stream_dedup(s, ["content_md5"]).select("content_md5"),
                               os.path.join(base, "out"), os.path.join(base, "ck"))
    assert out.count() == 2


def _csv_files(texts):
    path = os.path.join(_tmp(), "csv")
    os.makedirs(path)
    for name, text in texts.items():
        with open(os.path.join(path, name), "w", newline="") as f:
            f.write(text)
    return path


def test_records_are_read_by_header_name(spark):
    path = _csv_files({
        "b.csv": 'concept_and_mnemonic,url\r\n"x ""q""\r\ny",u1\r\n,u2\r\n',
        "a.csv": "url,mainContent,concept_and_mnemonic\n" + "".join(f"v{i},m,c{i}\n" for i in range(300)) + "short\nlong,m,c,more\n",
        "c.csv": "url\nonly\n", "d.csv": ""})
    r = readers.read_records(spark, path)
    assert r.columns[:3] == ["row_no", "url", "concept_and_mnemonic"] and set(r.columns) == {"row_no", "url", "concept_and_mnemonic", "mainContent"}
    rows = [(x.url, x.concept_and_mnemonic, x.mainContent) for x in r.orderBy("row_no").collect()]
    assert rows == [(f"v{i}", f"c{i}", "m") for i in range(300)] + [
        ("short", None, None), ("long", "c", "m"), ("u1", 'x "q"\r\ny', None), ("u2", "", None), ("only", None, None)]


def test_headers_that_clash_or_repeat(spark):
    path = _csv_files({"a.csv": "URL,url,row_no,x,x\n1,2,3,4,5\n", "b.csv": "concept_and_mnemonic,Url\nc,u\n"})
    r = readers.read_records(spark, path)
    assert r.columns == ["row_no", "url", "concept_and_mnemonic", "URL_2", "Url_3", "row_no_2", "x"]
    assert sorted((tuple(x)[1:] for x in r.collect()), key=str) == [("2", None, "1", None, "3", "5"), (None, "c", None, "u", None, None)]


def test_rows_equal_the_standard_parser_over_any_splits(spark):
    import csv
    import io
    import random

    rng = random.Random(3)
    pieces = ["a", "b c", ",", ",", '"', '""', "\n", "\r\n", '"x\ny"', '"p""q"', "é", "\n\n", '"\n', ' "']
    texts = {f"{i:02}.csv": "".join(rng.choice(pieces) for _ in range(rng.randint(0, 60))) for i in range(40)}
    texts["long.csv"] = "".join(f'{i},"line {i}\n{"more " * (i % 7)}""q"""\r\n' for i in range(300))
    path = _csv_files(texts)
    # a carriage return that no line feed follows is text here, the end of a line there
    want = {name: [r for r in csv.reader(io.StringIO(t, newline="")) if r] for name, t in sorted(texts.items())}
    for size in ("64", "1024", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            rows = readers.read_csv_rows(spark, path).orderBy("row_no").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        got = {name: [] for name in want}
        for r in rows:
            assert r.line == len(got[r.file.rsplit("/", 1)[1]])
            got[r.file.rsplit("/", 1)[1]].append(r.fields)
        assert [r.row_no for r in rows] == list(range(len(rows)))
        for name in want:
            assert got[name] == want[name], (size, name, texts[name])


def test_positional_rows_keep_every_field(spark):
    path = _csv_files({"a.csv": "a,,c\n" + ",".join(map(str, range(11))) + '\n""\nx\n"a\nb",c\n'})
    r = readers.read_records_positional(spark, path).orderBy("row_no").collect()
    assert [x.fields for x in r] == [["a", "", "c"], [str(i) for i in range(11)], [""], ["x"], ["a\nb", "c"]]
    assert [x.n_fields for x in r] == [3, 11, 1, 1, 2] and [x.row_no for x in r] == list(range(5)) and r[3]["_c1"] is None
    out = os.path.join(_tmp(), "out")
    files.rewrite_positional(readers.read_records_positional(spark, path), out, lambda c: F.upper(c))
    back = readers.read_records_positional(spark, out).orderBy("row_no").collect()
    assert [x.fields for x in back] == [["a", "", "c"], [str(i) for i in range(11)], [""], ["x"], ["a\nb", "C"]]


def test_items_are_written_as_objects(spark):
    base = _tmp()
    items = spark.sql("""select 'm' as subject, 0L as row_no, 0 as pos, parse_json('{"term": "a", "n": [1, null]}') as item
                         union all select 'b', 1L, 0, parse_json('"text"')""")
    for name, write in (("one", files.write_by_subject), ("flat", files.write_flat)):
        path = os.path.join(base, name)
        write(items, path)
        lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
        assert {json.dumps(x["item"]) for x in lines} == {'{"n": [1, null], "term": "a"}', '"text"'}
    path = os.path.join(base, "all")
    files.write_all_subjects(items, path)
    files.write_all_subjects(items.where("subject = 'm'"), path)
    assert [r.subject for r in spark.read.json(path).collect()] == ["m"]


def test_scratch_folder_only_on_a_local_master():
    from types import SimpleNamespace

    import pytest

    from cardforge.session import checkpoint_dir

    def session(master, folder=None):
        made = []
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: made[-1] if made else None, setCheckpointDir=made.append,
                             getConf=lambda: SimpleNamespace(get=lambda key, default: folder))
        return SimpleNamespace(sparkContext=sc)

    for master in ("yarn", "spark://host:7077", "k8s://h", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            checkpoint_dir(session(master))
        assert checkpoint_dir(session(master, "hdfs:///shared")) == "hdfs:///shared"
    assert checkpoint_dir(session("local[2]")) and checkpoint_dir(session("local"))


def test_no_task_sorts_a_large_subject_alone(spark, tmp_path):
    rows = spark.range(40_000).select(F.when(F.col("id") % 3 > 0, "large").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("subject"),
                                      "id", F.sha2(F.col("id").cast("string"), 512).alias("text")).coalesce(1)
    key, path = "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(tmp_path / "out")
    before = spark.conf.get(key)
    spark.conf.set(key, "200000")
    try:
        files.write_by_subject(rows, path)
    finally:
        spark.conf.set(key, before)
    back = spark.read.json(path)
    assert back.select("subject", "id", "text").exceptAll(rows).isEmpty() and back.count() == 40_000
    sizes = [r["count"] for r in back.groupBy("_metadata.file_path").count().collect()]
    assert max(sizes) < 15_000  # one task wrote all 26,667 rows of the large subject
