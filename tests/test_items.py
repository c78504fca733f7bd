"""Records -> items: parsing strictness, numbering, harmonising."""

import json

from cardforge.operators.items import (harmonise_items, number_items, parse_items, records_to_items,
                                       validity_report)


def _records(spark, texts, urls=None):
    urls = urls or ["https://site.example.net/chemistry/x.html"] * len(texts)
    return spark.createDataFrame([(i, u, t) for i, (u, t) in enumerate(zip(urls, texts))],
                                 "row_no long, url string, concept_and_mnemonic string")


def _py_ok(t):
    try:
        json.loads(t)
        return True
    except Exception:
        return False


def test_parse_strictness_matches_json_loads(spark):
    texts = ['[{"term":"a"}]', '[{"a":1},{"a":2},{"a":3}]', "[]", '{"term":"x"}', "5", '[{"a":1},5]',
             '[{"term":"a"}] junk', "[1],[2]", "[{'term':'a'}]", '[{"term":"a","term":"b"}]',
             '[{"term":"a","extra":[1]}]', '[{"keywords":"str"}]', '[{"definition":null}]', '["a\nb"]', "",
             '  [1]  ', '{"a": 1} {"b": 2}']
    parsed, rejects = parse_items(_records(spark, texts), mode="strict")
    ok = {r.row_no for r in parsed.collect()}
    assert ok == {i for i, t in enumerate(texts) if _py_ok(t.strip())}
    assert rejects.count() == len(texts) - len(ok)


def test_records_to_items_counts(spark):
    texts = ['```json\n[{"term":"a","keywords":["k1","k2"]},{"term":"b"}]\n```', '```json\n{"name":"N"}\n```',
             "```\n[]\n```", "not json", "   ", '```json\n[{"concept":"C","definition":"d"}]\n```']
    items, rejects = records_to_items(_records(spark, texts))
    got = sorted((r.row_no, r.pos, r.term) for r in harmonise_items(items).collect())
    assert got == [(0, 0, "a"), (0, 1, "b"), (1, 0, "N"), (5, 0, "C")]
    assert sorted((r.row_no, r.reason) for r in rejects.collect()) == [(3, "invalid_json"), (4, "missing")]


def test_number_items_any_partitioning(spark):
    texts = ['```json\n[{"t":1},{"t":2}]\n```', "```json\n[]\n```", '```json\n{"t":0}\n```', "oops",
             '```json\n[{"t":3},{"t":4},{"t":5}]\n```', '```json\n[{"t":6},"s",{"t":7}]\n```']
    for parts in (1, 4, 16):
        rows, items = number_items(_records(spark, texts).repartition(parts))
        got = sorted((r.row_no, r.pos, r["count"]) for r in items.collect())
        assert got == [(0, 0, 1), (0, 1, 2), (4, 0, 3), (4, 1, 4), (4, 2, 5), (5, 0, 6), (5, 2, 7)]
        out = {r.row_no: r.concept_and_mnemonic for r in rows.collect()}
        assert set(out) == {0, 1, 3, 4, 5}
        assert out[3] == "oops"
        body = json.loads(out[5].removeprefix("```json\n").removesuffix("\n```"))
        assert body == [{"t": 6, "count": 6}, "s", {"t": 7, "count": 7}]


def test_validity_report_keeps_rows(spark):
    texts = ['```json\n[{"a":""}]\n```', '```JSON [1] ```', "bad"]
    rep = {r.row_no: r.is_valid for r in validity_report(_records(spark, texts)).collect()}
    # the "" collapse breaks the empty string: reproduced
    assert rep == {0: False, 1: True, 2: False}


def test_bare_objects_reported_when_numbering(spark):
    from cardforge.operators.items import dropped_bare_objects
    texts = ['```json\n{"t": 1}\n```', '```json\n[{"t": 2}]\n```', "5"]
    got = sorted((r.row_no, r.reason) for r in dropped_bare_objects(_records(spark, texts)).collect())
    assert got == [(0, "not_a_list"), (2, "not_a_list")]


def test_parse_strictness_random(spark):
    import random

    from pyspark.sql import functions as F

    from cardforge.operators.items import try_parse_value
    rnd = random.Random(8)
    parts = ['[', ']', '{', '}', '"a"', ':', ',', '1', '-0.5e3', 'true', 'null', ' ', '\n', '"x\\"y"', "'s'",
             '"\\u00e9"', '01', '1.', '"\t"', 'tru', '[]', '{}', '"k":1', '"]"', '"\\\\"']
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 7))) for _ in range(1500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", try_parse_value(F.col("t")).isNotNull().alias("v"))
    assert [r.t for r in df.collect() if r.v != _py_ok(r.t)] == []


def test_long_strings(spark):
    long = "x" * 300_000 + '\\"' * 20_000
    texts = [f'[{{"term": "{long}"}}]', f'["{long}"] junk', '["' + "y" * 300_000, "[" * 300 + "1" + "]" * 300]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    from pyspark.sql import functions as F

    from cardforge.operators.items import try_parse_value
    got = {r.i: r.v for r in df.select("i", try_parse_value(F.col("t")).isNotNull().alias("v")).collect()}
    assert got == {0: True, 1: False, 2: False, 3: True}


def test_sparse_keys_are_numbered_over_many_tasks(spark):
    from pyspark.sql import functions as F

    from cardforge.operators.items import _placed, ordinals, prefix_offsets
    n = 20_000
    d = spark.range(n).select((F.col("id") * 1_000_003).alias("k"), (F.col("id") % 3).alias("n"), F.lit("hot").alias("s"))
    o = prefix_offsets(d, "k", "n")
    rows = {r.k: r.offset for r in o.collect()}
    total = 0
    for i in range(n):
        assert rows[i * 1_000_003] == total
        total += i % 3
    # even range partitions for any spacing, and for one hot key
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows would fit one
    try:
        for keys in ([], ["s"]):
            sizes = [r["count"] for r in _placed(d, [*keys, "k"]).groupBy("_part").count().collect()]
            assert len(sizes) > 1 and max(sizes) < n / 2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    g = ordinals(d, ["s"], ["k"]).select("k", "ordinal").collect()
    assert {r.k // 1_000_003 + 1 for r in g} == {r.ordinal for r in g} and all(r.k // 1_000_003 + 1 == r.ordinal for r in g)


def test_numbers_skip_other_elements(spark):
    texts = ["```json\n[1, {\"t\": 1}, null, {\"t\": 2}, \"s\"]\n```", "```json\n[{}]\n```"]
    _, items = number_items(_records(spark, texts))
    assert sorted((r.row_no, r.pos, r["count"]) for r in items.collect()) == [(0, 1, 1), (0, 3, 2), (1, 0, 3)]
