"""Properties: numbering is 1..N without gaps for any
partitioning; items + rejects cover every input row."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cardforge.operators.items import number_items, records_to_items

row = st.one_of(
    st.lists(st.dictionaries(st.sampled_from(["term", "definition", "x"]), st.text("abc ", max_size=4),
                             max_size=3), max_size=4).map(lambda xs: "```json\n" + json.dumps(xs) + "\n```"),
    st.just("not json"), st.just("   "), st.just('{"term": "bare"}'))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=12), parts=st.sampled_from([1, 3, 7]))
def test_numbering_is_gapless(spark, rows, parts):
    df = spark.createDataFrame([(i * 70001, "https://a.example/s/x", t) for i, t in enumerate(rows)],
                               "row_no long, url string, concept_and_mnemonic string").repartition(parts)
    _, items = number_items(df)
    got = sorted((r.row_no, r.pos, r["count"]) for r in items.collect())
    expected, n = [], 0
    for i, t in enumerate(rows):
        try:
            v = json.loads(t.strip().strip("`").replace("json", "").strip())
        except ValueError:
            continue
        if isinstance(v, list):
            for p, x in enumerate(v):
                if isinstance(x, dict):
                    n += 1
                    expected.append((i * 70001, p, n))
    assert got == expected


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=12))
def test_items_and_rejects_cover_all_rows(spark, rows):
    df = spark.createDataFrame([(i, "https://a.example/s/x", t) for i, t in enumerate(rows)],
                               "row_no long, url string, concept_and_mnemonic string")
    items, rejects = records_to_items(df)
    seen = {r.row_no for r in items.select("row_no").collect()} | {r.row_no for r in rejects.collect()}
    empty = set()
    for i, t in enumerate(rows):
        try:
            v = json.loads(t.strip().removeprefix("```json").removeprefix("```").removesuffix("```").strip())
            if v == []:
                empty.add(i)
        except ValueError:
            pass
    assert seen | empty == set(range(len(rows)))
