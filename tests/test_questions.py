"""Questions: routing, requests, answers, rewrite, summary (FIXTURES §2)."""

import json

from cardforge.operators.questions import (apply_questions, parse_record_items, question_requests,
                                           run_summary)


def _records(spark, rows):
    return spark.createDataFrame([(i, "https://site.example.net/names/x.html", t) for i, t in enumerate(rows)],
                                 "row_no long, url string, concept_and_mnemonic string")


ROWS = [
    '```json\n[{"term": "", "definition": "d"}, {"term": "Waldemar (given name)", "definition": null},'
    ' {"term": "Argon", "definition": "", "mnemonic": ""}, {"term": "Neon", "definition": "gas", "mnemonic": "m"},'
    ' {"term": "Xenon", "definition": "gas"}, 5]\n```',
    "   ",
    "```\n[1]\n```",                       # bare fence prefix: guard fails, unchanged
    '```json\n{"term": "solo"}\n```',     # not a list: unchanged
    "```json\n[{oops}]\n```",             # unparseable: unchanged
]


def test_routes_and_requests(spark):
    it = parse_record_items(_records(spark, ROWS))
    got = sorted((r.row_no, r.pos, r.route) for r in it.collect())
    assert got == [(0, 0, "skip"), (0, 1, "rule"), (0, 2, "rule"), (0, 3, "ask"), (0, 4, "ask"), (0, 5, "skip")]
    req = {r.pos: r.input for r in question_requests(it).collect()}
    assert req[3] == 'Term: "Neon"\nDefinition: "gas"\nMnemonic: "m"'
    assert req[4] == 'Term: "Xenon"\nDefinition: "gas"'


def test_apply_questions_and_summary(spark):
    rec = _records(spark, ROWS)
    it = parse_record_items(rec)
    req = question_requests(it)
    neon = [r.request_id for r in req.collect() if "Neon" in r.input]
    resp = spark.createDataFrame([(neon[0], '  "What gas is Neon?" ')], "request_id string, output_text string")
    after = apply_questions(rec, req, resp)
    out = {r.row_no: r.concept_and_mnemonic for r in after.collect()}
    for i in range(1, 5):
        assert out[i] == ROWS[i]
    items = json.loads(out[0].removeprefix("```json\n").removesuffix("\n```"))
    assert [x.get("question") if isinstance(x, dict) else x for x in items] == [
        None, "What is the first name associated with Waldemar?", "What is the first name associated with Argon?",
        "What gas is Neon?", "What is Xenon?", 5]
    assert items[3]["mnemonic"] == "m"
    s = run_summary(rec, after).first()
    assert (s.total, s.processed, s.errors) == (5, 1, 3)


def test_route_of_empty_values(spark):
    import json

    from pyspark.sql import functions as F

    from cardforge.operators.questions import question_route
    values = [None, "", "a", "0", 0, 0.0, -0.0, 1, False, True, [], ["x"], {}, {"k": 1}]
    items = [{"term": t, "definition": d} for t in values for d in values] + [{}, {"term": "a"}, "a", 5, ["a"]]
    rows = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(items)], "i int, j string")
    got = {r.i: r.r for r in rows.select("i", question_route(F.parse_json("j")).alias("r")).collect()}
    for i, x in enumerate(items):
        d = x if isinstance(x, dict) else {}
        assert got[i] == ("skip" if not d.get("term") else "ask" if d.get("definition") else "rule"), x
