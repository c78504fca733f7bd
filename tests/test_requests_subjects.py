"""Model request tables, subjects and counts."""

from pyspark.sql import functions as F

from cardforge.operators.dom import attr, dom_nodes, has_class, page_trees
from cardforge.operators.extraction import TEMPLATES, attach_responses, extraction_requests
from cardforge.operators.items import records_to_items
from cardforge.operators.subjects import group_by_subject, subject_counts


def test_requests_keep_pages_without_container(spark):
    html = "<html><body><div id='mainContent'><p>x</p><!-- c --></div></body></html>"
    pages = spark.createDataFrame([(1, "https://a.example/c/1", html), (2, "https://a.example/names/2", "<p>none</p>"),
                                   (3, "https://a.example/c/3", None)], "page_id long, url string, html string")
    req = extraction_requests(page_trees(pages), [("/names/", "names")])
    rows = {r.page_id: r for r in req.collect()}
    assert {i: (r.template, r.input) for i, r in rows.items()} == {
        1: ("general", "<div id='mainContent'><p>x</p><!-- c --></div>"), 2: ("names", ""), 3: ("general", "")}
    assert all(r.instructions == TEMPLATES[r.template] for r in rows.values())
    assert len({r.request_id for r in rows.values()}) == 3
    only = extraction_requests(page_trees(pages), [("/names/", "names")], default=None).collect()
    assert [r.page_id for r in only] == [2]
    resp = spark.createDataFrame([(rows[i].request_id, '```json\n[{"term": "x"}]\n```') for i in (1, 3)],
                                 "request_id string, output_text string")
    answered, unanswered = attach_responses(req, resp)
    assert sorted(r.page_id for r in answered.collect()) == [1, 3] and [r.page_id for r in unanswered.collect()] == [2]
    assert answered.first().concept_and_mnemonic.startswith("```json")
    answered, unanswered = attach_responses(req, resp, on_missing="stop")
    assert [r.page_id for r in answered.collect()] == [1] and sorted(r.page_id for r in unanswered.collect()) == [2, 3]


def test_subject_ordinals_and_counts(spark):
    texts = [("https://a.example/chemistry/1", '[{"term": "a"}, {"term": "b"}]'),
             ("https://a.example/biology/2", '[{"term": "c"}]'),
             ("https://a.example/chemistry/3?x=/y", '{"term": "d"}'),
             ("https://a.example/", '[{"term": "e"}]')]
    rec = spark.createDataFrame([(i * 100000, u, t) for i, (u, t) in enumerate(texts)],
                                "row_no long, url string, concept_and_mnemonic string")
    items, _ = records_to_items(rec)
    got = sorted((r.subject, r.ordinal, r.row_no, r.pos) for r in group_by_subject(items).collect())
    assert got == [("biology", 1, 100000, 0), ("chemistry", 1, 0, 0), ("chemistry", 2, 0, 1),
                   ("chemistry", 3, 200000, 0), ("unknown", 1, 300000, 0)]
    counts = {(r.subject, r.n_items, r.n_subjects, r.level) for r in subject_counts(items).collect()}
    assert counts == {("biology", 1, 1, 0), ("chemistry", 3, 1, 0), ("unknown", 1, 1, 0), (None, 5, 3, 1)}


def test_hot_subject_ordinals_span_buckets(spark):
    # one subject holding every row, spread over many buckets and partitions
    n = 200_000
    rec = (spark.range(0, n, numPartitions=8)
           .select((F.col("id") * 3).alias("row_no"), F.lit("https://a.example/hot/x").alias("url"),
                   F.lit('[{"term": "t"}]').alias("concept_and_mnemonic")))
    items, _ = records_to_items(rec)
    g = group_by_subject(items)
    stats = g.agg(F.min("ordinal").alias("lo"), F.max("ordinal").alias("hi"),
                  F.countDistinct("ordinal").alias("n"),
                  F.max(F.when(F.col("ordinal") != F.col("row_no") / 3 + 1, 1).otherwise(0)).alias("bad")).first()
    assert (stats.lo, stats.hi, stats.n, stats.bad) == (1, n, n, 0)


def test_class_and_attribute_helpers(spark):
    html = '<div class="nav  page-next x" data-a="1&amp;2" data-a="3"><a href=\'/q?a=1&amp;b=2\'>n</a></div>'
    nodes = dom_nodes(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string"))
    div = nodes.filter("name = 'div'").select(has_class("attrs", "page-next").alias("c"),
                                              attr("attrs", "data-a").alias("a")).first()
    assert div.c is True and div.a == "3"
    a = nodes.filter("name = 'a'").select(attr("attrs", "href").alias("h")).first()
    assert a.h == "/q?a=1&b=2"
