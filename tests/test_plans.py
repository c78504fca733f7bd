"""Plan shape: the scale discipline the operators are written for."""

import re

from pyspark.sql import functions as F

from cardforge.functions.urls import subject_of
from cardforge.operators.dom import dom_nodes, extract_lessons, next_links, page_trees
from cardforge.operators import crawl
from cardforge.operators.items import number_items, records_to_items

PAGES = "/root/testdata/sf0.001/pages.parquet"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_page_structure_is_found_without_a_shuffle(spark):
    pages = spark.read.parquet(PAGES)
    for df in (dom_nodes(pages), extract_lessons(pages), next_links(page_trees(pages))):
        plan = _plan(df)
        assert "Exchange" not in plan and "Window" not in plan and "Join" not in plan, plan


def test_projection_prunes_html(spark):
    df = spark.read.parquet(PAGES).select("page_id", subject_of("url").alias("s")).filter(F.col("page_id") > 3)
    plan = _plan(df)
    read_schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "html" not in read_schema
    assert "PushedFilters: [IsNotNull(page_id), GreaterThan(page_id,3)]" in plan


def test_numbering_has_no_global_window_over_rows(spark):
    rows = spark.range(0, 1000).select(F.col("id").alias("row_no"), F.lit("https://a.example/x").alias("url"),
                                       F.lit('```json\n[{"a": 1}, {"b": 2}]\n```').alias("concept_and_mnemonic"))
    _, items = number_items(rows)
    plan = _plan(items)
    # the only single-partition step is the running sum over the partitions' totals
    for window in re.findall(r"Window \[[^\n]*", plan):
        assert "_part" in window, window
    assert items.count() == 2000


def test_records_are_parsed_once(spark):
    rec = spark.createDataFrame([(0, "https://a.example/x", "[1]")], "row_no long, url string, concept_and_mnemonic string")
    items, rejects = records_to_items(rec)
    for df in (items, rejects):
        assert "parse_json" not in _plan(df) and "ParseJson" not in _plan(df)


def test_walks_join_no_null_keys(spark):
    links = spark.createDataFrame([("a", "b"), ("b", None), ("c", "gone")], "url string, next_url string")
    _, _, jumps = crawl._graph(links)
    for level in jumps.levels:
        assert level.where("j is null").count() == 0
