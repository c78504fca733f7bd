"""End-to-end plans composed from the operators.

* ``heading_subject_counts`` - the flagship slice (pages -> subject ->
  heading split -> per-subject counts).
* ``model_scrape`` - index pages -> links -> walks -> model requests.
* ``rule_scrape`` - pages -> lessons (the rule extractor), restricted to the
  pages reached by following next links from the seeds.
* ``records_to_flashcards`` - records -> items -> questions -> subjects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardforge.functions.urls import subject_of
from cardforge.operators import crawl, dom, extraction, items, questions, subjects
from cardforge.session import apply_conf


def heading_subject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(subject, n_pages, n_with_word, n_with_definition, level)``: pages
    per subject (first URL path segment), how many yield a word and a
    definition from their first h1, and a total row (``level`` 1)."""
    apply_conf(spark)
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    head = dom.split_heading(dom.page_trees(pages))
    j = pages.select("page_id", subject_of("url").alias("subject")).join(head, "page_id", "left")
    return (j.rollup("subject")
            .agg(F.count(F.lit(1)).alias("n_pages"), F.count("word").alias("n_with_word"),
                 F.count("definition").alias("n_with_definition"), F.grouping_id().cast("long").alias("level")))


def rule_scrape(pages: DataFrame, seeds: DataFrame) -> DataFrame:
    """E1: lessons of every page reached from the seeds (each seed walks its
    own chain; pages reached from several seeds are extracted once and
    reported once per seed)."""
    links = dom.next_links(dom.page_trees(pages)).select("url", "next_url")
    walks = crawl.follow_chain(links, seeds)
    reached = walks.select("url").distinct()
    lessons = dom.extract_lessons(pages.join(reached, "url", "left_semi"))
    return walks.join(lessons, "url")


def model_scrape(pages: DataFrame, index_pages: DataFrame, done: DataFrame, routes: list[tuple[str, str]],
                 base: str | None = None, walk: bool = True) -> DataFrame:
    """E2, up to the model: links of the index pages -> those not done yet ->
    their pages (with ``walk``, all pages their next links lead to) -> one request
    a page (``extraction_requests``).  A page that several walks reach is asked
    about once.  ``attach_responses`` and ``append_rows`` finish the run."""
    links = dom.index_links(dom.page_trees(index_pages), base=base)
    seeds = crawl.skip_done(links.select(F.col("link").alias("url")).distinct(), done)
    seeds = seeds.withColumn("seed_id", F.col("url"))
    if walk:
        reached = crawl.follow_chain(dom.next_links(dom.page_trees(pages)).select("url", "next_url"), seeds)
    else:
        reached = crawl.visit_single(pages, seeds)
    wanted = pages.join(reached.select("url").distinct(), "url", "left_semi").select("page_id", "url", "html")
    return extraction.extraction_requests(dom.page_trees(wanted), routes)


def records_to_flashcards(records: DataFrame, responses: DataFrame | None = None
                          ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """E3: ``(flashcards, rejects, counts)``.  Records are cleaned (strict
    fence), parsed and exploded; every item gets a question (rule, model
    answer or fallback; none for items without a term) and a subject."""
    it, rejects = items.records_to_items(records)
    routed = it.withColumn("route", questions.question_route(F.col("item")))
    req = questions.question_requests(routed)
    resp = responses if responses is not None else req.sparkSession.createDataFrame(
        [], "request_id string, output_text string")
    qs = questions.item_questions(routed, req, resp)
    typed = items.harmonise_items(routed).drop("question")
    cards = subjects.with_subject(typed.join(qs, ["row_no", "pos"], "left"))
    return cards, rejects, subjects.subject_counts(cards)
