"""cardforge: lesson pages to flashcards, as Spark jobs.

Typical use::

    from cardforge import dom_nodes, extract_lessons, records_to_items, number_items
    lessons = extract_lessons(spark.read.parquet(".../pages"))
    items, rejects = records_to_items(spark.read.parquet(".../records"))
"""

from cardforge.functions.fences import strip_fence, wrap_fence
from cardforge.functions.questions import clean_answer, fallback_question, rule_question
from cardforge.functions.text import decode_entities, strip_ws
from cardforge.functions.urls import resolve_url, subject_of
from cardforge.operators.crawl import crawl_all, follow_chain, skip_done, until_first_repeat, visit_single
from cardforge.operators.dom import (dom_nodes, extract_lessons, index_links, next_links, page_images,
                                     select_container, split_heading)
from cardforge.operators.extraction import attach_responses, extraction_requests
from cardforge.operators.items import (harmonise_items, number_items, parse_items, records_to_items,
                                       validity_report)
from cardforge.operators.questions import apply_questions, question_requests, run_summary
from cardforge.operators.subjects import group_by_subject, subject_counts

__all__ = [
    "strip_fence", "wrap_fence", "clean_answer", "fallback_question", "rule_question", "decode_entities",
    "strip_ws", "resolve_url", "subject_of", "crawl_all", "follow_chain", "skip_done", "until_first_repeat",
    "visit_single", "dom_nodes", "extract_lessons", "index_links", "next_links", "page_images",
    "select_container", "split_heading", "attach_responses", "extraction_requests", "harmonise_items",
    "number_items", "parse_items", "records_to_items", "validity_report", "apply_questions",
    "question_requests", "run_summary", "group_by_subject", "subject_counts",
]
