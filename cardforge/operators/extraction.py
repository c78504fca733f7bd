"""Model extraction as request / response tables (EXT-1, EXT-2).

The library prepares one request per page and attaches the answers; the model call itself happens outside (any batch inference
system).  The instruction wording below is our own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardforge.operators.dom import MAIN, Predicate, container_markup

_COMMON = ("Reply with a JSON array only. Each element is an object with the keys listed below; use null for "
           "anything the page does not give.")

TEMPLATES = {
    "general": ("The HTML below is a lesson page that may teach one or several memory aids. For each one give "
                "the taught term, its definition if there is one, the memory sentence (often shown in red), an "
                "image URL if one illustrates it, and keywords that sound like the term. " + _COMMON +
                " Keys: term, definition, mnemonic, image, keywords."),
    "elements": ("The HTML below teaches one chemical element with a memory aid. Give the element, its defining "
                 "facts, the memory sentence, an illustrating image URL and sound-alike keywords. " + _COMMON +
                 " Keys: term, definition, mnemonic, image, keywords."),
    "multiple": ("The HTML below holds several memory aids. List every one. " + _COMMON +
                 " Keys: term, definition, mnemonic."),
    "names": ("The HTML below lists first names, each with a memory sentence. List every name with its "
              "sentence. " + _COMMON + " Keys: name, mnemonic."),
    "trees": ("The HTML below describes trees and how to recognise them with a memory aid. Reply with one JSON "
              "object with the keys concept, definition, mnemonic."),
    "vocab": ("The HTML below teaches foreign-language words with memory aids. For each word give the word, its "
              "English meaning, the memory sentence, an image URL and sound-alike keywords. " + _COMMON +
              " Keys: term, definition, mnemonic, image, keywords."),
}


def template_of(url: Column, routes: list[tuple[str, str]], default: str | None = "general") -> Column:
    """The template of a URL: that of the first ``(pattern, template)`` whose
    regular expression is found in it, else ``default`` (null: no request)."""
    unknown = {t for _, t in routes} | ({default} if default else set())
    if not unknown <= set(TEMPLATES):
        raise ValueError(f"no such template: {sorted(unknown - set(TEMPLATES))}")
    name = F.lit(default).cast("string")
    for pattern, template in reversed(routes):
        name = F.when(url.rlike(pattern), F.lit(template)).otherwise(name)
    return name


def extraction_requests(trees: DataFrame, routes: list[tuple[str, str]], default: str | None = "general",
                        pred: Predicate = MAIN) -> DataFrame:
    """EXT-1: ``(request_id, page_id, url, template, instructions, input)``: one
    request a page, by the template of its seed list (``routes`` on the URL).
    ``input`` is the container's markup, ``''`` when the page has none (the
    request is still made).  ``request_id`` is sha256 of template, url and input."""
    instructions = F.create_map(*[F.lit(x) for pair in TEMPLATES.items() for x in pair])
    pages = container_markup(trees, pred, on_missing="empty").withColumnRenamed("container_html", "input")
    pages = pages.withColumn("template", template_of(F.col("url"), routes, default)).where("template is not null")
    rid = F.sha2(F.concat_ws("\u0001", F.col("template"), F.col("url"), F.col("input")), 256)
    return pages.select(rid.alias("request_id"), "page_id", "url", "template",
                        F.element_at(instructions, F.col("template")).alias("instructions"), "input")


def one_answer(responses: DataFrame) -> DataFrame:
    """``(request_id, output_text)``, one row a request that was answered.

    Batch inference delivers at least once: of several answers to one request the
    least text (by code point) counts, whatever their order; a null answer is none."""
    given = responses.where(F.col("output_text").isNotNull() & F.col("request_id").isNotNull())
    return given.groupBy("request_id").agg(F.min("output_text").alias("output_text"))


def attach_responses(requests: DataFrame, responses: DataFrame, on_missing: str = "skip") -> tuple[DataFrame, DataFrame]:
    """EXT-2: ``(answered, unanswered)``.  Answered rows carry the raw
    output unparsed as ``concept_and_mnemonic``, one answer a request (see
    :func:`one_answer`).  A request without an answer (a failed call) is left out and reported in ``unanswered``; with
    ``on_missing='stop'`` the run ends there instead: of the requests in order
    of ``page_id`` (ties: ``request_id``) those before the first unanswered one
    are answered, and all others are unanswered."""
    if on_missing not in ("skip", "stop"):
        raise ValueError("on_missing: 'skip' or 'stop'")
    r = one_answer(responses).withColumnRenamed("output_text", "concept_and_mnemonic")
    answered = requests.join(r, "request_id")
    unanswered = requests.join(r.select("request_id"), "request_id", "left_anti")
    if on_missing == "stop":
        # one row: where the run ends
        end = unanswered.agg(F.min(F.struct("page_id", "request_id")).alias("_end"))
        before = F.col("_end").isNull() | (F.struct("page_id", "request_id") < F.col("_end"))
        answered = answered.join(F.broadcast(end)).where(before).drop("_end")
        unanswered = requests.join(F.broadcast(end)).where(~before).drop("_end")
    return answered, unanswered
