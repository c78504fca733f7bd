"""Flashcard questions (QST-1 .. QST-7).

The question text of most items comes from an external text model.  The
library does not call it: ``question_requests`` produces the request table,
the caller answers it in any batch system, and ``apply_questions`` attaches
the answers (or the fallback question) back into the records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardforge.functions.fences import strip_fence, wrap_fence
from cardforge.functions.questions import clean_answer, fallback_question, rule_question
from cardforge.functions.text import is_blank
from cardforge.operators.extraction import one_answer
from cardforge.operators.items import TEXT, is_json_array, is_json_object, item_field, try_parse_value, with_key
from cardforge.session import materialize

# Our own instruction wording for the question requests.
QUESTION_INSTRUCTIONS = (
    "Write one flashcard question for the item below. The definition must be the answer, the term must "
    "appear in the question, and the mnemonic (if given) is what helps recall the answer. Reply with the "
    "question only.")


def _empty(item, key: str) -> F.Column:
    """True for a field that is absent, null, '', 0, false, [] or {}."""
    text = F.to_json(item_field(item, key, "variant"))
    number = text.rlike(r"^-?0+(\.0*)?([eE].*)?$")
    return F.coalesce(text.isin("null", '""', "false", "[]", "{}") | number, F.lit(True))


def question_route(item) -> F.Column:
    """QST-1: 'skip' (not an object, or an empty term), 'rule' (an empty
    definition), else 'ask'."""
    return (F.when(~is_json_object(item) | _empty(item, "term"), F.lit("skip"))
            .when(_empty(item, "definition"), F.lit("rule")).otherwise(F.lit("ask")))


def parse_record_items(records: DataFrame, text_col: str = TEXT) -> DataFrame:
    """Items of the records QST-6 can rewrite: blank text, text that does not
    start with [ or { after cleaning, unparseable text, or a non-list leave
    the record unchanged and give no items.  ``(row_no, pos, item, route)``."""
    # the guarded cleaner returns the text unchanged unless it yields [ or {
    cleaned = records.withColumn("_clean", strip_fence(F.col(text_col), "guarded"))
    ok = F.col("_clean").startswith("[") | F.col("_clean").startswith("{")
    r = cleaned.withColumn("value", F.when(ok, try_parse_value(F.col("_clean"))))
    # a non-list explodes to nothing: no filter for the optimizer to push
    # down (pushing it would copy the cleaning and parsing into the filter)
    arr = F.when(is_json_array(F.col("value")), F.try_variant_get(F.col("value"), "$", "array<variant>"))
    items = r.select("row_no", F.posexplode(arr).alias("pos", "item"))
    # written once: requests, questions and the rewrite all read the parsed items
    return materialize(items.withColumn("route", question_route(F.col("item"))), "question-items")


def question_requests(items: DataFrame) -> DataFrame:
    """QST-3: one request per item routed 'ask':
    ``(request_id, row_no, pos, instructions, input)``; the input lists the
    term, the definition and, when non-empty, the mnemonic."""
    asks = items.filter(F.col("route") == "ask")
    term, definition = item_field("item", "term"), item_field("item", "definition")
    mnemonic = item_field("item", "mnemonic")
    lines = F.concat_ws("\n", F.format_string('Term: "%s"', term), F.format_string('Definition: "%s"', definition),
                        F.when((mnemonic.isNotNull()) & (mnemonic != ""), F.format_string('Mnemonic: "%s"', mnemonic)))
    rid = F.sha2(F.concat_ws("\u0001", F.lit("question"), F.col("row_no").cast("string"),
                             F.col("pos").cast("string"), lines), 256)
    return asks.select(rid.alias("request_id"), "row_no", "pos", F.lit(QUESTION_INSTRUCTIONS).alias("instructions"),
                       lines.alias("input"))


def item_questions(items: DataFrame, requests: DataFrame, responses: DataFrame) -> DataFrame:
    """QST-2/4/5: the question of every non-skipped item
    ``(row_no, pos, question)``: rule question for 'rule' items, cleaned
    answer for 'ask' items (a blank one stays blank), fallback when none came back.
    One answer a request, however often it was made or answered."""
    asked = requests.select("request_id", "row_no", "pos").distinct()
    ans = asked.join(one_answer(responses).withColumnRenamed("output_text", "answer"), "request_id")
    j = items.filter(F.col("route") != "skip").join(ans.drop("request_id"), ["row_no", "pos"], "left")
    term = item_field("item", "term")
    q = (F.when(F.col("route") == "rule", rule_question(term))
         .when(F.col("answer").isNotNull(), clean_answer(F.col("answer")))
         .otherwise(fallback_question(term)))
    return j.select("row_no", "pos", q.alias("question"))


def apply_questions(records: DataFrame, requests: DataFrame, responses: DataFrame,
                    text_col: str = TEXT, items: DataFrame | None = None) -> DataFrame:
    """QST-6: set ``question`` in every eligible item (other keys kept) and
    re-fence the record; records that cannot be processed are unchanged.
    Items are re-collected per record (a record's own items: bounded).
    ``items``: the records' parsed items, if the caller has them already."""
    items = parse_record_items(records, text_col) if items is None else items
    qs = item_questions(items, requests, responses)
    merged = items.join(qs, ["row_no", "pos"], "left")
    new_item = F.when(F.col("question").isNotNull(), with_key(F.col("item"), "question", F.col("question"))) \
        .otherwise(F.col("item"))
    per_row = (merged.select("row_no", "pos", F.to_json(new_item).alias("j"))
               .groupBy("row_no").agg(F.array_sort(F.collect_list(F.struct("pos", "j"))).alias("xs"))
               .select("row_no", wrap_fence(F.concat(F.lit("["), F.array_join(F.transform("xs", lambda x: x["j"]), ","),
                                                     F.lit("]"))).alias("new_text")))
    out = records.join(per_row, "row_no", "left")
    return out.withColumn(text_col, F.coalesce("new_text", F.col(text_col))).drop("new_text")


def run_summary(before: DataFrame, after: DataFrame, text_col: str = TEXT) -> DataFrame:
    """QST-7: ``(total, processed, errors)``: processed = records whose text
    changed; errors = non-blank records left unchanged; blank ones count in
    the total only."""
    j = before.select("row_no", F.col(text_col).alias("b")).join(
        after.select("row_no", F.col(text_col).alias("a")), "row_no")
    return j.agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("processed"),
                 F.count_if(F.col("a").eqNullSafe(F.col("b")) & ~is_blank(F.col("b"))).alias("errors"))
