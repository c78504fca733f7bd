"""Flashcard question column functions (QST-2, QST-4, QST-5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardforge.functions._col import as_col, let
from cardforge.functions.text import strip_ws

# The two question templates of the source material.
RULE_QUESTION = "What is the first name associated with {}?"
FALLBACK_QUESTION = "What is {}?"


def rule_question(term) -> Column:
    """QST-2: question for an item without a definition; uses the term up
    to the first '(' and stripped."""
    head = strip_ws(F.substring_index(as_col(term), "(", 1))
    return F.format_string(RULE_QUESTION.replace("{}", "%s"), head)


def clean_answer(text) -> Column:
    """QST-4: strip, then remove one pair of surrounding double quotes only
    when both are present."""
    def unquote(s):
        quoted = s.startswith('"') & s.endswith('"')
        # s[1:-1]; a lone '"' becomes ''
        return F.when(quoted, F.substring(s, F.lit(2), F.greatest(F.length(s) - 2, F.lit(0)))).otherwise(s)
    return let(strip_ws(as_col(text)), unquote)


def fallback_question(term) -> Column:
    """QST-5: used when no answer came back for an item."""
    return F.format_string(FALLBACK_QUESTION.replace("{}", "%s"), as_col(term))
