"""Fence cleaning (JSN-1..4) and re-wrapping (JSN-9).

Model output arrives as JSON inside a Markdown code fence.  Four different
cleaners exist in the source material; ``strip_fence(col, mode)`` exposes all
of them, each a short chain of regex replaces.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardforge.functions._col import as_col, let
from cardforge.functions.text import is_blank, strip_chars, strip_ws

MODES = ("strict", "guarded", "symmetric", "collapse")


def _without(s: Column, head: int, tail: int) -> Column:
    """``s`` without so many characters at its ends."""
    return F.substr(s, F.lit(head + 1), F.length(s) - head - tail)


def strip_fence(c, mode: str = "strict") -> Column:
    """Remove a Markdown JSON fence.

    strict     strip; drop one leading ```json, else one leading ```; drop one
               trailing ```; strip (case-sensitive).
    guarded    strip; drop a leading ```json and a trailing ``` (each followed
               by a strip); if the rest does not start with [ or {, the value
               is returned unchanged.  Blank values are returned unchanged.
    symmetric  strip; strip backticks at both ends; delete every "json"
               (also inside values); strip.
    collapse   strip; remove ^```json\\s* and \\s*```$ in one pass, any case;
               turn every "" into ".
    """
    col = as_col(c)
    if mode == "strict":
        s = strip_ws(col)
        s = F.when(s.startswith("```json"), _without(s, 7, 0)).when(s.startswith("```"), _without(s, 3, 0)).otherwise(s)
        return let(s, lambda t: strip_ws(F.when(t.endswith("```"), _without(t, 0, 3)).otherwise(t)))
    if mode == "guarded":
        def head(s):
            return F.when(s.startswith("```json"), strip_ws(F.substring(s, 8, 1 << 30))).otherwise(s)

        def tail(s):
            return F.when(s.endswith("```"), strip_ws(_without(s, 0, 3))).otherwise(s)

        def pick(s):
            ok = s.startswith("[") | s.startswith("{")
            return F.when(is_blank(col) | ~ok, col).otherwise(s)
        return let(let(let(strip_ws(col), head), tail), pick)
    if mode == "symmetric":
        s = strip_chars(strip_ws(col), "`")
        return strip_ws(F.replace(s, F.lit("json"), F.lit("")))
    if mode == "collapse":
        # Python's \s (str.isspace) also matches 0x1C-0x1F; Java's does not
        s = F.regexp_replace(strip_ws(col), r"(?iU)^```json[\s\x1c-\x1f]*|[\s\x1c-\x1f]*```\z", "")
        return F.replace(s, F.lit('""'), F.lit('"'))
    raise ValueError(f"unknown fence mode {mode!r}; expected one of {MODES}")


def wrap_fence(json_text) -> Column:
    """JSN-9: back to a ```json fenced block."""
    return F.concat(F.lit("```json\n"), as_col(json_text), F.lit("\n```"))
