"""String column functions shared by every stage.

All but ``decode_entities`` are built-in Spark expressions (JVM side).
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cardforge.functions._col import as_col

# Python's ``str.strip()`` removes every Unicode whitespace character plus the
# information separators 0x1C-0x1F; Java's ``(?U)\s`` misses the latter.
_WS = r"[\s\x1c-\x1f]"
#: the same characters, for a trim that looks at the ends of a text only
_WS_CHARS = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_LSTRIP_RE = rf"(?U)^{_WS}+"
_RSTRIP_RE = rf"(?U){_WS}+\z"


def strip_ws(c) -> Column:
    """Equivalent of Python ``str.strip()`` with no argument."""
    return F.btrim(as_col(c), F.lit(_WS_CHARS))


def is_blank(c) -> Column:
    """True when the value is null or only whitespace (Python ``not s.strip()``)."""
    return as_col(c).isNull() | (strip_ws(c) == F.lit(""))


def nbsp_to_space(c) -> Column:
    return F.replace(as_col(c), F.lit("\u00a0"), F.lit(" "))


def strip_chars(c, chars: str) -> Column:
    """Python ``str.strip(chars)``: remove any of ``chars`` from both ends."""
    cls = "".join("\\" + ch if ch in r"\^-]" else ch for ch in chars)
    return F.regexp_replace(as_col(c), rf"^[{cls}]+|[{cls}]+\z", "")


#: references with more digits than Python turns into an integer
_LONG_REFERENCE = re.compile(r"&#0*([0-9]*)")


def unescape(text: str) -> str:
    """``text`` with character references decoded as the HTML standard does; numbers
    of any length (those beyond the last code point give U+FFFD)."""
    if "&" not in text:
        return text
    if "&#" in text:
        text = _LONG_REFERENCE.sub(lambda m: m.group() if len(m.group()) < 4000 else f"&#{m.group(1)[:8] or 0}", text)
    return html.unescape(text)


def decode_entities(c) -> Column:
    """Decode character references as the HTML standard does: the full table,
    ``;`` optional where the standard says so, numeric ones of any length, in one
    pass ("&amp;lt;" gives "&lt;").  Arrow-batched; null stays null."""
    return _unescape(as_col(c))


@F.pandas_udf(StringType())
def _unescape(values: pd.Series) -> pd.Series:
    return values.map(unescape, na_action="ignore")
