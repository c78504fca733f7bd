from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a lambda variable).

    Column builders that use an intermediate value several times would
    otherwise copy its whole expression tree into every use (and evaluate it
    that many times)."""
    return F.transform(F.array(value), body)[0]
