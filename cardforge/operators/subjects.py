"""Subjects: categorising items by URL and counting them (CAT-1 .. CAT-3).

Writers (CAT-4 .. CAT-6) are in ``cardforge.sinks.files``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardforge.functions.urls import subject_of
from cardforge.operators.items import ordinals


def with_subject(items: DataFrame, url_col: str = "url") -> DataFrame:
    """CAT-1 as a column: ``subject`` = first path segment of the URL."""
    return items.withColumn("subject", subject_of(F.col(url_col)))


def group_by_subject(items: DataFrame) -> DataFrame:
    """CAT-2: items per subject in file order, kept flat:
    ``(subject, ordinal, row_no, pos, item)`` with ``ordinal`` = 1-based place
    of the item in its subject's list.

    A subject may hold a third of all items, so the list is never collected
    into one row or one task: items are sorted once over range partitions of
    (subject, row_no, pos), and numbered from the partitions' sizes."""
    df = with_subject(items) if "subject" not in items.columns else items
    return ordinals(df, ["subject"], ["row_no", "pos"])


def subject_counts(items: DataFrame) -> DataFrame:
    """CAT-3: items per subject, plus a total row (``subject`` null,
    ``level`` 1) carrying the grand total and the number of subjects."""
    df = with_subject(items) if "subject" not in items.columns else items
    return (df.rollup("subject")
            .agg(F.count(F.lit(1)).alias("n_items"), F.countDistinct("subject").alias("n_subjects"),
                 F.grouping_id().alias("level")))
