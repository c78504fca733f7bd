"""Documents to training tokens: quality rules, language ID, near duplicates,
mixing of sources, byte-level BPE.

Each stage takes the documents that its predecessor kept, and is written as
Parquet and read again before the next.  All but the last return the columns of
``documents``, whatever their names; the last gives ``(doc_id, n_tokens, ids)`` for each
document that the mix takes, as often as it takes it.

Defined results: a null or empty text has no words and goes with the base rules; a
null lang or source is a group of its own; rows that share an id count as one document,
so one of them stays; rows with a null id are linked with nothing and stay; an empty
table gives no rows.  Every stage writes a table under
``spark.checkpoint.dir`` and leaves it there (about three times the documents in all): a
lost executor costs the tasks that it had, a lost driver the stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cardforge.llm import bpe, language_id, mixing, ngram_join, quality
from cardforge.llm.common import materialize, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outlier of their language and source."""
    return quality.keep_good(docs)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which one known language makes up half at least."""
    return language_id.keep_identified(docs, least_score=0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the least id) of each group linked by shingles of five words, Jaccard 0.8 or more."""
    return ngram_join.keep_one(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them (0 to 3 times)."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each whole text."""
    return bpe.encode_documents(docs, RANKS, offsets=False)


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode),
]

#: robust covariance, expectation-maximisation and random rounding are not SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
    return docs
