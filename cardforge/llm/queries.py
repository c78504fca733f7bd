"""Registered queries of the operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cardforge.llm import (bpe, divergence, embedding_dedup, hash_tree, language_id, main_text, mixing, ngram_join, periodic_runs,
                           quality, token_files, toxicity, url_filter)
from cardforge.llm.common import shared_path, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


#: host, path, verdict (fixed values)
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), width=3, percent=90)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), RANKS, digests=True)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, TOKENIZER, end_id=2)
    return token_files.crc_of_ids(token_files.read_token_files(spark, path))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract_pages(table(spark, sf_dir, "pages"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_repeats(table(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.find_runs(docs))


def op12_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.shard_table(table(spark, sf_dir, "documents"), hash_tree.balanced(8))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_mixing": op2_mixing,
    "op3_toxicity": op3_toxicity,
    "op4_quality": op4_quality,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_url_filter": op6_url_filter,
    "op7_token_files": op7_token_files,
    "op8_main_text": op8_main_text,
    "op9_language_id": op9_language_id,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_hash_tree": op12_hash_tree,
    "op13_divergence": op13_divergence,
}

# components of pairs(a, b): the least id reachable
_COMPONENTS = """
        sym AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
        reach(x, y) AS (SELECT a, b FROM sym UNION SELECT r.x, s.b FROM reach r JOIN sym s ON s.a = r.y),
        least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)"""

ORACLES: dict[str, str] = {
    "op1_ngram_join": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents),
        sh AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
            FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        pairs AS (
            SELECT x.doc_id AS a, y.doc_id AS b FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id
            JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
            GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 90 * (p.n + q.n - count(*))),
        {_COMPONENTS}
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(l.y, d.doc_id), d.doc_id) AS component_id
        FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least l ON l.x = d.doc_id
    """,
    "op8_main_text": """
        WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS a FROM pages),
        b AS (SELECT page_id, url, list_filter(list_transform(regexp_split_to_array(a, '</?(?:p|h1)>'), lambda x: trim(regexp_replace(
                         regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'), '\\s+', ' ', 'g'))), lambda x: x <> '') AS blocks
              FROM a),
        t AS (SELECT page_id, url, regexp_replace(replace(replace(replace(replace(replace(array_to_string(blocks, chr(10) || chr(10)),
                         '&middot;', '·'), '&copy;', '©'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;?', '&', 'g') AS text FROM b)
        SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM t
    """,
    "op10_embedding_dedup": f"""
        WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        pairs AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id < y.vec_id
                  WHERE list_cosine_similarity(x.e, y.e) >= 0.95),
        {_COMPONENTS},
        links AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM pairs UNION ALL SELECT b FROM pairs) GROUP BY id)
        SELECT v.vec_id, coalesce(k.n, 0) AS n_links, coalesce(least(l.y, v.vec_id), v.vec_id) AS component_id,
               coalesce(l.y >= v.vec_id, true) AS kept
        FROM v LEFT JOIN links k ON k.id = v.vec_id LEFT JOIN least l ON l.x = v.vec_id
    """,
    "op13_divergence": r"""
        WITH t AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        k AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM t) GROUP BY ALL HAVING count(*) >= 10),
        v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
        c AS (SELECT lang, source, term, count(*) AS c FROM (SELECT lang, source, unnest(w) AS term FROM t) JOIN k USING (lang, term)
              GROUP BY ALL),
        n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL),
        g AS (SELECT lang, source, coalesce(v, 0) AS v, coalesce(n, 0) AS n FROM (SELECT DISTINCT lang, source FROM t)
              LEFT JOIN n USING (lang, source) LEFT JOIN v USING (lang)),
        s AS (SELECT lang, source, term, coalesce(c, 0) AS c,
                     CAST(1 + 1000000000 * (CAST(coalesce(c, 0) AS HUGEINT) + 2) // (n + 2 * v) AS HUGEINT) AS p
              FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
        l AS (SELECT lang, term, CAST(1 + 1000000000 * (CAST(sum(c) AS HUGEINT) + 2) // (n + 2 * v) AS HUGEINT) AS q
              FROM c JOIN (SELECT lang, sum(n) AS n, max(v) AS v FROM g GROUP BY lang) USING (lang) GROUP BY lang, term, n, v),
        pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
                  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                  LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
                             FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) x
                  ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
        terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM s JOIN l USING (lang, term)
                  WHERE c > 0 AND p > q),
        r AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms),
        o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM o WHERE part = 'pair' OR rank <= 10
    """,
    "op6_url_filter": """
        WITH p AS (
            SELECT page_id, url,
                   translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
            FROM pages),
        r(rule_host, rule_path, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                              ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        best AS (
            SELECT p.page_id, p.url, p.host, p.path, arg_max(r.rule_host || r.rule_path, length(r.rule_host || r.rule_path)) AS rule,
                   arg_max(r.v, length(r.rule_host || r.rule_path)) AS v
            FROM p LEFT JOIN r ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host))
                              AND starts_with(p.path, r.rule_path)
            GROUP BY ALL)
        SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM best
    """,
}
