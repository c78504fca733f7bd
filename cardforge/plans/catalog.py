"""The query catalog: one entry per operator of the survey inventory.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the operator over the
driver's tables (or inputs Spark derives from them, see ``fixtures``);
``ORACLES[name]`` is DuckDB SQL over the same tables computing the expected
rows independently.  Column names match on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardforge.functions.fences import strip_fence
from cardforge.functions.text import decode_entities
from cardforge.functions.urls import resolve_url, subject_of
from cardforge.operators import crawl, dom, extraction, items, maintained, numbering, questions, subjects, tokens
from cardforge.plans import fixtures as fx
from cardforge.plans import lessons
from cardforge.session import apply_conf, checkpoint_dir, materialize
from cardforge.sinks import documents, files, published
from cardforge.sources import readers, snapshot
from cardforge.streaming import stateful, streams, totals

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return run
    return deco


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the cluster's checkpoint folder (shared storage)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/cardforge-{tag}-{uuid.uuid4().hex}"


def _ordinal(df: DataFrame, part: str, order: list[str]) -> DataFrame:
    """1-based rank inside a bounded group (one page's items)."""
    return df.withColumn("ordinal", F.row_number().over(Window.partitionBy(part).orderBy(*order)).cast("long"))


WS = r"'^\s+|\s+$', '', 'g'"  # DuckDB: ASCII strip (constructed texts only hold ASCII whitespace)


def _trim(x: str) -> str:
    return f"regexp_replace({x}, {WS})"


# ================================================================ columns: fences (JSN-1..4)

@query("fence_strict", f"""
WITH {fx.RECORDS_SQL}
SELECT row_no, {_trim(f"regexp_replace(regexp_replace({_trim('concept_and_mnemonic')}, '^```(json)?', ''), '```$', '')")}
       AS cleaned
FROM records""")
def q_fence_strict(spark, d):
    """JSN-1: strict fence cleaning of every record."""
    r = fx.records(spark, d)
    return r.select("row_no", strip_fence("concept_and_mnemonic", "strict").alias("cleaned"))


_G1 = _trim("concept_and_mnemonic")
_G2 = f"CASE WHEN starts_with({_G1}, '```json') THEN {_trim(f'substr({_G1}, 8)')} ELSE {_G1} END"
_G3 = f"CASE WHEN ends_with({_G2}, '```') THEN {_trim(f'left({_G2}, length({_G2}) - 3)')} ELSE {_G2} END"


@query("fence_guarded", f"""
WITH {fx.RECORDS_SQL}
SELECT row_no,
       CASE WHEN {_G1} = '' THEN concept_and_mnemonic
            WHEN starts_with({_G3}, '[') OR starts_with({_G3}, '{{') THEN {_G3}
            ELSE concept_and_mnemonic END AS cleaned
FROM records""")
def q_fence_guarded(spark, d):
    """JSN-2: guarded cleaning (unchanged unless the result starts with [ or {)."""
    r = fx.records(spark, d)
    return r.select("row_no", strip_fence("concept_and_mnemonic", "guarded").alias("cleaned"))


@query("fence_symmetric", f"""
WITH {fx.RECORDS_SQL}
SELECT row_no, {_trim(f"replace(trim({_trim('concept_and_mnemonic')}, '`'), 'json', '')")} AS cleaned
FROM records""")
def q_fence_symmetric(spark, d):
    """JSN-3: strip backticks at both ends, delete every 'json'."""
    r = fx.records(spark, d)
    return r.select("row_no", strip_fence("concept_and_mnemonic", "symmetric").alias("cleaned"))


@query("fence_collapse", f"""
WITH {fx.RECORDS_SQL}
SELECT row_no,
       replace(regexp_replace({_trim('concept_and_mnemonic')}, '(?i)^```json\\s*|\\s*```$', '', 'g'), '""', '"')
       AS cleaned
FROM records""")
def q_fence_collapse(spark, d):
    """JSN-4: case-insensitive fence removal and "" collapse."""
    r = fx.records(spark, d)
    return r.select("row_no", strip_fence("concept_and_mnemonic", "collapse").alias("cleaned"))


# ================================================================ records -> items (JSN-5..10, EXT-3)

@query("parse_rejects", f"""
WITH {fx.RECORDS_SQL}
SELECT row_no, CASE WHEN k % 19 = 0 OR k % 13 = 0 THEN 'missing' ELSE 'invalid_json' END AS reason
FROM records WHERE k % 19 = 0 OR k % 13 = 0 OR k % 17 = 0""")
def q_parse_rejects(spark, d):
    """JSN-5 + JSN-7: records skipped as missing or invalid JSON."""
    _, rejects = items.records_to_items(fx.records(spark, d))
    return rejects.select("row_no", "reason")


@query("drop_incomplete", f"""
WITH {fx.RECORDS_SQL}
SELECT row_no, regexp_replace(url, {WS}) AS url FROM records WHERE k % 19 <> 0 AND k % 13 <> 0""")
def q_drop_incomplete(spark, d):
    """JSN-7: rows kept after stripping, blank url or text removed."""
    kept, _ = items.drop_incomplete(fx.records(spark, d))
    return kept.select("row_no", "url")


@query("explode_items", f"""
WITH {fx.ITEMS_SQL}
SELECT row_no, pos, term, definition, mnemonic, keyword0, CAST(2 AS INTEGER) AS n_keywords FROM typed""")
def q_explode_items(spark, d):
    """JSN-5/6/8 + EXT-3: parsed items, typed view."""
    it, _ = items.records_to_items(fx.records(spark, d))
    t = items.harmonise_items(it)
    return t.select("row_no", F.col("pos").cast("long").alias("pos"), "term", "definition", "mnemonic",
                    F.col("keywords")[0].alias("keyword0"), F.size("keywords").alias("n_keywords"))


@query("harmonise_items", f"""
WITH {fx.ITEMS_SQL}
SELECT row_no, pos, term,
       CASE WHEN k % 7 = 0 THEN 'name' WHEN k % 7 = 1 THEN 'concept' ELSE 'term' END AS term_key
FROM typed""")
def q_harmonise_items(spark, d):
    """EXT-3: one term column over the term / name / concept shapes."""
    it, _ = items.records_to_items(fx.records(spark, d))
    t = items.harmonise_items(it)
    key = (F.when(items.item_field("item", "name").isNotNull(), "name")
           .when(items.item_field("item", "concept").isNotNull(), "concept").otherwise("term"))
    return t.select("row_no", F.col("pos").cast("long").alias("pos"), "term", key.alias("term_key"))


@query("as_item_array", """
SELECT event_id, CAST(1 AS INTEGER) AS n_items, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def q_as_item_array(spark, d):
    """JSN-6: a bare JSON object becomes a one-element item list."""
    ev = fx.table(spark, d, "events").withColumn("v", items.try_parse_value(F.col("props")))
    arr = items.as_item_array(F.col("v"))
    return ev.select("event_id", F.size(arr).alias("n_items"),
                     F.try_variant_get(arr[0], "$.k", "bigint").alias("k"))


@query("rewrap_roundtrip", f"""
WITH {fx.ITEMS_SQL}
SELECT row_no, pos, term FROM typed""")
def q_rewrap(spark, d):
    """JSN-9: items -> fenced array -> strict clean -> parse gives the same values."""
    it, _ = items.records_to_items(fx.records(spark, d))
    per_row = it.groupBy("row_no", "url").agg(items.ordered_items_json().alias("arr"))
    rec = per_row.select("row_no", "url", items.rewrap(F.col("arr")).alias("concept_and_mnemonic"))
    again, _ = items.records_to_items(rec)
    t = items.harmonise_items(again)
    return t.select("row_no", F.col("pos").cast("long").alias("pos"), "term")


@query("validity_report", f"""
WITH {fx.RECORDS_SQL}
SELECT row_no, NOT (k % 13 = 0 OR k % 17 = 0 OR k % 4 = 1) AS is_valid FROM records""")
def q_validity(spark, d):
    """JSN-10: every row kept with a validity flag (collapse cleaning)."""
    return items.validity_report(fx.records(spark, d)).select("row_no", "is_valid")


# ================================================================ numbering (NUM-1)

@query("number_items_rows", """
SELECT 'kept' AS kind, count(*) AS n FROM (SELECT DISTINCT l_orderkey FROM lineitem) WHERE l_orderkey % 10 <> 3
UNION ALL SELECT 'unchanged', count(*) FROM (SELECT DISTINCT l_orderkey FROM lineitem) WHERE l_orderkey % 10 = 7
UNION ALL SELECT 'dropped', count(*) FROM (SELECT DISTINCT l_orderkey FROM lineitem) WHERE l_orderkey % 10 = 3""")
def q_number_items_rows(spark, d):
    """NUM-1: rows kept, kept unchanged (no JSON) and dropped (bare objects)."""
    rec = fx.line_records(spark, d)
    rows, _ = items.number_items(rec)
    both = rec.select("row_no", F.col("concept_and_mnemonic").alias("old")).join(rows, "row_no", "left")
    kind = lambda name, cond: both.agg(F.lit(name).alias("kind"), F.count_if(cond).alias("n"))
    new = F.col("concept_and_mnemonic")
    return kind("kept", new.isNotNull()).union(kind("unchanged", new == F.col("old"))).union(kind("dropped", new.isNull()))


@query("number_items", """
SELECT l_orderkey AS row_no,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
            l_extendedprice, l_returnflag) - 1 AS INTEGER) AS pos,
       CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
            l_extendedprice, l_returnflag) AS BIGINT) AS count
FROM lineitem WHERE l_orderkey % 10 NOT IN (3, 7)""")
def q_number_items(spark, d):
    """NUM-1: global 1-based numbering over (order, line) without a
    single-partition window."""
    _, numbered = items.number_items(fx.line_records(spark, d))
    return numbered.select("row_no", F.col("pos").cast("int").alias("pos"), F.col("count").cast("long"))


# ================================================================ subjects (CAT-1..6)

@query("subject_of", """
SELECT page_id,
       coalesce(nullif(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/*([^/?#;]*)', 1), ''), 'unknown')
       AS subject
FROM pages""")
def q_subject_of(spark, d):
    """CAT-1: first path segment of each page URL (the language code)."""
    p = fx.table(spark, d, "pages")
    return p.select("page_id", subject_of("url").alias("subject"))


@query("group_by_subject", f"""
WITH {fx.ITEMS_SQL}
SELECT subject, CAST(row_number() OVER (PARTITION BY subject ORDER BY row_no, pos) AS BIGINT) AS ordinal,
       row_no, pos
FROM typed""")
def q_group_by_subject(spark, d):
    """CAT-2: items per subject in file order (flat, with ordinal)."""
    it, _ = items.records_to_items(fx.records(spark, d))
    g = subjects.group_by_subject(it)
    return g.select("subject", F.col("ordinal").cast("long"), "row_no", F.col("pos").cast("long").alias("pos"))


@query("subject_counts", f"""
WITH {fx.ITEMS_SQL}
SELECT subject, count(*) AS n_items, count(DISTINCT subject) AS n_subjects,
       CAST(GROUPING(subject) AS BIGINT) AS level
FROM typed GROUP BY ROLLUP (subject)""")
def q_subject_counts(spark, d):
    """CAT-3: items per subject, grand total and number of subjects."""
    it, _ = items.records_to_items(fx.records(spark, d))
    c = subjects.subject_counts(it)
    return c.select("subject", "n_items", "n_subjects", F.col("level").cast("long"))


def _items_with_subject(spark, d):
    it, _ = items.records_to_items(fx.records(spark, d))
    return subjects.with_subject(items.harmonise_items(it))


@query("write_by_subject", f"""
WITH {fx.ITEMS_SQL}
SELECT subject, row_no, pos, term FROM typed""")
def q_write_by_subject(spark, d):
    """CAT-4: one output folder per subject (dynamic overwrite); read back."""
    path = scratch(spark, "subjects")
    files.write_by_subject(_items_with_subject(spark, d).select("subject", "row_no", "pos", "term", "item"), path)
    back = spark.read.json(path)
    return back.select(F.col("subject").cast("string"), F.col("row_no").cast("long"),
                       F.col("pos").cast("long"), "term")


@query("write_all_subjects", f"""
WITH {fx.ITEMS_SQL}
SELECT subject, CAST(row_number() OVER (PARTITION BY subject ORDER BY row_no, pos) AS BIGINT) AS ordinal, term
FROM typed""")
def q_write_all_subjects(spark, d):
    """CAT-5: all subjects in one output (partitioned, with the in-subject
    ordinal that orders each subject's list); read back."""
    path = scratch(spark, "allsubjects")
    g = subjects.group_by_subject(_items_with_subject(spark, d))
    files.write_all_subjects(g.select("subject", "ordinal", "row_no", "pos", "term", "item"), path)
    back = spark.read.json(path)
    return back.select(F.col("subject").cast("string"), F.col("ordinal").cast("long"), "term")


@query("write_flat", f"""
WITH {fx.ITEMS_SQL}
SELECT row_no, pos, term FROM typed""")
def q_write_flat(spark, d):
    """CAT-6: every item in file order as JSON lines; read back."""
    path = scratch(spark, "flat")
    files.write_flat(_items_with_subject(spark, d).select("row_no", "pos", "term", "item"), path)
    back = spark.read.json(path)
    return back.select(F.col("row_no").cast("long"), F.col("pos").cast("long"), "term")


@query("subjects_document", f"""
WITH {fx.ITEMS_SQL}
SELECT subject, CAST(row_number() OVER (PARTITION BY subject ORDER BY row_no, pos) AS BIGINT) AS ordinal, term FROM typed""")
def q_subjects_document(spark, d):
    """CAT-5: all subjects as one JSON document written in parallel parts; read back
    in order, subjects found from the document's own keys."""
    path = scratch(spark, "document")
    it = _items_with_subject(spark, d)
    it = it.withColumn("item", F.struct("term", "item"))  # the harmonised term beside the item as it came
    documents.write_subjects_document(subjects.group_by_subject(it).select("subject", "ordinal", "item"), path)
    back = documents.read_document(spark, path)
    return back.select("subject", "ordinal", F.get_json_object("json", "$.term").alias("term"))


@query("flat_document", f"""
WITH {fx.ITEMS_SQL}
SELECT CAST(row_number() OVER (ORDER BY row_no, pos) AS BIGINT) AS ordinal, term FROM typed""")
def q_flat_document(spark, d):
    """CAT-6: all items in file order as one JSON array written in parallel parts."""
    path = scratch(spark, "document")
    it = _items_with_subject(spark, d)
    documents.write_flat_document(it.select("row_no", "pos", F.struct("term", "item").alias("item")), path)
    return documents.read_document(spark, path).select("ordinal", F.get_json_object("json", "$.term").alias("term"))


@query("numbered_batches", """
WITH n AS (SELECT l_orderkey AS row_no, count(*) AS n FROM lineitem GROUP BY 1)
SELECT row_no, CAST(1 + sum(n) OVER (ORDER BY row_no % 2, row_no) - n AS BIGINT) AS first, n FROM n""")
def q_numbered_batches(spark, d):
    """NUM-1 over runs: the lines of even orders get numbers first; the second batch has
    all orders, of which the even ones keep theirs; then it is replayed."""
    path = scratch(spark, "ledger")
    sizes = fx.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("row_no")).agg(F.count(F.lit(1)).alias("n"))
    numbering.number_batch(sizes.where("row_no % 2 = 0"), path, "even")
    numbering.number_batch(sizes, path, "all")
    return numbering.number_batch(sizes, path, "all")


# ================================================================ page structure (DOM-1..9, URL-1)

_TOKEN_SQL = r"""'</?[a-zA-Z](?:[^>"'']|"[^"]*"|''[^'']*'')*>|[^<]+|<'"""
_VOID_SQL = ", ".join(f"'{v}'" for v in tokens.VOID_ELEMENTS)

DOM_SQL = f"""
cleaned AS (SELECT page_id, url, {fx.CLEAN_HTML_SQL} AS h FROM pages),
arr AS (SELECT page_id, url, regexp_extract_all(h, {_TOKEN_SQL}) AS t FROM cleaned),
toks AS (SELECT page_id, url, unnest(t) AS raw, CAST(unnest(range(len(t))) AS INTEGER) AS pos FROM arr),
kinded AS (
  SELECT page_id, url, pos, raw,
         CASE WHEN regexp_matches(raw, '^<[a-zA-Z]') THEN 'start'
              WHEN regexp_matches(raw, '^</[a-zA-Z]') THEN 'end' ELSE 'text' END AS kind,
         lower(regexp_extract(raw, '^</?([a-zA-Z][^\\t\\n\\r\\f />\\x00]*)', 1)) AS name
  FROM toks),
flags AS (
  SELECT *, kind = 'end' OR (kind = 'start' AND NOT (name IN ({_VOID_SQL}) OR regexp_matches(raw, '/>$')))
         AS pairable
  FROM kinded),
lv AS (
  SELECT *, sum(CASE WHEN NOT pairable THEN 0 WHEN kind = 'start' THEN 1 ELSE -1 END)
            OVER (PARTITION BY page_id, name ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nl
  FROM flags),
keyed AS (SELECT *, CASE WHEN NOT pairable THEN NULL WHEN kind = 'end' THEN nl + 1 ELSE nl END AS key FROM lv),
mates AS (
  SELECT *, CASE WHEN pairable AND kind = 'start' AND lead(kind) OVER w = 'end' THEN lead(pos) OVER w END AS mate
  FROM keyed WINDOW w AS (PARTITION BY page_id, name, key ORDER BY pos)),
matched AS (SELECT page_id, pos AS s, mate AS e FROM mates WHERE mate IS NOT NULL),
uend AS (
  SELECT u.page_id, u.pos, min(m.e) AS e
  FROM mates u JOIN matched m ON m.page_id = u.page_id AND m.s < u.pos AND u.pos < m.e
  WHERE u.pairable AND u.kind = 'start' AND u.mate IS NULL GROUP BY u.page_id, u.pos),
lastp AS (SELECT page_id, max(pos) AS lp FROM toks GROUP BY page_id),
elems AS (
  SELECT x.page_id, x.url, x.pos, x.name, x.raw,
         CAST(CASE WHEN x.mate IS NOT NULL THEN x.mate WHEN x.pairable THEN coalesce(ue.e, lp.lp + 1)
                   ELSE x.pos END AS INTEGER) AS end_pos
  FROM mates x LEFT JOIN uend ue ON ue.page_id = x.page_id AND ue.pos = x.pos
  JOIN lastp lp ON lp.page_id = x.page_id
  WHERE x.kind = 'start'),
depths AS (
  SELECT a.page_id, a.pos, CAST(count(b.pos) AS INTEGER) AS depth
  FROM elems a LEFT JOIN elems b ON b.page_id = a.page_id AND b.pos < a.pos AND a.pos < b.end_pos
  GROUP BY a.page_id, a.pos)"""


@query("dom_nodes", f"""
WITH {DOM_SQL}
SELECT e.page_id, e.pos, e.name, e.end_pos, d.depth FROM elems e JOIN depths d USING (page_id, pos)""")
def q_dom_nodes(spark, d):
    """DOM-1: element intervals and nesting depth of every page."""
    n = dom.dom_nodes(fx.table(spark, d, "pages"))
    return n.filter(F.col("kind") == "start").select("page_id", "pos", "name", "end_pos",
                                                     F.col("depth").cast("int").alias("depth"))


_ARTICLE_SQL = "regexp_extract(html, '(?s)<article\\b[^>]*>.*?</article\\s*>', 0)"


@query("select_container", f"""
SELECT page_id, CAST(length(a) AS INTEGER) AS n_chars, md5(a) AS container_md5
FROM (SELECT page_id, {_ARTICLE_SQL} AS a FROM pages) WHERE a <> ''""")
def q_select_container(spark, d):
    """DOM-2: the first container element (here ``article``) of each page."""
    t = dom.page_trees(fx.table(spark, d, "pages"))
    c = dom.container_markup(t, dom.element("article"))
    return c.select("page_id", F.length("container_html").alias("n_chars"),
                    F.md5("container_html").alias("container_md5"))


@query("split_heading", """
SELECT p_partkey AS page_id,
       CASE WHEN p_partkey % 4 IN (0, 1) THEN p_name
            WHEN p_partkey % 4 = 2 THEN p_name || '-' || lower(p_type)
            ELSE p_name || ' ' || lower(p_type) END AS word,
       CASE WHEN p_partkey % 4 IN (0, 1) THEN lower(p_type) ELSE p_brand || ' part' END AS definition
FROM part""")
def q_split_heading(spark, d):
    """DOM-3: word / definition from the first h1 (dash rules, next sibling)."""
    return dom.split_heading(dom.page_trees(fx.heading_pages(spark, d)))


def _block_trees(spark, d):
    return dom.page_trees(fx.block_pages(spark, d))


@query("page_images", """
SELECT p_partkey // 50 AS page_id,
       CAST(row_number() OVER (PARTITION BY p_partkey // 50 ORDER BY p_partkey) AS BIGINT) AS ordinal,
       'https://cards.example.net/img/' || CAST(p_partkey AS VARCHAR) || '.png' AS image
FROM part WHERE (p_partkey + 2) % 5 = 0""")
def q_page_images(spark, d):
    """DOM-4: container images, resolved, in order."""
    im = dom.page_images(_block_trees(spark, d))
    return _ordinal(im, "page_id", ["pos"]).select("page_id", "ordinal", "image")


@query("highlights", f"""
WITH {fx.BLOCKS_SQL}
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY k) AS BIGINT) AS ordinal, highlight
FROM bmn""")
def q_highlights(spark, d):
    """DOM-5: red-span highlights of the processed blocks."""
    h = dom.highlights(_block_trees(spark, d))
    return _ordinal(h, "page_id", ["block_pos", "pos"]).select("page_id", "ordinal", "highlight")


@query("mnemonic_blocks", f"""
WITH {fx.BLOCKS_SQL}
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY k) AS BIGINT) AS ordinal, mnemonic
FROM bmn""")
def q_mnemonic_blocks(spark, d):
    """DOM-6: first qualifying block per image segment (all before the first image)."""
    m = dom.mnemonic_blocks(_block_trees(spark, d))
    return _ordinal(m, "page_id", ["pos"]).select("page_id", "ordinal", "mnemonic")


LESSONS_SQL = f"""
{fx.BLOCKS_SQL},
pg AS (SELECT p_partkey // 50 AS page_id, count(*) AS n_parts,
              sum(CASE WHEN (p_partkey + 2) % 5 = 0 THEN 1 ELSE 0 END) AS n_img FROM part GROUP BY 1),
mn AS (SELECT page_id, count(*) AS n_mn, string_agg(mnemonic, '|' ORDER BY k) AS mns, string_agg(highlight, '|' ORDER BY k) AS hls
       FROM bmn GROUP BY 1),
ims AS (SELECT p_partkey // 50 AS page_id,
               string_agg('https://cards.example.net/img/' || CAST(p_partkey AS VARCHAR) || '.png', '|' ORDER BY p_partkey) AS ims
        FROM part WHERE (p_partkey + 2) % 5 = 0 GROUP BY 1),
lessons AS (
  SELECT pg.page_id, 'https://cards.example.net/blocks/' || CAST(pg.page_id AS VARCHAR) || '.html' AS url,
         'Block ' || CAST(pg.page_id AS VARCHAR) AS word, CAST(pg.n_parts AS VARCHAR) || ' parts' AS definition,
         CAST(coalesce(mn.n_mn, 0) AS INTEGER) AS n_mnemonic, CAST(coalesce(mn.n_mn, 0) AS INTEGER) AS n_highlight,
         CAST(pg.n_img AS INTEGER) AS n_images, coalesce(mns, '') AS mnemonics, coalesce(hls, '') AS highlights,
         coalesce(ims, '') AS images
  FROM pg LEFT JOIN mn USING (page_id) LEFT JOIN ims USING (page_id))"""


@query("extract_lessons", f"""
WITH {LESSONS_SQL}
SELECT * FROM lessons""")
def q_extract_lessons(spark, d):
    """DOM-7: one lesson record per page with a container, contents compared."""
    return _lesson_columns(dom.extract_lessons(fx.block_pages(spark, d)))


def _lesson_columns(ls: DataFrame) -> DataFrame:
    return ls.select("page_id", "url", "word", "definition", F.size("mnemonic").alias("n_mnemonic"),
                     F.size("highlighted_text").alias("n_highlight"), F.size("images").alias("n_images"),
                     F.array_join("mnemonic", "|").alias("mnemonics"), F.array_join("highlighted_text", "|").alias("highlights"),
                     F.array_join("images", "|").alias("images"))


_NEXT_SQL = """
SELECT o_orderkey AS page_id,
       CASE WHEN o_orderkey % 1000 = 500 THEN 'https://shop.example.net/o/missing-' || CAST(o_orderkey AS VARCHAR) || '.html'
            WHEN o_orderkey % 150 <> 149 THEN 'https://shop.example.net/o/' || CAST(o_orderkey + 1 AS VARCHAR) || '.html'
            WHEN (o_orderkey // 150) % 2 = 0 THEN 'https://shop.example.net/o/' || CAST(o_orderkey - 149 AS VARCHAR) || '.html'
       END AS next_url
FROM orders"""


@query("next_links", _NEXT_SQL)
def q_next_links(spark, d):
    """DOM-8: the next-page link of every page, resolved."""
    t = dom.page_trees(fx.chain_pages(spark, d))
    return dom.next_links(t).select("page_id", "next_url")


@query("index_links", f"""
WITH navs AS (SELECT page_id, regexp_extract({fx.CLEAN_HTML_SQL}, '(?s)<nav\\b[^>]*>.*?</nav\\s*>', 0) AS nav
              FROM pages),
hrefs AS (SELECT page_id, regexp_extract_all(nav, '<a\\s[^>]*href="([^"]*)"', 1) AS hs FROM navs),
flat AS (SELECT page_id, unnest(hs) AS href, unnest(range(len(hs))) AS i FROM hrefs)
SELECT page_id, CAST(i + 1 AS BIGINT) AS ordinal, 'https://site.example.net' || replace(href, '&amp;', '&') AS link
FROM flat""")
def q_index_links(spark, d):
    """DOM-9: every link of the first nav block, resolved against a fixed base."""
    t = dom.page_trees(fx.table(spark, d, "pages"))
    links = dom.index_links(t, dom.element("nav"), base="https://site.example.net/")
    return _ordinal(links, "page_id", ["pos"]).select("page_id", "ordinal", "link")


@query("index_links_all", """
WITH b AS (SELECT o_orderkey AS k, o_orderkey // 150 AS b FROM orders WHERE o_orderkey % 150 = 0)
SELECT b // 10 AS page_id, CAST(row_number() OVER (PARTITION BY b // 10 ORDER BY b % 3, k) AS BIGINT) AS ordinal,
       'https://shop.example.net/o/' || CAST(k AS VARCHAR) || '.html' AS link
FROM b""")
def q_index_links_all(spark, d):
    """DOM-9: the links of every container, whatever its tag."""
    links = dom.index_links(dom.page_trees(fx.index_pages(spark, d)))
    return _ordinal(links, "page_id", ["pos"]).select("page_id", "ordinal", "link")


@query("select_container_empty", """
SELECT o_orderkey AS page_id, CASE WHEN o_orderkey % 3 = 0 THEN '<div id="mainContent"><!-- k --><script>if (1<2) x="</div>"</script>'
       || CAST(o_orderkey AS VARCHAR) || '</div>' ELSE '' END AS container_html
FROM orders""")
def q_select_container_empty(spark, d):
    """DOM-2, on_missing='empty': pages without a container are kept with ''; markup
    keeps comments and scripts."""
    k = F.col("o_orderkey").cast("string")
    box = F.concat(F.lit('<div id="mainContent"><!-- k --><script>if (1<2) x="</div>"</script>'), k, F.lit("</div>"))
    html = F.concat(F.lit("<body><p>a"), F.when(F.col("o_orderkey") % 3 == 0, box).otherwise(F.lit("<p>none")), F.lit("</body>"))
    pages = fx.table(spark, d, "orders").select(F.col("o_orderkey").alias("page_id"), F.lit("https://h/").alias("url"), html.alias("html"))
    return dom.container_markup(dom.page_trees(pages), on_missing="empty").select("page_id", "container_html")


@query("dom_nodes_misnested", """
SELECT p_partkey AS page_id, CAST(u.pos AS INTEGER) AS pos, u.name, CAST(u.end_pos AS INTEGER) AS end_pos, CAST(u.depth AS INTEGER) AS depth
FROM part, (VALUES (0, 'div', 11, 0, 0), (1, 'p', 11, 1, 0), (3, 'b', 7, 2, 0), (4, 'i', 7, 3, 0), (5, 'span', 7, 4, 0), (8, 'em', 10, 2, 0),
                   (0, 'ul', 8, 0, 1), (1, 'li', 8, 1, 1), (2, 'img', 2, 2, 1), (4, 'li', 8, 2, 1), (5, 'a', 8, 3, 1), (9, 'p', 12, 0, 1),
                   (10, 'p', 12, 1, 1)) u(pos, name, end_pos, depth, kind)
WHERE p_partkey % 2 = u.kind""")
def q_dom_nodes_misnested(spark, d):
    """DOM-1 on misnested pages: expected places are written out by hand.
    Even parts: <div><p>text<b><i><span>x</b><em>y</em></div>; odd parts: items
    and paragraphs without end tags, a stray end tag."""
    p = fx.table(spark, d, "part")
    name = F.col("p_name")
    even = F.concat(F.lit("<div><p>"), name, F.lit("<b><i><span>x</b><em>y</em></div>"))
    odd = F.concat(F.lit("<ul><li><img src=a>"), name, F.lit("<li><a href=b>x</q></ul><p><p>"), name)
    pages = p.select(F.col("p_partkey").alias("page_id"), F.lit("https://h/").alias("url"),
                     F.when(F.col("p_partkey") % 2 == 0, even).otherwise(odd).alias("html"))
    n = dom.dom_nodes(pages)
    return n.filter("kind = 'start'").select("page_id", "pos", "name", "end_pos", "depth")


# Character references and what they stand for.
REFERENCES = {"&oslash;": "ø", "&ugrave;": "ù", "&rarr;": "→", "&copy 2020": "© 2020", "a&nbsp": "a\u00a0", "&#0000000065;": "A", "&#38;lt;": "&lt;",
              "&amp;amp;": "&amp;", "&#x1F600;": "\U0001F600", "&unknown;": "&unknown;", "&#128;": "€", "&notit;": "¬it;"}
_REF_SQL = ", ".join("('" + k.replace("'", "''") + "', '" + v + "')" for k, v in REFERENCES.items())


@query("entities", f"""
SELECT p_partkey, r.ref, p_name || ' ' || r.txt || ' ' || p_name AS decoded FROM part, (VALUES {_REF_SQL}) r(ref, txt)""")
def q_entities(spark, d):
    """Character references in text: full table, optional semicolon, one pass."""
    refs = spark.createDataFrame([(k,) for k in REFERENCES], "ref string")
    p = fx.table(spark, d, "part").select("p_partkey", "p_name").crossJoin(F.broadcast(refs))
    text = F.concat("p_name", F.lit(" "), "ref", F.lit(" "), "p_name")
    return p.select("p_partkey", "ref", decode_entities(text).alias("decoded"))


# The relative reference forms resolved against every page URL.
HREF_FORMS = ["img/x.png", "../up.html", "/root.html", "?q=1", "#frag", "//cdn.example.org/lib.js",
              "https://other.example.org/a", "./here/", "", "a/../b.html"]


@query("resolve_url", """
WITH u AS (
  SELECT page_id, url,
         regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1) AS scheme,
         regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/?#]*)', 1) AS auth,
         regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(url, '^[^?#]*(\\?[^#]*)', 1) AS query
  FROM pages),
v AS (
  SELECT *, scheme || ':' || auth AS origin,
         CASE WHEN regexp_replace(path, '[^/]*$', '') = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END AS dir
  FROM u),
w AS (SELECT *, CASE WHEN dir = '/' THEN '/' ELSE regexp_replace(dir, '[^/]*/$', '') END AS parent FROM v)
SELECT page_id, form, resolved FROM (
  SELECT page_id, CAST(0 AS INTEGER) AS form, origin || dir || 'img/x.png' AS resolved FROM w UNION ALL
  SELECT page_id, 1, origin || parent || 'up.html' FROM w UNION ALL
  SELECT page_id, 2, origin || '/root.html' FROM w UNION ALL
  SELECT page_id, 3, origin || path || '?q=1' FROM w UNION ALL
  SELECT page_id, 4, origin || path || query || '#frag' FROM w UNION ALL
  SELECT page_id, 5, scheme || '://cdn.example.org/lib.js' FROM w UNION ALL
  SELECT page_id, 6, 'https://other.example.org/a' FROM w UNION ALL
  SELECT page_id, 7, origin || dir || 'here/' FROM w UNION ALL
  SELECT page_id, 8, url FROM w UNION ALL
  SELECT page_id, 9, origin || dir || 'b.html' FROM w)""")
def q_resolve_url(spark, d):
    """URL-1: reference resolution of ten relative forms against every page URL."""
    p = fx.table(spark, d, "pages").select("page_id", "url")
    forms = spark.createDataFrame([(i, h) for i, h in enumerate(HREF_FORMS)], "form int, href string")
    j = p.crossJoin(F.broadcast(forms))
    return j.select("page_id", "form", resolve_url(F.col("url"), F.col("href")).alias("resolved"))


# ================================================================ traversal (TRV-1..5)

def _chain_links(spark, d):
    return dom.next_links(dom.page_trees(fx.chain_pages(spark, d))).select("url", "next_url")


def _seeds(spark, d):
    return fx.table(spark, d, "orders").select(F.col("o_orderkey").alias("seed_id"), fx.order_url("o_orderkey").alias("url"))


@query("follow_chain", f"""
WITH {fx.CHAIN_SQL}
SELECT seed_id, depth, url FROM cvisit""")
def q_follow_chain(spark, d):
    """TRV-1: every page each seed's next-link walk visits, with depth."""
    return crawl.follow_chain(_chain_links(spark, d), _seeds(spark, d))


@query("visit_single", """
SELECT o_orderkey AS seed_id, CAST(0 AS BIGINT) AS depth,
       'https://shop.example.net/o/' || CAST(o_orderkey AS VARCHAR) || '.html' AS url
FROM orders""")
def q_visit_single(spark, d):
    """TRV-2: one visit per seed present in the snapshot (as many seeds are not)."""
    seeds = _seeds(spark, d)
    missing = seeds.select("seed_id", F.replace("url", F.lit("/o/"), F.lit("/gone/")).alias("url"))
    return crawl.visit_single(fx.chain_pages(spark, d), seeds.unionByName(missing))


@query("until_first_repeat", """
WITH h AS (SELECT source, doc_id, md5(text) AS hh FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY source, hh ORDER BY doc_id) > 1 AS rep FROM h),
m AS (SELECT *, max(CASE WHEN rep THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY doc_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen FROM r)
SELECT source, doc_id FROM m WHERE seen = 0""")
def q_until_first_repeat(spark, d):
    """TRV-3: per source, documents up to the first repeated content."""
    docs = fx.table(spark, d, "documents")
    return crawl.until_first_repeat(docs, "source", "doc_id", "text").select("source", "doc_id")


def _customer_urls(spark, d):
    c = fx.table(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("seed_id"), "c_mktsegment",
                    F.concat(F.lit("https://shop.example.net/c/"), F.col("c_custkey").cast("string")).alias("url"))


@query("skip_done", """
SELECT c_custkey AS seed_id, 'https://shop.example.net/c/' || CAST(c_custkey AS VARCHAR) AS url
FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def q_skip_done(spark, d):
    """TRV-4: seeds already in the previous output are skipped."""
    cu = _customer_urls(spark, d)
    # the previous output: BUILDING customers done, HOUSEHOLD rows without a url
    prior = cu.filter(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD")).select(
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("url")).alias("url"))
    return crawl.skip_done(cu.select("seed_id", "url"), readers.done_urls(prior))


@query("crawl_all_repeats", f"""
WITH {fx.CHAIN_SQL}
SELECT url, count(*) AS visits, min(depth) AS first_depth, max(depth) AS last_depth FROM cvisit GROUP BY url""")
def q_crawl_all_repeats(spark, d):
    """TRV-5, default: pages that several walks share are visited by each."""
    w = crawl.crawl_all(_chain_links(spark, d), _seeds(spark, d))
    return w.groupBy("url").agg(F.count(F.lit(1)).alias("visits"), F.min("depth").alias("first_depth"),
                                F.max("depth").alias("last_depth"))


@query("maintained_walks", f"""
WITH {fx.CHAIN_SQL}
SELECT url, count(*) AS visits, min(depth) AS first_depth, max(depth) AS last_depth FROM cvisit GROUP BY url""")
def q_maintained_walks(spark, d):
    """TRV-1 from kept jump tables: built without every 997th page and with wrong links of
    others, which a second version adds and mends."""
    links = materialize(_chain_links(spark, d), "links")
    late = F.pmod(F.xxhash64("url"), F.lit(997))
    tables = maintained.WalkTables(spark, scratch(spark, "walk-tables"))
    tables.update(links.where(late > 0).select("url", F.when(late == 1, F.lit("https://shop.example.net/gone")).otherwise(F.col("next_url")).alias("next_url")))
    tables.update(links.where(late <= 1))
    w = tables.walks(_seeds(spark, d))
    return w.groupBy("url").agg(F.count(F.lit(1)).alias("visits"), F.min("depth").alias("first_depth"), F.max("depth").alias("last_depth"))


@query("crawl_all", f"""
WITH {fx.CHAIN_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seed_id, depth) AS rn FROM cvisit)
SELECT url, seed_id, depth FROM ranked WHERE rn = 1""")
def q_crawl_all(spark, d):
    """TRV-5: union of all walks, each page once (dedup='global')."""
    w = crawl.crawl_all(_chain_links(spark, d), _seeds(spark, d), dedup="global")
    return w.select("url", "seed_id", "depth")


# ================================================================ model requests (EXT-1, EXT-2)

# Which template the pages of a seed list (here a language folder) are asked with
ROUTES = [("/de/", "vocab"), ("/fr/", "names"), ("/es/", "multiple")]
_ROUTE_SQL = "CASE " + " ".join(f"WHEN contains(url, '{p}') THEN '{t}'" for p, t in ROUTES) + " ELSE 'general' END"


@query("extraction_requests", f"""
WITH a AS (SELECT page_id, url, {_ROUTE_SQL} AS template, {_ARTICLE_SQL} AS input FROM pages)
SELECT sha256(template || chr(1) || url || chr(1) || input) AS request_id, page_id, template,
       CAST(length(input) AS INTEGER) AS n_input, md5(input) AS input_md5
FROM a""")
def q_extraction_requests(spark, d):
    """EXT-1: one request per page by its seed list's template; input = container markup."""
    t = dom.page_trees(fx.table(spark, d, "pages"))
    r = extraction.extraction_requests(t, ROUTES, pred=dom.element("article"))
    return r.select("request_id", "page_id", "template", F.length("input").alias("n_input"), F.md5("input").alias("input_md5"))


def _conversation_tables(spark, d):
    c = fx.table(spark, d, "conversations")
    rid = lambda turn: F.sha2(F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string")), 256)  # noqa
    requests = c.filter(F.col("role") == "user").select(rid(F.col("turn")).alias("request_id"), "conv_id", "turn",
                                                        F.col("text").alias("input"))
    responses = c.filter(F.col("role") == "assistant").select(rid(F.col("turn") - 1).alias("request_id"),
                                                              F.col("text").alias("output_text"))
    return requests, responses


@query("attach_responses", """
SELECT u.conv_id, u.turn, CAST(length(u.text) AS INTEGER) AS n_input,
       CAST(length(a.text) AS INTEGER) AS n_output
FROM conversations u JOIN conversations a
  ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
WHERE u.role = 'user'""")
def q_attach_responses(spark, d):
    """EXT-2: answers joined to their requests (raw output kept)."""
    req, resp = _conversation_tables(spark, d)
    answered, _ = extraction.attach_responses(req, resp)
    return answered.select("conv_id", "turn", F.length("input").alias("n_input"),
                           F.length("concept_and_mnemonic").alias("n_output"))


@query("unanswered_requests", """
SELECT u.conv_id, u.turn FROM conversations u
WHERE u.role = 'user' AND NOT EXISTS (
  SELECT 1 FROM conversations a WHERE a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant')""")
def q_unanswered(spark, d):
    """EXT-2: requests without an answer are reported, not kept."""
    req, resp = _conversation_tables(spark, d)
    _, unanswered = extraction.attach_responses(req, resp)
    return unanswered.select("conv_id", "turn")


def _repeated(responses):
    """Every answer twice, a null one, and a later (greater) text for each."""
    later = responses.withColumn("output_text", F.concat("output_text", F.lit(" again")))
    return responses.union(responses).union(later).union(responses.withColumn("output_text", F.lit(None).cast("string")))


@query("attach_responses_repeated", """
SELECT u.conv_id, u.turn, md5(a.text) AS answer FROM conversations u LEFT JOIN conversations a
  ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' AND a.turn % 4 <> 3
WHERE u.role = 'user'""")
def q_attach_responses_repeated(spark, d):
    """EXT-2: answers delivered several times count once; requests that got only
    null answers are unanswered."""
    req, resp = _conversation_tables(spark, d)
    null_ids = req.where("(turn + 1) % 4 = 3").select("request_id").withColumn("output_text", F.lit(None).cast("string"))
    some = resp.join(null_ids.select("request_id"), "request_id", "left_anti").union(null_ids)
    answered, unanswered = extraction.attach_responses(req, _repeated(some))
    one = answered.select("conv_id", "turn", F.md5("concept_and_mnemonic").alias("answer"))
    return one.union(unanswered.select("conv_id", "turn", F.lit(None).cast("string")))


# ================================================================ flashcard questions (QST-1..7)

QITEMS_SQL = fx.RECORDS_SQL + """,
qitems AS (
  SELECT row_no, k, p_name, p_brand, subject, p_size, CAST(i AS INTEGER) AS pos,
         p_name || ' ' || CAST(i AS VARCHAR) AS term,
         CASE WHEN k % 7 IN (0, 1) THEN 'skip' WHEN (k + i) % 5 = 0 THEN 'rule' ELSE 'ask' END AS route
  FROM records, range(0, 3) t(i)
  WHERE k % 13 <> 0 AND k % 17 <> 0 AND k % 4 <> 1 AND k % 11 <> 0 AND i < n_items)"""


def _question_items(spark, d):
    return questions.parse_record_items(fx.records(spark, d))


@query("question_route", f"""
WITH {QITEMS_SQL}
SELECT row_no, pos, route FROM qitems""")
def q_question_route(spark, d):
    """QST-1: skip / rule / ask per item of the records questions can rewrite."""
    return _question_items(spark, d).select("row_no", "pos", "route")


_QINPUT = ("""'Term: "' || term || '"' || chr(10) || 'Definition: "' || subject || ' size ' || CAST(p_size AS VARCHAR)"""
           f""" || '"' || chr(10) || 'Mnemonic: "' || {fx.mnemonic_sql()} || '"'""")


@query("question_requests", f"""
WITH {QITEMS_SQL}
SELECT sha256('question' || chr(1) || CAST(row_no AS VARCHAR) || chr(1) || CAST(pos AS VARCHAR) || chr(1)
              || {_QINPUT}) AS request_id, row_no, pos, {_QINPUT} AS input
FROM qitems WHERE route = 'ask'""")
def q_question_requests(spark, d):
    """QST-3: one request per 'ask' item (term, definition, mnemonic lines)."""
    r = questions.question_requests(_question_items(spark, d))
    return r.select("request_id", "row_no", "pos", "input")


def _question_responses(spark, d, it, req):
    """Answers for the requests, derived from the items: every request except
    those with (row_no + pos) % 7 = 3 (a failed call) gets a quoted answer."""
    term = items.item_field("item", "term")
    ans = req.join(it.select("row_no", "pos", term.alias("term")), ["row_no", "pos"]) \
        .filter((F.col("row_no") + F.col("pos")) % 7 != 3)
    return ans.select("request_id", F.concat(F.lit('  "How is '), F.col("term"), F.lit(' described?" '))
                      .alias("output_text"))


def _applied(spark, d):
    rec = fx.records(spark, d)
    it = questions.parse_record_items(rec)
    req = questions.question_requests(it)
    return rec, questions.apply_questions(rec, req, _question_responses(spark, d, it, req), items=it)


@query("apply_questions", f"""
WITH {QITEMS_SQL}
SELECT row_no, pos,
       CASE WHEN route = 'skip' THEN NULL
            WHEN route = 'rule' THEN 'What is the first name associated with ' || term || '?'
            WHEN (row_no + pos) % 7 = 3 THEN 'What is ' || term || '?'
            ELSE 'How is ' || term || ' described?' END AS question
FROM qitems""")
def q_apply_questions(spark, d):
    """QST-2/4/5/6: questions written into the records (rule, cleaned answer,
    or fallback); read back from the rewritten text."""
    _, after = _applied(spark, d)
    again = questions.parse_record_items(after)
    return again.select("row_no", F.col("pos").cast("int"), items.item_field("item", "question").alias("question"))


@query("apply_questions_repeated", f"""
WITH {QITEMS_SQL}
SELECT row_no, pos, count(*) AS copies,
       max(CASE WHEN route = 'skip' THEN NULL
                WHEN route = 'rule' THEN 'What is the first name associated with ' || term || '?'
                WHEN (row_no + pos) % 7 = 3 THEN 'What is ' || term || '?'
                ELSE 'How is ' || term || ' described?' END) AS question
FROM qitems GROUP BY row_no, pos""")
def q_apply_questions_repeated(spark, d):
    """QST-6: requests made twice and answered several times leave one item each."""
    rec = fx.records(spark, d)
    it = questions.parse_record_items(rec)
    req = questions.question_requests(it)
    after = questions.apply_questions(rec, req.union(req), _repeated(_question_responses(spark, d, it, req)), items=it)
    again = questions.parse_record_items(after).select("row_no", F.col("pos").cast("int"), items.item_field("item", "question").alias("q"))
    return again.groupBy("row_no", "pos").agg(F.count(F.lit(1)).alias("copies"), F.max("q").alias("question"))


@query("run_summary", f"""
WITH {fx.RECORDS_SQL}
SELECT count(*) AS total,
       count(*) FILTER (WHERE k % 13 <> 0 AND k % 17 <> 0 AND k % 4 <> 1 AND k % 11 <> 0) AS processed,
       count(*) FILTER (WHERE k % 13 <> 0 AND (k % 17 = 0 OR k % 4 = 1 OR k % 11 = 0)) AS errors
FROM records""")
def q_run_summary(spark, d):
    """QST-7: total, processed (text changed) and errors (unchanged)."""
    before, after = _applied(spark, d)
    return questions.run_summary(before, after)


# ================================================================ sources (SRC-1..5)

@query("read_pages", """
SELECT page_id, url, CAST(length(html) AS INTEGER) AS n_chars FROM pages""")
def q_read_pages(spark, d):
    """SRC-1: the listed URLs the snapshot holds (unlisted / missing give no row)."""
    p = fx.table(spark, d, "pages").select("url")
    listed = p.unionByName(p.select(F.concat("url", F.lit("?missing=1")).alias("url")))
    pages = readers.read_pages(spark, f"{d.rstrip('/')}/pages.parquet", listed)
    return pages.select("page_id", "url", F.length("html").alias("n_chars"))


@query("read_urls", """
SELECT page_id, url, CAST(length(html) AS INTEGER) AS n_chars FROM pages
WHERE url IN (SELECT url FROM pages WHERE page_id % 3 = 0)""")
def q_read_urls(spark, d):
    """SRC-1 by URL: a third of the pages from a snapshot clustered by URL hash (as many wanted URLs are missing)."""
    pages, path = fx.table(spark, d, "pages"), scratch(spark, "snapshot")
    snapshot.write_snapshot(pages, path)
    wanted = pages.where("page_id % 3 = 0").select("url")
    found = snapshot.read_urls(spark, path, wanted.union(wanted.select(F.concat("url", F.lit("?missing=1")))))
    return found.select("page_id", "url", F.length("html").alias("n_chars"))


def _records_csv(spark, d) -> str:
    """Two inputs of different column order and one of them with a third column."""
    path = scratch(spark, "records-csv")
    r = fx.records(spark, d)
    files.refresh_rows(r.where("row_no % 2 = 0").select("concept_and_mnemonic", "url"), path, fmt="csv")
    files.append_rows(r.where("row_no % 2 = 1").select("url", F.col("row_no").cast("string").alias("mainContent"), "concept_and_mnemonic"),
                      path, fmt="csv")
    return path


@query("read_records", f"""
WITH {fx.RECORDS_SQL}
SELECT url, concept_and_mnemonic, CASE WHEN row_no % 2 = 1 THEN CAST(row_no AS VARCHAR) END AS mainContent FROM records""")
def q_read_records(spark, d):
    """SRC-2: CSV files of differing column order, fields found by header name."""
    r = readers.read_records(spark, _records_csv(spark, d))
    return r.select("url", "concept_and_mnemonic", "mainContent")


@query("read_records_order", """
SELECT o_orderkey AS k, CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS row_no FROM orders""")
def q_read_records_order(spark, d):
    """SRC-2: ``row_no`` follows file names, then lines, over files of any size."""
    path = scratch(spark, "ordered-csv")
    o = fx.table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("url"), F.lit("x").alias("concept_and_mnemonic"))
    files.refresh_rows(o.orderBy(F.col("url").cast("long")), path, fmt="csv")
    r = readers.read_records(spark, path)
    # rows counted without the header line of each file
    r = items.ordinals(r.select(F.col("url").cast("long").alias("k"), "row_no"), [], ["row_no"])
    return r.select("k", (F.col("ordinal") - 1).cast("long").alias("row_no"))


@query("read_records_positional", f"""
WITH {fx.RECORDS_SQL}, files AS (SELECT row_no % 2 AS f, count(*) AS n FROM records GROUP BY 1)
SELECT CAST(2 AS INTEGER) AS n_fields, concept_and_mnemonic AS _c0, url AS _c1 FROM records WHERE row_no % 2 = 0
UNION ALL SELECT 3, url, CAST(row_no AS VARCHAR) FROM records WHERE row_no % 2 = 1""")
def q_read_records_positional(spark, d):
    """SRC-3: positional read of rows of two and three fields (header lines, one a
    written file, are data rows and left out here)."""
    r = readers.read_records_positional(spark, _records_csv(spark, d))
    return r.where(~F.col("_c0").isin("url", "concept_and_mnemonic")).select(F.col("n_fields").cast("int"), "_c0", "_c1")


_WIDE_SQL = """
wide AS (SELECT p_partkey AS k, CAST(p_partkey % 11 + 1 AS INTEGER) AS n_fields, p_name FROM part),
cells AS (SELECT k, n_fields, CAST(i AS INTEGER) AS i,
                 CASE WHEN i % 3 = 1 THEN '' WHEN i = 0 THEN CAST(k AS VARCHAR) ELSE p_name || ' "' || CAST(i AS VARCHAR) || '", ' || chr(10) END AS v
          FROM wide, range(0, 11) t(i) WHERE i < n_fields)"""


def _wide_csv(spark, d) -> str:
    path = scratch(spark, "wide-csv")
    k = F.col("p_partkey")
    cell = lambda i: (F.when(i % 3 == 1, F.lit("")).when(i == 0, k.cast("string"))
                      .otherwise(F.concat(F.lit('"'), F.col("p_name"), F.lit(' ""'), i.cast("string"), F.lit('"", \n"'))))
    line = F.array_join(F.transform(F.sequence(F.lit(0), (k % 11).cast("int")), cell), ",")
    fx.table(spark, d, "part").select(line.alias("value")).write.text(path)
    return path


@query("positional_wide", f"""
WITH {_WIDE_SQL}
SELECT k, n_fields, i, v FROM cells""")
def q_positional_wide(spark, d):
    """SRC-3: rows of 1 to 11 fields, empty ones included, none lost."""
    r = readers.read_records_positional(spark, _wide_csv(spark, d))
    cells = r.select(F.col("_c0").cast("long").alias("k"), "n_fields", F.posexplode("fields").alias("i", "v"))
    return cells.select("k", "n_fields", "i", "v")


@query("rewrite_positional", f"""
WITH {_WIDE_SQL}
SELECT k, n_fields, i, CASE WHEN i = 1 THEN 'new' || v ELSE v END AS v FROM cells""")
def q_rewrite_positional(spark, d):
    """SNK-3, positional: the second field rewritten, short rows and extra fields kept."""
    path = scratch(spark, "wide-out")
    files.rewrite_positional(readers.read_records_positional(spark, _wide_csv(spark, d)), path, lambda c: F.concat(F.lit("new"), c))
    r = readers.read_records_positional(spark, path)
    cells = r.select(F.col("_c0").cast("long").alias("k"), "n_fields", F.posexplode("fields").alias("i", "v"))
    return cells.select("k", "n_fields", "i", "v")


@query("enumerate_urls", """
SELECT c_custkey, CAST(n AS BIGINT) AS n,
       'https://site.example.net/list.html?p=' || CAST(n AS VARCHAR) || '&order=alpha' AS url
FROM (SELECT c_custkey, unnest(range(2, 2 + c_nationkey)) AS n FROM customer)""")
def q_enumerate_urls(spark, d):
    """SRC-4: ?p={n} pages for n in [2, 2 + c_nationkey) per customer."""
    c = fx.table(spark, d, "customer").select("c_custkey", F.lit(2).cast("long").alias("lo"),
                                              (F.lit(2) + F.col("c_nationkey")).cast("long").alias("hi"))
    u = readers.enumerate_urls(c, "https://site.example.net/list.html?p=%d&order=alpha")
    return u.select("c_custkey", "n", "url")


@query("read_done_urls", """
SELECT DISTINCT 'https://shop.example.net/c/' || CAST(c_custkey AS VARCHAR) AS url
FROM customer WHERE c_mktsegment = 'BUILDING'""")
def q_read_done_urls(spark, d):
    """SRC-5: the resume set of a previous output (nulls dropped, distinct)."""
    cu = _customer_urls(spark, d)
    prior = cu.filter(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD")).select(
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("url")).alias("url"), "seed_id")
    path = scratch(spark, "done")
    files.refresh_rows(prior, path)
    return readers.read_done_urls(spark, path)


# ================================================================ sinks (SNK-1..3)

def _lesson_rows(spark, d):
    ls = dom.extract_lessons(fx.block_pages(spark, d))
    return ls.select("url", "word", "definition", "mnemonic", "highlighted_text", "images")


@query("append_rows", f"""
WITH {LESSONS_SQL}
SELECT url, CAST(3 AS BIGINT) AS copies, word FROM lessons""")
def q_append_rows(spark, d):
    """SNK-1: appended outputs accumulate (refresh once, append twice)."""
    path = scratch(spark, "append")
    rows = _lesson_rows(spark, d)
    files.refresh_rows(rows, path, fmt="csv")
    files.append_rows(rows, path, fmt="csv")
    files.append_rows(rows, path, fmt="csv")
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return back.groupBy("url", "word").agg(F.count(F.lit(1)).alias("copies")).select("url", "copies", "word")


@query("refresh_rows", f"""
WITH {LESSONS_SQL}
SELECT url, CAST(1 AS BIGINT) AS copies, mnemonics, images FROM lessons""")
def q_refresh_rows(spark, d):
    """SNK-2: a refresh replaces the previous output."""
    path = scratch(spark, "refresh")
    rows = _lesson_rows(spark, d)
    files.refresh_rows(rows, path)
    files.refresh_rows(rows, path)
    back = spark.read.parquet(path)
    return back.groupBy("url").agg(F.count(F.lit(1)).alias("copies"), F.max(F.array_join("mnemonic", "|")).alias("mnemonics"),
                                   F.max(F.array_join("images", "|")).alias("images"))


@query("published_runs", f"""
WITH {LESSONS_SQL}
SELECT url, CAST(2 AS BIGINT) AS copies, mnemonics FROM lessons""")
def q_published_runs(spark, d):
    """SNK-1 and SNK-2 by manifest: a refresh, an append and its replay, a run that
    wrote its rows and was lost before it published them."""
    path, rows = scratch(spark, "published"), _lesson_rows(spark, d)
    published.refresh_run(rows, path, "first")
    published.append_run(rows, path, "second")
    published.append_run(rows, path, "second")
    published.stage(rows, path, "lost")
    back = published.read_published(spark, path)
    return back.groupBy("url").agg(F.count(F.lit(1)).alias("copies"), F.max(F.array_join("mnemonic", "|")).alias("mnemonics"))


@query("published_subjects", f"""
WITH {fx.ITEMS_SQL}
SELECT CASE WHEN subject >= 'm' THEN 'second' ELSE 'first' END AS run, subject, count(*) AS n FROM typed
WHERE subject < 'm' OR row_no % 2 = 0 GROUP BY ALL""")
def q_published_subjects(spark, d):
    """CAT-4 by manifest: a second run replaces the later half of the subjects (by the items of every other record)."""
    path = scratch(spark, "published-subjects")
    it = materialize(_items_with_subject(spark, d).select("subject", "row_no", "pos", "item"), "items")
    published.write_subjects_run(it, path, "first")
    for _ in range(2):
        published.write_subjects_run(it.where("subject >= 'm' and row_no % 2 = 0"), path, "second")
    return published.read_published(spark, path).groupBy("run", "subject").agg(F.count(F.lit(1)).alias("n"))


@query("rewrite_records", f"""
WITH {fx.RECORDS_SQL}
SELECT url, CASE WHEN row_no % 2 = 1 THEN CAST(row_no AS VARCHAR) ELSE '' END AS mainContent,
       replace(regexp_replace({_trim('concept_and_mnemonic')}, '(?i)^```json\\s*|\\s*```$', '', 'g'), '""', '"')
       AS concept_and_mnemonic
FROM records""")
def q_rewrite_records(spark, d):
    """SNK-3: CSV rewrite through the collapse cleaner, every other column kept."""
    src = readers.read_records(spark, _records_csv(spark, d))
    path = scratch(spark, "rewrite")
    files.rewrite_records(src.drop("row_no"), path, "concept_and_mnemonic", lambda c: strip_fence(c, "collapse"))
    back = readers.read_records(spark, path)
    return back.select("url", "mainContent", "concept_and_mnemonic")


# ================================================================ streams (STR-1..3)

@query("stream_extract", f"""
WITH {LESSONS_SQL}
SELECT * FROM lessons""")
def q_stream_extract(spark, d):
    """STR-1: page files arriving in a folder become lessons exactly once, over
    several micro-batches and a restart."""
    src, out, ckpt = scratch(spark, "stream-pages"), scratch(spark, "stream-out"), scratch(spark, "stream-ckpt")
    pages = fx.block_pages(spark, d)
    pages.where("page_id % 2 = 0").repartition(3, "page_id").write.parquet(src)
    streams.stream_extract(spark, src, out, ckpt, max_files_per_trigger=1).awaitTermination()
    pages.where("page_id % 2 = 1").repartition(2, "page_id").write.mode("append").parquet(src)
    streams.stream_extract(spark, src, out, ckpt, max_files_per_trigger=1).awaitTermination()
    return _lesson_columns(spark.read.parquet(out))


def _event_files(spark, d, n: int = 5) -> str:
    """The events in ``n`` files of consecutive times (a micro-batch each)."""
    src = scratch(spark, "events")
    ev = fx.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    ev.repartitionByRange(n, "ts").write.parquet(src)
    return src


@query("stream_dedup", """
SELECT DISTINCT user_id, event_type FROM events""")
def q_stream_dedup(spark, d):
    """STR-2: the first event of each (user, type), over five micro-batches."""
    ev = streams.page_stream(spark, _event_files(spark, d), max_files_per_trigger=1)
    dd = streams.stream_dedup(ev, ["user_id", "event_type"]).select("user_id", "event_type")
    return streams.run_to_table(spark, dd, scratch(spark, "dedup"), scratch(spark, "dedup-ckpt"))


def _ranges(df: DataFrame, key: str, cuts: list[float]):
    """The rows of ``df`` by ranges of ``key``, in order."""
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        part = df if lo is None else df.where(F.col(key) > lo)
        yield part if hi is None else part.where(F.col(key) <= hi)


def _batches_in_order(spark, df, key: str, cuts: list[float], label: str, n_files: int, by: str) -> DataFrame:
    """A stream with a micro-batch a range of ``key``."""
    path = scratch(spark, label)
    for part in _ranges(df, key, cuts):
        streams.write_batch(part, path, n_files, by)
    return streams.batch_stream(spark, path, n_files)


@query("stream_until_repeat", """
WITH h AS (SELECT source, doc_id, md5(text) AS hh FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY source, hh ORDER BY doc_id) > 1 AS rep FROM h),
m AS (SELECT *, max(CASE WHEN rep THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY doc_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen FROM r)
SELECT source, doc_id FROM m WHERE seen = 0""")
def q_stream_until_repeat(spark, d):
    """TRV-3 over runs: documents of each source up to the first repeated content, in
    five micro-batches and with a restart after two of them."""
    docs = fx.table(spark, d, "documents").select("source", "doc_id", "text")
    cuts = docs.approxQuantile("doc_id", [0.2, 0.4, 0.6, 0.8], 0.01)
    src, out, ckpt = scratch(spark, "docs"), scratch(spark, "until"), scratch(spark, "until-ckpt")
    result, n_files = None, streams.batch_files(docs, len(cuts) + 1)
    for lo, hi, files_ in ((None, cuts[1], cuts[:1]), (cuts[1], None, cuts[2:])):
        part = docs.where(F.col("doc_id") <= hi) if lo is None else docs.where(F.col("doc_id") > lo)
        for some in _ranges(part, "doc_id", files_):
            streams.write_batch(some, src, n_files, "doc_id")
        stream = streams.batch_stream(spark, src, n_files)
        with stateful.entry_store(spark):
            result = streams.run_to_table(spark, stateful.stream_until_repeat(stream, "source", "doc_id", "text"), out, ckpt)
    return result.select("source", "doc_id")


@query("stream_answers", """
SELECT u.conv_id, u.turn, CASE WHEN u.turn % 5 < 3 THEN md5(a.text) END AS answer FROM conversations u LEFT JOIN conversations a
  ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' WHERE u.role = 'user'""")
def q_stream_answers(spark, d):
    """EXT-2 as a stream: answers within 30 minutes (some come twice, some an hour
    late), unanswered requests at the deadline, over five micro-batches of each side."""
    req, resp = _conversation_tables(spark, d)
    minute = F.col("conv_id") * 3 + F.col("turn")
    begin = F.lit("2024-01-01 00:00:00").cast("timestamp")
    at = lambda m: F.timestamp_add("MINUTE", m.cast("int"), begin)
    asked = req.select("request_id", "conv_id", "turn", minute.alias("m"), at(minute).alias("asked_at"))
    times = asked.select("request_id", F.when(F.col("turn") % 5 < 3, F.col("turn") % 5 * 10).otherwise(F.lit(90)).alias("lag"), "m")
    given = resp.join(times, "request_id").select("request_id", at(F.col("m") + F.col("lag")).alias("answered_at"), "output_text",
                                                  (F.col("m") + F.col("lag")).alias("m"))
    # a row of each side far ahead lets the last deadlines pass
    end = spark.range(1).select(F.lit("end").alias("request_id"), at(F.lit(100_000_000)).alias("t"), F.lit(100_000_000).cast("long").alias("m"))
    asked = asked.union(end.select("request_id", F.lit(None).cast("long"), F.lit(None).cast("long"), "m", "t"))
    given = given.union(given).union(end.select("request_id", "t", F.lit("x"), "m"))
    cuts = asked.where("m < 100000000").approxQuantile("m", [0.25, 0.5, 0.75, 1.0], 0.0)
    n_files = streams.batch_files(fx.table(spark, d, "conversations"), len(cuts) + 1)
    sides = [_batches_in_order(spark, side, "m", cuts, name, n_files, "request_id").drop("m")
             for side, name in ((asked, "asked"), (given, "given"))]
    out = streams.run_to_table(spark, stateful.stream_answers(*sides, deadline="30 MINUTES", delay="5 minutes"),
                               scratch(spark, "answers"), scratch(spark, "answers-ckpt"))
    return out.where("conv_id is not null").select("conv_id", "turn", F.md5("concept_and_mnemonic").alias("answer"))


@query("stream_subject_counts", """
SELECT coalesce(nullif(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/*([^/?#;]*)', 1), ''), 'unknown')
       AS subject, count(*) AS n_items
FROM pages GROUP BY 1""")
def q_stream_subject_counts(spark, d):
    """STR-3: running count per subject over a page stream of several micro-batches."""
    src = scratch(spark, "pages")
    fx.table(spark, d, "pages").select("page_id", "url").repartition(4, "page_id").write.parquet(src)
    pg = streams.page_stream(spark, src, max_files_per_trigger=1)
    return streams.run_to_table(spark, streams.stream_subject_counts(pg), scratch(spark, "subjects"), scratch(spark, "subj-ckpt"),
                                mode="complete")


# ================================================================ end to end (E1..E3)

@query("stream_totals", """
SELECT coalesce(nullif(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/*([^/?#;]*)', 1), ''), 'unknown') AS subject,
       count(*) AS n_items FROM pages GROUP BY 1""")
def q_stream_totals(spark, d):
    """STR-3 with totals that merge on read: six micro-batches over two runs, folded
    into a base between them, the last batch of the first run delivered again."""
    pages, path = fx.table(spark, d, "pages").select("page_id", "url"), scratch(spark, "totals")
    src, ckpt, keys = scratch(spark, "totals-src"), scratch(spark, "totals-ckpt"), {"subject": subject_of("url")}
    for part in (0, 1):
        pages.where(F.col("page_id") % 2 == part).repartition(3, "page_id").write.mode("append").parquet(src)
        totals.stream_totals(streams.page_stream(spark, src, 1), keys, path, ckpt).awaitTermination()
        if part == 0:
            last = totals.compact(spark, path)
            totals.write_partial(pages.where("page_id % 2 = 0"), keys, path, last)
    return totals.read_totals(spark, path)


@query("rule_scrape", f"""
WITH {LESSONS_SQL}
SELECT page_id AS seed_id, CAST(0 AS BIGINT) AS depth, word, definition, mnemonics, images FROM lessons""")
def q_rule_scrape(spark, d):
    """E1: seeds -> walk -> lessons of the pages reached."""
    pages = fx.block_pages(spark, d)
    seeds = pages.select(F.col("page_id").alias("seed_id"), "url")
    ls = lessons.rule_scrape(pages, seeds)
    return ls.select("seed_id", "depth", "word", "definition", F.array_join("mnemonic", "|").alias("mnemonics"),
                     F.array_join("images", "|").alias("images"))


@query("model_scrape", f"""
WITH {fx.chain_sql("k % 150 = 0 AND b % 7 <> 0")}
SELECT url, CAST(1 AS BIGINT) AS copies, 'answer to ' || url AS concept_and_mnemonic
FROM (SELECT DISTINCT url FROM cvisit) WHERE right(url, 6) <> '7.html'""")
def q_model_scrape(spark, d):
    """E2: index pages -> links not done -> walks -> requests -> answers (none for
    pages whose number ends in 7) -> appended rows, read back."""
    firsts = fx.table(spark, d, "orders").where((F.col("o_orderkey") % 150 == 0) & ((F.col("o_orderkey") / 150).cast("long") % 7 == 0))
    done = readers.done_urls(firsts.select(fx.order_url("o_orderkey").alias("url")))
    req = materialize(lessons.model_scrape(fx.chain_pages(spark, d), fx.index_pages(spark, d), done, ROUTES), "requests")
    resp = req.where(~F.col("url").endswith("7.html")).select("request_id", F.concat(F.lit("answer to "), "url").alias("output_text"))
    answered, _ = extraction.attach_responses(req, resp)
    path = scratch(spark, "answers")
    files.append_rows(answered, path, columns=["url", "concept_and_mnemonic"])
    return spark.read.parquet(path).groupBy("url", "concept_and_mnemonic").agg(F.count(F.lit(1)).alias("copies"))


@query("flashcards", f"""
WITH {fx.ITEMS_SQL}
SELECT t.row_no, t.pos, t.subject, t.term,
       CASE WHEN k % 7 IN (0, 1) THEN NULL
            WHEN (k + t.pos) % 5 = 0 THEN 'What is the first name associated with ' || t.term || '?'
            ELSE 'What is ' || t.term || '?' END AS question
FROM typed t""")
def q_flashcards(spark, d):
    """E3: records -> items -> questions (no answers given: rule or fallback) -> subjects."""
    cards, _, _ = lessons.records_to_flashcards(fx.records(spark, d))
    return cards.select("row_no", F.col("pos").cast("long").alias("pos"), "subject", "term", "question")


@query("rewrite_subjects", f"""
WITH {fx.ITEMS_SQL}
SELECT 'by subject' AS rule, subject, count(*) AS n FROM typed GROUP BY subject
UNION ALL SELECT 'all', subject, count(*) FROM typed WHERE subject >= 'm' GROUP BY subject""")
def q_rewrite_subjects(spark, d):
    """CAT-4 and CAT-5 written twice, the second time without half of the subjects:
    the one keeps the old subjects, the other replaces all."""
    it = materialize(_items_with_subject(spark, d).select("subject", "row_no", "pos", "item"), "items")
    some = it.where("subject >= 'm'")
    one, two = scratch(spark, "subjects"), scratch(spark, "allsubjects")
    for part in (it, some):
        files.write_by_subject(part, one)
        files.write_all_subjects(subjects.group_by_subject(part), two)
    out = None
    for rule, path in (("by subject", one), ("all", two)):
        back = spark.read.json(path).groupBy(F.col("subject").cast("string").alias("subject")).agg(F.count("item.keywords").alias("n"))
        back = back.select(F.lit(rule).alias("rule"), "subject", "n")
        out = back if out is None else out.union(back)
    return out


# ================================================================ flagship

@query("heading_subject_counts", """
WITH p AS (
  SELECT coalesce(nullif(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/*([^/?#;]*)', 1), ''), 'unknown')
         AS subject,
         regexp_matches(html, '<h1[\\s>]') AS has_h1,
         regexp_matches(html, '<h1[^>]*>[^<]*( – | - )') OR regexp_matches(html, '</h1>[^<]*<[a-zA-Z]') AS has_def
  FROM pages)
SELECT subject, count(*) AS n_pages, count(*) FILTER (WHERE has_h1) AS n_with_word,
       count(*) FILTER (WHERE has_h1 AND has_def) AS n_with_definition, CAST(GROUPING(subject) AS BIGINT) AS level
FROM p GROUP BY ROLLUP (subject)""")
def q_heading_subject_counts(spark, d):
    """Flagship: pages per subject with a word / definition from the first h1."""
    return lessons.heading_subject_counts(spark, d)
