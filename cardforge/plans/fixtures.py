"""Inputs the catalog derives from the driver's tables.

The ``pages`` table has no images, red spans, containers or next links, and
no table holds fenced model output.  Where the markup or records are missing
they are built here from table columns (so their volume grows with the
tables), and the oracle SQL next to each builder computes the expected
answer from the same columns without parsing.  Each Spark builder has its
DuckDB twin below; both must produce identical strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardforge.session import materialize

NL = "\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


# ---------------------------------------------------------------- records (from part)

#: parts whose records one task builds
TASK_RECORDS = 20_000


def _item(i: int) -> F.Column:
    k = F.col("p_partkey")
    tkey = F.when(k % 7 == 0, "name").when(k % 7 == 1, "concept").otherwise("term")
    definition = F.when((k + i) % 5 == 0, F.lit("null")).otherwise(
        F.concat(F.lit('"'), F.col("subject"), F.lit(" size "), _s("p_size"), F.lit('"')))
    # some are long: more than a page of text in one string
    mnemonic = F.concat(F.col("p_brand"), F.when(k % 23 == 0, F.lit(" json ")).otherwise(F.lit(" keeps ")),
                        F.col("p_name"), F.when(k % 97 == 0, F.repeat(F.lit(" and on"), 2000)).otherwise(F.lit("")))
    return F.concat(F.lit('{"'), tkey, F.lit('": "'), F.col("p_name"), F.lit(f" {i}"), F.lit('", "definition": '),
                    definition, F.lit(', "mnemonic": "'), mnemonic, F.lit('", "keywords": ["'), F.col("p_brand"),
                    F.lit('", "'), F.col("subject"), F.lit('"]}'))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model-output records, one per part: ``(row_no, url, concept_and_mnemonic)``.
    k = p_partkey: 1 + k%3 items; bare object when k%11=0; a stray quote
    (invalid) when k%17=0; blank text when k%13=0; blank url when k%19=0;
    fence style by k%4; term key 'name' / 'concept' / 'term' by k%7."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    p = p.repartition(p.count() // TASK_RECORDS + 1, "p_partkey").withColumn("subject", F.lower("p_type"))
    k = F.col("p_partkey")
    n = F.lit(1) + k % 3
    # staged through named columns so each piece is built once
    p = p.withColumn("_i0", _item(0)).withColumn("_i1", _item(1)).withColumn("_i2", _item(2))
    arr = F.concat(F.lit("["), F.col("_i0"), F.when(n > 1, F.concat(F.lit(", "), F.col("_i1"))).otherwise(F.lit("")),
                   F.when(n > 2, F.concat(F.lit(", "), F.col("_i2"))).otherwise(F.lit("")), F.lit("]"))
    p = p.withColumn("_b0", F.when(k % 11 == 0, F.col("_i0")).otherwise(arr))
    p = p.withColumn("_body", F.when(k % 17 == 0, F.replace(F.col("_b0"), F.lit('"definition"'),
                                                                F.lit('"definition'))).otherwise(F.col("_b0")))
    body = F.col("_body")
    text = (F.when(k % 13 == 0, F.lit("   "))
            .when(k % 4 == 0, F.concat(F.lit("```json" + NL), body, F.lit(NL + "```")))
            .when(k % 4 == 1, F.concat(F.lit("```" + NL), body, F.lit(NL + "```")))
            .when(k % 4 == 2, body)
            .otherwise(F.concat(F.lit("  ```json "), body, F.lit("```  "))))
    url = F.when(k % 19 == 0, F.lit("  ")).otherwise(
        F.concat(F.lit("https://cards.example.net/"), F.col("subject"), F.lit("/"), _s(k), F.lit(".html")))
    # a table like any input: its long expression is no part of the operators' plans
    return materialize(p.select(k.alias("row_no"), url.alias("url"), text.alias("concept_and_mnemonic")), "records")


def mnemonic_sql(k: str = "k") -> str:
    return (f"p_brand || (CASE WHEN {k} % 23 = 0 THEN ' json ' ELSE ' keeps ' END) || p_name"
            f" || (CASE WHEN {k} % 97 = 0 THEN repeat(' and on', 2000) ELSE '' END)")


def _sql_item(i: int) -> str:
    return (f"""'{{"' || (CASE WHEN p_partkey % 7 = 0 THEN 'name' WHEN p_partkey % 7 = 1 THEN 'concept' ELSE 'term' END)"""
            f""" || '": "' || p_name || ' {i}", "definition": ' || """
            f"""(CASE WHEN (p_partkey + {i}) % 5 = 0 THEN 'null' ELSE '"' || lower(p_type) || ' size ' """
            f"""|| CAST(p_size AS VARCHAR) || '"' END) || ', "mnemonic": "' || {mnemonic_sql('p_partkey')} || '", "keywords": ["' """
            f"""|| p_brand || '", "' || lower(p_type) || '"]}}'""")


RECORDS_SQL = f"""
rec_base AS (
  SELECT p_partkey AS k, p_name, p_brand, p_size, lower(p_type) AS subject,
         1 + p_partkey % 3 AS n_items,
         CASE WHEN p_partkey % 11 = 0 THEN {_sql_item(0)}
              ELSE '[' || {_sql_item(0)}
                   || CASE WHEN 1 + p_partkey % 3 > 1 THEN ', ' || {_sql_item(1)} ELSE '' END
                   || CASE WHEN 1 + p_partkey % 3 > 2 THEN ', ' || {_sql_item(2)} ELSE '' END || ']' END AS body0
  FROM part),
rec AS (
  SELECT k, p_name, p_brand, p_size, subject, n_items,
         CASE WHEN k % 17 = 0 THEN replace(body0, '"definition"', '"definition') ELSE body0 END AS body,
         CASE WHEN k % 19 = 0 THEN '  ' ELSE 'https://cards.example.net/' || subject || '/' || CAST(k AS VARCHAR)
              || '.html' END AS url
  FROM rec_base),
records AS (
  SELECT k AS row_no, url, k, p_name, p_brand, p_size, subject, n_items,
         CASE WHEN k % 13 = 0 THEN '   '
              WHEN k % 4 = 0 THEN '```json' || chr(10) || body || chr(10) || '```'
              WHEN k % 4 = 1 THEN '```' || chr(10) || body || chr(10) || '```'
              WHEN k % 4 = 2 THEN body
              ELSE '  ```json ' || body || '```  ' END AS concept_and_mnemonic
  FROM rec)"""

# items every strict parse yields: not blank, not malformed, url present
ITEMS_SQL = RECORDS_SQL + f""",
items AS (
  SELECT row_no, url, subject, k, p_name, p_brand, p_size, CAST(i AS BIGINT) AS pos
  FROM records, range(0, 3) t(i)
  WHERE k % 13 <> 0 AND k % 17 <> 0 AND k % 19 <> 0
    AND i < CASE WHEN k % 11 = 0 THEN 1 ELSE n_items END),
typed AS (
  SELECT row_no, pos, url, subject, k,
         p_name || ' ' || CAST(pos AS VARCHAR) AS term,
         CASE WHEN (k + pos) % 5 = 0 THEN NULL ELSE subject || ' size ' || CAST(p_size AS VARCHAR) END AS definition,
         {mnemonic_sql()} AS mnemonic,
         p_brand AS keyword0
  FROM items)"""


# ---------------------------------------------------------------- heading pages (from part)

def heading_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per part with h1 = p_name SEP subject; SEP by k%4:
    ' – ', ' - ', '-', ' '; an NBSP entity before the dash when k%9=0."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    subject = F.lower("p_type")
    sep = (F.when(k % 4 == 0, F.when(k % 9 == 0, F.lit("&nbsp;– ")).otherwise(F.lit(" – ")))
           .when(k % 4 == 1, F.lit(" - ")).when(k % 4 == 2, F.lit("-")).otherwise(F.lit(" ")))
    html = F.concat(F.lit("<html><body><div class=\"lesson\"><h1>"), F.col("p_name"), sep, subject,
                    F.lit("</h1>\n<p>"), F.col("p_brand"), F.lit(" part</p></div></body></html>"))
    url = F.concat(F.lit("https://cards.example.net/parts/"), _s(k), F.lit(".html"))
    return p.select(k.alias("page_id"), url.alias("url"), html.alias("html"))


# ---------------------------------------------------------------- block pages (from part)

BLOCK = 50


def block_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per part one element of a lesson page (pages of 50 consecutive
    parts).  r = (k+2)%5: 0 img, 1-2 red block, 3 NOTE block, 4 plain."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    r = (k + 2) % 5
    elem = (F.when(r == 0, F.concat(F.lit('<img src="/img/'), _s(k), F.lit('.png" alt="x">')))
            .when(r <= 2, F.concat(F.lit('<p><span style="color:#ff0000">'), F.col("p_name"), F.lit(" "), _s(k),
                                   F.lit("</span> tail</p>")))
            .when(r == 3, F.concat(F.lit('<p><span style="color: #FF0000">NOTE '), F.col("p_name"),
                                   F.lit("</span> note</p>")))
            .otherwise(F.concat(F.lit("<p>plain "), F.col("p_name"), F.lit("</p>"))))
    return p.select((k / BLOCK).cast("long").alias("page_id"), k.alias("k"), elem.alias("elem"))


def block_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages(page_id, url, html)``: a page's elements are a bounded group
    (50 parts), concatenated in key order."""
    e = block_elements(spark, sf_dir)
    g = e.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("k", "elem"))).alias("xs"),
                                 F.count(F.lit(1)).alias("n"))
    body = F.array_join(F.transform("xs", lambda x: x["elem"]), "")
    html = F.concat(F.lit("<html><head><title>b</title></head><body><h1>Block "), _s("page_id"),
                    F.lit("</h1><p>"), _s("n"), F.lit(" parts</p><div id=\"mainContent\">"), body,
                    F.lit("</div><footer>end</footer></body></html>"))
    url = F.concat(F.lit("https://cards.example.net/blocks/"), _s("page_id"), F.lit(".html"))
    return g.select("page_id", url.alias("url"), html.alias("html"))


BLOCKS_SQL = """
belem AS (
  SELECT p_partkey AS k, p_partkey // 50 AS page_id, (p_partkey + 2) % 5 AS r, p_name FROM part),
bseg AS (
  SELECT *, sum(CASE WHEN r = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY k
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg
  FROM belem),
bred AS (
  SELECT *, row_number() OVER (PARTITION BY page_id, seg ORDER BY k) AS rn
  FROM bseg WHERE r IN (1, 2)),
bmn AS (
  SELECT page_id, k, p_name || ' ' || CAST(k AS VARCHAR) || ' tail' AS mnemonic,
         p_name || ' ' || CAST(k AS VARCHAR) AS highlight
  FROM bred WHERE seg = 0 OR rn = 1)"""


# ---------------------------------------------------------------- chain pages (from orders)

CHAIN = 150
#: orders whose pages one task builds and hands on (a file's splits hold millions)
TASK_PAGES = 20_000


def chain_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per order key k.  Blocks of 150 keys: next = k+1; the last
    of a block links back to the block start when the block number is even
    and has no next link when odd; k%1000=500 links to a page that does not
    exist.  The href form (absolute path, relative, absolute URL) by k%3."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    o = o.repartition(o.count() // TASK_PAGES + 1, "o_orderkey")
    k = F.col("o_orderkey")
    last = k % CHAIN == CHAIN - 1
    even = (k / CHAIN).cast("long") % 2 == 0
    nxt = F.when(~last, k + 1).when(even, k - (CHAIN - 1))
    target = F.when(k % 1000 == 500, F.concat(F.lit("missing-"), _s(k))).otherwise(_s(nxt))
    href = (F.when(k % 3 == 0, F.concat(F.lit("/o/"), target, F.lit(".html")))
            .when(k % 3 == 1, F.concat(F.lit("../o/"), target, F.lit(".html")))
            .otherwise(F.concat(F.lit("https://shop.example.net/o/"), target, F.lit(".html"))))
    nav = F.when(nxt.isNotNull(), F.concat(F.lit('<div class="nav page-next"><a href="'), href,
                                           F.lit('">next</a></div>'))).otherwise(F.lit(""))
    html = F.concat(F.lit("<html><body><h1>Order "), _s(k), F.lit("</h1>"), nav, F.lit("</body></html>"))
    url = F.concat(F.lit("https://shop.example.net/o/"), _s(k), F.lit(".html"))
    return o.select(k.alias("page_id"), url.alias("url"), html.alias("html"))


def order_url(col) -> F.Column:
    return F.concat(F.lit("https://shop.example.net/o/"), _s(col), F.lit(".html"))


def index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index pages: the first pages of the blocks, ten blocks a page, listed in
    three ``grid-menu`` containers of different tags by (k/150)%3; the link also
    stands outside of them once."""
    o = table(spark, sf_dir, "orders").where(F.col("o_orderkey") % CHAIN == 0)
    k = F.col("o_orderkey")
    b = (k / CHAIN).cast("long")
    link = F.concat(F.lit('<a href="/o/'), _s(k), F.lit('.html">x</a>'))
    g = o.groupBy((b / 10).cast("long").alias("page_id")).agg(
        *[F.array_sort(F.collect_list(F.when(b % 3 == i, F.struct(k.alias("k"), link.alias("a"))))).alias(f"m{i}") for i in range(3)])
    part = lambda i: F.array_join(F.transform(f"m{i}", lambda x: x["a"]), " ")
    html = F.concat(F.lit('<html><body><a href="/o/none.html">home</a><div class="grid-menu">'), part(0), F.lit('</div><ul class="big grid-menu"><li>'),
                    part(1), F.lit('</ul><div class="grid-menu">'), part(2), F.lit("</div></body></html>"))
    url = F.concat(F.lit("https://shop.example.net/index/"), _s("page_id"), F.lit(".html"))
    return g.select("page_id", url.alias("url"), html.alias("html"))


def chain_sql(seeds: str = "true") -> str:
    """DuckDB twin: ``cvisit(seed_id, depth, url)`` of the walks from the orders
    that satisfy ``seeds`` (on ``k``, ``b``)."""
    return f"""
cnodes AS (
  SELECT o_orderkey AS k, o_orderkey // 150 AS b, (o_orderkey // 150) * 150 AS lo,
         (o_orderkey // 150) * 150 + 149 AS hi FROM orders),
cstops AS (SELECT b, k FROM cnodes WHERE k % 1000 = 500),
cseeds AS (
  SELECT n.k AS s, n.b, n.lo, n.hi, min(t.k) FILTER (WHERE t.k >= n.k) AS m1, min(t.k) FILTER (WHERE t.k < n.k) AS m2
  FROM (SELECT * FROM cnodes WHERE {seeds}) n LEFT JOIN cstops t ON t.b = n.b GROUP BY ALL),
cvisit AS (
  SELECT s AS seed_id,
         CAST(CASE WHEN k >= s THEN k - s ELSE c.hi - s + 1 + k - c.lo END AS BIGINT) AS depth,
         'https://shop.example.net/o/' || CAST(k AS VARCHAR) || '.html' AS url
  FROM cseeds c JOIN cnodes n ON n.b = c.b
  WHERE (k >= s AND k <= coalesce(m1, c.hi))
     OR (m1 IS NULL AND c.b % 2 = 0 AND k < s AND k <= coalesce(m2, c.hi)))"""


CHAIN_SQL = chain_sql()


# ---------------------------------------------------------------- numbering records (from lineitem)

def line_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per order: a fenced array with one object per line item
    (an order's lines: a bounded group); a bare object when k%10=3, a text that
    is no JSON when k%10=7."""
    li = table(spark, sf_dir, "lineitem")
    key = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"]
    g = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*key))).alias("xs"))
    objs = F.transform("xs", lambda x: F.concat(F.lit('{"line": '), x["l_linenumber"].cast("string"),
                                                F.lit(', "flag": "'), x["l_returnflag"], F.lit('"}')))
    k = F.col("l_orderkey")
    body = (F.when(k % 10 == 3, objs[0]).when(k % 10 == 7, F.concat(F.lit("[oops, "), objs[0]))
            .otherwise(F.concat(F.lit("["), F.array_join(objs, ", "), F.lit("]"))))
    text = F.concat(F.lit("```json" + NL), body, F.lit(NL + "```"))
    return materialize(g.select(F.col("l_orderkey").alias("row_no"), order_url("l_orderkey").alias("url"),
                                text.alias("concept_and_mnemonic")), "records")


# ---------------------------------------------------------------- other sources

CSS_TEMPLATES = ["general", "elements", "multiple", "names", "trees", "vocab"]

CLEAN_HTML_SQL = ("regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), "
                  "'<![^>]*>|<\\?[^>]*>', '', 'g'), '(?is)(<script\\b[^>]*>).*?(</script\\s*>)', '\\1\\2', 'g'), "
                  "'(?is)(<style\\b[^>]*>).*?(</style\\s*>)', '\\1\\2', 'g')")
