"""Queries of outlines, sections, notes, links and gates over one outline of segments and customers for each nation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import sections as R
from ..operators import toc as T
from ..operators import vault as V
from . import extract
from . import fixtures as fx
from .lineage import checkpoint

c = F.col


def toc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.run(spark, sf_dir, fx.TOC)


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The section table, written once: what follows joins it several times, and its expressions are large."""
    return checkpoint(T.build_sections(toc(spark, sf_dir), fx.run(spark, sf_dir, fx.PAGES)))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.run(spark, sf_dir, fx.PAGE_TEXT)


_SLUG = "coalesce(nullif(rtrim(left(trim(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '-'), 60), '-'), ''), 'section')"
#: The section table in SQL: parents by self-join, numbers by recursion.
CTE = f"""
WITH RECURSIVE toc AS (SELECT source_slug AS s, ord, level, title, start_page FROM ({fx.duck(fx.TOC)}) t), pc AS (SELECT source_slug AS s, page_count AS n FROM ({fx.duck(fx.PAGES)}) q),
e AS (SELECT *, least(ord + 1, ord + min(greatest(level, 1) - ord) OVER (PARTITION BY s ORDER BY ord)) AS eff FROM toc),
p AS (SELECT a.s, a.ord, max(b.ord) AS parent FROM e a LEFT JOIN e b ON b.s = a.s AND b.ord < a.ord AND b.eff < a.eff GROUP BY a.s, a.ord),
i AS (SELECT e.*, p.parent, row_number() OVER (PARTITION BY e.s, p.parent ORDER BY e.ord) AS idx, count(*) OVER (PARTITION BY e.s, p.parent) AS sib FROM e JOIN p ON p.s = e.s AND p.ord = e.ord),
g AS (SELECT *, lpad(CAST(idx AS VARCHAR), CAST(greatest(2, length(CAST(sib AS VARCHAR))) AS INT), '0') AS part FROM i),
path AS (
  SELECT s, ord, part AS num, CAST(NULL AS VARCHAR) AS up, CAST(idx AS VARCHAR) AS human FROM g WHERE parent IS NULL
  UNION ALL SELECT g.s, g.ord, path.num || '.' || g.part, path.num, path.human || '.' || g.idx FROM g JOIN path ON g.s = path.s AND g.parent = path.ord),
nx AS (SELECT a.s, a.ord, min(b.ord) AS nxt FROM e a LEFT JOIN e b ON b.s = a.s AND b.ord > a.ord AND b.eff <= a.eff GROUP BY a.s, a.ord),
sec AS (
  SELECT g.s, CAST(g.ord AS INT) AS ord, num AS toc_number, up AS parent_number, CAST(g.eff AS INT) AS level, g.title, human || ' ' || g.title AS display_title, {_SLUG.replace("title", "g.title")} AS slug,
    coalesce(lead(g.eff) OVER (PARTITION BY g.s ORDER BY g.ord) <= g.eff, true) AS is_leaf,
    CAST(least(greatest(g.start_page, 1), pc.n) AS INT) AS start_page,
    CAST(least(greatest(CASE WHEN t.start_page IS NULL THEN pc.n ELSE greatest(g.start_page, t.start_page - 1) END, least(greatest(g.start_page, 1), pc.n)), pc.n) AS INT) AS end_page
  FROM g JOIN path ON path.s = g.s AND path.ord = g.ord JOIN nx ON nx.s = g.s AND nx.ord = g.ord LEFT JOIN toc t ON t.s = g.s AND t.ord = nx.nxt JOIN pc ON pc.s = g.s),
pre AS (SELECT s.s, s.toc_number, s.start_page AS first_page, min(k.start_page) - 1 AS last_page FROM sec s JOIN sec k ON k.s = s.s AND k.parent_number = s.toc_number GROUP BY ALL HAVING min(k.start_page) > s.start_page),
own AS (
  SELECT s, ord, toc_number, CAST(unnest(range(lo, hi + 1)) AS INT) AS page FROM (
    SELECT sec.s, ord, sec.toc_number, CASE WHEN is_leaf THEN start_page ELSE first_page END AS lo, CASE WHEN is_leaf THEN end_page ELSE last_page END AS hi
    FROM sec LEFT JOIN pre ON pre.s = sec.s AND pre.toc_number = sec.toc_number) r WHERE lo <= hi),
pg AS (SELECT source_slug AS s, page, text FROM ({fx.duck(fx.PAGE_TEXT)}) x),
anc AS (SELECT a.s, a.ord, b.level AS depth, b.toc_number || '-' || b.slug AS seg FROM sec a JOIN sec b ON a.s = b.s AND (a.toc_number = b.toc_number OR a.toc_number LIKE b.toc_number || '.%')),
pth AS (
  SELECT s.s, s.ord, s.toc_number, s.s || '/' || string_agg(seg, '/' ORDER BY depth) || CASE WHEN s.is_leaf THEN '' ELSE '/' || s.toc_number || '-' || s.slug END AS link_target
  FROM anc JOIN sec s ON s.s = anc.s AND s.ord = anc.ord GROUP BY s.s, s.ord, s.toc_number, s.is_leaf, s.slug),
txt AS (
  SELECT own.s, own.ord, string_agg(trim(text, ' ' || chr(10)), chr(10) || chr(10) ORDER BY own.page) AS markdown FROM own JOIN pg ON pg.s = own.s AND pg.page = own.page GROUP BY own.s, own.ord)
"""


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.note_paths(sections(spark, sf_dir))


def section_rows(*columns: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: sections(spark, sf_dir).select("source_slug", "ord", *columns)


def _section_sql(*columns: str) -> str:
    return f"{CTE} SELECT s AS source_slug, ord, {', '.join(columns)} FROM sec"


def t04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.effective_levels(toc(spark, sf_dir)).select("source_slug", "ord", c("eff").cast("int").alias("eff"))


def t09(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of children of each branch and the place of each leaf among leaves."""
    s = sections(spark, sf_dir)
    kids = s.groupBy("source_slug", c("parent_number").alias("toc_number")).agg(F.count(F.lit(1)).alias("children"))
    place = F.when(c("is_leaf"), F.row_number().over(W.partitionBy("source_slug", "is_leaf").orderBy("ord")))
    return s.join(kids, ["source_slug", "toc_number"], "left").select("source_slug", "toc_number", F.coalesce("children", F.lit(0)).alias("children"), F.coalesce(place, F.lit(0)).alias("leaf_place"))


def t01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outline of the best source: embedded for documents that have it, else one entry per page."""
    docs = fx.run(spark, sf_dir, "SELECT concat('n', CAST(n_nationkey AS STRING)) AS source_slug, n_name AS title, n_regionkey + 2 AS page_count FROM {nation}")
    embedded = docs.where("page_count % 2 = 0").select("source_slug", F.lit(0).alias("ord"), F.lit(1).alias("level"), "title", F.lit(1).alias("start_page"), F.lit(0).alias("priority"))
    return T.choose_source(embedded.unionByName(T.page_entries(docs).withColumn("priority", F.lit(3)))).select("source_slug", "ord", "title", "start_page")


T01_SQL = """
WITH d AS (SELECT 'n' || n_nationkey AS source_slug, n_name AS title, n_regionkey + 2 AS n FROM nation)
SELECT source_slug, 0 AS ord, title, 1 AS start_page FROM d WHERE n % 2 = 0
UNION ALL SELECT source_slug, CAST(p - 1 AS INT), 'Page ' || p, CAST(p AS INT) FROM (SELECT source_slug, unnest(range(1, n + 1)) AS p FROM d WHERE n % 2 = 1) x
"""


def t02(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.run(spark, sf_dir, "SELECT concat('n', CAST(c_nationkey AS STRING)) AS source_slug, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS STRING) ELSE c_name END AS title FROM {customer}")
    return T.looks_degenerate(rows).select("source_slug", F.round("share", 6).alias("share"), "degenerate")


T02_SQL = "SELECT 'n' || c_nationkey AS source_slug, round(avg(CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END), 6) AS share, avg(CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END) >= 0.5 AS degenerate FROM customer GROUP BY c_nationkey"


def t11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines from headings: two of three pages have one, behind a fenced comment; page 1 of half of them none."""
    sql = """SELECT concat('d', CAST(floor(doc_id / 5) AS INT)) AS source_slug, CAST(doc_id % 5 AS INT) + 1 AS page,
      concat('~~~', chr(10), '# no', chr(10), '~~~', chr(10), CASE WHEN doc_id % 3 = 0 THEN 'plain' ELSE concat('## **T', CAST(doc_id AS STRING), '**') END, chr(10), '# second') AS text FROM {documents}"""
    text = F.when(c("page") % 2 == 1, F.regexp_replace("text", "\n# second", "")).otherwise(c("text"))
    return T.toc_from_headings(fx.run(spark, sf_dir, sql).withColumn("text", text)).select("source_slug", "ord", "title", "start_page")


T11_SQL = """
WITH p AS (SELECT 'd' || CAST(floor(doc_id / 5) AS INT) AS s, CAST(doc_id % 5 AS INT) + 1 AS page, doc_id FROM documents),
h AS (SELECT s, page, CASE WHEN doc_id % 3 <> 0 THEN 'T' || doc_id WHEN page % 2 = 0 THEN 'second' END AS title FROM p),
f AS (SELECT s, min(page) AS first FROM h WHERE title IS NOT NULL GROUP BY s),
u AS (SELECT s, page, title FROM h WHERE title IS NOT NULL UNION ALL SELECT s, 1, CASE WHEN first = 2 THEN 'Page 1' ELSE 'Pages 1-' || (first - 1) END FROM f WHERE first > 1)
SELECT s AS source_slug, CAST(row_number() OVER (PARTITION BY s ORDER BY page) - 1 AS INT) AS ord, title, CAST(page AS INT) AS start_page FROM u
"""


def t12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of printed contents: titled page r + 1, followed by pages with leaders up to a gap."""
    sql = """SELECT concat('n', CAST(n_nationkey AS STRING)) AS source_slug, CAST(c_custkey % 12 AS INT) + 1 AS page, min(CASE WHEN c_custkey % 12 = n_regionkey THEN '## Contents'
      WHEN c_custkey % 12 > n_regionkey AND c_custkey % 12 < n_regionkey + 3 THEN 'a ...... 3' WHEN c_custkey % 12 = n_regionkey + 5 THEN 'b ..... 4' ELSE 'text' END) AS text
      FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey GROUP BY n_nationkey, c_custkey % 12"""
    return T.locate_toc_pages(fx.run(spark, sf_dir, sql))


T12_SQL = """
WITH p AS (SELECT DISTINCT n_nationkey, n_regionkey AS r, c_custkey % 12 AS q FROM customer JOIN nation ON c_nationkey = n_nationkey),
k AS (SELECT p.*, row_number() OVER (PARTITION BY n_nationkey ORDER BY q) AS o FROM p WHERE q >= r AND n_nationkey IN (SELECT n_nationkey FROM p WHERE q = r)),
b AS (SELECT n_nationkey, min(o) AS stop FROM k WHERE NOT (q = r OR (q > r AND q < r + 3) OR q = r + 5) GROUP BY 1)
SELECT 'n' || k.n_nationkey AS source_slug, CAST(q + 1 AS INT) AS page FROM k LEFT JOIN b USING (n_nationkey) WHERE stop IS NULL OR o < stop
"""


def t15(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = "SELECT c_custkey AS k, CASE c_custkey % 5 WHEN 0 THEN concat(CAST(c_custkey AS STRING), ' ', c_name) WHEN 1 THEN concat('1.2.', CAST(c_custkey AS STRING), ' x') WHEN 2 THEN concat('A ', c_name) WHEN 3 THEN 'A.1' ELSE c_name END AS title FROM {customer}"
    return fx.run(spark, sf_dir, sql).select("k", T.numbered_level(c("title")).alias("level"))


T15_SQL = "SELECT c_custkey AS k, CAST(CASE c_custkey % 5 WHEN 1 THEN 3 WHEN 3 THEN 2 ELSE 1 END AS INT) AS level FROM customer"


def t14(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indent levels of lines at three depths that wobble by less than the tolerance."""
    sql = "SELECT concat('n', CAST(c_nationkey AS STRING)) AS source_slug, c_custkey AS k, CAST(50 + 11 * (c_custkey % 3) AS DOUBLE) + CASE WHEN c_custkey % 2 = 0 THEN 0.5 ELSE 0.0 END AS x0 FROM {customer}"
    rows = fx.run(spark, sf_dir, sql).withColumn("bands", T.indent_bands(F.collect_set("x0").over(W.partitionBy("source_slug"))))
    return rows.select("k", T.band_level(c("bands"), c("x0")).alias("level"))


T14_SQL = """
WITH r AS (SELECT c_nationkey AS n, c_custkey AS k, c_custkey % 3 AS d FROM customer)
SELECT k, CAST(dense_rank() OVER (PARTITION BY n ORDER BY d) AS INT) AS level FROM r
"""


def t16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page offsets of outlines whose printed pages are region + 2 behind, with every seventh title unknown."""
    sql = "SELECT concat('n', CAST(c_nationkey AS STRING)) AS source_slug, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS INT) AS ord, c_custkey, n_regionkey, c_name FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"
    base = fx.run(spark, sf_dir, sql)
    rows = base.select("source_slug", "ord", F.when(c("c_custkey") % 7 == 0, F.lit("zzz")).otherwise(F.concat(F.lit("É "), "c_name")).alias("title"), c("ord").alias("page"))
    heads = base.select("source_slug", (c("ord") + c("n_regionkey") + 2).alias("page"), F.concat(F.lit("1. é  "), F.upper("c_name"), F.lit(" !")).alias("title"))
    return T.page_offset(rows, heads)


T16_SQL = """
WITH r AS (SELECT c_nationkey AS n, n_regionkey AS r, c_custkey AS c, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS k, greatest(count(*) OVER (PARTITION BY c_nationkey) // 20, 1) AS step FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT 'n' || n AS source_slug, CAST(r + 2 AS INT) AS page_offset, CAST(count(*) AS INT) AS votes, CAST(count(*) AS INT) AS winners FROM r WHERE k % step = 0 AND k < step * 20 AND c % 7 <> 0 GROUP BY n, r
"""


def t17(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Printed rows in their three forms into outlines: levels by indent, and by the numbers before the titles."""
    sql = """SELECT concat('n', CAST(c_nationkey AS STRING)) AS source_slug, 1 AS page_no, CAST(c_custkey AS INT) * 2 AS row_no,
      CASE c_custkey % 3 WHEN 0 THEN concat(CAST(c_custkey AS STRING), ' | ', c_name) WHEN 1 THEN concat(CAST(c_custkey AS STRING), ' ', c_name) ELSE concat(c_name, ' ', CAST(c_custkey AS STRING)) END AS text,
      CAST(10 + 11 * (c_custkey % 2) AS DOUBLE) AS x0, CAST(10 + 11 * (c_custkey % 2) AS DOUBLE) AS x1, c_custkey, c_name FROM {customer}"""
    rows = fx.run(spark, sf_dir, sql)
    dotted = F.concat(F.repeat(F.lit("1."), (c("c_custkey") % 3).cast("int")), c("c_custkey").cast("string"), F.lit(" "), "c_name")
    numbered = rows.withColumn("text", F.concat(c("c_custkey").cast("string"), F.lit(" | "), dotted)).withColumn("source_slug", F.concat(F.lit("x"), "source_slug"))
    entries = T.parse_printed_rows(rows.unionByName(numbered).drop("c_custkey", "c_name"))
    slugs = entries.select("source_slug").distinct()
    return T.printed_toc(entries, slugs.withColumn("page_offset", F.lit(2)), slugs.withColumn("page_count", F.lit(900))).select("source_slug", "ord", "level", "title", "start_page")


T17_SQL = """
WITH e AS (SELECT c_nationkey AS n, c_custkey AS c, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS INT) AS ord, CAST(dense_rank() OVER (PARTITION BY c_nationkey ORDER BY c_custkey % 2) AS INT) AS band, c_name AS title, CAST(least(c_custkey + 2, 900) AS INT) AS start_page FROM customer)
SELECT 'n' || n AS source_slug, ord, band AS level, title, start_page FROM e UNION ALL SELECT 'xn' || n, ord, CAST(c % 3 + 1 AS INT), title, start_page FROM e
"""


def r01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.section_text(sections(spark, sf_dir), pages(spark, sf_dir)).select("source_slug", "ord", "markdown")


def r03(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = R.section_text(sections(spark, sf_dir), pages(spark, sf_dir))
    return text.select("source_slug", "ord", F.explode("assets").alias("a")).groupBy("source_slug", "ord", "a.ref", "a.kind").agg(F.count(F.lit(1)).alias("n"), F.sum("a.page").alias("page_sum"))


def r05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.note_headings(pages(spark, sf_dir).select("source_slug", c("page").cast("string").alias("link_target"), c("text").alias("markdown"))).select("source_slug", "link_target", "key", "heading")


_INDEX_BODY = "concat('## INDEX', chr(10), '- Customer#', CAST(c_custkey % 40 AS STRING), ' ', CAST(c_custkey % 40 AS STRING), ', **', CAST(c_custkey % 40 + 3 AS STRING), '**, 99999', chr(10), 'no entry 5')"


def r06(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index notes over sections: a page, a bold page, and a page that no note covers; notes have a heading for each page that they cover."""
    s, paths = sections(spark, sf_dir), _paths(spark, sf_dir)
    index = fx.run(spark, sf_dir, f"SELECT concat('n', CAST(c_nationkey AS STRING)) AS source_slug, CAST(c_custkey AS STRING) AS link_target, {_INDEX_BODY} AS markdown FROM {{customer}}")
    targets = R.page_targets(s, paths)
    heads = targets.select("source_slug", "link_target", F.concat(F.lit("## 3. Customer#"), "page").alias("markdown"))
    merged = heads.groupBy("source_slug", "link_target").agg(F.array_join(F.sort_array(F.collect_list("markdown")), "\n").alias("markdown"))
    return R.linkify_index(index, targets, R.note_headings(merged)).select("source_slug", "link_target", "markdown")


_TARGETS = """tgt AS (SELECT s, page, link_target FROM (SELECT *, row_number() OVER (PARTITION BY s, page ORDER BY is_leaf DESC, ord) AS r FROM (
  SELECT sec.s, sec.ord, is_leaf, CAST(unnest(range(start_page, end_page + 1)) AS INT) AS page, link_target FROM sec JOIN pth ON pth.s = sec.s AND pth.ord = sec.ord) u) v WHERE r = 1)"""
R06_SQL = f"""{CTE}, {_TARGETS}, x AS (SELECT *, 'n' || c_nationkey AS s, c_custkey % 40 AS p FROM customer)
SELECT x.s AS source_slug, CAST(c_custkey AS VARCHAR) AS link_target, '## INDEX' || chr(10) || '- Customer#' || p || ' '
  || coalesce('[[' || a.link_target || '#Customer#' || p || '|' || p || ']]', CAST(p AS VARCHAR))
  || ', ' || coalesce('**[[' || b.link_target || CASE WHEN b.link_target = a.link_target THEN '#Customer#' || p ELSE '' END || '|' || (p + 3) || ']]**', '**' || (p + 3) || '**')
  || ', 99999' || chr(10) || 'no entry 5' AS markdown
FROM x LEFT JOIN tgt a ON a.s = x.s AND a.page = p LEFT JOIN tgt b ON b.s = x.s AND b.page = p + 3
"""


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = fx.run(spark, sf_dir, fx.PAGES)
    title, name = F.concat(F.lit('All "'), "source_slug", F.lit('"')), F.concat("source_slug", F.lit(".pdf"))
    return n.select("source_slug", title.alias("source_title"), name.alias("file_name"), "page_count", F.lit("2024-01-02").alias("created"), F.lit("headings").alias("toc_source"))


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All notes of the outlines' documents, built from their sections and pages."""
    s = sections(spark, sf_dir)
    text = R.section_text(s, pages(spark, sf_dir).withColumn("text", X.image_sentinels(c("text"))))
    full = s.join(text, ["source_slug", "ord"], "left").withColumn("kind", F.when(c("is_leaf") & (c("ord") % 5 == 0), F.lit("index")).otherwise("text"))
    listed = F.concat(F.coalesce("markdown", F.lit("")), F.lit("\n- Zeta "), c("start_page").cast("string"), F.lit(", **"), (c("start_page") + 1).cast("string"), F.lit("**, 999999"))
    full = full.withColumn("markdown", F.when(c("kind") == "index", listed).otherwise(c("markdown")))
    return R.build_notes(full, sources(spark, sf_dir), V.OWNER)


def r13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notes(spark, sf_dir).select("path", "text")


def u01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warnings of a whole extraction: outlines of every second nation are embedded and share pages, the others are inferred from headings."""
    embedded = toc(spark, sf_dir).where("CAST(substring(source_slug, 2) AS INT) % 2 = 0")
    return extract.extract(pages(spark, sf_dir), fx.run(spark, sf_dir, fx.PAGES), embedded, fallback="headings").warnings.select("source_slug", "warning")


U01_SQL = f"""{CTE}
SELECT DISTINCT s AS source_slug, 'page ' || page || ' is shared by sections ' || owner || ' and ' || toc_number AS warning
FROM (SELECT *, first_value(toc_number) OVER (PARTITION BY s, page ORDER BY ord) AS owner FROM own) o WHERE owner <> toc_number AND CAST(substr(s, 2) AS INT) % 2 = 0
UNION ALL SELECT s, 'no embedded outline: the structure is inferred from ' || count(*) || ' headings, to be verified' FROM pg WHERE CAST(substr(s, 2) AS INT) % 2 = 1 GROUP BY s
"""

_Q = "replace(replace({0}, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"')"
R13_SQL = f"""{CTE}, {_TARGETS},
lk AS (SELECT sec.s, sec.ord, sec.toc_number, '[[' || link_target || '|' || display_title || ']]' AS l FROM sec JOIN pth ON pth.s = sec.s AND pth.ord = sec.ord),
nb AS (SELECT lk.s, lk.ord, lag(l) OVER (PARTITION BY lk.s ORDER BY lk.ord) AS pv, lead(l) OVER (PARTITION BY lk.s ORDER BY lk.ord) AS nx FROM lk JOIN sec ON sec.s = lk.s AND sec.ord = lk.ord WHERE is_leaf),
lst AS (SELECT sec.s, parent_number, string_agg('- ' || l, chr(10) ORDER BY sec.ord) AS items FROM sec JOIN lk ON lk.s = sec.s AND lk.ord = sec.ord GROUP BY sec.s, parent_number),
body AS (
  SELECT sec.*, pth.link_target, lk.l, nb.pv, nb.nx, coalesce(pl.l, '[[' || sec.s || '/' || sec.s || '|All "' || sec.s || '"]]') AS up, lst.items,
    replace(CASE WHEN is_leaf AND sec.ord % 5 = 0 THEN coalesce(markdown, '') || chr(10) || '- Zeta ' || coalesce('[[' || ta.link_target || '|' || sec.start_page || ']]', CAST(sec.start_page AS VARCHAR))
      || ', ' || coalesce('**[[' || tb.link_target || '|' || (sec.start_page + 1) || ']]**', '**' || (sec.start_page + 1) || '**') || ', 999999' ELSE markdown END, '![x](img/', '![](' || repeat('../', length(pth.link_target) - length(replace(pth.link_target, '/', '')) - 1) || 'assets/') AS md
  FROM sec JOIN pth ON pth.s = sec.s AND pth.ord = sec.ord JOIN lk ON lk.s = sec.s AND lk.ord = sec.ord LEFT JOIN nb ON nb.s = sec.s AND nb.ord = sec.ord LEFT JOIN txt ON txt.s = sec.s AND txt.ord = sec.ord
    LEFT JOIN lk pl ON pl.s = sec.s AND pl.toc_number = sec.parent_number LEFT JOIN lst ON lst.s = sec.s AND lst.parent_number = sec.toc_number
    LEFT JOIN tgt ta ON ta.s = sec.s AND ta.page = sec.start_page LEFT JOIN tgt tb ON tb.s = sec.s AND tb.page = sec.start_page + 1)
SELECT link_target || '.md' AS path, '---' || chr(10) || 'title: "' || display_title || '"' || chr(10) || 'source: "' || s || '.pdf"' || chr(10) || 'source_pages: [' || start_page || ', ' || end_page || ']' || chr(10)
  || 'boundary: page-level' || chr(10) || 'toc_level: ' || level || chr(10) || 'toc_number: "' || toc_number || '"' || chr(10) || 'parent: "' || {_Q.format("up")} || '"' || chr(10)
  || coalesce('prev: "' || pv || '"' || chr(10), '') || coalesce('next: "' || nx || '"' || chr(10), '') || 'tags: [pdf-import, ' || s || ']' || chr(10) || 'created: 2024-01-02' || chr(10) || 'generated_by: engine' || chr(10) || '---' || chr(10) || chr(10)
  || CASE WHEN is_leaf THEN coalesce(md, '_No extractable text in this section._') ELSE '# ' || display_title || chr(10) || chr(10) || coalesce(md || chr(10) || chr(10), '') || '## Contents' || chr(10) || chr(10) || items END || chr(10) AS text
FROM body
UNION ALL SELECT lst.s || '/' || lst.s || '.md', '---' || chr(10) || 'title: "All \\"' || lst.s || '\\""' || chr(10) || 'source: "' || lst.s || '.pdf"' || chr(10) || 'source_pages: [1, ' || n || ']' || chr(10) || 'boundary: page-level' || chr(10) || 'toc_level: 0' || chr(10)
  || 'toc_number: "00"' || chr(10) || 'parent: "[[index|Imported PDFs]]"' || chr(10) || 'tags: [pdf-import, ' || lst.s || ']' || chr(10) || 'created: 2024-01-02' || chr(10) || 'generated_by: engine' || chr(10) || '---' || chr(10) || chr(10)
  || '# All "' || lst.s || '"' || chr(10) || chr(10) || '> Source: `' || lst.s || '.pdf` - ' || n || ' pages - imported 2024-01-02' || chr(10) || chr(10)
  || '> [!note] No embedded table of contents. This structure was inferred from detected headings, not extracted from PDF bookmarks - verify it matches the source before relying on it.' || chr(10) || chr(10)
  || '## Contents' || chr(10) || chr(10) || items || chr(10) FROM lst JOIN pc ON pc.s = lst.s WHERE parent_number IS NULL
"""

# A small vault of customer notes with known faults.
VAULT = """
SELECT concat('tpch/', CASE WHEN c_custkey % 31 = 0 THEN 'Bad Name' ELSE '01' END, '-c', CAST(c_custkey AS STRING), '.md') AS path,
  concat('---', chr(10), 'title: "', c_name, '"', chr(10), 'source: "tpch.pdf"', chr(10), CASE WHEN c_custkey % 23 = 0 THEN '' ELSE concat('source_pages: [1, ', CASE WHEN c_custkey % 29 = 0 THEN 'x' ELSE '2' END, ']', chr(10)) END,
    'toc_level: 1', chr(10), 'toc_number: "01"', chr(10), 'tags: [pdf-import]', chr(10), CASE WHEN c_custkey % 41 = 0 THEN concat('summary: old text', chr(10)) ELSE '' END, 'created: 2024-01-02', chr(10),
    'generated_by: ', CASE WHEN c_custkey % 37 = 0 THEN 'me' ELSE 'engine' END, chr(10), '---', chr(10), chr(10), '# ', CASE WHEN c_custkey % 43 = 0 THEN 'C A P S' ELSE c_name END, chr(10),
    '[[tpch/01-c', CAST(c_custkey + 1 AS STRING), '#h|', CASE WHEN c_custkey % 17 = 0 THEN '' ELSE 'next' END, ']]', CASE WHEN c_custkey % 13 = 0 THEN ' [[bare]]' ELSE '' END, chr(10),
    '![](', CASE c_custkey % 3 WHEN 0 THEN 'http://x/y.png' WHEN 1 THEN '../tpch/./assets/a.png' ELSE 'assets/b.png' END, ')', chr(10),
    '|a|b|', chr(10), '|--|--|', chr(10), '|1|', CASE WHEN c_custkey % 47 = 0 THEN '2|3|' ELSE '2|' END, chr(10), CASE WHEN c_custkey % 53 = 0 THEN 'Copy of 7' ELSE 'text' END, chr(10)) AS text
FROM {customer}
UNION ALL SELECT 'index.md', concat('# Imported', chr(10), '[[tpch/01-c1|one]]', chr(10), '<!-- auto-start -->', chr(10), '- [[tpch/tpch|Old]]', chr(10), '- [[other/other|Other]]', chr(10), '<!-- auto-end -->', chr(10), 'tail') FROM {region} WHERE r_regionkey = 0
UNION ALL SELECT '.trash/x.md', 'x' FROM {region} WHERE r_regionkey = 0
UNION ALL SELECT 'loose.md', 'no frontmatter' FROM {region} WHERE r_regionkey = 0
"""
PATTERNS = (r"Copy of \d+",)


def vault(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vault's parsed notes, written once; parsing YAML is the dear part, so the notes are dealt over all tasks."""
    return checkpoint(V.parse_notes(V.scan(fx.run(spark, sf_dir, VAULT, deal=True))))


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.scan(fx.run(spark, sf_dir, VAULT)).select("path").unionByName(fx.run(spark, sf_dir, "SELECT 'tpch/assets/a.png' AS path FROM {region} WHERE r_regionkey = 0"))


_ALL = "WITH RECURSIVE v AS (SELECT c_custkey AS k, c_name, 'tpch/' || CASE WHEN c_custkey % 31 = 0 THEN 'Bad Name' ELSE '01' END || '-c' || c_custkey || '.md' AS path, c_custkey % 37 <> 0 AS mine FROM customer)"
GATES: dict[str, str] = {
    "frontmatter": "SELECT path, 'missing key source_pages' AS detail FROM v WHERE mine AND k % 23 = 0 UNION ALL SELECT path, 'source_pages must be two integers' FROM v WHERE mine AND (k % 23 = 0 OR k % 29 = 0) UNION ALL SELECT 'loose.md', 'missing or unparseable frontmatter'",
    "filenames": "SELECT path, 'does not match the naming contract' AS detail FROM v WHERE mine AND k % 31 = 0",
    "links": "SELECT path, 'no alias ''tpch/01-c' || (k + 1) || '''' AS detail FROM v WHERE k % 17 = 0 UNION ALL SELECT path, 'bare wikilink ''bare''' FROM v WHERE k % 13 = 0 UNION ALL SELECT v.path, 'unresolved ''tpch/01-c' || (v.k + 1) || '''' FROM v LEFT JOIN v w ON w.path = 'tpch/01-c' || (v.k + 1) || '.md' WHERE w.k IS NULL UNION ALL SELECT 'index.md', 'unresolved ''' || t || '''' FROM (VALUES ('tpch/tpch'), ('other/other')) x(t)",
    "assets": "SELECT path, CASE k % 3 WHEN 0 THEN 'transient image ''http://x/y.png''' ELSE 'missing asset ''assets/b.png''' END AS detail FROM v WHERE k % 3 IN (0, 2)",
    "reachability": "SELECT path, 'not reachable from the library index' AS detail FROM v WHERE mine AND path NOT IN (SELECT 'tpch/01-c' || k || '.md' FROM r)",
    "tables": "SELECT path, 'columns 2, 3 in the table at line ' || CASE WHEN k % 23 = 0 THEN 14 ELSE 15 END + CASE WHEN k % 41 = 0 THEN 1 ELSE 0 END AS detail FROM v WHERE k % 47 = 0",
    "boilerplate": "SELECT path, 'survived: Copy of \\d+' AS detail FROM v WHERE k % 53 = 0",
    "heading_artifacts": "SELECT path, 'spaced-out heading on line ' || (CASE WHEN k % 23 = 0 THEN 11 ELSE 12 END + CASE WHEN k % 41 = 0 THEN 1 ELSE 0 END) AS detail FROM v WHERE k % 43 = 0",
}
_REACH = "r AS (SELECT k FROM v WHERE k = 1 UNION SELECT v.k FROM r JOIN v ON v.k = r.k + 1 AND v.k % 31 <> 0)"


def gate(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return V.verify(vault(spark, sf_dir), _files(spark, sf_dir), checkpoint, [name], PATTERNS)

    return run


def v09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.verify(vault(spark, sf_dir), _files(spark, sf_dir), checkpoint, patterns=PATTERNS).groupBy("gate").agg(F.count(F.lit(1)).alias("failures"))


def gate_sql(name: str) -> str:
    return f"{_ALL}, {_REACH} SELECT '{name}' AS gate, path, detail FROM ({GATES[name]}) g"


V09_SQL = f"{_ALL}, {_REACH} " + " UNION ALL ".join(f"SELECT '{n}' AS gate, count(*) AS failures FROM ({sql}) g_{i} HAVING count(*) > 0" for i, (n, sql) in enumerate(GATES.items()))


def s08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.scan(fx.run(spark, sf_dir, VAULT)).select("path")


def r15(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = c("meta")
    return vault(spark, sf_dir).select("path", m["ok"].alias("ok"), m["title"].alias("title"), F.coalesce(m["source_pages"][1], F.lit(-1)).alias("last_page"), F.coalesce(F.array_join(m["tags"], ","), F.lit("")).alias("tags"), m["created"].alias("created"), F.length("body").alias("body_chars"))


R15_SQL = f"""{_ALL}, f AS (SELECT * FROM ({fx.duck(VAULT)}) x WHERE path NOT LIKE '.trash%')
SELECT path, path LIKE 'tpch/%' AS ok, nullif(regexp_extract(text, 'title: "([^"]*)"', 1), '') AS title, coalesce(try_cast(regexp_extract(text, 'source_pages: \\[1, (\\d+)\\]', 1) AS INT), -1) AS last_page,
  CASE WHEN path LIKE 'tpch/%' THEN 'pdf-import' ELSE '' END AS tags, CASE WHEN path LIKE 'tpch/%' THEN '2024-01-02' END AS created,
  CAST(CASE WHEN path LIKE 'tpch/%' THEN length(text) - strpos(text, chr(10) || '---' || chr(10)) - 4 ELSE length(text) END AS INT) AS body_chars FROM f"""


def r17(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = "SELECT 'n' AS path, concat('|[[a/', CAST(c_custkey AS STRING), chr(92), '|', c_name, ']]| [[ b/x ]] [[c/', CAST(c_custkey AS STRING), '#h| ', c_mktsegment, ' ]]') AS text, c_custkey AS k FROM {customer}"
    found = fx.run(spark, sf_dir, sql).select("k", F.posexplode(X.links(c("text"))).alias("pos", "l"))
    return found.select("k", "pos", "l.target", "l.alias")


R17_SQL = """SELECT c_custkey AS k, 0 AS pos, 'a/' || c_custkey AS target, c_name AS alias FROM customer UNION ALL SELECT c_custkey, 1, 'b/x', '' FROM customer
UNION ALL SELECT c_custkey, 2, 'c/' || c_custkey || '#h', c_mktsegment FROM customer"""


def r18(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Managed regions replaced or appended."""
    sql = "SELECT c_custkey AS k, concat('head', CASE WHEN c_custkey % 2 = 0 THEN concat(' <!-- auto-start -->', chr(10), 'old', chr(10), '<!-- auto-end --> tail') ELSE repeat(chr(10), 3) END) AS text, c_name FROM {customer}"
    entries = F.array(F.struct(F.lit("z/z").alias("target"), F.lit("Z").alias("alias")), F.struct(F.concat(F.lit("a/"), "c_name").alias("target"), c("c_name").alias("alias")))
    return fx.run(spark, sf_dir, sql).select("k", V.upsert_region(c("text"), V.managed_block(entries)).alias("text"))


R18_SQL = """WITH b AS (SELECT c_custkey AS k, '<!-- auto-start -->' || chr(10) || '- [[a/' || c_name || '|' || c_name || ']]' || chr(10) || '- [[z/z|Z]]' || chr(10) || '<!-- auto-end -->' AS block FROM customer)
SELECT k, CASE WHEN k % 2 = 0 THEN 'head ' || block || ' tail' ELSE 'head' || chr(10) || chr(10) || block || chr(10) END AS text FROM b"""


def k02(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned writes over the vault: user notes that the last record doesn't hold are conflicts."""
    present = vault(spark, sf_dir)
    prior = fx.run(spark, sf_dir, "SELECT concat('tpch/01-c', CAST(c_custkey AS STRING), '.md') AS path FROM {customer} WHERE c_custkey % 2 = 0")
    return V.write_conflicts(present.select("path"), present, prior)


K02_SQL = f"{_ALL} SELECT path FROM v WHERE NOT mine AND path NOT IN (SELECT 'tpch/01-c' || k || '.md' FROM v WHERE k % 2 = 0) UNION ALL SELECT unnest(['index.md', 'loose.md'])"


#: Recorded notes of one source for each nation, and what a build of every second nation writes.
_RECORDED = "SELECT concat('n', CAST(c_nationkey AS STRING)) AS source_slug, concat('n', CAST(c_nationkey AS STRING), '/', CAST(c_custkey AS STRING), '.md') AS path FROM {customer} WHERE c_custkey % 5 > 0"
_PLANNED = "SELECT concat('n', CAST(c_nationkey AS STRING)) AS source_slug, concat('n', CAST(c_nationkey AS STRING), '/', CAST(c_custkey AS STRING), '.md') AS path FROM {customer} WHERE c_custkey % 3 > 0 AND c_nationkey % 2 = 0"


def k03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.orphans(fx.run(spark, sf_dir, _RECORDED), fx.run(spark, sf_dir, _PLANNED))


def k04(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record after a build of some of its sources."""
    return V.next_record(fx.run(spark, sf_dir, _RECORDED), fx.run(spark, sf_dir, _PLANNED))


K03_SQL = f"""WITH r AS ({fx.duck(_RECORDED)}), p AS ({fx.duck(_PLANNED)})
SELECT path FROM r WHERE source_slug IN (SELECT source_slug FROM p) AND path NOT IN (SELECT path FROM p)"""
K04_SQL = """SELECT 'n' || c_nationkey AS source_slug, 'n' || c_nationkey || '/' || c_custkey || '.md' AS path,
  CASE WHEN c_nationkey % 2 = 0 AND c_custkey % 3 > 0 THEN 'written'
    WHEN EXISTS (SELECT 1 FROM customer o WHERE o.c_nationkey = c.c_nationkey AND o.c_nationkey % 2 = 0 AND o.c_custkey % 3 > 0) THEN 'orphan' ELSE 'kept' END AS state
FROM customer c WHERE c_custkey % 5 > 0 OR (c_nationkey % 2 = 0 AND c_custkey % 3 > 0)"""


def k06(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = R.section_text(sections(spark, sf_dir), pages(spark, sf_dir))
    staged = fx.run(spark, sf_dir, "SELECT concat('n', CAST(n_nationkey AS STRING)) AS source_slug, concat(CAST(n_regionkey AS STRING), '.png') AS ref FROM {nation}")
    return V.referenced_assets(text, staged)


def k07(spark: SparkSession, sf_dir: str) -> DataFrame:
    books = fx.run(spark, sf_dir, "SELECT 'tpch' AS source_slug, 'New' AS title FROM {region} WHERE r_regionkey = 0")
    return V.update_library_index(vault(spark, sf_dir).where("path = 'index.md'"), books)


K07_SQL = "SELECT '# Imported' || chr(10) || '[[tpch/01-c1|one]]' || chr(10) || '<!-- auto-start -->' || chr(10) || '- [[other/other|Other]]' || chr(10) || '- [[tpch/tpch|New]]' || chr(10) || '<!-- auto-end -->' || chr(10) || 'tail' || chr(10) AS text"


def k09(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned notes with their whole text and the number of lines in their diff."""
    changed = checkpoint(V.clean_notes(vault(spark, sf_dir), PATTERNS))
    diff = F.size(F.filter("diff", lambda x: x.rlike(r"\A[-+](?![-+]{2})")))
    return changed.join(V.cleaning_report(changed), "path").select("path", "text", diff.alias("diff_lines"))


K09_SQL = f"""WITH f AS (SELECT path, text, replace(replace(text, 'Copy of 7' || chr(10), ''), '# C A P S' || chr(10), '# CAPS' || chr(10)) AS new FROM ({fx.duck(VAULT)}) x WHERE path LIKE 'tpch/%')
SELECT path, new AS text, CAST(CASE WHEN contains(text, 'Copy of 7') THEN 1 ELSE 0 END + CASE WHEN contains(text, 'C A P S') THEN 2 ELSE 0 END AS INT) AS diff_lines FROM f WHERE new <> text
UNION ALL SELECT 'loose.md', 'no frontmatter' || chr(10), 0"""


def k10(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = """SELECT CAST(c_custkey AS STRING) AS path, concat('**----- Start of picture text -----**', CASE c_custkey % 4 WHEN 0 THEN 'Copy of 9<br>' WHEN 1 THEN concat('Map  of<br>', c_name)
      WHEN 2 THEN 'This ebook belongs to x' ELSE '' END, '**----- End of picture text -----**') AS text FROM {customer}"""
    return V.picture_residue(fx.run(spark, sf_dir, sql), PATTERNS)


def r19(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment of every note with a summary and two tags, one of which is there."""
    sql = "SELECT concat('tpch/01-c', CAST(c_custkey AS STRING), '.md') AS path, concat(' a  ', c_name) AS summary, c_custkey % 82 = 0 AS force FROM {customer}"
    updates = fx.run(spark, sf_dir, sql).withColumn("add_tags", F.array(F.lit("pdf-import"), F.lit("new"), F.lit("new")))
    return V.enrich(vault(spark, sf_dir), updates).select("path", "outcome", "summary", F.array_join("tags", ",").alias("tags"), "text")


R19_SQL = """
WITH u AS (SELECT c_custkey AS k, c_name, CASE WHEN c_custkey % 31 = 0 THEN 'no such note' WHEN c_custkey % 37 = 0 THEN 'not generated' WHEN c_custkey % 41 = 0 AND c_custkey % 82 <> 0 THEN 'already enriched' ELSE 'applied' END AS outcome FROM customer),
f AS (SELECT path, replace(replace(text, 'source_pages: [1, x]' || chr(10), ''), 'summary: old text' || chr(10), '') AS text FROM (__VAULT__) x)
SELECT 'tpch/01-c' || k || '.md' AS path, outcome, CASE WHEN outcome = 'applied' THEN 'a ' || c_name END AS summary, CASE WHEN outcome = 'applied' THEN 'pdf-import,new' END AS tags,
  CASE WHEN outcome = 'applied' THEN replace(replace(f.text, 'tags: [pdf-import]', 'tags: [pdf-import, new]'), 'created: ', 'summary: "a ' || c_name || '"' || chr(10) || 'created: ') END AS text
FROM u LEFT JOIN f ON f.path = 'tpch/01-c' || k || '.md'
""".replace("__VAULT__", fx.duck(VAULT))


def r20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repairs of notes: a new first line of prose (rejected), an unknown kind (rejected), or the same body (accepted)."""
    n = vault(spark, sf_dir).where("path LIKE 'tpch/%'")
    kind = F.when(F.endswith("path", F.lit("9.md")), F.lit("other")).when(~F.endswith("path", F.lit("8.md")), F.lit("table"))
    proposals = n.select("path", kind.alias("kind"), F.when(F.length("path") % 2 == 0, F.concat(F.lit("more\n"), c("body"))).otherwise(c("body")).alias("new_body"))
    accepted, rejected = V.repair(n, proposals)
    return accepted.select("path", F.lit("accepted").alias("outcome"), "text").unionByName(rejected.select("path", c("kind").alias("outcome"), F.lit("").alias("text")))


R20_SQL = f"""{_ALL}, o AS (SELECT path, CASE WHEN NOT mine THEN 'ownership' WHEN path LIKE '%9.md' THEN 'kind' WHEN length(path) % 2 = 0 THEN 'prose' ELSE 'accepted' END AS outcome FROM v)
SELECT o.path, outcome, CASE WHEN outcome = 'accepted' THEN replace(replace(text, 'source_pages: [1, x]' || chr(10), ''), 'summary: old text', 'summary: "old text"') ELSE '' END AS text FROM o JOIN ({fx.duck(VAULT)}) x USING (path)"""

Q = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Q] = {
    "t01_toc_source": t01, "t02_degenerate": t02,
    "t03_clamp_depth": lambda s, d: T.clamp_depth(toc(s, d), 2).select("source_slug", "ord", "level", "title"),
    "t04_levels": t04, "t05_numbering": section_rows("toc_number", "parent_number", "level"), "t06_padding": section_rows("toc_number"),
    "t07_sections": section_rows("display_title", "slug", "is_leaf"), "t08_page_ranges": section_rows("start_page", "end_page"), "t09_tree": t09,
    "t10_preamble": lambda s, d: T.preambles(sections(s, d)).select("source_slug", "toc_number", "first_page", "last_page"),
    "t11_heading_toc": t11, "t12_toc_pages": t12, "t14_indent_levels": t14, "t15_prefix_levels": t15, "t16_page_offset": t16, "t17_printed_toc": t17,
    "s06_page_entries": lambda s, d: T.page_entries(fx.run(s, d, fx.PAGES)).select("source_slug", "ord", "title", "start_page"),
    "s08_vault_scan": s08,
    "r01_section_text": r01, "r02_shared_pages": lambda s, d: R.shared_pages(sections(s, d)).select("source_slug", "toc_number", "page", "owner"), "r03_section_assets": r03,
    "r04_page_targets": lambda s, d: R.page_targets(sections(s, d), _paths(s, d)).select("source_slug", "page", "link_target"), "r05_note_headings": r05, "r06_linkify_index": r06,
    "r07_note_paths": lambda s, d: _paths(s, d).select("source_slug", "toc_number", "note_path"),
    "r08_prev_next": lambda s, d: R.neighbours(sections(s, d)).select("source_slug", "toc_number", "prev_number", "next_number"),
    "r09_parent_links": lambda s, d: R.parent_links(sections(s, d), _paths(s, d), sources(s, d)).select("source_slug", "toc_number", "parent"),
    "r10_contents": lambda s, d: R.contents(sections(s, d), _paths(s, d)).select("source_slug", F.coalesce("parent_number", F.lit("")).alias("parent_number"), "contents"),
    "u01_extract_warnings": u01, "r13_build_notes": r13, "r15_parse_notes": r15, "r17_links": r17, "r18_managed_region": r18, "r19_enrich": r19, "r20_repair": r20,
    "k02_write_conflicts": k02, "k03_orphans": k03, "k04_record": k04, "k06_assets": k06, "k07_library_index": k07, "k09_clean_notes": k09, "k10_picture_text": k10,
    **{f"v0{i + 1}_{name}": gate(name) for i, name in enumerate(V.GATES)},
    "v09_verify": v09,
}
ORACLES: dict[str, str] = {
    "t01_toc_source": T01_SQL, "t02_degenerate": T02_SQL, "t03_clamp_depth": f"SELECT source_slug, ord, level, title FROM ({fx.duck(fx.TOC)}) t WHERE level <= 2",
    "t04_levels": f"{CTE} SELECT s AS source_slug, ord, CAST(eff AS INT) AS eff FROM e", "t05_numbering": _section_sql("toc_number", "parent_number", "level"), "t06_padding": _section_sql("toc_number"),
    "t07_sections": _section_sql("display_title", "slug", "is_leaf"), "t08_page_ranges": _section_sql("start_page", "end_page"),
    "t09_tree": f"{CTE}, k AS (SELECT s, parent_number AS p, count(*) AS n FROM sec GROUP BY ALL) SELECT sec.s AS source_slug, toc_number, coalesce(k.n, 0) AS children, CASE WHEN is_leaf THEN CAST(row_number() OVER (PARTITION BY sec.s, is_leaf ORDER BY ord) AS INT) ELSE 0 END AS leaf_place FROM sec LEFT JOIN k ON k.s = sec.s AND p = toc_number",
    "t10_preamble": f"{CTE} SELECT s AS source_slug, toc_number, first_page, last_page FROM pre",
    "t11_heading_toc": T11_SQL, "t12_toc_pages": T12_SQL, "t14_indent_levels": T14_SQL, "t15_prefix_levels": T15_SQL, "t16_page_offset": T16_SQL, "t17_printed_toc": T17_SQL,
    "s06_page_entries": f"{CTE} SELECT s AS source_slug, CAST(p - 1 AS INT) AS ord, 'Page ' || p AS title, CAST(p AS INT) AS start_page FROM (SELECT s, unnest(range(1, n + 1)) AS p FROM pc) x",
    "s08_vault_scan": f"SELECT path FROM ({fx.duck(VAULT)}) x WHERE path NOT LIKE '.%'",
    "r01_section_text": f"{CTE} SELECT s AS source_slug, ord, markdown FROM txt",
    "r02_shared_pages": f"{CTE} SELECT DISTINCT s AS source_slug, toc_number, page, owner FROM (SELECT *, first_value(toc_number) OVER (PARTITION BY s, page ORDER BY ord) AS owner FROM own) o WHERE owner <> toc_number",
    "r03_section_assets": f"{CTE} SELECT own.s AS source_slug, own.ord, regexp_extract(text, '([0-9]+\\.png)', 1) AS ref, 'image' AS kind, count(*) AS n, CAST(sum(own.page) AS BIGINT) AS page_sum FROM own JOIN pg ON pg.s = own.s AND pg.page = own.page GROUP BY ALL",
    "r04_page_targets": f"{CTE}, {_TARGETS} SELECT s AS source_slug, page, link_target FROM tgt",
    "r05_note_headings": "SELECT 'n' || doc_id % 25 AS source_slug, CAST(doc_id // 25 + 1 AS VARCHAR) AS link_target, 'customer' || doc_id AS key, 'Customer#' || doc_id AS heading FROM documents",
    "r06_linkify_index": R06_SQL, "r07_note_paths": f"{CTE} SELECT s AS source_slug, toc_number, link_target || '.md' AS note_path FROM pth",
    "r08_prev_next": f"{CTE} SELECT s AS source_slug, toc_number, lag(toc_number) OVER (PARTITION BY s ORDER BY ord) AS prev_number, lead(toc_number) OVER (PARTITION BY s ORDER BY ord) AS next_number FROM sec WHERE is_leaf",
    "r09_parent_links": f"{CTE} SELECT s.s AS source_slug, s.toc_number, coalesce('[[' || pth.link_target || '|' || p.display_title || ']]', '[[' || s.s || '/' || s.s || '|All \"' || s.s || '\"]]') AS parent FROM sec s LEFT JOIN sec p ON p.s = s.s AND p.toc_number = s.parent_number LEFT JOIN pth ON pth.s = p.s AND pth.ord = p.ord",
    "r10_contents": f"{CTE} SELECT sec.s AS source_slug, coalesce(parent_number, '') AS parent_number, string_agg('- [[' || link_target || '|' || display_title || ']]', chr(10) ORDER BY sec.ord) AS contents FROM sec JOIN pth ON pth.s = sec.s AND pth.ord = sec.ord GROUP BY 1, 2",
    "u01_extract_warnings": U01_SQL, "r13_build_notes": R13_SQL, "r15_parse_notes": R15_SQL, "r17_links": R17_SQL, "r18_managed_region": R18_SQL, "r19_enrich": R19_SQL, "r20_repair": R20_SQL,
    "k02_write_conflicts": K02_SQL, "k03_orphans": K03_SQL, "k04_record": K04_SQL,
    "k06_assets": f"{CTE} SELECT DISTINCT own.s AS source_slug, regexp_extract(text, '([0-9]\\.png)', 1) AS ref FROM own JOIN pg ON pg.s = own.s AND pg.page = own.page JOIN nation ON 'n' || n_nationkey = own.s WHERE regexp_extract(text, '([0-9])\\.png', 1) = CAST(n_regionkey AS VARCHAR)",
    "k07_library_index": K07_SQL, "k09_clean_notes": K09_SQL,
    "k10_picture_text": "SELECT CAST(c_custkey AS VARCHAR) AS path, 'Map of ' || c_name AS residue FROM customer WHERE c_custkey % 4 = 1",
    **{f"v0{i + 1}_{name}": gate_sql(name) for i, name in enumerate(V.GATES)},
    "v09_verify": V09_SQL,
}
