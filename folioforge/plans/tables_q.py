"""Queries of line rules, table rules and drift guards.

Inputs are texts rendered from orders with a known fault; the SQL renders the same orders without it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import guards, lines, tables
from . import fixtures as fx

c = F.col
NL = "chr(10)"
LICENSE = r"Licensed under the Apache License, Version 2\.0\."
COPY = r"Copy of \d+"

_V = "'|', CAST(l_partkey AS STRING), '|', CAST(l_suppkey AS STRING), '|', CAST(l_linenumber AS STRING), '|', l_returnflag, '|', l_linestatus, '|'"
_SEP8 = "'|---|---|---|---|---|---|---|---|', chr(10)"
_NAME = "concat('|W', CAST(rn AS STRING))"
_TAIL = "concat(chr(10), 'after | ', chr(10), '```', chr(10), '|x|y|', chr(10), '|---|---|', chr(10), '```')"


def _text(head: str, line: str, tail: str = _TAIL) -> str:
    return fx.tables_sql(head, line, tail)


# Column labels that the rules look for; eight columns, the labels below a group row.
_LABELS = "'|Weapon|S|L|S|Str|D|**Ap**|Traits|', chr(10)"
_ROW8 = f"concat({_NAME}, {_V}, 'Melee', '|', chr(10))"

#: Head and line of the texts that several queries take.
BEFORE: dict[str, tuple[str, str]] = {
    "b02_promote_header": (f"'intro', {NL}, '||Rng|Rng|Acc|Str|D|||', {NL}, {_SEP8}, {_LABELS}", _ROW8),
    "b04_promote_label_row": (f"'intro', {NL}, '|*Selections*|||', {NL}, '|---|---|---|', {NL}, '|Available|Benefit|Cost|', {NL}", "concat('|', CAST(l_linenumber AS STRING), '-', CAST(l_linenumber + 1 AS STRING), '|', l_returnflag, '|', CAST(l_partkey AS STRING), '|', chr(10))"),
    "b05_collapse_headers": (f"'|Name|Range|Range|Acc|Acc|D||Traits|', {NL}, '|Weapon|S|L|S|L|D|AP|Traits|', {NL}, {_SEP8}", _ROW8),
    "b06_split_fused": (f"'|Weapon|S|L|Str|D|AP|Am  Traits|', {NL}, '|---|---|---|---|---|---|:--:|--|', {NL}".replace("|:--:|--|'", "|:---:|'"), f"concat({_NAME}, {_V}, CASE CAST(l_linenumber AS INT) % 4 WHEN 0 THEN '5+ Rapid Fire' WHEN 1 THEN '- Melee' WHEN 2 THEN 'Sharp' ELSE '6+' END, '|', chr(10))"),
    "b07_merge_wrapped_rows": (f"'|Weapon|S|L|Str|D|AP|Traits|', {NL}, '|---|---|---|---|---|---|---|', {NL}", f"concat({_NAME}, {_V}, CASE CAST(l_linenumber AS INT) % 3 WHEN 0 THEN concat('Knock,|', chr(10), '|||||||Sharp,|', chr(10), '|||||||Shock') WHEN 1 THEN concat('x, Shield|', chr(10), '|||||||Breaker, y') ELSE concat('Sharp|', chr(10), '|||||||Other') END, '|', chr(10))"),
    "b08_merge_wrapped_names": (f"'|Weapon|S|L|Str|D|AP|Traits|', {NL}, '|---|---|---|---|---|---|---|', {NL}", f"concat({_NAME}, {_V}, 'x|', chr(10), CASE CAST(l_linenumber AS INT) % 3 WHEN 0 THEN concat('|grenades||||||', chr(10), '|and more||||||', chr(10)) WHEN 1 THEN concat('|*Pistols*||||||', chr(10)) ELSE '' END)"),
}

BEFORE_AFTER: dict[str, tuple[str, Callable[[Column], Column], str]] = {
    "b02_promote_header": (
        _text(*BEFORE["b02_promote_header"]), tables.promote_header,
        _text(f"'intro', {NL}, '|Weapon|Rng (S)|Rng (L)|Acc (S)|Str|D|**Ap**|Traits|', {NL}, {_SEP8}", _ROW8),
    ),
    "b04_promote_label_row": (
        _text(*BEFORE["b04_promote_label_row"]), tables.promote_label_row,
        _text(f"'intro', {NL}, {NL}, '**Selections**', {NL}, {NL}, '|Available|Benefit|Cost|', {NL}, '|---|---|---|', {NL}", "concat('|', CAST(l_linenumber AS STRING), '-', CAST(l_linenumber + 1 AS STRING), '|', l_returnflag, '|', CAST(l_partkey AS STRING), '|', chr(10))"),
    ),
    "b05_collapse_headers": (
        _text(*BEFORE["b05_collapse_headers"]), tables.collapse_headers,
        _text(f"'|Name (Weapon)|Range (S)|Range (L)|Acc (S)|Acc (L)|D|AP|Traits|', {NL}, {_SEP8}", _ROW8),
    ),
    "b06_split_fused": (
        _text(*BEFORE["b06_split_fused"]), tables.split_fused,
        _text(f"'|Weapon|S|L|Str|D|AP|Am|Traits|', {NL}, '|---|---|---|---|---|---|:---:|:---:|', {NL}", f"concat({_NAME}, {_V}, CASE CAST(l_linenumber AS INT) % 4 WHEN 0 THEN '5+|Rapid Fire' WHEN 1 THEN '-|Melee' WHEN 2 THEN '|Sharp' ELSE '6+|' END, '|', chr(10))"),
    ),
    "b07_merge_wrapped_rows": (
        _text(*BEFORE["b07_merge_wrapped_rows"]), tables.merge_wrapped_rows,
        _text(f"'|Weapon|S|L|Str|D|AP|Traits|', {NL}, '|---|---|---|---|---|---|---|', {NL}", f"concat({_NAME}, {_V}, CASE CAST(l_linenumber AS INT) % 3 WHEN 0 THEN 'Knock, Sharp, Shock' WHEN 1 THEN 'x, Shield Breaker, y' ELSE concat('Sharp|', chr(10), '|||||||Other') END, '|', chr(10))"),
    ),
    "b08_merge_wrapped_names": (
        _text(*BEFORE["b08_merge_wrapped_names"]), tables.merge_wrapped_names,
        _text(f"'|Weapon|S|L|Str|D|AP|Traits|', {NL}, '|---|---|---|---|---|---|---|', {NL}", f"concat({_NAME}, CASE WHEN CAST(l_linenumber AS INT) % 3 = 0 THEN ' grenades and more' ELSE '' END, {_V}, 'x|', chr(10), CASE CAST(l_linenumber AS INT) % 3 WHEN 1 THEN concat('|*Pistols*||||||', chr(10)) ELSE '' END)"),
    ),
    "n08_stat_profiles": (
        _text(f"'# Wil Int', {NL}", "concat('Ganger', CAST(rn AS STRING), '....', CAST(l_partkey AS STRING), ' credits ** M WS BS S T W I A Ld Cl Wil Int **<br>5\" 4+ 4+ 3 3 1 4+ ', CASE WHEN rn % 5 = 0 THEN 'x' ELSE '1' END, ' 7+ 6+ - ', CAST(l_linenumber AS STRING), '+ Skills: ', l_returnflag, chr(10))", "'end'"), lines.tabulate_profiles,
        _text(f"'# Wil Int', {NL}", "CASE WHEN rn % 5 = 0 THEN concat('Ganger', CAST(rn AS STRING), '....', CAST(l_partkey AS STRING), ' credits ** M WS BS S T W I A Ld Cl Wil Int **<br>5\" 4+ 4+ 3 3 1 4+ x 7+ 6+ - ', CAST(l_linenumber AS STRING), '+ Skills: ', l_returnflag, chr(10)) ELSE concat('Ganger', CAST(rn AS STRING), ' ', CAST(l_partkey AS STRING), ' credits', chr(10), chr(10), '| M | WS | BS | S | T | W | I | A | Ld | Cl | Wil | Int |', chr(10), '|---|---|---|---|---|---|---|---|---|---|---|---|', chr(10), '| 5\" | 4+ | 4+ | 3 | 3 | 1 | 4+ | 1 | 7+ | 6+ | - | ', CAST(l_linenumber AS STRING), '+ |', chr(10), chr(10), 'Skills: ', l_returnflag, chr(10)) END", "'end'"),
    ),
    "n09_equipment_lists": (
        _text(f"'## List', {NL}", "concat('- Gun', CAST(rn AS STRING), '........', CAST(l_partkey AS STRING), ' credits', CASE WHEN rn % 2 = 0 THEN ' - Scope.....+15 credits' ELSE '' END, chr(10), CASE WHEN rn % 3 = 0 THEN concat('- Copper ladle', chr(10), '- spoon*....210 credits', chr(10)) ELSE '' END)", f"concat('end', {NL}, '- worth 10 credits, or so')"), lines.tabulate_equipment,
        _text(f"'## List', {NL}, {NL}, '| Item | Cost |', {NL}, '|---|---|', {NL}", "concat('| Gun', CAST(rn AS STRING), ' | ', CAST(l_partkey AS STRING), ' credits |', chr(10), CASE WHEN rn % 2 = 0 THEN concat('| — Scope | +15 credits |', chr(10)) ELSE '' END, CASE WHEN rn % 3 = 0 THEN concat('| Copper ladle spoon* | 210 credits |', chr(10)) ELSE '' END)", f"concat({NL}, 'end', {NL}, '- worth 10 credits, or so')"),
    ),
}


def _both(sql: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.run(spark, sf_dir, fx.spark_agg(sql))


def order_texts(spark: SparkSession, sf_dir: str, keys: Sequence[str]) -> DataFrame:
    """``(k, key, text)``: the texts that the queries ``keys`` take, those of an order out of one pass over its lines.

    A union would read and shuffle the lines once for each query, and plan and compile all rules above it as often.
    """
    made = fx.run(spark, sf_dir, fx.texts_sql({key[:3]: (*BEFORE[key], _TAIL, "rn") for key in keys}))
    each = F.array(*[F.struct(F.lit(key).alias("key"), c(key[:3]).alias("text")) for key in keys])
    return made.select("k", F.explode(each).alias("t")).select("k", "t.key", "t.text")


def rewrite_query(key: str) -> Callable[[SparkSession, str], DataFrame]:
    before, rule, _ = BEFORE_AFTER[key]
    return lambda spark, sf_dir: _both(before, spark, sf_dir).select("k", rule(c("text")).alias("text"))


def rewrite_oracle(key: str) -> str:
    return fx.duck_agg(fx.duck(BEFORE_AFTER[key][2]))


_B_TABLE = _text(f"'intro', {NL}, '|Name|Part|Supp|Line|Flag|Status|', {NL}, '|---|---|---|---|---|---|', {NL}", f"concat({_NAME}, {_V}, chr(10))")
_CHANGED = "CASE WHEN l_orderkey % 3 = 1 AND rn = 1 THEN CAST(l_partkey + 1 AS STRING) ELSE CAST(l_partkey AS STRING) END"
_SWAPPED = "CASE WHEN l_orderkey % 3 = 2 AND rn IN (1, 2) THEN 3 - rn ELSE rn END"
_B_HEAD = f"'intro', {NL}, '|Name|Part|Supp|Line|Flag|Status|', {NL}, '|---|---|---|---|---|---|', {NL}"
_PAIRS = fx.texts_sql({
    "before": (_B_HEAD, f"concat({_NAME}, {_V}, chr(10))", _TAIL, "rn"),
    "after": (_B_HEAD, f"concat({_NAME}, '|', {_CHANGED}, '|', CAST(l_suppkey AS STRING), '|', CAST(l_linenumber AS STRING), '|', l_returnflag, '|', l_linestatus, '|', chr(10))", _TAIL, _SWAPPED),
})


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables before and after an edit: unchanged, with one value changed, or with the first two rows swapped."""
    return fx.run(spark, sf_dir, _PAIRS)


def lost(rows: DataFrame) -> DataFrame:
    """The pairs, with the whole table gone in every eleventh text."""
    return rows.withColumn("after", F.when(c("k") % 11 == 4, F.lit("intro")).otherwise(c("after")))


_ITEMS = fx.duck(fx.ITEMS)
D03_SQL = f"""
WITH i AS ({_ITEMS}), b AS (
  SELECT l_orderkey AS k, CAST(l_partkey AS VARCHAR) AS token, -1 AS n FROM i WHERE rn = 1 AND l_orderkey % 3 = 1
  UNION ALL SELECT l_orderkey, CAST(l_partkey + 1 AS VARCHAR), 1 FROM i WHERE rn = 1 AND l_orderkey % 3 = 1)
SELECT k, 0 AS table_no, token, n AS delta FROM b WHERE k % 11 <> 4
UNION ALL SELECT DISTINCT l_orderkey, -1, 'number of tables', -1 FROM i WHERE l_orderkey % 11 = 4
"""
_STRICT = f"""
WITH i AS ({_ITEMS}), n AS (SELECT l_orderkey AS k, count(*) AS n FROM i GROUP BY 1), strict AS (
  SELECT k, 'order' AS kind, 0 AS table_no, 'W1 -> W2' AS detail FROM n WHERE k % 3 = 2 AND n >= 2
  UNION ALL SELECT l_orderkey, 'dropped', 0, CAST(l_partkey AS VARCHAR) || ' x1' FROM i WHERE rn = 1 AND l_orderkey % 3 = 1
  UNION ALL SELECT l_orderkey, 'added', 0, CAST(l_partkey + 1 AS VARCHAR) || ' x1' FROM i WHERE rn = 1 AND l_orderkey % 3 = 1)
"""
D05_SQL = f"{_STRICT} SELECT * FROM strict WHERE k % 11 <> 4 UNION ALL SELECT k, 'tables', -1, '1 -> 0' FROM n WHERE k % 11 = 4"
D04_SQL = f"SELECT l_orderkey AS k, string_agg('W' || CAST(rn AS VARCHAR), ',' ORDER BY rn) AS anchors FROM ({_ITEMS}) i GROUP BY l_orderkey"
N10_SQL = f"""
WITH i AS ({_ITEMS})
SELECT l_orderkey AS k, 0 AS table_no, CAST(rn + 1 AS INT) AS row_no, 2 AS first_line, 6 AS n_cells, false AS is_sep FROM i
UNION ALL SELECT DISTINCT l_orderkey, 0, 0, 2, 6, false FROM i
UNION ALL SELECT DISTINCT l_orderkey, 0, 1, 2, 6, true FROM i
"""

_INDEX = """SELECT c_custkey AS k,
  concat('---', chr(10), 'title: x', chr(10), '---', chr(10), '# INDEX', chr(10), '- ', c_name, ' ', CAST(c_custkey % 90 AS STRING), ', [[t/a|', CAST(c_custkey AS STRING), ']]', chr(10), '```', chr(10), 'code 1', chr(10), '```') AS before,
  concat('# I', chr(10), '- ', CASE WHEN c_custkey % 4 = 1 THEN 'Other#1' ELSE c_name END, ' ', CAST(c_custkey % 90 AS STRING), ', ', CAST(c_custkey AS STRING), CASE WHEN c_custkey % 4 = 2 THEN ' more' ELSE '' END) AS after
FROM {customer}"""
_TOK = r"regexp_extract_all(lower(c_name), '[a-z]+|[0-9]+')"
D06_SQL = f"SELECT c_custkey AS k, array_to_string(list_concat({_TOK}, [CAST(c_custkey % 90 AS VARCHAR), CAST(c_custkey AS VARCHAR)]), ' ') AS tokens FROM customer"
D07_SQL = f"""
WITH t AS (SELECT c_custkey AS k, {_TOK} AS w FROM customer)
SELECT k, 0 AS position, w[1] AS was, 'other' AS now, CAST(len(w) + 2 AS INT) AS n_before, 4 AS n_after FROM t WHERE k % 4 = 1
UNION ALL SELECT k, CAST(len(w) + 2 AS INT), '<end>', 'more', CAST(len(w) + 2 AS INT), CAST(len(w) + 3 AS INT) FROM t WHERE k % 4 = 2
"""

# n03: what is left of a dirty page, by the way it was made.
N03_SQL = r"""
WITH d AS (SELECT doc_id, string_split(text || chr(7), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS x FROM d),
m AS (SELECT doc_id, i, x, regexp_replace(x, 'Licensed under the Apache License, Version 2\.0\.', '', 'g') AS y FROM l),
n AS (SELECT doc_id, i, CASE WHEN y <> x THEN regexp_replace(regexp_replace(y, '(\S) {2,}(\S)', '\1 \2', 'g'), '(\S) {2,}(\S)', '\1 \2', 'g') ELSE x END AS z, y <> x AS cut FROM m),
k AS (SELECT doc_id, string_agg(z, chr(10) ORDER BY i) AS body FROM n WHERE NOT (cut AND regexp_matches(trim(z), '^(\d{1,4})?$')) GROUP BY doc_id)
SELECT d.doc_id, '## CHAPTER ' || d.doc_id || chr(10) || coalesce(body || chr(10), '') || chr(10)
  || CASE WHEN d.doc_id % 400 > 225 THEN d.doc_id % 400 || chr(10) ELSE '' END
  || '```' || chr(10) || '12' || chr(10) || '```' || chr(10) || ' for review' || chr(10) || '|a|' || d.doc_id || '|' AS text
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""
N01_SQL = "SELECT doc_id, CAST(len(string_split(text, chr(10))) + 10 AS INT) AS n_lines, 3 AS n_code, 1 AS n_table FROM documents"
E01_SQL = """
WITH l AS (SELECT DISTINCT doc_id, lang, unnest(string_split(text, chr(10))) AS line FROM documents),
b AS (SELECT line FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT doc_id) >= 10),
a AS (SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT lang, count(*) AS n_lines, CAST(sum(length(a.line)) AS BIGINT) AS n_chars FROM a JOIN b ON a.line = b.line GROUP BY lang
"""


def n01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, lines in fences and table lines of dirty pages."""
    seg = lines.segments(c("text"))
    count = lambda keep: F.size(F.flatten(F.transform(F.filter(seg, keep), lines.lines_of)))
    return fx.run(spark, sf_dir, fx.DIRTY).select("doc_id", count(lambda s: F.lit(True)).alias("n_lines"), count(lines.is_code).alias("n_code"), count(lines.is_table).alias("n_table"))


def n03(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = lines.normalize_body(c("text"), [LICENSE, COPY], True, F.lit(225))
    return fx.run(spark, sf_dir, fx.DIRTY).select("doc_id", body.alias("text"))


def n02(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three heading tests on lines with a mark, without, and with a blank before it."""
    sql = "SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN concat('## ', c_name) WHEN 1 THEN concat('  # ', c_name) WHEN 2 THEN concat('#', c_name) ELSE concat('####### ', c_name) END AS s FROM {customer}"
    stripped = F.trim("s").rlike(r"(?U)\A#{1,6}\s+.+")
    return fx.run(spark, sf_dir, sql).select("k", lines.is_hash_line(c("s")).alias("loose"), lines.is_heading(c("s")).alias("at_start"), stripped.alias("trimmed"))


N02_SQL = "SELECT c_custkey AS k, true AS loose, c_custkey % 4 = 0 AS at_start, c_custkey % 4 < 2 AS trimmed FROM customer"


def n07(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings with glued words, spaced by a map."""
    sql = "SELECT c_custkey AS k, concat('## **', upper(c_mktsegment), 'CHAPTER** is: ', c_name, chr(10), upper(c_mktsegment), 'CHAPTER') AS s, concat(upper(c_mktsegment), 'CHAPTER') AS glued FROM {customer}"
    mapping = F.create_map(c("glued"), F.replace("glued", F.lit("CHAPTER"), F.lit(" CHAPTER")))
    return fx.run(spark, sf_dir, sql).select("k", lines.spaced_headings(c("s"), mapping).alias("s"))


N07_SQL = "SELECT c_custkey AS k, '## **' || upper(c_mktsegment) || ' CHAPTER** is: ' || c_name || chr(10) || upper(c_mktsegment) || 'CHAPTER' AS s FROM customer"


def common_lines(spark: SparkSession, sf_dir: str, least: int = 10) -> DataFrame:
    """Lines and characters per language that stand in ``least`` documents or more: the corpus's boilerplate.

    Only 128-bit hashes of lines are shuffled, with partial counts, so a line of every document is one row of each task, for
    both counts: in how many documents it stands (a document's copies of a line are made one inside its row), and how often in
    each language. They meet with a row for each line and language at most, so no line is a hot key and nothing is broadcast.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lines = F.split("text", "\n", -1)
    hashed = [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")]
    each = docs.select(F.explode(F.array_distinct(lines)).alias("line")).where("line <> ''").select(*hashed)
    shared = each.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(c("n") >= least).select("h1", "h2")
    line = docs.select("lang", F.explode(lines).alias("line")).where("line <> ''").select("lang", F.length("line").alias("chars"), *hashed)
    counted = line.groupBy("lang", "h1", "h2").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("chars").alias("n_chars"))
    return counted.join(shared, ["h1", "h2"]).groupBy("lang").agg(F.sum("n_lines").alias("n_lines"), F.sum("n_chars").alias("n_chars"))


def b01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapes of the demoted-header, label-row and two-row-header tables: which test takes which, and the separator's row."""
    out = None
    for key in ("b02_promote_header", "b04_promote_label_row", "b05_collapse_headers"):
        # One value, so that the text is cut once and not for each mention of its cells.
        shape = lambda cells: F.struct(tables.is_demoted_header(cells).alias("demoted"), tables.is_demoted_label_row(cells).alias("label_row"), tables.separator_index(cells).alias("sep"))
        first = X.let(guards.blocks(c("text")), lambda b: F.try_element_at(b, F.lit(1)))
        each = _both(BEFORE_AFTER[key][0], spark, sf_dir).select("k", F.explode(F.array(X.let(tables.cells_of(first), shape))).alias("s"))
        part = each.select("k", F.lit(key[:3]).alias("input"), "s.demoted", "s.label_row", "s.sep")
        out = part if out is None else out.unionByName(part)
    return out


B01_SQL = f"SELECT DISTINCT l_orderkey AS k, input, input = 'b02' AS demoted, input = 'b04' AS label_row, CAST(CASE WHEN input = 'b05' THEN 2 ELSE 1 END AS INT) AS sep FROM ({_ITEMS}) i, (VALUES ('b02'), ('b04'), ('b05')) v(input)"


def n10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.table_rows(_both(_B_TABLE, spark, sf_dir), "k")
    return rows.select("k", "table_no", "row_no", "first_line", F.size("cells").alias("n_cells"), "is_sep")


def d04(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.try_element_at(guards.blocks(c("text")), F.lit(1))
    return _both(_B_TABLE, spark, sf_dir).select("k", F.array_join(guards.anchors(first), ",").alias("anchors"))


def d06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.run(spark, sf_dir, _INDEX).select("k", F.array_join(guards.index_tokens(c("before")), " ").alias("tokens"))


def d09(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repair verdicts: table edits of which every fifth also changes prose; kinds that are null or unknown; mere promotions."""
    kind = F.when(c("k") % 13 == 1, F.lit("prose")).when(c("k") % 13 != 0, F.lit("table"))
    table = pairs(spark, sf_dir).withColumn("after", F.when(c("k") % 5 == 0, F.concat("after", F.lit(" more"))).otherwise(c("after"))).withColumn("kind", kind)
    promoted = _both(BEFORE_AFTER["b04_promote_label_row"][0], spark, sf_dir).select((-c("k") - 1).alias("k"), c("text").alias("before"), tables.promote_label_row(c("text")).alias("after"), F.lit("table").alias("kind"))
    index = fx.run(spark, sf_dir, _INDEX).select((c("k") + 1_000_000_000).alias("k"), "before", "after", F.lit("index").alias("kind"))
    return guards.repair_drift(table.unionByName(promoted).unionByName(index), "k").fillna(-1, ["table_no"])


D09_SQL = f"""
{_STRICT} SELECT * FROM strict WHERE k % 13 <> 1
UNION ALL SELECT k, 'kind', -1, 'unknown kind prose' FROM n WHERE k % 13 = 1
UNION ALL SELECT k, 'prose', -1, 'lines outside tables changed' FROM n WHERE k % 5 = 0 AND k % 13 <> 1
UNION ALL SELECT k + 1000000000, 'index', -1, 'position ' || position || ': ' || was || ' -> ' || now FROM ({D07_SQL}) x
"""


def d10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of all structural rules in their order over demoted, fused and wrapped tables: there must be none."""
    every = order_texts(spark, sf_dir, ("b02_promote_header", "b05_collapse_headers", "b06_split_fused", "b07_merge_wrapped_rows", "b08_merge_wrapped_names"))
    pair = tables.repair_tables(every.withColumn("before", c("text")), "text").withColumnRenamed("text", "after")
    drifted = F.size(guards.table_findings(c("before"), c("after"), order=False)).cast("long")
    return pair.select("k", F.substring("key", 1, 3).alias("rule"), (c("before") != c("after")).alias("changed"), drifted.alias("drifted"))


D10_SQL = f"""
WITH i AS ({_ITEMS}), k AS (SELECT l_orderkey AS k, bool_or(CAST(l_linenumber AS INT) % 3 < 2) AS wrapped, bool_or(CAST(l_linenumber AS INT) % 3 = 0) AS named FROM i GROUP BY 1)
SELECT k, rule, CASE rule WHEN 'b07' THEN wrapped WHEN 'b08' THEN named ELSE true END AS changed, CAST(0 AS BIGINT) AS drifted
FROM k, (VALUES ('b02'), ('b05'), ('b06'), ('b07'), ('b08')) v(rule)
"""

def u09(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of all orders with their rows sorted backwards by a Python callable."""
    return tables.map_blocks_with(_both(_B_TABLE, spark, sf_dir), "k", "text", lambda rows: rows[:2] + sorted(rows[2:], reverse=True))


U09_SQL = fx.duck_agg(fx.duck(_B_TABLE)).replace("ORDER BY rn)", "ORDER BY line DESC)")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "e01_boilerplate_by_lang": common_lines,
    "n01_fences": n01,
    "n02_heading_tests": n02,
    "n03_normalize_body": n03,
    "n07_spaced_headings": n07,
    "n10_table_rows": n10,
    "b01_table_shapes": b01,
    **{key: rewrite_query(key) for key in BEFORE_AFTER},
    "d03_data_drift": lambda spark, sf_dir: guards.data_drift(lost(pairs(spark, sf_dir)), "k"),
    "d04_row_anchors": d04,
    "d05_strict_drift": lambda spark, sf_dir: guards.strict_drift(lost(pairs(spark, sf_dir)), "k").fillna(-1, ["table_no"]),
    "d06_index_tokens": d06,
    "d07_index_drift": lambda spark, sf_dir: guards.index_drift(fx.run(spark, sf_dir, _INDEX), "k"),
    "d09_repair_check": d09,
    "d10_extraction_guard": d10,
    "u09_map_blocks": u09,
}

ORACLES: dict[str, str] = {
    "e01_boilerplate_by_lang": E01_SQL,
    "n01_fences": N01_SQL,
    "n02_heading_tests": N02_SQL,
    "n03_normalize_body": N03_SQL,
    "n07_spaced_headings": N07_SQL,
    "n10_table_rows": N10_SQL,
    "b01_table_shapes": B01_SQL,
    **{key: rewrite_oracle(key) for key in BEFORE_AFTER},
    "d03_data_drift": D03_SQL,
    "d04_row_anchors": D04_SQL,
    "d05_strict_drift": D05_SQL,
    "d06_index_tokens": D06_SQL,
    "d07_index_drift": D07_SQL,
    "d09_repair_check": D09_SQL,
    "d10_extraction_guard": D10_SQL,
    "u09_map_blocks": U09_SQL,
}
