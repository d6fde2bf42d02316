"""Deterministic dirty inputs, rendered from the tables by SQL that Spark and DuckDB both run.

``{name}`` stands for a table. Spark sees the tables as temporary views with a prefix of their own.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
_NAME = re.compile(r"\{(" + "|".join(TABLES) + r")\}")


def run(spark: SparkSession, sf_dir: str, sql: str, deal: bool = False) -> DataFrame:
    """The rows of fixture SQL over the tables below ``sf_dir``.

    A table file may be one row group, which one task reads, and with it does all that needs no shuffle. ``deal`` parts the tables' rows, before
    texts are made of them, by their first column over all tasks: for rules that cost more than that shuffle.
    """
    for name in sorted(set(_NAME.findall(sql))):
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if deal:
            # An explicit number, since small rows would be put together again, and be few tasks.
            tasks = max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
            table = table.repartition(tasks, table.columns[0])
        table.createOrReplaceTempView(f"folioforge_{name}_dealt" if deal else f"folioforge_{name}")
    return spark.sql(_NAME.sub(r"folioforge_\1_dealt" if deal else r"folioforge_\1", sql))


def duck(sql: str) -> str:
    """The same SQL over DuckDB's views."""
    return _NAME.sub(r"\1", sql)


#: An outline of segments and customers for each nation, with level jumps and shared pages.
TOC = """
SELECT source_slug, CAST(rn - 1 AS INT) AS ord, level, title, CAST(floor((rn - 1) / 3) AS INT) + 1 AS start_page FROM (
  SELECT *, row_number() OVER (PARTITION BY source_slug ORDER BY k1, k2) AS rn FROM (
    SELECT DISTINCT concat('n', CAST(c_nationkey AS STRING)) AS source_slug, 1 AS level, c_mktsegment AS title, c_mktsegment AS k1, CAST(-1 AS BIGINT) AS k2 FROM {customer}
    UNION ALL SELECT concat('n', CAST(c_nationkey AS STRING)), CASE WHEN c_custkey % 7 = 0 THEN 4 ELSE 2 END, c_name, c_mktsegment, c_custkey FROM {customer}
  ) u
) v
"""

#: The pages' texts: all documents, dealt over the nations, with a heading and an image.
PAGE_TEXT = """
SELECT concat('n', CAST(doc_id % 25 AS STRING)) AS source_slug, CAST(floor(doc_id / 25) AS INT) + 1 AS page,
  concat('## ', CAST(doc_id % 40 + 1 AS STRING), '. Customer#', CAST(doc_id AS STRING), chr(10), text, chr(10), '![x](img/', CAST(doc_id % 9 AS STRING), '.png)') AS text
FROM {documents}
"""

#: Number of pages of those documents: what the outline or the texts need.
PAGES = f"""
SELECT t.source_slug, CAST(greatest(t.n, coalesce(p.n, 0)) AS INT) AS page_count
FROM (SELECT source_slug, max(start_page) + 2 AS n FROM ({TOC}) o GROUP BY source_slug) t
LEFT JOIN (SELECT source_slug, max(page) AS n FROM ({PAGE_TEXT}) x GROUP BY source_slug) p ON t.source_slug = p.source_slug
"""

#: One page per document with the usual furniture of extracted text.
DIRTY = """
SELECT doc_id, concat('## C H A P T E R  ', CAST(doc_id AS STRING), chr(10), text, chr(7), chr(10), chr(10), chr(10), chr(10),
  CAST(doc_id % 400 AS STRING), chr(10), '```', chr(10), '12', chr(10), '```', chr(10),
  'Copy of ', CAST(doc_id AS STRING), ' for  review', chr(10), '|a|', CAST(doc_id AS STRING), '|') AS text
FROM {documents}
"""

#: Lines of all orders, numbered by a total order.
ITEMS = """
SELECT *, row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax) AS rn
FROM {lineitem}
"""


def tables_sql(head: str, line: str, tail: str = "''", items: str = ITEMS) -> str:
    """One text per order: ``head``, then a line per item, then ``tail``; all SQL expressions."""
    rows = f"SELECT l_orderkey, rn, {line} AS line FROM ({items}) i"
    return f"""
SELECT l_orderkey AS k, concat({head}, TEXT_AGG(line, rn), {tail}) AS text FROM ({rows}) r GROUP BY l_orderkey
"""


def texts_sql(texts: Mapping[str, tuple[str, str, str, str]], items: str = ITEMS) -> str:
    """Several texts of each order in one row, by name: ``head``, ``line``, ``tail`` and the number that the lines stand in order by.

    For Spark. The window that numbers an order's lines has brought them together and sorted; a second one gathers them there, so that
    all texts take one shuffle and one sort, and no aggregation.
    """
    kinds = list(dict.fromkeys((order, line) for _, line, _, order in texts.values()))
    rows = ", ".join(f"struct({order} AS o, {line} AS x) AS r{i}" for i, (order, line) in enumerate(kinds))
    lists = ", ".join(f"collect_list(r{i}) OVER (PARTITION BY l_orderkey) AS a{i}" for i in range(len(kinds)))
    joined = lambda line, order: f"array_join(transform(sort_array(a{kinds.index((order, line))}), r -> r.x), '')"
    each = ", ".join(f"concat({head}, {joined(line, order)}, {tail}) AS {name}" for name, (head, line, tail, order) in texts.items())
    return f"""
SELECT l_orderkey AS k, {each} FROM (SELECT l_orderkey, rn, {lists} FROM (SELECT l_orderkey, rn, {rows} FROM ({items}) i) r) a WHERE rn = 1
"""


_AGG = re.compile(r"TEXT_AGG\((\w+), (\w+)\)")


def spark_agg(sql: str) -> str:
    return _AGG.sub(r"array_join(transform(sort_array(collect_list(struct(\2, \1))), x -> x.\1), '')", sql)


def duck_agg(sql: str) -> str:
    return _AGG.sub(r"string_agg(\1, '' ORDER BY \2)", sql)
