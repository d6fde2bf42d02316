"""Plans that must not put a table into one task or into the driver."""

import re

from pyspark.sql import functions as F

from folioforge.operators import sections as R
from folioforge.plans import fixtures as fx
from folioforge.plans import notes_q

SF = "/root/testdata/sf0.001"


def test_pages_asked_for_are_no_broadcast(spark):
    """All pages come out of one row a document, which looks small: their join with blocks must be no broadcast of them."""
    rows = [("a", 0, "1", None, False, 1, 30000), ("a", 1, "1.1", "1", True, 2, 2), ("b", 0, "1", None, True, 1, 7)]
    tree = spark.createDataFrame(rows, "source_slug string, ord int, toc_number string, parent_number string, is_leaf boolean, start_page int, end_page int")
    paths = tree.select("source_slug", "toc_number", F.concat_ws("/", "source_slug", "toc_number").alias("link_target"))
    found = R.page_targets(tree, paths)
    got = {(r.source_slug, r.page): r.link_target for r in found.collect()}
    assert len(got) == 30007 and got["a", 1] == "a/1" and got["a", 2] == "a/1.1" and got["a", 30000] == "a/1" and got["b", 7] == "b/1"
    plan = found._jdf.queryExecution().executedPlan().toString()
    kinds = re.findall(r"(\w+Join)\b[^\n]*\bb#\d+", plan)
    assert kinds and set(kinds) == {"SortMergeJoin"}


def test_notes_of_one_row_group_are_parsed_in_many_tasks(spark):
    notes = notes_q.vault(spark, SF)
    used = [r["n"] for r in notes.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(used) >= 8 and max(used) < sum(used) / 4


def test_dealt_tables_have_the_same_rows(spark):
    plain, dealt = fx.run(spark, SF, notes_q.VAULT), fx.run(spark, SF, notes_q.VAULT, deal=True)
    assert sorted(plain.collect()) == sorted(dealt.collect())
