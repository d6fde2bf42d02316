"""What the plans of this round's queries hold."""

from pyspark.sql import functions as F

from folioforge.functions import text as X
from folioforge.operators import guards, tables
from folioforge.plans import tables_q

SF = "/root/testdata/sf0.001"


def test_guarded_texts_take_one_scan(spark):
    plan = tables_q.d10(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 1


def test_ordinary_tables_are_not_cut_for_label_rows(spark):
    texts = ["|x|y|\n|---|---|\n|1|2|", "a\n| T ||\n|---|---|\n|Available|Cost|\n|1-2|5|"]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").rlike(tables._MAY_LABEL).alias("may")).collect()
    assert [r.may for r in found] == [False, True]


def test_values_worked_out_once_are_not_copied(spark):
    plan = spark.range(1).select(X.let(F.col("id") + 1, lambda v: v * v).alias("x"))
    assert "transform(" not in plan._jdf.queryExecution().analyzed().toString() and plan.first().x == 1


def test_rows_without_a_separator_among_the_first(spark):
    late = "\n".join(["|a|b|"] * 6 + ["|---|---|", "|c  d|", "|e|"])
    rows = spark.createDataFrame([(late,), ("|a|\n|b c|",)], "t string").select(F.transform(guards.blocks(F.col("t")), guards.data_rows).alias("r"), F.transform(guards.blocks(F.col("t")), guards.data_tokens).alias("k"))
    assert [(r.r, r.k) for r in rows.collect()] == [([[["c  d"], ["e"]]], [["c", "d", "e"]]), ([[["a"], ["b c"]]], [["a", "b", "c"]])]
