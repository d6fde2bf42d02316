"""Values that a rule names often are worked out once: what the plans of the rules hold."""

from pyspark.sql import functions as F

from folioforge.functions import text as X
from folioforge.operators import lines, tables
from folioforge.plans import tables_q


def times(df, word: str) -> int:
    return df._jdf.queryExecution().analyzed().toString().count(word)


def one(spark, rule):
    return spark.createDataFrame([("k", "|a|b|")], "k string, text string").select(rule(F.col("text")).alias("x"))


def test_cells_take_no_step_a_cell(spark):
    assert times(one(spark, X.split_cells), "lambda") == 0
    rows = [" | a  b | c ||", "|", "", "| |", "a|b ", " | x\t|", "||"]
    found = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, r string").select("i", X.split_cells(F.col("r")).alias("c")).orderBy("i").collect()
    assert [r.c for r in found] == [["a  b", "c", ""], [""], [""], [""], ["a", "b"], ["x"], [""]]


def test_pieces_of_equipment_lists_are_cut_once(spark):
    assert times(one(spark, lines.tabulate_equipment), "regexp_extract_all") == 1


def test_profiles_are_matched_few_times(spark):
    assert times(one(spark, lines.tabulate_profiles), "M\\s+WS") <= 4


def test_rows_without_wraps_are_not_folded(spark):
    for rule in (tables.merge_wrapped_rows, tables.merge_wrapped_names):
        assert "exists(" in one(spark, rule)._jdf.queryExecution().analyzed().toString()


def test_fused_columns_are_looked_for_once_a_table(spark):
    assert times(one(spark, tables.split_fused), "Traits\\z") <= 4


def test_shapes_cut_each_text_once(spark):
    assert times(tables_q.b01(spark, "/root/testdata/sf0.001"), "regexp_extract_all") <= 3


def test_python_rules_shuffle_nothing(spark):
    rows = spark.createDataFrame([(1, "x\n|a|\n|b|\ny"), (1, "|c|"), (2, None), (3, "plain")], "k int, text string")
    new = tables.map_blocks_with(rows, "k", "text", lambda block: block[::-1])
    assert "Exchange" not in new._jdf.queryExecution().executedPlan().toString()
    assert sorted(((r.k, r.text) for r in new.collect()), key=str) == [(1, "x\n|b|\n|a|\ny"), (1, "|c|"), (2, None), (3, "plain")]
