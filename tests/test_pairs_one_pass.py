"""Tables before and after an edit come out of one pass over the lines."""

from pyspark.sql import functions as F

from folioforge.plans import tables_q

SF = "/root/testdata/sf0.001"


def test_pairs_take_one_scan(spark):
    found = tables_q.pairs(spark, SF)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation [l_orderkey") == 1
    before = tables_q._both(tables_q._B_TABLE, spark, SF)
    assert sorted(map(tuple, found.select("k", "before").collect())) == sorted(map(tuple, before.collect()))
    assert {(r["m"], r["same"]) for r in found.select((F.col("k") % 3).alias("m"), (F.col("before") == F.col("after")).alias("same")).distinct().collect()} >= {(0, True), (1, False), (2, False)}
