"""Texts of orders out of one pass over their lines, and rules that look at a text before they cut it."""

import random

from pyspark.sql import functions as F

from folioforge.operators import guards, lines, tables
from folioforge.plans import fixtures as fx
from folioforge.plans import geometry_q, tables_q

SF = "/root/testdata/sf0.001"
RULES = {
    tables.promote_header: tables.promote_header_block, tables.collapse_headers: tables.collapse_header_block, tables.split_fused: tables.split_fused_block,
    tables.merge_wrapped_rows: tables.merge_wrapped_block, tables.merge_wrapped_names: tables.merge_names_block,
}


def test_order_texts_take_one_scan(spark):
    plan = geometry_q.u01_pages(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 1


def test_texts_of_one_pass_are_those_of_their_own_queries(spark):
    each = geometry_q.u01_pages(spark, SF)
    for key in geometry_q.U01_TABLES:
        own = tables_q._both(tables_q.BEFORE_AFTER[key][0], spark, SF).select(F.concat(F.lit(key[:4]), F.col("k").cast("string")), "text")
        got = each.where(F.startswith("source_slug", F.lit(key[:4]))).select("source_slug", "text")
        assert own.count() > 100 and sorted(map(tuple, got.collect())) == sorted(map(tuple, own.collect()))


def _cell(rng):
    return rng.choice(["", "", " ", "x", "AP", "D", "Traits", "Am  Traits", "S", "---", ":---:", "--", "Knock,", "Rapid", "Fire", "5+ Rapid Fire", "grenades", "*P*", " ", "1-2", "x, "])


def _text(rng):
    out = []
    for _ in range(rng.randrange(1, 9)):
        kind, n = rng.random(), rng.choice([1, 2, 3, 6, 6, 7])
        if kind < 0.2:
            row = "|" + "|".join(["---"] * n) + "|"
        elif kind < 0.4:
            row = "|" + "|".join([_cell(rng)] + [" " * rng.randrange(2)] * (n - 1)) + rng.choice(["|", "", "| \t"])
        elif kind < 0.9:
            row = rng.choice(["", " ", " "]) + "|" + "|".join(_cell(rng) for _ in range(n)) + rng.choice(["|", "", " |\r"])
        else:
            row = rng.choice(["", "```", "intro", "12", "# A B C D", " | x"])
        out.append(row)
    return "\n".join(out) + rng.choice(["", "\n"])


def test_a_look_at_the_text_misses_no_change(spark):
    rng = random.Random(5)
    texts = [_text(rng) for _ in range(3000)]
    texts += ["||Rng|Rng|Acc|D|AP|\n|---|---|---|---|---|---|\n|W|S|L|D|AP|Traits|\n|a|1|2|3|4|5|", "\n| T ||\n|:---|---|\n|Available|Cost|\n|1-2|5|", None, ""]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4).cache()
    changed = {}
    for rule, block in RULES.items():
        both = frame.select("text", rule(F.col("text")).alias("got"), tables.map_blocks(F.col("text"), block).alias("want")).collect()
        assert [r for r in both if r["got"] != r["want"]] == []
        changed[rule.__name__] = sum(r["got"] != r["text"] for r in both)
    may = F.col("text").rlike(tables._MAY_LABEL)
    first = F.exists(F.transform(guards.blocks(F.coalesce("text", F.lit(""))), tables.cells_of), tables.is_demoted_label_row)
    assert frame.where(first & ~may).count() == 0 and frame.where(first).count() > 0
    assert min(changed.values()) > 0, changed


def test_lines_that_may_change(spark):
    rng = random.Random(6)
    texts = [_text(rng) for _ in range(500)] + ["a\n 12 \nb", "a\n12\r\nb", "x Copy of 7", " **12**", "a\n\n\n\nb", "a\n\n  # C A P S x"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    plain, anchored = lines.normalize_body(F.col("text"), [r"Copy of \d+"]), lines.normalize_body(F.col("text"), [r"Copy of \d+", r"^nothing$"])
    got = frame.select("text", plain.alias("got"), anchored.alias("want")).collect()
    assert [r for r in got if r["got"] != r["want"]] == [] and any(r["got"] != r["text"] for r in got)


def test_page_counts_may_be_a_column(spark):
    from folioforge.plans import extract

    pages = spark.createDataFrame([("a", 1, "x\n7\ny", 5), ("b", 1, "x\n7\ny", 9)], "source_slug string, page int, text string, n int")
    table = extract.normalize_pages(pages.drop("n"), {}, pages.select("source_slug", F.col("n").alias("page_count"))).pages
    column = extract.normalize_pages(pages, {}, F.col("n")).pages
    rows = {r.source_slug: r.text for r in column.collect()}
    assert rows == {r.source_slug: r.text for r in table.collect()} == {"a": "x\n7\ny", "b": "x\ny"}
