"""Rules on hand-made texts: idempotence, negative cases, chains, and nulls."""

import pytest
from pyspark.sql import functions as F

from folioforge.functions import text as X
from folioforge.operators import guards, lines, tables, toc, vault


def run(spark, expression, *texts):
    return [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(expression(F.col("t"))).collect()]


CHART = "|Weapon|S|L|Str|D|AP|Traits|\n|---|---|---|---|---|---|---|\n"


def test_wrapped_rows_chain_and_stay_idempotent(spark):
    text = CHART + "|A|1|2|3|4|5|Knock,|\n|||||||Sharp,|\n|||||||Shock|\n|B|1|2|3|4|5|x, Shield|\n|||||||Breaker|\n"
    (once,) = run(spark, tables.merge_wrapped_rows, text)
    assert "|A|1|2|3|4|5|Knock, Sharp, Shock|" in once and "x, Shield Breaker|" in once
    assert run(spark, tables.merge_wrapped_rows, once) == [once]


def test_narrow_tables_and_fences_stay(spark):
    narrow = "|a|b|\n|---|---|\n|x,|1|\n|y||\n"
    fenced = "```\n" + CHART + "|A|1|2|3|4|5|x,|\n|||||||y|\n```"
    assert run(spark, tables.merge_wrapped_rows, narrow, fenced, "", None) == [narrow, fenced, "", None]


def test_names_merge_but_not_subheadings(spark):
    text = CHART + "|copper ladle|1|2|3|4|5|x|\n|grenades||||||\n|*Pistols*||||||\n|HEAVY||||||\n"
    (got,) = run(spark, tables.merge_wrapped_names, text)
    assert "|copper ladle grenades|1|2|3|4|5|x|\n|*Pistols*||||||\n|HEAVY||||||" in got


def test_normalize_body_is_idempotent_and_keeps_code(spark):
    text = "# C H A P T E R\n\n\n\n12\n```\n12\n```\n| |\n|7|\n5000\n**3**\nCopy of 9 12\ntext  Copy of 9  end"
    rule = lambda c: lines.normalize_body(c, [r"Copy of \d+"], True, F.lit(100))
    (once,) = run(spark, rule, text)
    assert once == "# CHAPTER\n\n```\n12\n```\n| |\n|7|\n5000\ntext end"
    assert run(spark, rule, once, None, "") == [once, None, ""]


def test_open_fence_runs_to_the_end(spark):
    assert run(spark, lambda c: lines.normalize_body(c, (), True), "a\n```\n1\n2") == ["a\n```\n1\n2"]


def test_long_blocks_need_no_stack(spark):
    long = "|a|b|\n" * 60_000
    assert [len(x) for x in run(spark, lambda c: guards.blocks(c), long)] == [1]


@pytest.mark.parametrize("text", ["- 3x20 credits worth of goods", "no price", "| a | 5 credits |"])
def test_prose_is_no_equipment(spark, text):
    assert run(spark, lines.tabulate_equipment, text) == [text]


def test_links(spark):
    got = run(spark, X.links, r"[[a/b\|x]] [[ c ]] [[d|]] [not] [[|x]]")[0]
    assert [(r.target, r.alias) for r in got] == [("a/b", "x"), ("c", ""), ("d", "")]


def test_sections_of_a_known_outline(spark):
    entries = [(1, "A", 1), (2, "B", 2), (2, "C", 4), (4, "D", 5), (1, "E", 9), (0, "F", 99)]
    frame = spark.createDataFrame([("s", i, *e) for i, e in enumerate(entries)], "source_slug string, ord int, level int, title string, start_page int")
    pages = spark.createDataFrame([("s", 10)], "source_slug string, page_count int")
    got = [(r.toc_number, r.parent_number, r.is_leaf, r.start_page, r.end_page) for r in toc.build_sections(frame, pages).orderBy("ord").collect()]
    assert got == [
        ("01", None, False, 1, 8), ("01.01", "01", True, 2, 3), ("01.02", "01", False, 4, 8), ("01.02.01", "01.02", True, 5, 8), ("02", None, True, 9, 10), ("03", None, True, 10, 10),
    ]
    assert toc.build_sections(frame.limit(0), pages).count() == 0


def test_frontmatter_parsing(spark):
    texts = ["---\ntitle: a\ntags: [x]\n---\nbody", "---\nopen", "none", "---\n: [\n---\nx", "---\n---\n\nx", None]
    frame = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "path string, text string")
    got = {r.path: r for r in vault.parse_notes(frame).collect()}
    assert [got[str(i)].meta.ok for i in range(6)] == [True, False, False, False, False, False]
    assert got["0"].meta.title == "a" and got["0"].body == "body" and got["1"].body == "---\nopen"
