"""Ranges by blocks, many patterns at once, callables over blocks, bucketed documents: against brute force, and their plans."""

import random
import re

import pytest
from pyspark.sql import functions as F

from folioforge.operators import patterns, ranges, sections, tables, toc, vault
from folioforge.plans.lineage import checkpoint
from folioforge.sources import tables as store


def exchanges(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hash")


def test_blocks_hold_their_range(spark):
    rng = random.Random(3)
    pairs = [(a, a + rng.choice([-3, 0, 1, 2, 7, 100, 1000])) for a in [1, 2, 3, 8, 63, 64, 65, *(rng.randint(1, 3000) for _ in range(150))]]
    frame = spark.createDataFrame(pairs, "lo int, hi int")
    for r in frame.select("lo", "hi", ranges.blocks_of_range(F.col("lo"), F.col("hi")).alias("b")).collect():
        held = [p for b in r.b for p in range(b.block << b.level, (b.block + 1) << b.level)]
        assert sorted(held) == list(range(r.lo, r.hi + 1)), r
        assert len(r.b) <= 2 * (max(r.hi - r.lo + 1, 1)).bit_length()
    pages = spark.range(1, 1100).select(F.col("id").cast("int").alias("p"), ranges.blocks_of_page(F.col("id").cast("int")).alias("b")).collect()
    assert all([(b.level, b.block) for b in r.b] == [(i, r.p >> i) for i in range(r.p.bit_length())] for r in pages)


def test_page_targets_equal_all_pairs(spark):
    """Branches over thousands of pages are few rows, and each page has the note that all pairs would choose."""
    rng = random.Random(5)
    rows = [("s", 0, "01", False, 1, 5000), ("s", 1, "01.01", False, 1, 5000)] + [("s", i, f"01.01.{i}", True, a, a + rng.randint(0, 30)) for i, a in ((i, rng.randint(1, 5200)) for i in range(2, 200))]
    rows += [("t", 0, "01", True, 3, 4)]
    frame = spark.createDataFrame(rows, "source_slug string, ord int, toc_number string, is_leaf boolean, start_page int, end_page int")
    paths = frame.select("source_slug", "toc_number", F.concat_ws("/", "source_slug", "toc_number").alias("link_target"))
    want = {}
    for s, o, n, leaf, a, b in rows:
        for p in range(a, b + 1):
            want[s, p] = min(want.get((s, p), (True, 1 << 30, "")), (not leaf, o, n))
    got = {(r.source_slug, r.page): r.link_target for r in sections.page_targets(frame, paths).collect()}
    assert got == {k: f"{k[0]}/{v[2]}" for k, v in want.items()}


@pytest.mark.parametrize(
    "pattern,literal",
    [("Copy of \\d+", "Copy of "), ("ab*c", "a"), ("ab+cd", "ab"), ("a{2}bcd", "bcd"), ("x|y", None), ("(?i)abc", None), ("(abc)d", "d"), ("[abc]de?f", "d"), (".*", None),
     ("a\\.b\\$", "a.b$"), ("^page$", "page"), ("\\Qa\\E", None), ("[^]x]yy", "yy"), ("[a\\]b]cc", None), ("a\\sbb", "bb"), ("(a(b)c)+dd", "dd"), ("", None)],
)
def test_needed_characters(pattern, literal):
    assert patterns.needed(pattern) == literal


def test_needed_characters_stand_in_every_match():
    rng = random.Random(6)
    for _ in range(5000):
        pattern = "".join(rng.choice(["a", "b", "c", "a+", "b*", "c?", "[ab]", "(ab)", "(a)?", ".", "\\.", "b{1,2}", "\\w"]) for _ in range(rng.randint(1, 6)))
        found = patterns.needed(pattern)
        text = "".join(rng.choice("abc.") for _ in range(12))
        for m in re.finditer(pattern, text):
            assert found is None or found in m.group(), (pattern, found, m.group())


def test_two_thousand_patterns_equal_trying_all(spark):
    rng = random.Random(7)
    listed = [f"word{i} \\d+" for i in range(0, 4000, 2)] + ["(?i)always", "x|never seen"]
    rows = [(str(i), " ".join(f"word{rng.randint(0, 4001)} {rng.choice(['7', 'x'])}" for _ in range(60)) + rng.choice(["", " ALWAYS"])) for i in range(120)] + [("n", None), ("e", "")]
    frame = spark.createDataFrame(rows, "path string, text string")
    want = {p: next((x for x in listed if re.search(x, t)), None) if t is not None else None for p, t in rows}
    assert {r.path: r.hit for r in patterns.first_match(frame, "text", listed).collect()} == want
    assert {r.path: r.detail for r in vault.check_boilerplate(frame, listed).collect()} == {p: f"survived: {h}" for p, h in want.items() if h}
    assert vault.check_boilerplate(frame, []).count() == 0


def test_callables_over_blocks(spark):
    table = "|a|\n|b|"
    texts = ["x\n" + table + "\ny", table, "no table", None, "", "```\n|in|\n```\n" + table + "\n\n|c|", "a | b"]
    frame = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = {r.k: r.text for r in tables.map_blocks_with(frame, "k", "text", lambda rows: [f"<{r}>" for r in reversed(rows)]).collect()}
    new = "<|b|>\n<|a|>"
    assert got == {0: f"x\n{new}\ny", 1: new, 2: "no table", 3: None, 4: "", 5: f"```\n|in|\n```\n{new}\n\n<|c|>", 6: "a | b"}
    gone = {r.k: r.text for r in tables.map_blocks_with(frame, "k", "text", lambda rows: []).collect()}
    assert gone[0] == "x\ny" and gone[3] is None


def test_bucketed_documents_need_no_shuffle(spark):
    """Neighbours, contents, folders and texts of whole documents: the plans over bucketed tables have no exchange."""
    rows = [(f"d{d}", i, i % 3 + 1, f"t{i}", i + 1) for d in range(7) for i in range(12)]
    entries = spark.createDataFrame(rows, "source_slug string, ord int, level int, title string, start_page int")
    tree = checkpoint(toc.build_sections(entries, spark.createDataFrame([(f"d{d}", 13) for d in range(7)], "source_slug string, page_count int")))
    pages = spark.createDataFrame([(f"d{d}", p, f"page {p}") for d in range(7) for p in range(1, 14)], "source_slug string, page int, text string")
    try:
        store.write_bucketed(tree, "folio_sections", 4)
        store.write_bucketed(pages, "folio_pages", 4, "page")
        with store.by_document(spark):
            s, p = spark.table("folio_sections"), spark.table("folio_pages")
            every = {
                "neighbours": lambda s, p: sections.neighbours(s), "paths": lambda s, p: sections.note_paths(s).drop("ord"),
                "contents": lambda s, p: sections.contents(s, sections.note_paths(s)), "text": lambda s, p: sections.section_text(s, p),
            }
            for name, plan in every.items():
                lying = plan(s, p)
                assert exchanges(lying) == 0, name
                assert sorted(map(str, lying.collect())) == sorted(map(str, plan(tree, pages).collect())), name
    finally:
        spark.sql("DROP TABLE IF EXISTS folio_sections")
        spark.sql("DROP TABLE IF EXISTS folio_pages")


def linked(spark, pairs):
    """Notes with links between them; the index is node 0."""
    name = lambda i: "index" if i == 0 else f"n/{i:06}"
    of = {}
    for a, b in pairs:
        of.setdefault(a, []).append(b)
        of.setdefault(b, [])
    return spark.createDataFrame([(f"{name(a)}.md", " ".join(f"[[{name(b)}|x]]" for b in bs)) for a, bs in of.items()], "path string, text string")


def test_a_chain_takes_few_rounds(spark):
    """Ten thousand notes that link to the next and back, and one that nothing links to."""
    n = 10_000
    notes = linked(spark, [(i, i + 1) for i in range(n)] + [(i + 1, i) for i in range(n)] + [(n + 5, 3)])
    rounds = []
    found = checkpoint(vault.reachable(notes, checkpoint, counted=rounds))
    assert found.count() == n + 1 == found.distinct().count() == sum(rounds) and len(rounds) <= 16
    assert found.where(F.col("path") == f"n/{n + 5:06}.md").count() == 0


def test_reachable_equals_search_on_random_links(spark):
    rng = random.Random(8)
    for size, links in ((30, 25), (60, 90), (40, 38)):
        pairs = [(rng.randrange(size), rng.randrange(size)) for _ in range(links)] + [(0, 1), (1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (6, 4)]
        want, todo = {0}, [0]
        while todo:
            at = todo.pop()
            for b in {b for a, b in pairs if a == at} - want:
                want.add(b)
                todo.append(b)
        found = vault.reachable(linked(spark, pairs), checkpoint, patience=1).collect()
        assert sorted(r.path for r in found) == sorted("index.md" if i == 0 else f"n/{i:06}.md" for i in want)
