"""Drift inside the row: against counting by hand, rows with one key, plans without a shuffle, repairs that would cancel each other."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from folioforge.operators import guards, vault
from folioforge.plans.lineage import checkpoint

PAIRS = "k int, kind string, before string, after string"
HEAD = "|a|b|\n|---|---|\n"


def exchanges(frame):
    """Shuffles in the plan of a frame."""
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_multiset_difference_equals_counters(spark):
    rng = random.Random(4)
    rows = [([rng.choice("abcdeé") for _ in range(rng.randint(0, 9))], [rng.choice("abcdeé") for _ in range(rng.randint(0, 9))]) for _ in range(400)]
    frame = spark.createDataFrame(rows, "b array<string>, a array<string>")
    found = frame.select("b", "a", guards.multiset_difference(F.array_sort("b"), F.array_sort("a")).alias("d")).collect()
    for r in found:
        now, was = Counter(r.a), Counter(r.b)
        assert {x.token: x.delta for x in r.d} == {t: now[t] - was[t] for t in {*now, *was} if now[t] != was[t]}


def test_large_tables_take_no_square(spark):
    """Forty thousand changed tokens in one table."""
    before, after = (HEAD + "".join(f"|{w}{i}|x|\n" for i in range(20_000)) for w in "pq")
    drift = guards.data_drift(spark.createDataFrame([(1, None, before, after)], PAIRS), "k")
    assert {(r["delta"], r["count"]) for r in drift.groupBy("delta").count().collect()} == {(1, 20_000), (-1, 20_000)}


def test_rows_of_one_key_do_not_cancel(spark):
    one, two = HEAD + "|1|x|", HEAD + "|2|x|"
    frame = spark.createDataFrame([(1, "table", one, two), (1, "table", two, one), (None, None, one, two)], PAIRS)
    assert sorted((r.k or 0, r.token, r.delta) for r in guards.data_drift(frame, "k").collect()) == sorted([(0, "1", -1), (0, "2", 1), *2 * [(1, "1", -1), (1, "2", 1)]][:2] + [(1, "1", -1), (1, "2", 1), (1, "1", 1), (1, "2", -1)])
    assert guards.repair_drift(frame, "k").count() == 6


def test_drift_needs_no_shuffle(spark):
    frame = checkpoint(spark.createDataFrame([(1, "table", HEAD + "|1|x|", HEAD + "|2|x|")], PAIRS))
    for guard in (guards.data_drift, guards.order_drift, guards.strict_drift, guards.table_count_drift, guards.index_drift, guards.repair_drift):
        assert exchanges(guard(frame, "k")) == 0, guard.__name__


def test_order_and_order_with_changed_data(spark):
    rows = [(1, None, HEAD + "|p|1|\n|q|2|", HEAD + "|q|1|\n|p|2|"), (2, None, HEAD + "|p|1|\n|q|2|", HEAD + "|q|3|\n|p|2|"), (3, None, HEAD + "|p|1|", HEAD + "|p|1|  ")]
    frame = spark.createDataFrame(rows, PAIRS)
    assert sorted(tuple(r) for r in guards.strict_drift(frame, "k").collect()) == [
        (1, "order", 0, "p -> q"), (2, "added", 0, "3 x1"), (2, "dropped", 0, "1 x1"), (2, "order", 0, "p -> q"),
    ]


LABELS = "|*Selections*|||\n|---|---|---|\n|Available|Benefit|Cost|\n|1-2|x|3|"


@pytest.fixture
def notes(spark):
    head = "---\ntitle: t\nsource: s\nsource_pages: [1, 2]\ntoc_level: 1\ntoc_number: '01'\ntags: [pdf-import]\ncreated: c\ngenerated_by: {}\n---\n\n"
    rows = [("a.md", head.format("engine") + HEAD + "|1|x|\n"), ("b.md", head.format("engine") + LABELS + "\n"), ("c.md", head.format("me") + LABELS + "\n")]
    return checkpoint(vault.parse_notes(spark.createDataFrame(rows, "path string, text string")))


def test_proposals_for_one_note(spark, notes):
    """Two edits of one note that would cancel each other are both rejected; the same edit twice is one."""
    body = "\n" + HEAD + "|1|x|"
    rows = [("a.md", "table", body.replace("|1|", "|2|")), ("a.md", "table", body.replace("|1|", "|0|"))]
    accepted, rejected = vault.repair(notes, spark.createDataFrame(rows, "path string, kind string, new_body string"))
    assert accepted.count() == 0 and [(r.path, r.kind) for r in rejected.collect()] == [("a.md", "duplicate")]
    accepted, rejected = vault.repair(notes, spark.createDataFrame(2 * [("a.md", "table", body)], "path string, kind string, new_body string"))
    assert [r.path for r in accepted.collect()] == ["a.md"] and rejected.count() == 0


def test_transforms_make_bodies(spark, notes):
    shape = "path string, kind string, new_body string, transform string"
    rows = [("b.md", None, None, "demoted-label-row"), ("c.md", None, None, "demoted-label-row"), ("a.md", None, None, "other")]
    accepted, rejected = vault.repair(notes, spark.createDataFrame(rows, shape))
    got = accepted.collect()
    assert [r.path for r in got] == ["b.md"] and "**Selections**\n\n|Available|Benefit|Cost|\n|---|---|---|\n|1-2|x|3|" in got[0].text
    assert {(r.path, r.kind) for r in rejected.collect()} == {("c.md", "ownership"), ("a.md", "transform")}
