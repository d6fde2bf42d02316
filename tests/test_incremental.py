"""Refreshing a store: add, change, touch, rename and delete files; the result is that of a whole run; what did not change stays unread."""

import json
import os

import pytest
from pyspark.sql import functions as F

from folioforge.plans import extract, incremental
from folioforge.sources import documents

LONG = "plain words of a page that is long enough to be no scan " * 4


def doc(title, *pages):
    return b"DOC1" + json.dumps({"title": title, "pages": [f"# {p}\n{LONG}" for p in pages]}).encode()


def reading(log):
    """A plug-in that notes which files it parses."""

    def parse(path, content):
        with open(log, "a") as out:
            out.write(path.rpartition("/")[2] + "\n")
        return json.loads(content[4:])

    return parse


def stored(spark, store):
    return sorted((r.source_slug, r.ord, r.title, r.markdown) for r in incremental.read_sections(spark, store).collect())


@pytest.fixture
def place(tmp_path):
    (tmp_path / "in/deep").mkdir(parents=True)
    for name, body in (("a.doc", doc("Alpha", "x", "y")), ("b.doc", doc("Beta", "z")), ("deep/c.doc", doc("01", "w"))):
        (tmp_path / "in" / name).write_bytes(body)
    return tmp_path


def test_refresh_follows_the_inbox(spark, place):
    inbox, store, log = str(place / "in"), str(place / "store"), str(place / "log")

    def refresh():
        (place / "log").write_text("")
        done = incremental.refresh(spark, inbox, reading(log), store, fallback="headings")
        return {(r.path.rpartition("/")[2], r.change, r.source_slug) for r in done.changes.collect()}, set((place / "log").read_text().split())

    def whole():
        docs = documents.distinct_slugs(documents.read_documents(spark, inbox, reading(str(place / "other"))))
        found = extract.extract(documents.document_pages(docs), docs.select("source_slug", "page_count"), documents.document_outlines(docs), fallback="headings").sections
        return sorted((r.source_slug, r.ord, r.title, r.markdown) for r in found.collect())

    assert refresh() == ({("a.doc", "added", "alpha"), ("b.doc", "added", "beta"), ("c.doc", "added", "01")}, {"a.doc", "b.doc", "c.doc"})
    assert stored(spark, store) == whole() and len(stored(spark, store)) == 4
    assert refresh() == (set(), set())
    at = {p: os.stat(place / "store/sections" / p).st_mtime_ns for p in os.listdir(place / "store/sections") if "beta" in p}

    (place / "in/a.doc").write_bytes(doc("Alpha", "x", "more", "y"))
    os.utime(place / "in/b.doc", (1, 1))
    (place / "in/d.doc").write_bytes(doc("Beta", "new"))
    (place / "in/deep/c.doc").unlink()
    changes, parsed = refresh()
    assert {(n, c) for n, c, _ in changes} == {("a.doc", "changed"), ("b.doc", "touched"), ("d.doc", "added"), ("c.doc", "removed")} and parsed == {"a.doc", "d.doc"}
    assert stored(spark, store) == whole() and not any(r[0] == "01" for r in stored(spark, store))
    assert {p: os.stat(place / "store/sections" / p).st_mtime_ns for p in at} == at

    (place / "in/a.doc").write_bytes(doc("Gamma", "x"))
    assert refresh()[1] == {"a.doc"} and {r[0] for r in stored(spark, store)} == {"beta", "gamma"} | {r[0] for r in stored(spark, store) if r[0].startswith("beta-")}
    assert stored(spark, store) == whole()

    (place / "in/b.doc").write_bytes(b"DOC1" + json.dumps({"title": "Beta", "pages": ["# x"]}).encode())
    refresh()
    assert "beta" not in {r[0] for r in stored(spark, store)} and refresh() == (set(), set())


def test_a_refresh_that_crashes_is_repeated(spark, place):
    inbox, store, log = str(place / "in"), str(place / "store"), str(place / "log")
    incremental.refresh(spark, inbox, reading(log), store, fallback="headings")
    before = stored(spark, store)
    (place / "in/a.doc").write_bytes(doc("Alpha", "changed"))

    def broken(path, content):
        raise ValueError("crash")

    with pytest.raises(Exception, match="crash"):
        incremental.refresh(spark, inbox, broken, store, fallback="headings")
    assert stored(spark, store) == before
    (place / "store/state/9").mkdir()  # a version that was not written whole
    incremental.refresh(spark, inbox, reading(log), store, fallback="headings")
    assert [r[2] for r in stored(spark, store) if r[0] == "alpha"] == ["changed"]


def test_one_pass_writes_and_observes(spark):
    """Pages, characters and drift come from the job that writes the pages."""
    pages = spark.createDataFrame([("s", 1, "ab"), ("s", 2, None), ("t", 1, "|a|b|\n|---|---|\n|1|2|")], "source_slug string, page int, text string")
    done = extract.normalize_pages(pages)
    assert done.observed == {"pages": 3, "chars": 2 + len("|a|b|\n|---|---|\n|1|2|"), "drifted": 0} and done.drift.count() == 0
    assert {tuple(r) for r in done.chars.collect()} == {("s", 2), ("t", 21)} and done.pages.columns == ["source_slug", "page", "text"]


def test_drift_is_observed_and_rejects(spark, monkeypatch):
    """A rule that loses a cell: the observed number, the rows and the rejection agree."""
    monkeypatch.setattr(extract.tables, "promote_label_row", lambda c: F.regexp_replace(c, "lost", ""))
    pages = spark.createDataFrame([("s", 1, f"|a|b|\n|---|---|\n|lost|2|\n{LONG}"), ("t", 1, LONG)], "source_slug string, page int, text string")
    done = extract.normalize_pages(pages)
    assert done.observed["drifted"] == 1 and [tuple(r) for r in done.drift.collect()] == [("s#1", 0, "lost", -1)]
    counts = spark.createDataFrame([("s", 1), ("t", 1)], "source_slug string, page_count int")
    found = extract.extract(pages, counts, fallback="pages")
    assert [tuple(r) for r in found.rejected.collect()] == [("s", "table data changed")]
