"""Documents through a parser plug-in to a written vault and back: extract, build, verify, enrich, repair, clean."""

import json

import pytest
from pyspark.sql import functions as F

from folioforge.operators import guards, toc, vault
from folioforge.plans import build, extract
from folioforge.plans.lineage import checkpoint
from folioforge.sources import documents, vault_files

TABLE = "|Weapon|S|L|Str|D|AP|Traits|\n|---|---|---|---|---|---|---|\n|A|1|2|3|4|5|Knock,|\n|||||||Sharp|\n"


def parser():
    """A plug-in for a made-up binary format: JSON behind a signature."""

    def parse(path, content):
        assert content[:4] == b"DOC1"
        return json.loads(content[4:])

    return parse


def fragment(page, text, x, y):
    return (page, text, float(x), float(x + 6 * len(text)), float(y), float(y + 8), 10.0, 0)


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    long = "plain words of a page that is long enough to be no scan " * 4
    index = [fragment(4, f"Term{i} word word word .... {1 + i % 3}", 10 + 300 * (i % 2), 20 * (i // 2)) for i in range(12)]
    book = {
        "title": " Rule \u0007Book", "author": " A. ", "toc": [(1, "Start", 1), (2, "Guns", 2), (3, "More", 3), (1, "Index", 4)],
        "pages": [f"# Start\n{long}\n![x](img/a.png)", f"## Guns\n\n{TABLE}\n{long}", f"{long}\nCopy of 7", "flat index"], "fragments": index,
    }
    plain = {"pages": [f"## One\n{long}", f"text {long}", f"## Two\n{long}"]}
    contents = {
        "title": "Contents book", "pages": ["Contents\nAlpha ...... 1\nBeta ...... 2", f"# Alpha\n{long}", f"# Beta\n{long}"],
        "fragments": [fragment(1, "Contents", 10, 0), fragment(1, "Alpha ...... 1", 10, 30), fragment(1, "Beta ...... 2", 10, 60)],
    }
    for name, body in (("rules.doc", book), ("no title.doc", plain), ("contents.doc", contents), ("scan.doc", {"toc": [(1, "x", 1)], "pages": ["few"]})):
        (folder / name).write_bytes(b"DOC1" + json.dumps(body).encode())
    return str(folder)


def run_extract(spark, inbox, fallback="headings", **options):
    docs = checkpoint(documents.read_documents(spark, inbox, parser()))
    every = {"merge_wrapped_table_rows": True, "reconstruct_index": True, "boilerplate_patterns": (r"Copy of \d+",)} | options
    done = extract.extract(
        documents.document_pages(docs), docs.select("source_slug", "page_count"), documents.document_outlines(docs), documents.document_fragments(docs), every, fallback
    )
    sources = docs.select("source_slug", F.col("title").alias("source_title"), "file_name", "page_count", F.lit("2024-01-02").alias("created")).join(done.outlines, "source_slug")
    return done, sources


def test_extract_chooses_outlines_and_rejects(spark, inbox):
    done, _ = run_extract(spark, inbox)
    assert {(r.source_slug, r.toc_source) for r in done.outlines.collect()} == {("rule-book", "embedded"), ("no-title", "headings"), ("contents-book", "headings"), ("scan", "embedded")}
    assert [(r.source_slug, r.reason) for r in done.rejected.collect()] == [("scan", "too little text")]
    rows = {(r.source_slug, r.toc_number): r for r in done.sections.collect()}
    assert {s for s, _ in rows} == {"rule-book", "no-title", "contents-book"}
    index = rows["rule-book", "02"]
    assert index.kind == "index" and index.markdown.startswith("## INDEX") and "- Term0 word word word 1" in index.markdown
    assert "|A|1|2|3|4|5|Knock, Sharp|" in rows["rule-book", "01.01"].markdown and "Copy of" not in rows["rule-book", "01.01.01"].markdown
    warned = {r.source_slug for r in done.warnings.where("warning LIKE 'no leaf%'").collect()}
    assert warned == {"no-title", "contents-book"}


def test_printed_contents_and_missing_outlines(spark, inbox):
    done, _ = run_extract(spark, inbox, "toc", reconstruct_index=False)
    got = [(r.title, r.start_page) for r in done.sections.where("source_slug = 'contents-book'").orderBy("ord").collect()]
    assert got == [("Alpha", 2), ("Beta", 3)]
    assert ("no-title", "no outline") in {tuple(r) for r in done.rejected.collect()}


def test_build_verify_change_and_rebuild(spark, inbox, tmp_path):
    done, sources = run_extract(spark, inbox)
    where, record = str(tmp_path / "vault"), str(tmp_path / "record")
    (tmp_path / "a.png").write_bytes(b"png")
    staged = spark.createDataFrame([("rule-book", "a.png", str((tmp_path / "a.png").as_uri())), ("rule-book", "b.png", "file:///nowhere/b.png")], "source_slug string, ref string, uri string")
    full = checkpoint(done.sections)
    sources = checkpoint(sources.join(full.select("source_slug").distinct(), "source_slug", "left_semi"))
    first = build.build_vault(spark, full, sources, where, record, staged)
    paths = {r.path for r in first.written.collect()}
    assert "rule-book/rule-book.md" in paths and "rule-book/assets/a.png" in paths and first.removed.count() == 0
    assert (tmp_path / "vault/rule-book/assets/a.png").read_bytes() == b"png" and (tmp_path / "vault/no-title/sortspec.md").exists()

    notes = lambda: checkpoint(vault.parse_notes(vault.scan(vault_files.read_notes(spark, where)).where("path NOT LIKE '%sortspec.md'")))
    files = first.written.select("path")
    assert vault.verify(notes(), files, checkpoint).collect() == []
    linked = [r.text for r in notes().collect() if "## INDEX" in r.text]
    assert len(linked) == 1 and "[[rule-book/" in linked[0].split("## INDEX")[1]

    before = {r.path: r.text for r in notes().collect()}
    again = build.build_vault(spark, full, sources, where, record, staged)
    assert {r.path: r.text for r in notes().collect()} == before and again.removed.count() == 0

    guns = next(p for p in before if "guns" in p)
    updates = spark.createDataFrame([(guns, " a  summary ", ["new"], None), ("none.md", "x", [], None)], "path string, summary string, add_tags array<string>, force boolean")
    assert {tuple(r) for r in build.enrich_vault(spark, updates, where).collect()} == {(guns, "applied"), ("none.md", "no such note")}
    text = (tmp_path / "vault" / guns).read_text()
    assert 'summary: "a summary"' in text and "tags: [pdf-import, rule-book, new]" in text
    body = text.split("---\n", 2)[2]
    proposals = [(guns, "other", body), (guns.replace("guns", "none"), None, "x")]
    found = build.repair_vault(spark, spark.createDataFrame(proposals, "path string, kind string, new_body string"), where).collect()
    assert {r.kind for r in found} == {"kind", "ownership"} and (tmp_path / "vault" / guns).read_text() == text

    (tmp_path / "vault" / guns).write_text(text.replace("plain words", "Copy of 12 plain words"))
    changed = build.clean_vault(spark, where, [r"Copy of \d+ "], apply=True, report=str(tmp_path / "report"), backup=str(tmp_path / "backup"))
    assert [r.path for r in changed.collect()] == [guns] and "Copy of 12" in (tmp_path / "backup" / guns).read_text()
    assert "Copy of" not in (tmp_path / "vault" / guns).read_text() and spark.read.json(str(tmp_path / "report")).count() == 1

    one = full.where("source_slug = 'rule-book'"), sources.where("source_slug = 'rule-book'")
    fewer = build.build_vault(spark, *one, where, record)
    assert {r.path for r in fewer.removed.collect()} == {"rule-book/assets/a.png"} and not (tmp_path / "vault/rule-book/assets").exists()
    assert (tmp_path / "vault/no-title/no-title.md").exists() and (tmp_path / "vault/contents-book/contents-book.md").exists()
    recorded = {r.source_slug for r in vault_files.read_record(spark, record).collect()}
    assert recorded == {"rule-book", "no-title", "contents-book"}

    gone = build.remove_books(spark, sources.where("source_slug <> 'rule-book'"), where, record)
    assert {r.path.split("/")[0] for r in gone.collect()} == {"no-title", "contents-book"} and not (tmp_path / "vault/no-title").exists()
    assert {r.source_slug for r in vault_files.read_record(spark, record).collect()} == {"rule-book"}
    index = (tmp_path / "vault/index.md").read_text()
    assert "rule-book/rule-book" in index and "no-title" not in index
    left = spark.createDataFrame([(p,) for p in before if p.startswith("rule-book")], "path string")
    assert vault.verify(notes(), left, checkpoint, [g for g in vault.GATES if g != "assets"]).collect() == []
    mine = tmp_path / "vault/no-title/no-title.md"
    mine.parent.mkdir(exist_ok=True)
    mine.write_text("my own words")
    with pytest.raises(build.VaultConflict, match="no-title/no-title.md"):
        build.build_vault(spark, full, sources, where, record)
    assert mine.read_text() == "my own words" and not (tmp_path / "vault/contents-book/contents-book.md").exists()


def test_options_and_manifests(spark, tmp_path):
    path = tmp_path / "o.json"
    assert documents.read_options(spark, str(path), {"a": 1}) == {"a": 1}
    path.write_text('{"a": 2, "z": 3, "p": ["x"]}')
    assert documents.read_options(spark, str(path), {"a": 1, "p": ()}) == {"a": 2, "p": ("x",)}
    (tmp_path / "patterns").write_text("# no\n\n a+ \n")
    assert documents.read_patterns(spark, str(tmp_path / "patterns")) == ["a+"]
    taken, warned = documents.passthrough({"a": 1, "b": 2}, {"a": 0, "b": 0}, ["a"])
    assert taken == {"a": 1} and len(warned) == 1
    one = {"source": {"source_slug": "s"}, "sections": [{"title": "a\u0007", "display_title": "1 a", "markdown": "x\u0001\ny"}, {"title": "b"}]}
    (tmp_path / "m").mkdir()
    (tmp_path / "m/one.json").write_text(json.dumps(one, indent=2))
    rows = documents.manifest_sections(documents.read_manifests(spark, str(tmp_path / "m"))).orderBy("ord").collect()
    assert [(r.source_slug, r.ord, r.title, r.markdown) for r in rows] == [("s", 0, "a", "x\ny"), ("s", 1, "b", None)]


def test_manifests_of_an_extraction_come_back(spark, inbox, tmp_path):
    done, _ = run_extract(spark, inbox)
    docs = checkpoint(documents.read_documents(spark, inbox, parser()))
    made = checkpoint(extract.manifests(done, docs, {"split_depth": 3}, {"parser": "1.2"}, "/staging"))
    documents.write_manifests(made, str(tmp_path / "m"))
    documents.write_manifests(made.where("source_slug = 'no-title'"), str(tmp_path / "m"))
    back = {r.source.source_slug: r for r in documents.read_manifests(spark, str(tmp_path / "m")).collect()}
    assert set(back) == {"rule-book", "no-title", "contents-book"}
    book, plain = back["rule-book"], back["no-title"]
    assert (book.schema_version, book.toc_present, book.toc_source, book.source.title, book.source.author, book.source.page_count) == (1, True, "embedded", "Rule Book", "A.", 4)
    assert json.loads(book.tooling) == {"parser": "1.2"} and json.loads(book.config)["split_depth"] == 3 and json.loads(book.config)["toc_hierarchy_mode"] == "auto"
    assert book.source.file_path.endswith("rules.doc") and len(book.source.sha256) == 64 and book.source.assets_staging_dir == "/staging"
    assert [s.toc_number for s in book.sections] == ["01", "01.01", "01.01.01", "02"] and book.sections[3].kind == "index"
    assert sorted(plain.warnings) == plain.warnings and any("inferred from 2 headings" in w for w in plain.warnings)
    sections = {(r.source_slug, r.ord): r for r in documents.manifest_sections(documents.read_manifests(spark, str(tmp_path / "m"))).collect()}
    assert sections["rule-book", 1].markdown == book.sections[1].markdown and sections["no-title", 0].title == "One"


LONG = "plain words of a page that is long enough to be no scan " * 4


def pages_of(spark, **docs):
    rows = [(s, i + 1, t) for s, pages in docs.items() for i, t in enumerate(pages)]
    counts = [(s, len(pages)) for s, pages in docs.items()]
    return spark.createDataFrame(rows, "source_slug string, page int, text string"), spark.createDataFrame(counts, "source_slug string, page_count int")


def test_documents_of_one_slug_do_not_mix(spark):
    pages, counts = pages_of(spark, a=[f"# A\n{LONG}", f"# B\n{LONG}"], b=[f"# C\n{LONG}"])
    done = extract.extract(pages.unionByName(pages.where("source_slug = 'a'")), counts.unionByName(counts.where("source_slug = 'a'")), fallback="headings")
    assert [tuple(r) for r in done.rejected.collect()] == [("a", "several documents have this slug")]
    assert {r.source_slug for r in done.sections.collect()} == {"b"}
    docs = spark.createDataFrame([("/x/2", "a", 1), ("/x/1", "a", 2), ("/x/3", "b", 3)], "path string, source_slug string, page_count int")
    found = {r.path: r.source_slug for r in documents.distinct_slugs(docs).collect()}
    assert found["/x/1"] == "a" and found["/x/3"] == "b" and found["/x/2"].startswith("a-") and len(found["/x/2"]) == 10


def index_fragments(spark, slug, page, title):
    rows = [(slug, page, -1, title, 10.0, 90.0, 0.0, 10.0, False)]
    rows += [(slug, page, i, f"Term{i} word word word .... {1 + i % 3}", 10.0 + 300 * (i % 2), 200.0 + 300 * (i % 2), 20.0 * (i // 2 + 1), 10.0, False) for i in range(12)]
    return spark.createDataFrame(rows, "source_slug string, page int, frag_ord int, text string, x0 double, x1 double, y double, size double, bold boolean")


def test_index_titles_and_anchored_patterns(spark):
    """The title's row is no entry, whatever it says; a pattern is held against the beginning of a title."""
    pages, counts = pages_of(spark, s=[LONG, LONG, LONG])
    toc_rows = [("s", 0, 1, "Start", 1), ("s", 1, 1, "Reregister of guns", 2), ("s", 2, 1, "Register", 3)]
    embedded = spark.createDataFrame(toc_rows, "source_slug string, ord int, level int, title string, start_page int")
    options = {"reconstruct_index": True, "index_title_pattern": "register"}
    done = extract.extract(pages, counts, embedded, index_fragments(spark, "s", 3, "REGISTER"), options, warned=("option 'x' is not supported",))
    rows = {r.title: r for r in done.sections.collect()}
    assert rows["Reregister of guns"].kind == "text" and rows["Register"].kind == "index"
    assert "- Term0 word word word 1" in rows["Register"].markdown and "- REGISTER" not in rows["Register"].markdown
    assert {r.warning for r in done.warnings.collect()} == {"option 'x' is not supported"}


def test_printed_contents_say_what_they_are(spark):
    def rows(slug, lines):
        return [(slug, 1, i, t, 10.0, 100.0, 30.0 * i, 10.0, False) for i, t in enumerate(lines)]

    names = "source_slug string, page int, frag_ord int, text string, x0 double, x1 double, y double, size double, bold boolean"
    far = [f"# T{i}\n{LONG}" for i in range(6)]
    docs = {"good": ["Contents", *far], "none": ["Contents", *[LONG] * 3], "split": ["Contents of it", *far]}
    frags = rows("good", ["Contents", *[f"T{i} ..... {i}" for i in range(1, 6)]]) + rows("none", ["Contents", "Alpha .... 1"]) + rows("split", [f"T{i} ..... {i * i + 1}" for i in range(1, 6)])
    pages, counts = pages_of(spark, **docs)
    done = extract.extract(pages, counts, None, spark.createDataFrame(frags, names), {"toc_title_pattern": "contents"}, fallback="toc")
    said = {}
    for r in done.warnings.collect():
        said.setdefault(r.source_slug, []).append(r.warning)
    of = lambda slug, text: [w for w in said[slug] if text in w]
    assert of("good", "5 entries are read from printed contents on page 1") and not of("good", "offset")
    assert of("none", "no title is found among the headings") and of("split", "the page offset differs across 5 samples")


def test_structural_tier_keeps_texts_as_they_are(spark):
    page = f"# C A P S\n12\n![x](img/a.png)\n\n\n\n{TABLE}{LONG}\u0007"
    pages, _ = pages_of(spark, s=[page, None])
    done = extract.normalize_pages(pages, {"tier": "structural", "merge_wrapped_table_rows": True})
    texts = {r.page: r.text for r in done.pages.collect()}
    assert "ASSET" in texts[1] and TABLE in texts[1] and "# C A P S\n12\n" in texts[1] and "\u0007" not in texts[1]
    assert texts[2] == "" and done.drift.count() == 0
    clean = {r.page: r.text for r in extract.normalize_pages(pages, {"merge_wrapped_table_rows": True}).pages.collect()}
    assert clean[1].startswith("# CAPS\n![") and "Knock, Sharp|" in clean[1]


def test_outlines_of_any_depth(spark):
    rows = [("s", i, i + 1, f"t{i}", i + 1) for i in range(20)] + [("s", 20, 15, "u", 30), ("e", 0, None, "x", None)]
    frame = spark.createDataFrame(rows, "source_slug string, ord int, level int, title string, start_page int")
    pages = spark.createDataFrame([("s", 40), ("e", 3)], "source_slug string, page_count int")
    got = {(r.source_slug, r.ord): r for r in toc.build_sections(frame, pages).collect()}
    assert len({r.toc_number for (s, _), r in got.items() if s == "s"}) == 21
    assert got["s", 19].toc_number == ".".join(["01"] * 20) and got["s", 20].toc_number == ".".join(["01"] * 14 + ["02"])
    assert got["s", 20].parent_number == got["s", 13].toc_number and got["s", 14].end_page == 29 and got["s", 13].end_page == 40


def test_guards_report_lost_tables_and_unknown_kinds(spark):
    table = "|a|b|\n|---|---|\n|1|2|"
    rows = [(1, "table", f"x\n{table}\ny", "x\ny"), (2, None, table, table), (3, "other", table, table), (4, None, table, table + "\nmore"), (5, "index", "- a 1", "- a 2"), (6, "table", None, None)]
    frame = spark.createDataFrame(rows, "k int, kind string, before string, after string")
    assert [(r.k, r.table_no, r.token, r.delta) for r in guards.data_drift(frame, "k").collect()] == [(1, -1, guards.TABLES, -1)]
    assert {(r.k, r.kind) for r in guards.repair_drift(frame, "k").collect()} == {(1, "tables"), (3, "kind"), (4, "prose"), (5, "index")}
    with pytest.raises(ValueError, match="number of tables"):
        guards.raise_on_drift(guards.data_drift(frame, "k"))
    guards.raise_on_drift(guards.data_drift(frame.where("k > 1"), "k"))


def test_stream(spark, tmp_path):
    from folioforge.streaming.notes import normalize_stream

    spark.createDataFrame([(1, "a\n12\nCopy of 3"), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "in"))
    normalize_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c"), [r"Copy of \d+"]).awaitTermination()
    assert {(r.doc_id, r.text) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {(1, "a"), (2, None)}
