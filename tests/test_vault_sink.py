"""Changes to vaults that crash between two files, twice-run steps, folders, and libraries inside larger vaults."""

import pytest
from pyspark.sql import functions as F

from folioforge.plans import build
from folioforge.sources import vault_files, vault_sink

SECTIONS = (
    "source_slug string, ord int, toc_number string, parent_number string, level int, title string, display_title string, slug string, is_leaf boolean,"
    " start_page int, end_page int, markdown string, kind string, assets array<struct<ref:string,page:int,kind:string>>"
)
SOURCES = "source_slug string, source_title string, file_name string, page_count int, created string, toc_source string"


def book(spark, slug, n=3, text="words"):
    rows = [(slug, i, f"{i + 1:02}", None, 1, f"T{i}", f"{i + 1} T{i}", f"t{i}", True, i + 1, i + 1, f"{text} {i}", "text", []) for i in range(n)]
    return spark.createDataFrame(rows, SECTIONS), spark.createDataFrame([(slug, slug.title(), f"{slug}.pdf", n, "2024-01-02", "embedded")], SOURCES)


def tree(folder):
    return {str(p.relative_to(folder)): p.read_bytes() for p in folder.rglob("*") if p.is_file() and not p.name.endswith(".crc")}


def failing(frame, at):
    """The frame, whose second file can't be made."""

    @F.udf("string")
    def text(path, text):
        if path == at:
            raise ValueError("crash")
        return text

    return frame.withColumn("text", text("path", "text"))


def test_second_book_leaves_the_first(spark, tmp_path):
    where, record = tmp_path / "v", str(tmp_path / "record")
    build.build_vault(spark, *book(spark, "one"), str(where), record)
    first = {k: v for k, v in tree(where).items() if k.startswith("one/")}
    built = build.build_vault(spark, *book(spark, "two"), str(where), record)
    assert built.removed.count() == 0 and {k: v for k, v in tree(where).items() if k.startswith("one/")} == first
    fewer = build.build_vault(spark, *book(spark, "two", 2), str(where), record)
    assert [r.path for r in fewer.removed.collect()] == ["two/03-t2.md"]
    assert {r.path for r in vault_files.read_record(spark, record).where("source_slug = 'two'").collect()} == {"two/two.md", "two/01-t0.md", "two/02-t1.md"}
    assert {r.path for r in build.remove_books(spark, book(spark, "one")[1], str(where), record).collect()} == {*first}
    assert not (where / "one").exists() and "one" not in (where / "index.md").read_text() and not (where / ".commit/journal.json").exists()


def test_crash_while_staging_leaves_the_vault(spark, tmp_path):
    where = tmp_path / "v"
    where.mkdir()
    (where / "a.md").write_text("old")
    files = spark.createDataFrame([("a.md", "new"), ("b/c.md", "new"), ("d.md", "new")], "path string, text string").coalesce(1)
    with pytest.raises(Exception, match="crash"):
        vault_sink.stage(spark, failing(files, "b/c.md"), str(where))
    assert {k: v for k, v in tree(where).items() if not k.startswith(".commit")} == {"a.md": b"old"}
    change = vault_sink.stage(spark, files, str(where))
    assert {k: v for k, v in tree(where).items() if not k.startswith(".commit")} == {"a.md": b"old"}
    vault_sink.commit(spark, change)
    assert tree(where) == dict.fromkeys(("a.md", "b/c.md", "d.md"), b"new")


def test_crash_while_publishing_is_finished_by_the_next_change(spark, tmp_path):
    """The journal is there, one file has been moved: nothing is lost, and steps that are run twice do no harm."""
    where, record = tmp_path / "v", str(tmp_path / "record")
    build.build_vault(spark, *book(spark, "one"), str(where), record)
    files = spark.createDataFrame([("one/01-t0.md", "new"), ("one/x/y.md", "new")], "path string, text string")
    change = vault_sink.stage(spark, files, str(where))
    removed = spark.createDataFrame([("one/03-t2.md",), ("one/none.md",)], "path string")
    recorded = spark.createDataFrame([("one", change.root, "one/01-t0.md"), ("one", change.root, "one/x/y.md")], "source_slug string, vault string, path string")
    before = {k: v for k, v in tree(where).items() if not k.startswith(".commit")}
    vault_sink.seal(spark, change, removed, recorded, record)
    assert {k: v for k, v in tree(where).items() if not k.startswith(".commit")} == before
    some = vault_sink.staged_paths(spark, change).where("path = 'one/01-t0.md'")
    assert vault_sink.move_files(some, change.root, change.id).count() == 1
    assert (where / "one/01-t0.md").read_text() == "new" and not (where / "one/x").exists()
    build.build_vault(spark, *book(spark, "two"), str(where), record)
    assert (where / "one/x/y.md").read_text() == "new" and not (where / "one/03-t2.md").exists() and (where / "two/two.md").exists()
    assert {r.path for r in vault_files.read_record(spark, record).where("source_slug = 'one'").collect()} == {"one/01-t0.md", "one/x/y.md"}
    assert not vault_sink.recover(spark, str(where)) and not any(k.startswith(".commit") for k in tree(where))


def test_staged_rows_of_any_kind(spark, tmp_path):
    (tmp_path / "img").write_bytes(b"\x00png")
    uri = (tmp_path / "img").as_uri()
    rows = [("a/b.png", None, uri), ("a/c.png", None, uri + "-none"), ("e.md", None, None), ("f.md", "", None), ("g.md", "x" * 3_000_000, None)]
    files = spark.createDataFrame(rows, "path string, text string, uri string")
    change = vault_sink.stage(spark, files, str(tmp_path / "v"))
    assert {r.path for r in vault_sink.staged_paths(spark, change).collect()} == {"a/b.png", "e.md", "f.md", "g.md"}
    vault_sink.commit(spark, change)
    assert tree(tmp_path / "v") == {"a/b.png": b"\x00png", "e.md": b"", "f.md": b"", "g.md": b"x" * 3_000_000}
    vault_sink.commit(spark, vault_sink.stage(spark, files.limit(0), str(tmp_path / "v")))
    assert len(tree(tmp_path / "v")) == 4


def test_folders_go_level_by_level(spark, tmp_path):
    for path in ("a/b/c/d/x.md", "a/b/e/y.md", "f/g/z.md", "f/.hidden", "k.md"):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text("x")
    removed = spark.createDataFrame([("a/b/c/d/x.md",), ("f/g/z.md",), ("k.md",), ("no/such.md",)], "path string")
    vault_files.remove_files(spark, removed, str(tmp_path)).count()
    vault_files.prune_folders(spark, removed, str(tmp_path))
    assert {str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*") if p.is_dir()} == {"a", "a/b", "a/b/e", "f"}


def test_folders_of_many_files_are_counted_on_the_cluster(spark):
    paths = spark.range(300_000).select(F.concat_ws("/", F.col("id") % 10, F.col("id") % 1000, F.col("id") % 100_000, F.col("id")).alias("path"))
    found = {r["depth"]: r["count"] for r in vault_files.folders_above(paths).groupBy("depth").count().collect()}
    assert found == {1: 10, 2: 1000, 3: 100_000}


def test_library_inside_a_larger_vault(spark, tmp_path):
    (tmp_path / "big/.obsidian").mkdir(parents=True)
    where = tmp_path / "big/Games/Rules"
    assert vault_files.enclosing(spark, str(where)) == "Games/Rules" and vault_files.enclosing(spark, str(tmp_path / "big")) == "" == vault_files.enclosing(spark, str(tmp_path))
    build.build_vault(spark, *book(spark, "one"), str(where), str(tmp_path / "record"))
    assert 'parent: "[[Games/Rules/index|Imported PDFs]]"' in (where / "one/one.md").read_text()
    assert "target-folder: Games/Rules/one/**" in (where / "one/sortspec.md").read_text() and "target-folder: Games/Rules/*" in (where / "sortspec.md").read_text()
    build.build_vault(spark, *book(spark, "one"), str(where), str(tmp_path / "record"), index_link="root")
    assert 'parent: "[[index|Imported PDFs]]"' in (where / "one/one.md").read_text()
