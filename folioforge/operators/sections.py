"""Pages into sections, sections into linked notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from .ranges import blocks_of_page, blocks_of_range
from .toc import preambles


def page_slices(sections: DataFrame) -> DataFrame:
    """``(source_slug, ord, page)`` that a section owns: a leaf its range, a branch the pages before its first child."""
    before = preambles(sections).select("source_slug", "toc_number", "first_page", "last_page")
    ranged = sections.join(before, ["source_slug", "toc_number"], "left").select(
        "source_slug", "ord",
        F.when(F.col("is_leaf"), F.col("start_page")).otherwise(F.col("first_page")).alias("lo"),
        F.when(F.col("is_leaf"), F.col("end_page")).otherwise(F.col("last_page")).alias("hi"),
    )
    return ranged.where("lo <= hi").select("source_slug", "ord", F.explode(F.sequence("lo", "hi")).alias("page"))


def section_text(sections: DataFrame, pages: DataFrame) -> DataFrame:
    """``(source_slug, ord, markdown, assets)``: a section's non-empty pages in order, parted by blank lines, and its images.

    The range join is an explosion into (document, page) keys and an equi-join, so no nested loop is planned.
    """
    text = X.strip(F.coalesce("text", F.lit("")))
    part = page_slices(sections).join(pages.select("source_slug", "page", text.alias("t"), X.image_names(F.coalesce("text", F.lit(""))).alias("i")), ["source_slug", "page"])
    got = part.groupBy("source_slug", "ord").agg(F.sort_array(F.collect_list(F.struct("page", "t", "i"))).alias("p"))
    body = F.array_join(F.transform(F.filter("p", lambda x: x["t"] != ""), lambda x: x["t"]), "\n\n")
    assets = F.flatten(F.transform("p", lambda x: F.transform(x["i"], lambda n: F.struct(n.alias("ref"), x["page"].alias("page"), F.lit("image").alias("kind")))))
    return got.select("source_slug", "ord", X.strip(body).alias("markdown"), assets.alias("assets"))


def shared_pages(sections: DataFrame) -> DataFrame:
    """Sections that begin on a page which an earlier one owns: ``(source_slug, toc_number, page, owner)``, each once."""
    own = page_slices(sections).join(sections.select("source_slug", "ord", "toc_number"), ["source_slug", "ord"])
    first = F.first("toc_number").over(W.partitionBy("source_slug", "page").orderBy("ord"))
    return own.withColumn("owner", first).where("owner <> toc_number").select("source_slug", "toc_number", "page", "owner").distinct()


def note_paths(sections: DataFrame, layout: str = "nested") -> DataFrame:
    """``(source_slug, toc_number, dir, note_path, link_target)``.

    A branch is the note of a folder of its own, a leaf a file beside its siblings (its own folder too if ``layout`` is
    ``uniform``). Ancestors are the prefixes of the number, so one join against the segments builds all folders.
    """
    seg = X.segment(F.col("toc_number"), F.col("slug"))
    s = sections.select("source_slug", "ord", "toc_number", "is_leaf", seg.alias("seg"))
    parts = F.split("toc_number", r"\.")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), ".").alias("number")))
    up = s.select("source_slug", "ord", F.explode(prefixes).alias("a")).select("source_slug", "ord", "a.depth", F.col("a.number").alias("toc_number"))
    chain = up.join(s.select("source_slug", "toc_number", "seg"), ["source_slug", "toc_number"]).groupBy("source_slug", "ord").agg(F.sort_array(F.collect_list(F.struct("depth", "seg"))).alias("c"))
    folder = F.lit(layout == "uniform") | ~F.col("is_leaf")
    names = F.col("c.seg")
    above = F.when(folder, names).otherwise(F.slice(names, F.lit(1), F.size(names) - 1))
    d = s.join(chain, ["source_slug", "ord"]).select("source_slug", "ord", "toc_number", F.concat_ws("/", F.col("source_slug"), above).alias("dir"), "seg")
    nth = F.row_number().over(W.partitionBy("source_slug", "dir", "seg").orderBy("ord"))
    target = F.concat("dir", F.lit("/"), F.when(nth > 1, F.concat("seg", F.lit("-"), nth)).otherwise(F.col("seg")))
    return d.withColumn("link_target", target).select("source_slug", "ord", "toc_number", "dir", F.concat("link_target", F.lit(".md")).alias("note_path"), "link_target")


def page_targets(sections: DataFrame, paths: DataFrame) -> DataFrame:
    """``(source_slug, page, link_target)``: the note that covers a page; leaves before branches, then the first.

    Sections are cut into aligned blocks of pages, the best section of each block is kept, and each page asks the blocks that
    hold it. A branch over a whole document is a few rows, not one for each of its pages. All pages come out of one row a document, so
    plans take them for a small table: they are dealt over tasks, and their join is told not to broadcast them.
    """
    rank = F.struct((~F.col("is_leaf")).alias("branch"), "ord", "toc_number")
    block = sections.select("source_slug", rank.alias("s"), F.explode(blocks_of_range(F.col("start_page"), F.col("end_page"))).alias("b"))
    best = block.groupBy("source_slug", "b").agg(F.min("s").alias("s"))
    pages = sections.groupBy("source_slug").agg(F.max("end_page").alias("n")).select("source_slug", F.explode(F.sequence(F.lit(1), "n")).alias("page"))
    asked = pages.repartition("source_slug", "page").select("source_slug", "page", F.explode(blocks_of_page(F.col("page"))).alias("b"))
    of = asked.join(best.hint("merge"), ["source_slug", "b"]).groupBy("source_slug", "page").agg(F.min("s").alias("s")).select("source_slug", "page", "s.toc_number")
    return of.join(paths.select("source_slug", "toc_number", "link_target"), ["source_slug", "toc_number"]).select("source_slug", "page", "link_target")


def note_headings(notes: DataFrame) -> DataFrame:
    """``(source_slug, link_target, key, heading)``: each loose key's first heading of a note; fences don't count."""
    line = notes.select("source_slug", "link_target", F.posexplode(F.split(F.coalesce("markdown", F.lit("")), "\n", -1)).alias("n", "line"))
    raw = F.regexp_extract("line", r"(?U)\A#{1,6}\s+(.*\S)\s*\z", 1)
    shown = X.strip(F.regexp_replace(F.regexp_replace(raw, r"\*\*|__|`", ""), r"(?U)\A\s*\d+[.)]\s*", ""))
    found = line.where(raw != "").select("source_slug", "link_target", "n", shown.alias("heading")).withColumn("key", X.index_key(F.col("heading"))).where("key <> ''")
    return found.groupBy("source_slug", "link_target", "key").agg(F.min_by("heading", "n").alias("heading"))


# Fixed value: the form of an index entry that is linked, a list item with page references at its end.
_ENTRY = r"(?U)\A(- )(.*?)(\s+)(\*{0,2}\d[\d,–\-\s*]*)\z"


def linkify_index(notes: DataFrame, targets: DataFrame, headings: DataFrame) -> DataFrame:
    """Index notes with page numbers as links: ``(source_slug, link_target, markdown)`` out of the same columns.

    Each reference of an entry's trailing group goes to the note that covers its first page, with an anchor where that note
    has a heading of the entry's term; bold stays; a page without a note stays plain. Two left equi-joins.
    """
    key = ["source_slug", "link_target"]
    line = notes.select(*key, F.posexplode(F.split("markdown", "\n", -1)).alias("n", "line"))
    part = [F.regexp_extract("line", _ENTRY, i) for i in range(1, 5)]
    split = line.select(*key, "n", "line", F.concat(*part[:3]).alias("head"), X.index_key(part[1]).alias("key"), F.split(part[3], ",", -1).alias("refs"), (part[3] != "").alias("entry"))
    refs = split.where("entry").select(*key, "n", "key", F.posexplode("refs").alias("i", "ref")).withColumn("ref", X.strip(F.col("ref"))).where("ref <> ''")
    core = X.strip(F.regexp_replace("ref", r"\A\*+|\*+\z", ""))
    refs = refs.withColumn("core", core).withColumn("page", F.regexp_extract("core", r"\A(\d+)", 1).cast("int"))
    to = targets.select("source_slug", "page", F.col("link_target").alias("to"))
    heads = headings.select("source_slug", F.col("link_target").alias("to"), "key", "heading")
    joined = refs.join(to, ["source_slug", "page"], "left").join(heads, ["source_slug", "to", "key"], "left")
    link = X.wikilink(F.concat("to", F.coalesce(F.concat(F.lit("#"), F.col("heading")), F.lit(""))), F.col("core"))
    bold = F.startswith("ref", F.lit("**"))
    shown = F.when(F.col("to").isNull(), F.col("ref")).when(bold, F.concat(F.lit("**"), link, F.lit("**"))).otherwise(link)
    got = joined.groupBy(*key, "n").agg(F.sort_array(F.collect_list(F.struct("i", shown.alias("s")))).alias("r"))
    text = F.when(F.col("entry"), F.concat("head", F.array_join(F.coalesce(F.col("r.s"), F.array().cast("array<string>")), ", "))).otherwise(F.col("line"))
    lines = split.join(got, [*key, "n"], "left").select(*key, "n", text.alias("line"))
    return lines.groupBy(*key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), "\n").alias("markdown"))


def neighbours(sections: DataFrame) -> DataFrame:
    """``(source_slug, toc_number, prev_number, next_number)`` along the leaves."""
    w = W.partitionBy("source_slug").orderBy("ord")
    return sections.where("is_leaf").select("source_slug", "toc_number", F.lag("toc_number").over(w).alias("prev_number"), F.lead("toc_number").over(w).alias("next_number"))


def parent_links(sections: DataFrame, paths: DataFrame, titles: DataFrame) -> DataFrame:
    """``(source_slug, toc_number, parent)``: the link to the parent's note, or to the document's overview note."""
    named = sections.join(paths.select("source_slug", "toc_number", "link_target"), ["source_slug", "toc_number"])
    above = named.select("source_slug", F.col("toc_number").alias("parent_number"), X.wikilink(F.col("link_target"), F.col("display_title")).alias("up"))
    top = X.wikilink(F.concat("source_slug", F.lit("/"), "source_slug"), F.col("source_title"))
    return sections.join(above, ["source_slug", "parent_number"], "left").join(titles, "source_slug").select("source_slug", "toc_number", F.coalesce("up", top).alias("parent"))


def contents(sections: DataFrame, paths: DataFrame) -> DataFrame:
    """``(source_slug, parent_number, contents)``: children as list items in order; the top level has a null parent."""
    named = sections.join(paths.select("source_slug", "toc_number", "link_target"), ["source_slug", "toc_number"])
    item = F.concat(F.lit("- "), X.wikilink(F.col("link_target"), F.col("display_title")))
    listed = named.groupBy("source_slug", "parent_number").agg(F.sort_array(F.collect_list(F.struct("ord", item.alias("i")))).alias("c"))
    return listed.select("source_slug", "parent_number", F.array_join("c.i", "\n").alias("contents"))


# Frontmatter keys in their order.
FRONTMATTER_KEYS = ("title", "source", "source_pages", "boundary", "toc_level", "toc_number", "parent", "prev", "next", "tags", "summary", "created", "generated_by")


def frontmatter(meta: dict[str, Column]) -> Column:
    """A frontmatter block out of columns by key; null values are left out."""
    lines = []
    for key in FRONTMATTER_KEYS:
        c = meta.get(key)
        if c is None:
            continue
        if key == "source_pages":
            value = F.concat(F.lit("["), c[0].cast("string"), F.lit(", "), c[1].cast("string"), F.lit("]"))
        elif key == "tags":
            value = F.concat(F.lit("["), F.array_join(c, ", "), F.lit("]"))
        elif key in ("boundary", "created", "generated_by", "toc_level"):
            value = c.cast("string")
        else:
            value = X.quote(c)
        lines.append(F.concat(F.lit(f"{key}: "), value))
    kept = F.filter(F.array(*lines), lambda x: x.isNotNull())
    return F.concat(F.lit("---\n"), F.array_join(F.transform(kept, lambda x: F.concat(x, F.lit("\n"))), ""), F.lit("---"))


def render_note(meta: dict[str, Column], body: Column) -> Column:
    return F.concat(frontmatter(meta), F.lit("\n\n"), F.regexp_replace(body, r"\n+\z", ""), F.lit("\n"))


def leaf_body(markdown: Column, note_dir: Column, fallback: str = "_No extractable text in this section._") -> Column:
    return X.resolve_assets(F.when(F.coalesce(markdown, F.lit("")) == "", F.lit(fallback)).otherwise(markdown), note_dir)


def branch_body(title: Column, preamble: Column, listing: Column, note_dir: Column) -> Column:
    """Title, the pages before the first child if there are any, and the list of children."""
    before = F.when(F.coalesce(preamble, F.lit("")) != "", F.concat(X.resolve_assets(preamble, note_dir), F.lit("\n\n"))).otherwise(F.lit(""))
    return F.concat(F.lit("# "), title, F.lit("\n\n"), before, F.lit("## Contents\n\n"), F.coalesce(listing, F.lit("")))


# Fixed value: the mark of an outline that was inferred from headings.
INFERRED = (
    "> [!note] No embedded table of contents. This structure was inferred from detected headings, not extracted from PDF bookmarks "
    "- verify it matches the source before relying on it.\n\n"
)


def overview_body(title: Column, file_name: Column, page_count: Column, created: Column, toc_source: Column, listing: Column) -> Column:
    """A document's overview note; an outline inferred from headings is marked as such."""
    source = F.concat(F.lit("> Source: `"), file_name, F.lit("` - "), page_count.cast("string"), F.lit(" pages - imported "), created.cast("string"), F.lit("\n\n"))
    inferred = F.when(toc_source == "headings", F.lit(INFERRED)).otherwise(F.lit(""))
    return F.concat(F.lit("# "), title, F.lit("\n\n"), source, inferred, F.lit("## Contents\n\n"), F.coalesce(listing, F.lit("")))


def build_notes(sections: DataFrame, sources: DataFrame, owner: str, layout: str = "nested", index_target: str = "index") -> DataFrame:
    """All notes of all documents: ``(source_slug, path, text)``.

    ``sections`` is the section table with ``markdown`` and ``kind``; ``sources`` holds ``(source_slug, source_title, file_name,
    page_count, created, toc_source)``. Joins are equi-joins by document and number; ``owner`` marks the notes as generated.
    """
    paths = note_paths(sections, layout)
    at = paths.select("source_slug", "toc_number", "dir", "note_path", "link_target")
    named = sections.join(at, ["source_slug", "toc_number"])
    link = named.select("source_slug", F.col("toc_number").alias("n"), X.wikilink(F.col("link_target"), F.col("display_title")).alias("l"))
    near = neighbours(sections)
    for side in ("prev", "next"):
        near = near.join(link.withColumnRenamed("n", f"{side}_number").withColumnRenamed("l", side), ["source_slug", f"{side}_number"], "left")
    listing = contents(sections, paths)
    inner = listing.where("parent_number IS NOT NULL").withColumnRenamed("parent_number", "toc_number")
    linked = linkify_index(
        named.where("kind = 'index'").select("source_slug", "link_target", F.coalesce("markdown", F.lit("")).alias("markdown")),
        page_targets(sections, paths), note_headings(named.select("source_slug", "link_target", "markdown")),
    ).withColumnRenamed("markdown", "linked")
    full = (
        named.join(sources, "source_slug").join(parent_links(sections, paths, sources.select("source_slug", "source_title")), ["source_slug", "toc_number"])
        .join(near.select("source_slug", "toc_number", "prev", "next"), ["source_slug", "toc_number"], "left")
        .join(inner, ["source_slug", "toc_number"], "left").join(linked, ["source_slug", "link_target"], "left")
    )
    tags = F.array(F.lit("pdf-import"), F.col("source_slug"))
    shared = {"boundary": F.lit("page-level"), "tags": tags, "created": F.col("created"), "generated_by": F.lit(owner)}
    meta = shared | {
        "title": F.col("display_title"), "source": F.col("file_name"), "source_pages": F.array("start_page", "end_page"), "toc_level": F.col("level"),
        "toc_number": F.col("toc_number"), "parent": F.col("parent"), "prev": F.col("prev"), "next": F.col("next"),
    }
    leaf = leaf_body(F.coalesce("linked", "markdown"), F.col("dir"))
    body = F.when(F.col("is_leaf"), leaf).otherwise(branch_body(F.col("display_title"), F.col("markdown"), F.col("contents"), F.col("dir")))
    notes = full.select("source_slug", F.col("note_path").alias("path"), render_note(meta, body).alias("text"))
    top = sources.join(listing.where("parent_number IS NULL").drop("parent_number"), "source_slug", "left")
    over_meta = shared | {
        "title": F.col("source_title"), "source": F.col("file_name"), "source_pages": F.array(F.lit(1), F.col("page_count")), "toc_level": F.lit(0),
        "toc_number": F.lit("00"), "parent": F.lit(f"[[{index_target}|Imported PDFs]]"),
    }
    over = overview_body(F.col("source_title"), F.col("file_name"), F.col("page_count"), F.col("created"), F.col("toc_source"), F.col("contents"))
    return notes.unionByName(top.select("source_slug", X.moc_path(F.col("source_slug")).alias("path"), render_note(over_meta, over).alias("text")))
