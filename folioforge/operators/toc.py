"""Outlines: from flat entries to a numbered section tree with page ranges."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import unicode as U
from .outline import walk


def choose_source(candidates: DataFrame) -> DataFrame:
    """Entries of the best source of each document: ``priority`` (smallest first) out of embedded, toc-page, headings, pages."""
    best = F.min("priority").over(W.partitionBy("source_slug"))
    return candidates.withColumn("__best", best).where("priority = __best").drop("__best")


def looks_degenerate(toc: DataFrame) -> DataFrame:
    """``(source_slug, share, degenerate)``: at least half of the titles are bare digits."""
    share = F.avg(X.strip(F.col("title")).rlike(r"(?U)\A\d+\z").cast("int"))
    return toc.groupBy("source_slug").agg(share.alias("share")).withColumn("degenerate", F.col("share") >= 0.5)


def clamp_depth(toc: DataFrame, depth: int) -> DataFrame:
    """Without entries deeper than ``depth``; 0 keeps all."""
    return toc.where(F.col("level") <= depth) if depth else toc


def page_entries(pages: DataFrame) -> DataFrame:
    """One entry per page: ``(source_slug, ord, level, title, start_page)`` from ``(source_slug, page_count)``."""
    return pages.select("source_slug", F.posexplode(F.sequence(F.lit(1), F.col("page_count"))).alias("ord", "start_page")).select(
        "source_slug", "ord", F.lit(1).alias("level"), F.concat(F.lit("Page "), F.col("start_page")).alias("title"), "start_page"
    )


def effective_levels(toc: DataFrame) -> DataFrame:
    """Add ``k`` (position from 0) and ``eff``: the level, at least 1 and at most one below its predecessor's."""
    order = W.partitionBy("source_slug").orderBy("ord")
    k = F.row_number().over(order) - 1
    level = F.greatest(F.col("level"), F.lit(1))
    with_k = toc.withColumn("k", k).withColumn("__l", level - F.col("k"))
    low = F.min("__l").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    return with_k.withColumn("eff", F.least(F.col("k") + 1, F.col("k") + low)).drop("__l")


def build_sections(toc: DataFrame, pages: DataFrame, pad_width: int = 2, slug_len: int = 60, tasks: int | None = None) -> DataFrame:
    """The section table out of ``toc(source_slug, ord, level, title, start_page)`` and ``pages(source_slug, page_count)``.

    Returns ``(source_slug, ord, toc_number, parent_number, level, title, display_title, slug, is_leaf, start_page,
    end_page)``. Each entry's depth, number and end depend on all before and behind it; ``outline.walk`` works them out by a scan
    over range partitions (``tasks`` of them, if given), so a document may take many tasks. Documents without a page count give no
    sections; a null level is 1.
    """
    t = walk(toc, pad_width, tasks).join(pages.select("source_slug", F.col("page_count").cast("int").alias("page_count")), "source_slug")
    n = F.greatest(F.col("page_count"), F.lit(1))
    start = F.least(F.greatest(F.col("start_page"), F.lit(1)), n)
    end = F.when(F.col("next_page").isNull(), F.col("page_count")).otherwise(F.greatest(F.col("start_page"), F.col("next_page") - 1))
    title = X.clean_inline(F.col("title"))
    return t.select(
        "source_slug", F.col("k").alias("ord"), "toc_number", "parent_number", F.col("eff").alias("level"), title.alias("title"),
        F.concat_ws(" ", "plain", title).alias("display_title"), U.slugify(title, slug_len).alias("slug"), "is_leaf",
        start.alias("start_page"), F.least(F.greatest(end, start), n).alias("end_page"),
    )


def preambles(sections: DataFrame) -> DataFrame:
    """Pages of a branch before its first child: ``(source_slug, toc_number, first_page, last_page)``."""
    first = sections.where("parent_number IS NOT NULL").groupBy("source_slug", F.col("parent_number").alias("toc_number")).agg(F.min("start_page").alias("child"))
    return sections.join(first, ["source_slug", "toc_number"]).where("child > start_page").select("source_slug", "toc_number", F.col("start_page").alias("first_page"), (F.col("child") - 1).alias("last_page"))


_FENCE = r"(?U)\A\s*(?:```|~~~)"


def heading_titles(text: Column) -> Column:
    """Usable ATX headings of a page in order, outside ``` and ~~~ fences; no emphasis, cleaned, none empty."""
    lines = F.split(text, "\n", -1)
    start = F.struct(F.lit(False).alias("code"), F.array().cast("array<string>").alias("found"))

    def step(state: Column, line: Column) -> Column:
        fence = line.rlike(_FENCE)
        title = X.clean_inline(F.regexp_replace(F.regexp_extract(line, r"(?Us)\A\s*#{1,6}\s+(.+)\z", 1), r"[*_`]+", ""))
        use = ~fence & ~state["code"] & (title != "")
        return F.struct((state["code"] != fence).alias("code"), F.when(use, F.concat(state["found"], F.array(title))).otherwise(state["found"]).alias("found"))

    return F.aggregate(lines, start, step, lambda s: s["found"])


def toc_from_headings(pages: DataFrame) -> DataFrame:
    """Flat outline out of the first heading of each page; pages before the first one get an entry of their own."""
    found = pages.select("source_slug", "page", F.try_element_at(heading_titles(F.coalesce("text", F.lit(""))), F.lit(1)).alias("title")).where("title IS NOT NULL")
    first = found.groupBy("source_slug").agg(F.min("page").alias("first")).where("first > 1")
    gap = first.select(
        "source_slug", F.lit(1).alias("page"),
        F.when(F.col("first") == 2, F.lit("Page 1")).otherwise(F.concat(F.lit("Pages 1-"), F.col("first") - 1)).alias("title"),
    )
    every = found.select("source_slug", "page", "title").unionByName(gap)
    order = W.partitionBy("source_slug").orderBy("page", F.col("title"))
    return every.select("source_slug", (F.row_number().over(order) - 1).alias("ord"), F.lit(1).alias("level"), "title", F.col("page").alias("start_page"))


# Fixed value: titles of a printed table of contents.
TOC_TITLE = (
    r"(?i)^\s*(table\s+of\s+contents?|contents?|toc|index|inhoud(?:sopgave|stafel)?|inhaltsverzeichnis"
    r"|table\s+des\s+mati[eè]res|[ií]ndice|contenido)\s*$"
)


def locate_toc_pages(pages: DataFrame, title_pattern: str = TOC_TITLE, reach: int = 19, pinned: int | None = None) -> DataFrame:
    """Pages of the printed table of contents: ``(source_slug, page)``.

    The first page with a line, or a heading, whose beginning matches the title in either case (or the pinned one), and the pages behind it as long as
    each has a run of four or more leader dots, ``reach`` at most.
    """
    text = F.coalesce("text", F.lit(""))
    bare = F.transform(F.split(text, "\n", -1), lambda x: X.strip(F.regexp_replace(X.strip(x), r"(?U)\A#{1,6}\s+", "")))
    own = W.partitionBy("source_slug")
    titled = F.exists(bare, lambda x: (x != "") & x.rlike(rf"(?i)\A(?:{title_pattern})"))
    first = F.min(F.when(F.col("titled"), F.col("page"))).over(own) if pinned is None else F.greatest(F.lit(1), F.least(F.lit(pinned), F.max("page").over(own)))
    flags = pages.select("source_slug", "page", titled.alias("titled"), text.rlike(r"[.·…]{4,}").alias("leaders")).withColumn("first", first)
    after = flags.where(f"page >= first AND page <= first + {reach}")
    run = F.min((F.col("leaders") | (F.col("page") == F.col("first"))).cast("int")).over(own.orderBy("page").rowsBetween(W.unboundedPreceding, W.currentRow))
    return after.withColumn("ok", run).where("ok = 1").select("source_slug", "page")


def numbered_level(title: Column) -> Column:
    """Depth of a printed entry by its outline prefix: the number of dotted parts; 1 without a dotted or numeric prefix."""
    prefix = F.regexp_extract(X.strip(title), r"(?iU)\A([A-Z0-9]+(?:\.[A-Z0-9]+)*)(?:\s|\z)", 1)
    return F.when(F.contains(prefix, F.lit(".")) | prefix.rlike(r"\A\d+\z"), F.size(F.split(prefix, r"\.", -1))).otherwise(1)


def indent_bands(x0: Column, tolerance: float = 2.5) -> Column:
    """Anchors of indent bands of an array of left edges: a value opens a band where it is past the last anchor's reach."""
    distinct = F.array_sort(F.array_distinct(x0))
    start = F.array().cast("array<double>")
    return F.aggregate(distinct, start, lambda bands, v: F.when(F.coalesce(v - F.try_element_at(bands, F.lit(-1)) <= tolerance, F.lit(False)), bands).otherwise(F.concat(bands, F.array(v))))


def band_level(bands: Column, x: Column, tolerance: float = 2.5) -> Column:
    """Level of a left edge: the first band within reach, else the nearest, the outer one if two are as near."""
    near = F.array_position(F.transform(bands, lambda b: F.abs(x - b) <= tolerance), True)
    gaps = F.transform(bands, lambda b: F.abs(x - b))
    return F.when(near > 0, near).otherwise(F.array_position(gaps, F.array_min(gaps))).cast("int")


def page_offset(rows: DataFrame, headings: DataFrame, sample: int = 20) -> DataFrame:
    """Shift from printed to real pages by vote: ``(source_slug, page_offset, votes, winners)``.

    ``rows(source_slug, ord, title, page)`` are printed entries, ``headings(source_slug, page, title)`` those of the pages. Every
    n-th entry, ``sample`` at most, votes with the first page that has a heading which contains it or is contained in it;
    ties go to the vote cast first. ``rows`` per document are bounded by the sample before the join.
    """
    own = W.partitionBy("source_slug")
    numbered = rows.where("page IS NOT NULL").withColumn("k", F.row_number().over(own.orderBy("ord")) - 1).withColumn("n", F.count(F.lit(1)).over(own))
    step = F.greatest(F.floor(F.col("n") / sample), F.lit(1))
    chosen = numbered.where((F.col("k") % step == 0) & (F.col("k") < step * sample)).select("source_slug", "k", F.col("page").alias("printed"), U.normalize_title(F.col("title")).alias("t")).where("t <> ''")
    heads = headings.select(F.col("source_slug").alias("s"), F.col("page").alias("real"), U.normalize_title(F.col("title")).alias("h")).where("h <> ''")
    hit = (F.col("source_slug") == F.col("s")) & (F.contains(F.col("h"), F.col("t")) | F.contains(F.col("t"), F.col("h")))
    first = chosen.join(heads, hit).groupBy("source_slug", "k", "printed").agg(F.min("real").alias("real"))
    votes = first.groupBy("source_slug", (F.col("real") - F.col("printed")).alias("page_offset")).agg(F.count(F.lit(1)).alias("winners"), F.min("k").alias("cast"))
    ranked = votes.withColumn("votes", F.sum("winners").over(own)).withColumn("r", F.row_number().over(own.orderBy(F.desc("winners"), "cast")))
    return ranked.where("r = 1").select("source_slug", F.col("page_offset").cast("int").alias("page_offset"), F.col("votes").cast("int").alias("votes"), F.col("winners").cast("int").alias("winners"))


def offset_warnings(rows: DataFrame, offsets: DataFrame) -> DataFrame:
    """``(source_slug, warning)`` of documents with printed entries: no vote at all, or too few for the offset that won."""
    asked = rows.where("page IS NOT NULL").select("source_slug").distinct().join(offsets, "source_slug", "left")
    poor = F.col("winners") < F.greatest(F.lit(2), F.floor(F.col("votes") / 2))
    said = F.concat(F.lit("printed contents: the page offset differs across "), F.col("votes"), F.lit(" samples; "), F.col("page_offset"), F.lit(" is taken, which "), F.col("winners"), F.lit(" of them have"))
    none = F.lit("printed contents: no title is found among the headings; page offset 0 is taken")
    return asked.select("source_slug", F.when(F.col("votes").isNull(), none).when(poor, said).alias("warning")).where("warning IS NOT NULL")


# The forms of a printed entry: page and bar, page before the title, chapter label, page behind the title.
_PIPE, _LEADING, _CHAPTER = re.compile(r"(\d+)\s*\|\s*(.*)"), re.compile(r"(\d+)\s+([^\d|].+)"), re.compile(r"Chapter\s+\d+", re.I)
_TRAILING = re.compile(r"\s+(\*{0,2})(\d+)\1\s*$")


def _printed_entry(rows: list[tuple[str, float, float]]) -> Iterator[tuple[str, int | None, float]]:
    """Entries ``(title, page or None, left edge)`` out of rows ``(text, first x0, last x0)``; a label row may take the next row."""

    def numbered(text: str) -> bool:
        return bool(_PIPE.fullmatch(text) or _LEADING.fullmatch(text) or _TRAILING.search(text))

    queue = [r for r in rows if r[0]]
    while queue:
        text, left, right = queue.pop(0)
        titled = queue[0] if queue and not numbered(queue[0][0]) else None
        piped, led, tail = _PIPE.fullmatch(text), _LEADING.fullmatch(text), _TRAILING.search(text)
        if piped or led:
            page, title = int((piped or led).group(1)), (piped or led).group(2).strip()
            label = _CHAPTER.fullmatch(title) or (piped and not title)
            if label and titled:
                queue.pop(0)
                yield titled[0], page, titled[1]
            else:
                yield title or text, page, left if label and piped else right
        elif tail and not _CHAPTER.fullmatch(text):
            if title := text[: tail.start()].strip():
                yield title, int(tail.group(2)), left
        else:
            yield text, None, left


def parse_printed_rows(rows: DataFrame) -> DataFrame:
    """Printed entries ``(source_slug, ord, title, page, x0)`` out of ``rows(source_slug, page_no, row_no, text, x0, x1)``.

    ``text`` has its leaders stripped; ``x0`` and ``x1`` are the left edges of the row's first and last fragment. Rows look ahead
    and take rows, page by page, so each page's rows (one page's few lines) are walked in Python.
    """
    page = rows.groupBy("source_slug", "page_no").agg(F.sort_array(F.collect_list(F.struct("row_no", "text", "x0", "x1"))).alias("r"))
    shape = "array<struct<title:string,page:int,x0:double>>"

    @F.pandas_udf(shape)
    def walk(pages: pd.Series) -> pd.Series:
        return pages.map(lambda r: [{"title": t, "page": p, "x0": x} for t, p, x in _printed_entry([(f["text"], f["x0"], f["x1"]) for f in r])])

    each = page.select("source_slug", "page_no", F.posexplode(walk("r")).alias("i", "e"))
    order = W.partitionBy("source_slug").orderBy("page_no", "i")
    return each.select("source_slug", (F.row_number().over(order) - 1).alias("ord"), "e.title", "e.page", "e.x0")


def printed_toc(entries: DataFrame, offsets: DataFrame, pages: DataFrame, mode: str = "auto", threshold: float = 0.6) -> DataFrame:
    """Outline ``(source_slug, ord, level, title, start_page)`` out of printed entries that have a page.

    Levels come from outline prefixes (``numbered``), from indent bands (``indent``), or, with ``auto``, from prefixes where
    at least ``threshold`` of the entries with a page have one. Pages are shifted and clamped to the document.
    """
    own = W.partitionBy("source_slug")
    prefix = F.regexp_extract(X.strip(F.col("title")), r"(?iU)\A([A-Z0-9]+(?:\.[A-Z0-9]+)*)(?:\s|\z)", 1)
    has = (F.contains(prefix, F.lit(".")) | prefix.rlike(r"\A\d+\z")).cast("int")
    e = entries.where("page IS NOT NULL").withColumn("bands", indent_bands(F.collect_set("x0").over(own)))
    e = e.withColumn("share", F.avg(has).over(own))
    use = F.lit(mode == "numbered") | (F.lit(mode == "auto") & (F.col("share") >= threshold))
    level = F.when(use, numbered_level(F.col("title"))).otherwise(band_level(F.col("bands"), F.col("x0")))
    n = e.join(offsets.select("source_slug", "page_offset"), "source_slug", "left").join(pages.select("source_slug", "page_count"), "source_slug")
    start = F.least(F.greatest(F.col("page") + F.coalesce("page_offset", F.lit(0)), F.lit(1)), F.col("page_count"))
    order = F.row_number().over(own.orderBy("ord")) - 1
    rest = X.strip(F.substring(X.strip(F.col("title")), F.length(prefix) + 1, F.length("title")))
    title = F.when(use & (has == 1) & (rest != ""), rest).otherwise(F.col("title"))
    return n.select("source_slug", order.alias("ord"), level.alias("level"), title.alias("title"), start.alias("start_page"))
