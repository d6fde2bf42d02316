"""Positioned text: rows, columns, sizes, and the rebuilding of a printed index."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import unicode as U


def keep_zero_area(x0: Column, y0: Column, x1: Column, y1: Column, cell: tuple[Column, Column, Column, Column], overlaps: Column) -> Column:
    """Whether a glyph belongs to a cell: one without area by its origin (one point of room), others by ``overlaps``."""
    inside = x0.between(cell[0] - 1, cell[2] + 1) & y0.between(cell[1] - 1, cell[3] + 1)
    return F.when((x1 <= x0) | (y1 <= y0), inside).otherwise(overlaps)


def fragments(spans: DataFrame) -> DataFrame:
    """Fragments out of spans ``(..., y0, y1, flags)``: mid-height with one decimal, half to even, bold by flag 16, blank ones dropped."""
    kept = spans.where(X.strip(F.col("text")) != "")
    return kept.withColumn("y", U.python_round((F.col("y0") + F.col("y1")) / 2, 1)).withColumn("bold", F.col("flags").bitwiseAND(16) != 0).drop("y0", "y1", "flags")


def row_numbers(frags: DataFrame, tolerance: float = 4.0) -> DataFrame:
    """Add ``row``, from 0 on each page: a fragment joins a row while within ``tolerance`` of the row's first fragment.

    The anchor makes this a walk along the page's fragments by (y, x0); only their heights go to Python, as one array for
    each page.
    """
    keys = ["source_slug", "page"]
    others = [c for c in frags.columns if c not in keys]
    item = F.struct(F.col("y").alias("__y"), F.col("x0").alias("__x"), F.col("frag_ord").alias("__o"), *others)
    page = frags.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("f"))

    @F.pandas_udf("array<int>")
    def rows_of(heights: pd.Series) -> pd.Series:
        def one(ys) -> list[int]:
            found, anchor, row = [], None, -1
            for y in ys:
                if anchor is None or y is None or not abs(y - anchor) <= tolerance:
                    anchor, row = y, row + 1
                found.append(row)
            return found

        return heights.map(one)

    z = page.select(*keys, F.explode(F.arrays_zip(F.col("f"), rows_of(F.transform("f", lambda f: f["__y"])).alias("r"))).alias("z"))
    return z.select(*keys, *[F.col(f"z.f.{c}").alias(c) for c in others], F.col("z.r").alias("row"))


def column_bands(frags: DataFrame, min_gutter: int = 12, min_width: int = 40) -> DataFrame:
    """Columns of text of each page: ``(source_slug, page, band, lo, hi)``.

    Whole points from int(x0) to int(x1) are covered; bands are unions of covered stretches that no gutter of
    ``min_gutter`` or more uncovered points parts, and must be wider than ``min_width``. Gaps and islands over a running
    maximum.
    """
    spans = frags.select("source_slug", "page", F.col("x0").cast("int").alias("a"), F.greatest(F.col("x1").cast("int"), F.col("x0").cast("int")).alias("b"))
    order = W.partitionBy("source_slug", "page").orderBy("a", "b")
    reach = F.max("b").over(order.rowsBetween(W.unboundedPreceding, -1))
    islands = spans.withColumn("new", (F.col("a") - reach > min_gutter).cast("int")).withColumn("island", F.coalesce(F.sum("new").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)), F.lit(0)))
    bands = islands.groupBy("source_slug", "page", "island").agg(F.min("a").alias("lo"), F.max("b").alias("hi")).where(f"hi - lo > {min_width}")
    band = F.row_number().over(W.partitionBy("source_slug", "page").orderBy("lo")) - 1
    return bands.select("source_slug", "page", band.alias("band"), "lo", "hi")


def column_template(bands: DataFrame) -> DataFrame:
    """The bands of each document's first page with the most bands: ``(source_slug, band, lo, hi)``."""
    n = bands.groupBy("source_slug", "page").agg(F.count(F.lit(1)).alias("n"))
    best = n.withColumn("r", F.row_number().over(W.partitionBy("source_slug").orderBy(F.desc("n"), "page"))).where("r = 1").select("source_slug", "page")
    return bands.join(best, ["source_slug", "page"]).select("source_slug", "band", "lo", "hi")


def column_cuts(template: DataFrame) -> DataFrame:
    """``(source_slug, cuts)``: the midpoints between neighbouring bands, ascending."""
    nxt = F.lead("lo").over(W.partitionBy("source_slug").orderBy("band"))
    mid = template.withColumn("cut", (F.col("hi") + nxt) / 2)
    return mid.groupBy("source_slug").agg(F.sort_array(F.collect_list("cut")).alias("cuts"))


def column_of(x0: Column, cuts: Column) -> Column:
    """Number of cuts at or left of ``x0``."""
    return F.size(F.filter(cuts, lambda c: x0 >= c))


def dominant_size(frags: DataFrame) -> DataFrame:
    """``(source_slug, size)``: the most frequent size to one decimal, ties to the one met first by (page, frag_ord)."""
    sized = frags.select("source_slug", U.python_round(F.col("size")).alias("size"), F.struct("page", "frag_ord").alias("at"))
    n = sized.groupBy("source_slug", "size").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    r = F.row_number().over(W.partitionBy("source_slug").orderBy(F.desc("n"), "first"))
    return n.withColumn("r", r).where("r = 1").select("source_slug", "size")


# Fixed value: a letter head of a printed index, with or without emphasis.
_LETTER = r"\A[*_]{0,2}([A-Z])[*_]{0,2}\z"


def rebuild_index(frags: DataFrame, titles: DataFrame | None = None, tolerance: float = 0.6, room: int = 5) -> DataFrame:
    """Printed index pages as Markdown: ``(source_slug, markdown)`` for documents with two columns or more.

    Body-sized fragments and single-letter heads within the columns are read column by column; a row's text keeps bold
    runs and loses leaders; a letter met first becomes a heading, other rows list items; the rows of the title go, which is
    that of ``titles(source_slug, title)`` or ``Index``.
    """
    filled = frags.where(X.strip(F.col("text")) != "")
    template = column_template(column_bands(filled))
    edges = template.groupBy("source_slug").agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("n >= 2").drop("n")
    cuts = column_cuts(template).join(edges, "source_slug")
    body = filled.join(cuts, "source_slug").join(dominant_size(filled).withColumnRenamed("size", "dom"), "source_slug")
    sized = F.abs(U.python_round(F.col("size")) - F.col("dom")) <= tolerance
    kept = body.where((sized | X.strip(F.col("text")).rlike(_LETTER)) & F.col("x0").between(F.col("lo") - room, F.col("hi") + room))
    columns = kept.withColumn("page", F.struct("page", column_of(F.col("x0"), F.col("cuts")).alias("col"))).select(*frags.columns)
    shown = F.when(F.col("bold"), F.concat(F.lit("**"), X.strip(F.col("text")), F.lit("**"))).otherwise(F.col("text"))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("x0", "frag_ord", shown.alias("w")))), lambda f: f["w"])
    rows = row_numbers(columns).groupBy("source_slug", "page", "row").agg(X.strip_leaders(F.array_join(parts, " ")).alias("t"))
    if titles is not None:
        rows = rows.join(titles.select("source_slug", F.lower(X.strip(F.col("title"))).alias("own")), "source_slug", "left")
        rows = rows.where(F.lower("t") != F.coalesce("own", F.lit(""))).drop("own")
    rows = rows.where((F.col("t") != "") & (F.upper("t") != "INDEX"))
    letter = F.regexp_extract("t", _LETTER, 1)
    first = F.row_number().over(W.partitionBy("source_slug", letter).orderBy("page", "row")) == 1
    line = F.when(letter == "", F.concat(F.lit("- "), F.col("t"), F.lit("\n"))).when(first, F.concat(F.lit("\n### "), letter, F.lit("\n\n")))
    items = rows.withColumn("line", line).where("line IS NOT NULL")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page", "row", "line"))), lambda x: x["line"]), "")
    gap = F.when(F.startswith(joined, F.lit("\n")), F.lit("")).otherwise(F.lit("\n"))
    text = F.concat(F.regexp_replace(F.concat(F.lit("## INDEX\n"), gap, joined), r"\n+\z", ""), F.lit("\n"))
    return items.groupBy("source_slug").agg(text.alias("markdown"))


def glued_words(glyphs: DataFrame, ratio: float = 0.08) -> DataFrame:
    """Words whose glyphs stand apart: ``(source_slug, page, line_no, word_no, glued, spaced)`` where they differ.

    ``glyphs`` holds ``(source_slug, page, line_no, pos, c, x0, x1, size)``. A gap wider than ``ratio`` times the size becomes
    a blank; white-space glyphs part words.
    """
    line = W.partitionBy("source_slug", "page", "line_no").orderBy("pos")
    white = F.col("c").rlike(r"(?U)\A\s*\z")
    numbered = glyphs.withColumn("white", white).withColumn("word_no", F.sum(white.cast("int")).over(line.rowsBetween(W.unboundedPreceding, W.currentRow))).where("NOT white")
    word = W.partitionBy("source_slug", "page", "line_no", "word_no").orderBy("pos")
    gap = F.col("x0") - F.lag("x1").over(word)
    marked = numbered.withColumn("piece", F.when(F.coalesce(gap > ratio * F.col("size"), F.lit(False)), F.concat(F.lit(" "), F.col("c"))).otherwise(F.col("c")))
    chars = F.sort_array(F.collect_list(F.struct("pos", "c", "piece")))
    words = marked.groupBy("source_slug", "page", "line_no", "word_no").agg(chars.alias("ch"))
    out = words.select("source_slug", "page", "line_no", "word_no", F.array_join("ch.c", "").alias("glued"), F.array_join("ch.piece", "").alias("spaced"))
    return out.where("glued <> spaced")


def heading_space_map(glyphs: DataFrame, ratio: float = 0.08, floor: float = 12.0, factor: float = 1.15) -> DataFrame:
    """``(source_slug, mapping)``: glued to spaced words of heading lines.

    A line's size is its largest; headings reach the larger of ``floor + 1`` and ``factor`` times the upper median of the
    document's line sizes. Later lines override earlier ones.
    """
    sizes = glyphs.groupBy("source_slug", "page", "line_no").agg(F.max("size").alias("s"))
    own = W.partitionBy("source_slug")
    ranked = sizes.withColumn("r", F.row_number().over(own.orderBy("s")) - 1).withColumn("n", F.count(F.lit(1)).over(own))
    middle = ranked.where("r = floor(n / 2)").select("source_slug", F.greatest(F.lit(floor + 1), F.col("s") * factor).alias("least"))
    heads = sizes.join(middle, "source_slug").where("s >= least").select("source_slug", "page", "line_no")
    words = glued_words(glyphs, ratio).join(heads, ["source_slug", "page", "line_no"])
    last = words.groupBy("source_slug", "glued").agg(F.max_by("spaced", F.struct("page", "line_no", "word_no")).alias("spaced"))
    return last.groupBy("source_slug").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("glued", "spaced")))).alias("mapping"))
