"""From raw pages to sections: the fixed order of rules, the guard, the outline, the slices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import geometry, guards, lines, sections, tables, toc
from ..sources.documents import scanned_documents
from .lineage import checkpoint

#: Options and their defaults.
DEFAULTS: dict[str, object] = {
    "split_depth": 0, "pad_width": 2, "slug_max_len": 60, "tier": "clean", "boilerplate_patterns": (), "strip_page_numbers": True,
    "reformat_stat_blocks": False, "reformat_equipment_lists": False, "promote_header_below_separator": False, "collapse_table_headers": False,
    "split_am_traits": False, "merge_wrapped_table_rows": False, "merge_wrapped_name_rows": False, "guard_table_data": True, "fix_heading_spaces": False,
    "min_text_chars": 200, "toc_title_pattern": toc.TOC_TITLE, "toc_hierarchy_mode": "auto", "reconstruct_index": False, "index_title_pattern": r"^\s*index\s*$",
}


@dataclass(frozen=True)
class Extracted:
    """Normalised ``pages``, the table ``drift`` of the structural rules, which must be empty, ``chars(source_slug, chars)`` of the raw
    texts, and what was ``observed`` while the pages were written: ``pages``, ``chars``, ``drifted``."""

    pages: DataFrame
    drift: DataFrame
    chars: DataFrame
    observed: Mapping[str, int]


def normalize_pages(pages: DataFrame, options: Mapping[str, object] = {}, page_counts: DataFrame | Column | None = None, heading_maps: DataFrame | None = None) -> Extracted:
    """``pages(source_slug, page, text)`` with their texts normalised, and the guard's findings.

    Order: control characters, image sentinels, furniture, heading words, stat profiles, equipment, then the table rules between
    two snapshots that the guard compares. The ``structural`` tier stops after the image sentinels. Rules that are off are not
    in the plan. ``page_counts`` is a table, or a column of ``pages``, which needs no join. Texts, the guard's findings and the numbers of characters are written by one job, which also observes their
    sums: the findings are read again only where there are some.
    """
    cfg = DEFAULTS | dict(options)
    text = F.col("text")
    out = pages.withColumn("__chars", F.length(F.coalesce(text, F.lit("")))).withColumn("text", X.image_sentinels(X.clean_block(F.coalesce(text, F.lit("")))))
    findings = F.array().cast(guards._NONE)
    if cfg["tier"] != "structural":
        count = F.lit(None).cast("int")
        if isinstance(page_counts, Column):
            count = page_counts
        elif page_counts is not None:
            out, count = out.join(page_counts.select("source_slug", F.col("page_count").alias("__n")), "source_slug", "left"), F.col("__n")
        out = out.withColumn("text", lines.normalize_body(text, list(cfg["boilerplate_patterns"]), bool(cfg["strip_page_numbers"]), count)).drop("__n")
        if cfg["fix_heading_spaces"] and heading_maps is not None:
            spaced = F.when(F.col("mapping").isNull(), text).otherwise(lines.spaced_headings(text, F.col("mapping")))
            out = out.join(heading_maps, "source_slug", "left").withColumn("text", spaced).drop("mapping")
        if cfg["reformat_stat_blocks"]:
            out = out.withColumn("text", lines.tabulate_profiles(text))
        if cfg["reformat_equipment_lists"]:
            out = out.withColumn("text", lines.tabulate_equipment(text))
        chosen = [
            (tables.promote_header, "promote_header_below_separator"), (tables.promote_label_row, ""), (tables.collapse_headers, "collapse_table_headers"),
            (tables.split_fused, "split_am_traits"), (tables.merge_wrapped_rows, "merge_wrapped_table_rows"), (tables.merge_wrapped_names, "merge_wrapped_name_rows"),
        ]
        rules = [rule for rule, option in chosen if not option or cfg[option]]
        out = tables.repair_tables(out.withColumn("__before", text), "text", rules)
        if cfg["guard_table_data"]:
            findings = guards.table_findings(F.col("__before"), text, order=False)
    seen = Observation()
    whole = out.withColumn("__found", findings).drop("__before")
    sums = [F.count(F.lit(1)).alias("pages"), F.sum("__chars").alias("chars"), F.sum(F.size("__found")).alias("drifted")]
    done = checkpoint(whole.observe(seen, *sums))
    observed = {k: v or 0 for k, v in seen.get.items()}
    keyed = done.select("source_slug", "page", F.explode_outer("__found").alias("t")).where("t IS NOT NULL")
    drift = keyed.select(F.concat_ws("#", "source_slug", F.col("page").cast("string")).alias("key"), "t.table_no", "t.token", "t.delta")
    if not observed["drifted"]:
        drift = done.sparkSession.createDataFrame([], drift.schema)
    chars = done.groupBy("source_slug").agg(F.sum("__chars").alias("chars"))
    return Extracted(done.drop("__chars", "__found"), drift, chars, observed)


def sectionize(pages: DataFrame, entries: DataFrame, page_counts: DataFrame, options: Mapping[str, object] = {}) -> DataFrame:
    """The section table with texts and images: outline clamped and numbered, pages sliced along it."""
    cfg = DEFAULTS | dict(options)
    tree = checkpoint(toc.build_sections(toc.clamp_depth(entries, int(cfg["split_depth"])), page_counts, int(cfg["pad_width"]), int(cfg["slug_max_len"])))
    return tree.join(sections.section_text(tree, pages), ["source_slug", "ord"], "left").withColumn("kind", F.lit("text"))


def printed_outline(pages: DataFrame, fragments: DataFrame, page_counts: DataFrame, options: Mapping[str, object] = {}, pinned: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Outline out of printed tables of contents (their pages, rows, entries, page offset, levels), and ``(source_slug, warning)``."""
    cfg = DEFAULTS | dict(options)
    at = checkpoint(toc.locate_toc_pages(pages, str(cfg["toc_title_pattern"]), pinned=pinned))
    on = geometry.row_numbers(fragments.where(X.strip(F.col("text")) != "").join(at, ["source_slug", "page"]))
    parts = F.sort_array(F.collect_list(F.struct("x0", "frag_ord", "text")))
    rows = on.groupBy("source_slug", F.col("page").alias("page_no"), F.col("row").alias("row_no")).agg(parts.alias("f"))
    rows = rows.select("source_slug", "page_no", "row_no", X.strip_leaders(F.array_join("f.text", " ")).alias("text"), F.element_at("f.x0", 1).alias("x0"), F.element_at("f.x0", -1).alias("x1"))
    title = F.regexp_replace(F.col("text"), r"\A#{1,6}\s+", "")
    entries = checkpoint(toc.parse_printed_rows(rows.where(~title.rlike(rf"(?i)\A(?:{cfg['toc_title_pattern']})"))))
    headings = pages.join(at, ["source_slug", "page"], "left_anti").select("source_slug", "page", F.explode(toc.heading_titles(F.coalesce("text", F.lit("")))).alias("title"))
    offsets = checkpoint(toc.page_offset(entries, headings))
    outline = checkpoint(toc.printed_toc(entries, offsets, page_counts, str(cfg["toc_hierarchy_mode"])))
    where = at.groupBy("source_slug").agg(F.array_join(F.sort_array(F.collect_list("page")), ", ").alias("at"))
    read = outline.groupBy("source_slug").agg(F.count(F.lit(1)).alias("n")).join(where, "source_slug")
    inferred = F.concat(F.lit("no embedded outline: "), F.col("n"), F.lit(" entries are read from printed contents on page "), F.col("at"), F.lit(", inferred, to be verified"))
    return outline, read.select("source_slug", inferred.alias("warning")).unionByName(toc.offset_warnings(entries, offsets).join(read, "source_slug", "left_semi"))


def reconstruct_indexes(tree: DataFrame, fragments: DataFrame, pattern: str) -> DataFrame:
    """``(source_slug, ord, markdown)`` of the leaves whose title's beginning matches; null where their pages have no index layout."""
    plain = X.strip(F.regexp_replace("title", r"[\x00-\x1f]+", ""))
    found = tree.where(F.col("is_leaf") & plain.rlike(rf"(?i)\A(?:{pattern})")).select("source_slug", "ord", "start_page", "end_page", plain.alias("title"))
    key = F.concat_ws("#", F.col("ord").cast("string"), "source_slug")
    on = found.select("source_slug", "ord", F.explode(F.sequence("start_page", "end_page")).alias("page"))
    frags = fragments.join(on, ["source_slug", "page"]).withColumn("source_slug", key).drop("ord")
    rebuilt = geometry.rebuild_index(frags, found.select(key.alias("source_slug"), "title")).select(F.col("source_slug").alias("key"), "markdown")
    return found.withColumn("key", key).join(rebuilt, "key", "left").select("source_slug", "ord", "markdown")


@dataclass(frozen=True)
class Extraction:
    """``sections`` with texts and kinds, normalised ``pages``, ``outlines(source_slug, toc_source)``, ``warnings(source_slug,
    warning)``, and documents that were ``rejected(source_slug, reason)``, which have no sections."""

    sections: DataFrame
    pages: DataFrame
    outlines: DataFrame
    warnings: DataFrame
    rejected: DataFrame


# Names of outline sources, best first.
TOC_SOURCES = ("embedded", "toc-page", "headings", "pages")


def extract(
    pages: DataFrame, page_counts: DataFrame, embedded: DataFrame | None = None, fragments: DataFrame | None = None, options: Mapping[str, object] = {},
    fallback: str | None = None, ignore_toc: bool = False, toc_page: int | None = None, heading_maps: DataFrame | None = None, warned: Sequence[str] = (),
) -> Extraction:
    """Pages of many documents into sections.

    The embedded outline is used wherever there is one, unless ``ignore_toc``; other documents get that of ``fallback``
    (``toc``, ``headings`` or ``pages``), with a warning that it was inferred. Rejected are documents with table drift, with too little
    text, without an outline, and all that share a slug, whose pages can't be told apart (``documents.distinct_slugs`` parts
    them). ``reconstruct_index`` rebuilds index sections out of ``fragments``. ``warned`` are warnings of the page parser (see
    ``documents.passthrough``), given to each document.
    """
    cfg = DEFAULTS | dict(options)
    each = checkpoint(page_counts.groupBy("source_slug").agg(F.max("page_count").alias("page_count"), F.count(F.lit(1)).alias("n")))
    counts, twice = each.where("n = 1").select("source_slug", "page_count"), each.where("n > 1").select("source_slug")
    pages = pages.join(twice, "source_slug", "left_anti")
    done = normalize_pages(pages, options, counts, heading_maps)
    text = checkpoint(done.pages)
    shape = ["source_slug", F.col("ord").cast("int").alias("ord"), F.col("level").cast("int").alias("level"), "title", F.col("start_page").cast("int").alias("start_page")]
    candidates, bare, inferred = [], text, None
    if embedded is not None and not ignore_toc:
        embedded = embedded.join(counts.select("source_slug"), "source_slug", "left_semi")
        candidates.append((0, embedded.withColumn("title", X.clean_inline(F.col("title")))))
        bare = text.join(embedded.select("source_slug").distinct(), "source_slug", "left_anti")
    if fallback == "toc":
        if fragments is None:
            raise ValueError("the fallback to a printed table of contents needs fragments")
        printed, inferred = printed_outline(bare, fragments, counts, options, toc_page)
        candidates.append((1, printed))
    elif fallback == "headings":
        found = checkpoint(toc.toc_from_headings(bare))
        candidates.append((2, found))
        said = F.concat(F.lit("no embedded outline: the structure is inferred from "), F.count(F.lit(1)), F.lit(" headings, to be verified"))
        inferred = found.groupBy("source_slug").agg(said.alias("warning"))
    elif fallback == "pages":
        candidates.append((3, toc.page_entries(counts)))
    entries = reduce(DataFrame.unionByName, [t.select(*shape, F.lit(p).alias("priority")) for p, t in candidates]) if candidates else pages.sparkSession.createDataFrame([], "source_slug string, ord int, level int, title string, start_page int, priority int")
    chosen = checkpoint(toc.choose_source(entries))
    names = F.array(*[F.lit(n) for n in TOC_SOURCES])
    outlines = chosen.groupBy("source_slug").agg(F.element_at(names, F.min("priority") + 1).alias("toc_source"))
    reason = lambda rows, why: rows.select("source_slug", F.lit(why).alias("reason"))
    drifted = done.drift.select(F.regexp_replace("key", r"#[0-9]*\z", "").alias("source_slug")).distinct()
    rejected = reason(counts.join(outlines, "source_slug", "left_anti"), "no outline").unionByName(reason(drifted, "table data changed"))
    rejected = rejected.unionByName(reason(twice, "several documents have this slug"))
    rejected = checkpoint(rejected.unionByName(reason(scanned_documents(done.chars, outlines, int(cfg["min_text_chars"])), "too little text")))
    tree = sectionize(text, chosen.join(rejected, "source_slug", "left_anti").drop("priority"), counts, options)
    shared = sections.shared_pages(tree).select("source_slug", F.concat(F.lit("page "), F.col("page"), F.lit(" is shared by sections "), F.col("owner"), F.lit(" and "), F.col("toc_number")).alias("warning"))
    poor = toc.looks_degenerate(chosen.where("priority = 0")).where("degenerate").select("source_slug", F.lit("the embedded outline looks degenerate").alias("warning"))
    warnings = shared.unionByName(poor)
    if inferred is not None:
        warnings = warnings.unionByName(inferred.join(outlines, "source_slug", "left_semi"))
    if warned:
        warnings = warnings.unionByName(outlines.select("source_slug", F.explode(F.array(*[F.lit(w) for w in warned])).alias("warning")))
    if cfg["reconstruct_index"] and cfg["tier"] != "structural":
        if fragments is None:
            raise ValueError("rebuilding indexes needs fragments")
        tree = checkpoint(tree)
        built = checkpoint(reconstruct_indexes(tree, fragments, str(cfg["index_title_pattern"])))
        good = built.where("markdown IS NOT NULL").select("source_slug", "ord", F.col("markdown").alias("rebuilt"))
        tree = tree.join(good, ["source_slug", "ord"], "left")
        is_index = F.col("rebuilt").isNotNull()
        tree = tree.withColumn("kind", F.when(is_index, "index").otherwise("text")).withColumn("assets", F.when(~is_index, F.col("assets"))).withColumn("markdown", F.coalesce("rebuilt", "markdown")).drop("rebuilt")
        poor = built.where("markdown IS NULL").join(tree, ["source_slug", "ord"], "left_semi")
        none = tree.select("source_slug").distinct().join(built, "source_slug", "left_anti")
        warnings = warnings.unionByName(poor.select("source_slug", F.concat(F.lit("section "), F.col("ord"), F.lit(" has no index layout")).alias("warning")))
        warnings = warnings.unionByName(none.select("source_slug", F.lit("no leaf's title matches the index title").alias("warning")))
    return Extraction(tree, text, outlines, warnings.distinct(), rejected)


def manifests(done: Extraction, documents: DataFrame, options: Mapping[str, object] = {}, tooling: Mapping[str, str] = {}, staging: str | None = None) -> DataFrame:
    """One manifest for each extracted document, in the shape of ``documents.MANIFEST``.

    ``documents`` are those of ``documents.read_documents``; ``tooling`` names what the pages were parsed with. Sections stand in
    order, warnings once and sorted. A document without warnings or sections has empty lists.
    """
    cfg = DEFAULTS | dict(options)
    value = lambda v: F.array(*[F.lit(x) for x in v]).cast("array<string>") if isinstance(v, tuple | list) else F.lit(v)
    source = F.struct(
        F.col("path").alias("file_path"), "file_name", "title", "author", "source_slug", F.col("page_count").cast("int").alias("page_count"), "sha256",
        F.current_date().alias("extracted_at"), F.lit(staging).cast("string").alias("assets_staging_dir"),
    )
    own = documents.join(done.rejected.select("source_slug"), "source_slug", "left_anti").select("source_slug", source.alias("source"))
    columns = [c for c in done.sections.columns if c not in ("source_slug", "ord")]
    listed = done.sections.groupBy("source_slug").agg(F.sort_array(F.collect_list(F.struct("ord", F.struct(*columns).alias("s")))).alias("a"))
    said = done.warnings.groupBy("source_slug").agg(F.sort_array(F.collect_set("warning")).alias("warnings"))
    rows = own.join(done.outlines, "source_slug").join(listed, "source_slug", "left").join(said, "source_slug", "left")
    return rows.select(
        "source_slug", F.lit(1).alias("schema_version"), "source", F.struct(*[F.lit(v).alias(k) for k, v in tooling.items()] or [F.lit(None).cast("string").alias("parser")]).alias("tooling"),
        F.struct(*[value(v).alias(k) for k, v in cfg.items()]).alias("config"), F.lit(True).alias("toc_present"), "toc_source",
        F.col("a.s").alias("sections"), F.coalesce("warnings", F.array().cast("array<string>")).alias("warnings"),
    )
