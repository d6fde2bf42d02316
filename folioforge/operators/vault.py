"""Vaults of notes: parsing, integrity gates, guarded writes, enrichment, repair and cleaning."""

from __future__ import annotations

from collections.abc import Sequence
from difflib import unified_diff

import pandas as pd
import yaml
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from . import guards, tables
from . import sections as S
from .lines import is_code, is_hash_line, lines_of, normalize_body, segments
from .patterns import first_match

INDEX = "index.md"
#: The default mark of generated notes; pass the mark of an existing vault where it has another.
OWNER = "engine"
# Folders without notes; keys that generated notes need.
IGNORED = ("_templates", ".obsidian", ".trash", ".git")
REQUIRED = ("title", "source", "source_pages", "toc_level", "toc_number", "tags", "created", "generated_by")
AUTO_START, AUTO_END = "<!-- auto-start -->", "<!-- auto-end -->"


def is_note_path(path: Column, ignored: Sequence[str] = IGNORED) -> Column:
    """A Markdown file below no ignored folder and no folder that begins with a dot."""
    folders = F.slice(F.split(path, "/", -1), F.lit(1), F.size(F.split(path, "/", -1)) - 1)
    return F.endswith(path, F.lit(".md")) & ~F.exists(folders, lambda d: d.isin(*ignored) | F.startswith(d, F.lit(".")))


def scan(files: DataFrame) -> DataFrame:
    """The notes of ``files(path, ...)``."""
    return files.where(is_note_path(F.col("path")))


def split_note(text: Column) -> Column:
    """``struct<head, body>``: the frontmatter with its lines, byte for byte, and the rest; an unclosed one is no head."""
    n = X.frontmatter_end(text)
    return F.struct(F.substring(text, F.lit(1), n).alias("head"), F.substring(text, n + 1, F.length(text)).alias("body"))


_META = (
    "struct<ok:boolean,keys:array<string>,title:string,source:string,source_pages:array<int>,pages_ok:boolean,boundary:string,toc_level:int,toc_number:string,"
    "parent:string,prev:string,next:string,tags:array<string>,tags_ok:boolean,summary:string,summary_ok:boolean,created:string,generated_by:string>"
)

#: The C parser where the YAML library has it.
_LOADER = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
_FIELDS = [f.split(":")[0] for f in _META[7:-1].split(",")]


def _parsed(text: str | None) -> dict:
    lines = (text or "").split("\n")
    close = next((i for i, x in enumerate(lines) if i and x.strip() == "---"), 0) if lines[0].strip() == "---" else 0
    try:
        meta = yaml.load("\n".join(lines[1:close]), _LOADER) if close else None
    except yaml.YAMLError:
        meta = None
    if not isinstance(meta, dict) or not meta:
        return dict.fromkeys(_FIELDS) | {"ok": False, "keys": [], "pages_ok": False, "tags_ok": False, "summary_ok": True}
    pages, tags = meta.get("source_pages"), meta.get("tags")
    pages_ok = isinstance(pages, list) and len(pages) == 2 and all(isinstance(x, int) for x in pages)
    word = lambda k: None if meta.get(k) is None else str(meta[k])
    return {
        "ok": True, "keys": [str(k) for k in meta], "source_pages": pages if pages_ok else None, "pages_ok": pages_ok,
        "toc_level": meta.get("toc_level") if isinstance(meta.get("toc_level"), int) else None,
        "tags": [str(t) for t in tags] if isinstance(tags, list) else None, "tags_ok": isinstance(tags, list) and "pdf-import" in tags,
        "summary_ok": "summary" not in meta or isinstance(meta["summary"], str),
    } | {k: word(k) for k in ("title", "source", "boundary", "toc_number", "parent", "prev", "next", "summary", "created", "generated_by")}


def parse_notes(files: DataFrame) -> DataFrame:
    """``(path, text, meta, body)``: frontmatter read as YAML, once for all gates. Not-parsed ones have ``meta.ok`` false."""

    @F.pandas_udf(_META)
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = [_parsed(t) for t in texts]
        return pd.DataFrame({f: pd.Series([r[f] for r in rows], dtype=object) for f in _FIELDS})

    return files.select("path", "text", run("text").alias("meta"), split_note(F.col("text"))["body"].alias("body"))


def _failure(rows: DataFrame, gate: str, detail: Column | str) -> DataFrame:
    return rows.select(F.lit(gate).alias("gate"), "path", (F.lit(detail) if isinstance(detail, str) else detail).alias("detail"))


def check_frontmatter(notes: DataFrame, owner: str = OWNER) -> DataFrame:
    """Unreadable frontmatter of any note but the index; missing keys and wrong shapes of generated ones."""
    m = F.col("meta")
    owned = m["ok"] & F.coalesce(m["generated_by"] == owner, F.lit(False))
    missing = F.transform(F.array_except(F.array(*[F.lit(k) for k in REQUIRED]), m["keys"]), lambda k: F.concat(F.lit("missing key "), k))
    shape = F.filter(
        F.array(
            F.when(~m["pages_ok"], "source_pages must be two integers"),
            F.when(~m["tags_ok"], "tags must be a list with pdf-import"),
            F.when(~m["summary_ok"], "summary must be a string"),
        ),
        lambda x: x.isNotNull(),
    )
    wrong = F.when(~m["ok"], F.array(F.lit("missing or unparseable frontmatter"))).when(owned, F.concat(missing, shape))
    rows = notes.where(F.col("path") != INDEX).select("path", F.explode(wrong).alias("detail"))
    return _failure(rows, "frontmatter", F.col("detail"))


def check_filenames(notes: DataFrame, owner: str = OWNER) -> DataFrame:
    stem, folder = F.regexp_extract("path", r"([^/]*)\.md\z", 1), F.regexp_extract("path", r"([^/]*)/[^/]*\z", 1)
    good = ((stem == folder) | stem.rlike(r"\A\d{2,}(\.\d{2,})*-[a-z0-9][a-z0-9-]*\z")) & stem.rlike(r"\A[a-z0-9][a-z0-9.\-]*\z")
    owned = F.coalesce(F.col("meta.generated_by") == owner, F.lit(False))
    return _failure(notes.where((F.col("path") != INDEX) & owned & ~good), "filenames", "does not match the naming contract")


def note_links(notes: DataFrame) -> DataFrame:
    """``(path, pos, target, alias)``: all links, without their anchors."""
    return notes.select("path", F.posexplode(X.links(F.col("text"))).alias("pos", "l")).select("path", "pos", F.substring_index("l.target", "#", 1).alias("target"), F.col("l.alias").alias("alias"))


def check_links(notes: DataFrame) -> DataFrame:
    """Bare, alias-less and unresolved links, and links to a missing index. Resolution is one left join on paths."""
    links = note_links(notes)
    known = notes.select(F.col("path").alias("to")).distinct()
    index = X.is_index_target(F.col("target"))
    to = F.when(index, F.lit(INDEX)).otherwise(F.concat("target", F.lit(".md")))
    seen = links.withColumn("want", to).join(known, F.col("want") == F.col("to"), "left")
    quoted = F.concat(F.lit(" '"), F.col("target"), F.lit("'"))
    bare = X.is_bare(F.col("target"))
    wrong = F.filter(
        F.array(
            F.when(index & F.col("to").isNull(), F.lit("links to missing library index")),
            F.when(~index & bare, F.concat(F.lit("bare wikilink"), quoted)),
            F.when(~index & ~bare & (F.col("alias") == ""), F.concat(F.lit("no alias"), quoted)),
            F.when(~index & ~bare & F.col("to").isNull(), F.concat(F.lit("unresolved"), quoted)),
        ),
        lambda x: x.isNotNull(),
    )
    return _failure(seen.select("path", F.explode(wrong).alias("detail")), "links", F.col("detail"))


def normalized_path(folder: Column, ref: Column) -> Column:
    """``folder/ref`` without ``.`` and ``..`` parts."""
    parts = F.filter(F.split(F.concat_ws("/", F.when(folder != "", folder), ref), "/", -1), lambda p: ~p.isin("", "."))
    start = F.array().cast("array<string>")
    up = lambda a: (F.size(a) > 0) & F.coalesce(F.try_element_at(a, F.lit(-1)) != "..", F.lit(False))
    walked = F.aggregate(parts, start, lambda a, p: F.when((p == "..") & up(a), F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.concat(a, F.array(p))))
    return F.array_join(walked, "/")


def check_assets(notes: DataFrame, files: DataFrame) -> DataFrame:
    """Image references that are transient or to no file of ``files(path)``."""
    refs = notes.select("path", F.explode(F.regexp_extract_all("text", F.lit(r"!\[[^\]]*\]\(([^)]+)\)"), F.lit(1))).alias("ref"))
    transient = F.col("ref").rlike(r"\A(?:https?://|ASSET:)")
    folder = F.regexp_replace("path", r"/?[^/]*\z", "")
    seen = refs.withColumn("want", normalized_path(folder, F.col("ref"))).join(files.select(F.col("path").alias("to")).distinct(), F.col("want") == F.col("to"), "left")
    quoted = F.concat(F.lit(" '"), F.col("ref"), F.lit("'"))
    wrong = F.when(transient, F.concat(F.lit("transient image"), quoted)).when(F.col("to").isNull(), F.concat(F.lit("missing asset"), quoted))
    return _failure(seen.withColumn("w", wrong).where("w IS NOT NULL"), "assets", F.col("w"))


def jumps(edges: DataFrame, n: int, checkpoint) -> DataFrame:
    """``(path, to)``: for each node of ``edges(path, to)`` a node 1, 2, 4, ... links further along one way out of it.

    The way follows the next neighbour in the order of paths, or the first one. Pointer doubling makes the table in
    log2(n) joins, and it holds n log2(n) rows at most; every jump leads to a node that links reach.
    """
    ahead = F.coalesce(F.min(F.when(F.col("to") > F.col("path"), F.col("to"))), F.min("to"))
    step = checkpoint(edges.where("path <> to").groupBy("path").agg(ahead.alias("to")))
    every = step
    for _ in range(max(n - 1, 1).bit_length() - 1):
        step = checkpoint(step.join(step.select(F.col("path").alias("to"), F.col("to").alias("further")), "to").select("path", F.col("further").alias("to")).where("path <> to"))
        if step.isEmpty():
            break
        every = every.unionByName(step)
    return every


def reachable(notes: DataFrame, checkpoint, patience: int = 2, counted: list | None = None) -> DataFrame:
    """``(path)`` of the notes that links reach from the index; a breadth-first frontier join until nothing is new.

    ``checkpoint`` cuts lineage (see ``plans.lineage``). After ``patience`` rounds with something new, :func:`jumps` join the links, so a long chain
    takes as many rounds as its length has binary digits, not one for each note. ``counted`` gets the size of each round's frontier.
    """
    links = note_links(notes)
    to = F.when(X.is_index_target(F.col("target")), F.lit(INDEX)).otherwise(F.concat("target", F.lit(".md")))
    edges = checkpoint(links.select("path", to.alias("to")).distinct().join(notes.select(F.col("path").alias("to")).distinct(), "to").select("path", "to"))
    frontier = checkpoint(notes.where(F.col("path") == INDEX).select("path").distinct())
    seen, rounds = frontier, 0
    while new := frontier.count():
        if counted is not None:
            counted.append(new)
        if rounds == patience:
            edges = checkpoint(edges.unionByName(jumps(edges, edges.select("path").distinct().count(), checkpoint)).distinct())
        # Each round writes its own notes only; what was seen is a union of the rounds' files.
        frontier = checkpoint(frontier.join(edges, "path").select(F.col("to").alias("path")).distinct().join(seen, "path", "left_anti"))
        seen = seen.unionByName(frontier)
        rounds += 1
    return seen


def check_reachability(notes: DataFrame, checkpoint, owner: str = OWNER) -> DataFrame:
    owned = notes.where((F.col("path") == INDEX) | F.coalesce(F.col("meta.generated_by") == owner, F.lit(False)))
    lost = _failure(owned.join(reachable(notes, checkpoint), "path", "left_anti"), "reachability", "not reachable from the library index")
    index = notes.where(F.col("path") == INDEX).agg(F.count(F.lit(1)).alias("n"))
    none = _failure(index.where("n = 0").select(F.lit(INDEX).alias("path")), "reachability", "no library index")
    return lost.join(F.broadcast(index.where("n > 0")), how="left_semi").unionByName(none)


def check_tables(notes: DataFrame) -> DataFrame:
    """Tables whose rows, separators aside, differ in their number of cells."""
    rows = tables.table_rows(notes.where(F.col("path") != INDEX), "path", dashes=2).where("NOT is_sep")
    n = F.array_sort(F.collect_set(F.size("cells")))
    uneven = rows.groupBy("path", "table_no").agg(F.min("first_line").alias("line"), n.alias("n")).where("size(n) > 1")
    detail = F.concat(F.lit("columns "), F.array_join(F.col("n").cast("array<string>"), ", "), F.lit(" in the table at line "), F.col("line"))
    return _failure(uneven, "tables", detail)


def check_boilerplate(notes: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Notes in which a pattern is left: the first of the list that is found. Any number of patterns (see ``patterns.first_match``)."""
    found = first_match(notes.select("path", "text"), "text", patterns)
    return _failure(found.where("hit IS NOT NULL"), "boilerplate", F.concat(F.lit("survived: "), F.col("hit")))


def check_headings(notes: DataFrame) -> DataFrame:
    """``#`` lines outside fences that still hold spaced capitals."""
    parts = F.transform(segments(F.col("text")), lambda s: F.transform(lines_of(s), lambda x: F.struct(is_code(s).alias("code"), x.alias("line"))))
    lines = notes.select("path", F.posexplode(F.flatten(parts)).alias("n", "l")).where("NOT l.code").select("path", "n", "l.line")
    bad = lines.where(is_hash_line(F.col("line")) & (X.collapse_spaced_caps(F.col("line")) != F.col("line")))
    return _failure(bad, "heading_artifacts", F.concat(F.lit("spaced-out heading on line "), F.col("n") + 1))


GATES = ("frontmatter", "filenames", "links", "assets", "reachability", "tables", "boilerplate", "heading_artifacts")


def verify(notes: DataFrame, files: DataFrame, checkpoint, gates: Sequence[str] = GATES, patterns: Sequence[str] = (), owner: str = OWNER) -> DataFrame:
    """All failures ``(gate, path, detail)`` of the enabled gates; none means that the vault passes."""
    checks = {
        "frontmatter": lambda: check_frontmatter(notes, owner), "filenames": lambda: check_filenames(notes, owner), "links": lambda: check_links(notes),
        "assets": lambda: check_assets(notes, files), "reachability": lambda: check_reachability(notes, checkpoint, owner), "tables": lambda: check_tables(notes),
        "boilerplate": lambda: check_boilerplate(notes, patterns), "heading_artifacts": lambda: check_headings(notes),
    }
    found = notes.limit(0).select(F.lit("").alias("gate"), "path", F.lit("").alias("detail"))
    for gate in GATES:
        if gate in gates:
            found = found.unionByName(checks[gate]())
    return found


def write_conflicts(planned: DataFrame, present: DataFrame, prior: DataFrame, owner: str = OWNER) -> DataFrame:
    """Planned paths that would overwrite a user's note: there, not recorded before, and not marked as generated.

    ``present`` holds the vault's parsed notes, ``prior`` the paths recorded at the last build. Run before any write.
    """
    users = present.where(~F.coalesce(F.col("meta.generated_by") == owner, F.lit(False))).select("path")
    return planned.select("path").join(users, "path", "left_semi").join(prior.select("path"), "path", "left_anti")


def orphans(prior: DataFrame, planned: DataFrame) -> DataFrame:
    """``(path)`` recorded at the last build of a source that this one doesn't write.

    ``planned(source_slug, path)`` says which sources are built: recorded paths of other sources of ``prior(source_slug, path)`` are no
    orphans, nor are paths that any planned source writes.
    """
    built = prior.join(planned.select("source_slug").distinct(), "source_slug", "left_semi")
    return built.select("path").distinct().join(planned.select("path"), "path", "left_anti")


def next_record(prior: DataFrame, planned: DataFrame) -> DataFrame:
    """``(source_slug, path, state)`` of every path that is recorded or planned: ``written``, ``orphan``, or ``kept``.

    Kept are the paths of sources that this build leaves alone; the next record is all that is written or kept.
    """
    built = planned.select("source_slug").distinct().withColumn("built", F.lit(True))
    mine = planned.select("source_slug", "path").distinct().withColumn("now", F.lit(True))
    every = prior.select("source_slug", "path").distinct().join(mine, ["source_slug", "path"], "full").join(built, "source_slug", "left")
    state = F.when(F.col("now"), "written").when(F.col("built"), "orphan").otherwise("kept")
    return every.select("source_slug", "path", state.alias("state"))


def referenced_assets(sections: DataFrame, staged: DataFrame) -> DataFrame:
    """``(source_slug, ref)``: each image that sections use and that is staged."""
    return sections.select("source_slug", F.explode("assets.ref").alias("ref")).distinct().join(staged.select("source_slug", "ref"), ["source_slug", "ref"], "left_semi")


def managed_region(text: Column, start: str = AUTO_START, end: str = AUTO_END) -> Column:
    """The text between the markers, empty without both."""
    return F.regexp_extract(text, rf"(?s)\Q{start}\E(.*?)\Q{end}\E", 1)


def managed_block(entries: Column, start: str = AUTO_START, end: str = AUTO_END) -> Column:
    """List items of ``array<struct<target, alias>>`` by target, between the markers."""
    items = F.transform(F.array_sort(entries), lambda e: F.concat(F.lit("- "), X.wikilink(e["target"], e["alias"]), F.lit("\n")))
    return F.concat(F.lit(start + "\n"), F.array_join(items, ""), F.lit(end))


def upsert_region(text: Column, block: Column, start: str = AUTO_START, end: str = AUTO_END) -> Column:
    """The text with its first managed region replaced by ``block``, or with the block behind it."""
    pattern = rf"(?s)\A(.*?)\Q{start}\E.*?\Q{end}\E(.*)\z"
    base = F.regexp_replace(text, r"\n+\z", "")
    appended = F.concat(F.when(base != "", F.concat(base, F.lit("\n\n"))).otherwise(F.lit("")), block, F.lit("\n"))
    return F.when(text.rlike(pattern), F.concat(F.regexp_extract(text, pattern, 1), block, F.regexp_extract(text, pattern, 2))).otherwise(appended)


def update_library_index(index: DataFrame, books: DataFrame, gone: DataFrame | None = None) -> DataFrame:
    """``(text)``: the library index with one entry for each of ``books(source_slug, title)`` and none of ``gone(source_slug)``.

    ``index`` holds the old ``text`` (one row at most; without one a new index begins). Old entries whose first path part is
    one of the books go, whatever their form; others stay.
    """
    old = index.select("text").unionByName(index.sparkSession.range(1).select(F.lit("# Imported PDFs\n\n").alias("text"))).limit(1)
    kept = old.select(F.explode(X.links(managed_region(F.col("text")))).alias("e")).select("e.target", "e.alias")
    named = books.select(F.col("source_slug").alias("s"))
    named = named if gone is None else named.unionByName(gone.select(F.col("source_slug").alias("s")))
    kept = kept.join(named, F.substring_index("target", "/", 1) == F.col("s"), "left_anti")
    new = books.select(F.concat("source_slug", F.lit("/"), "source_slug").alias("target"), F.col("title").alias("alias"))
    entries = kept.unionByName(new).agg(F.collect_list(F.struct("target", "alias")).alias("e"))
    text = upsert_region(F.col("text"), managed_block(F.col("e")))
    return old.crossJoin(F.broadcast(entries)).select(F.concat(F.regexp_replace(text, r"\n+\z", ""), F.lit("\n")).alias("text"))


def rerender(meta: Column, body: Column, **changed: Column) -> Column:
    """A note out of its parsed frontmatter, with some values changed, and a body; keys come in their fixed order."""
    values = {k: meta[k] for k in S.FRONTMATTER_KEYS} | changed
    return S.render_note(values, F.regexp_replace(body, r"\A\n+", ""))


def enrich(notes: DataFrame, updates: DataFrame, owner: str = OWNER) -> DataFrame:
    """``(path, outcome, summary, tags, text)`` of each update of a note: applied, or why not.

    A summary is set unless there is one (or with ``force``); new tags go behind the old ones, each once. ``text`` is the
    note written anew with both, null where the update is not applied.
    """
    j = updates.join(notes.select("path", "meta", "body"), "path", "left")
    owned = F.coalesce(F.col("meta.generated_by") == owner, F.lit(False))
    has = F.coalesce(F.col("meta.summary"), F.lit("")) != ""
    skip = F.col("summary").isNotNull() & has & ~F.coalesce("force", F.lit(False))
    outcome = F.when(F.col("meta").isNull(), "no such note").when(~owned, "not generated").when(skip, "already enriched").otherwise("applied")
    old, new = F.coalesce("meta.tags", F.array().cast("array<string>")), F.filter(F.coalesce("add_tags", F.array().cast("array<string>")), lambda t: t != "")
    done = outcome == "applied"
    summary, tags = F.coalesce(X.collapse_white(F.col("summary")), F.col("meta.summary")), F.concat(old, F.array_except(new, old))
    text = rerender(F.col("meta"), F.col("body"), summary=summary, tags=tags)
    return j.select("path", outcome.alias("outcome"), F.when(done, summary).alias("summary"), F.when(done, tags).alias("tags"), F.when(done, text).alias("text"))


#: Repairs that need no body: they only change how a table is laid out.
TRANSFORMS = {"demoted-label-row": tables.promote_label_row}


def repair(notes: DataFrame, proposals: DataFrame, owner: str = OWNER) -> tuple[DataFrame, DataFrame]:
    """Accepted ``(path, text)`` and rejected ``(path, kind, table_no, detail)`` repairs of generated notes.

    ``proposals(path, kind, new_body)`` may name one of :data:`TRANSFORMS` in a column ``transform``, which then makes the body; an unknown
    one is a finding. Equal proposals are one; of several that differ, all are rejected, since each would be written over the
    others. An accepted note is written anew, frontmatter keys in their order, with the proposed body.
    """
    transform = F.col("transform") if "transform" in proposals.columns else F.lit(None).cast("string")
    asked = proposals.select("path", "kind", "new_body", transform.alias("transform")).distinct().withColumn("n", F.count(F.lit(1)).over(W.partitionBy("path")))
    joined = asked.join(notes.select("path", "meta", "body"), "path", "left")
    owned = F.coalesce(F.col("meta.generated_by") == owner, F.lit(False))
    body = F.when(F.col("transform").isNull(), F.col("new_body"))
    for name, rule in TRANSFORMS.items():
        body = body.when(F.col("transform") == name, rule(F.col("body")))
    why = lambda kind, detail: F.struct(F.lit(kind).alias("kind"), detail.alias("detail"))
    unknown = ~F.coalesce(F.col("transform").isin(*TRANSFORMS), F.lit(True))
    reason = (
        F.when(~owned, why("ownership", F.lit("not a generated note")))
        .when(F.col("n") > 1, why("duplicate", F.lit("several proposals for one note")))
        .when(unknown, why("transform", F.concat(F.lit("unknown transform "), F.col("transform"))))
    )
    judged = joined.withColumn("reason", reason).withColumn("after", body)
    refused = judged.where("reason IS NOT NULL").select("path", "reason.kind", F.lit(None).cast("int").alias("table_no"), "reason.detail").distinct()
    mine = judged.where("reason IS NULL")
    drift = guards.repair_drift(mine.select("path", "kind", F.col("body").alias("before"), "after"), "path")
    accepted = mine.join(drift.select("path").distinct(), "path", "left_anti").select("path", rerender(F.col("meta"), F.coalesce("after", F.lit(""))).alias("text"))
    return accepted, drift.unionByName(refused)


def clean_notes(notes: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """``(path, old, text)`` of the notes that cleaning changes, the index aside: bodies without boilerplate, heads untouched."""
    parts = split_note(F.col("text"))
    body = normalize_body(parts["body"], patterns, strip_page_numbers=False)
    new = F.concat(F.regexp_replace(F.concat(parts["head"], body), r"\n+\z", ""), F.lit("\n"))
    return notes.where(F.col("path") != INDEX).select("path", F.col("text").alias("old"), new.alias("text")).where("text <> old")


_PICTURE = r"(?s)\*\*-+ *Start of picture text *-+\*\*(.*?)\*\*-+ *End of picture text *-+\*\*"


def cleaning_report(changed: DataFrame) -> DataFrame:
    """``(path, diff)`` of ``changed(path, old, text)``: the lines of a unified diff of each note."""

    @F.pandas_udf("array<string>")
    def diff(paths: pd.Series, old: pd.Series, new: pd.Series) -> pd.Series:
        return pd.Series([list(unified_diff(a.splitlines(), b.splitlines(), f"a/{p}", f"b/{p}", lineterm="")) for p, a, b in zip(paths, old, new)])

    return changed.select("path", diff("path", "old", "text").alias("diff"))


def picture_residue(notes: DataFrame, patterns: Sequence[str], hint: str = "This ebook belongs to") -> DataFrame:
    """``(path, residue)``: picture text that patterns and line breaks leave; the report shows 120 characters of each block."""
    inner = notes.select("path", F.explode(F.regexp_extract_all("text", F.lit(_PICTURE), F.lit(1))).alias("t"))
    cut = F.col("t")
    for p in patterns:
        cut = F.regexp_replace(cut, p, "")
    cut = X.breaks_as_spaces(cut)
    left = X.collapse_white(F.when(F.contains(cut, F.lit(hint)), F.lit("")).otherwise(cut))
    return inner.select("path", F.substring(left, 1, 120).alias("residue")).where("residue <> ''")
