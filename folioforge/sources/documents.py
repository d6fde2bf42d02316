"""Sources and sinks of the document engine: manifests, pattern files, options, generated records, sort specs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X

#: ``tooling`` and ``config`` are JSON texts, whatever keys a manifest has.
MANIFEST = (
    "schema_version int, source struct<file_path:string,file_name:string,title:string,author:string,source_slug:string,page_count:int,sha256:string,"
    "extracted_at:date,assets_staging_dir:string>, tooling string, config string, toc_present boolean, toc_source string, sections array<struct<toc_number:string,parent_number:string,level:int,title:string,"
    "display_title:string,slug:string,is_leaf:boolean,start_page:int,end_page:int,markdown:string,assets:array<struct<ref:string,page:int,kind:string>>,"
    "kind:string>>, warnings array<string>"
)


def read_binary(spark: SparkSession, path: str) -> DataFrame:
    """Files with their content hash: ``(path, length, sha256, content)``. Any store that Spark reads."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"), "content")


def read_pages(spark: SparkSession, path: str, parse, schema: str = "source_slug string, page int, text string") -> DataFrame:
    """Pages of binary documents by a plug-in: ``parse(path, content)`` yields one tuple per page.

    No PDF library is part of this package; bring one in ``parse``. Files are read and parsed on the executors.
    """

    def run(frames):
        import pandas as pd

        names = [c.split()[0] for c in schema.split(", ")]
        for frame in frames:
            yield pd.DataFrame([row for f in frame.itertuples() for row in parse(f.path, f.content)], columns=names)

    return read_binary(spark, path).select("path", "content").mapInPandas(run, schema)


DOCUMENT = (
    "path string, file_name string, sha256 string, title string, author string, page_count int, toc array<struct<level:int,title:string,start_page:int>>,"
    "pages array<string>, fragments array<struct<page:int,text:string,x0:double,x1:double,y0:double,y1:double,size:double,flags:int>>"
)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, length, modified)`` of the files below a folder; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def parse_files(files: DataFrame, parse) -> DataFrame:
    """Files by a plug-in, one row each in the shape of :data:`DOCUMENT`, without slugs.

    ``files`` holds ``path`` and either ``sha256`` and ``content``, or ``known``: then executors open each file themselves, and one whose content
    hash is the known one comes back without being parsed (null ``pages``). ``parse(path, content)`` gives a dictionary with
    ``title``, ``author``, ``toc`` (tuples of level, title, page), ``pages`` (texts) and ``fragments`` (tuples in the order of the field), each of
    which may lack.
    """

    def run(frames):
        from hashlib import sha256

        import pandas as pd

        from .vault_files import _store

        fields = [f.split()[0] for f in ("path", "file_name", "sha256", "title", "author", "page_count", "toc", "pages", "fragments")]
        for frame in frames:
            rows = []
            for f in frame.itertuples():
                if hasattr(f, "content"):
                    sha, content = f.sha256, f.content
                else:
                    store, at = _store(f.path)
                    with store.open_input_stream(at) as data:
                        content = data.read()
                    sha = sha256(content).hexdigest()
                    if sha == f.known:
                        rows.append((f.path, f.path.rpartition("/")[2], sha, *[None] * 6))
                        continue
                d = parse(f.path, content)
                pages = list(d.get("pages", ()))
                toc = [dict(zip(("level", "title", "start_page"), e)) for e in d.get("toc", ())]
                frags = [dict(zip(("page", "text", "x0", "x1", "y0", "y1", "size", "flags"), e)) for e in d.get("fragments", ())]
                rows.append((f.path, f.path.rpartition("/")[2], sha, d.get("title"), (d.get("author") or "").strip(), len(pages), toc, pages, frags))
            yield pd.DataFrame(rows, columns=fields, dtype=object)

    return files.mapInPandas(run, DOCUMENT)


def with_slugs(documents: DataFrame) -> DataFrame:
    """Parsed files with their title, the cleaned one of the document or else its file's name without the ending, and ``source_slug``."""
    from ..functions import unicode as U

    own, stem = X.clean_inline(F.coalesce("title", F.lit(""))), F.regexp_replace("file_name", r"\.[^.]*\z", "")
    return documents.withColumn("title", F.when(own != "", own).otherwise(stem)).withColumn("source_slug", U.slugify(F.col("title")))


def read_documents(spark: SparkSession, path: str, parse) -> DataFrame:
    """Binary documents by a plug-in (see :func:`parse_files`), one row each in the shape of :data:`DOCUMENT` and their ``source_slug``."""
    return with_slugs(parse_files(read_binary(spark, path).select("path", "sha256", "content"), parse))


def document_pages(documents: DataFrame) -> DataFrame:
    """``(source_slug, page, text)``, pages from 1."""
    return documents.select("source_slug", F.posexplode("pages").alias("p", "text")).select("source_slug", (F.col("p") + 1).alias("page"), "text")


def document_outlines(documents: DataFrame) -> DataFrame:
    """``(source_slug, ord, level, title, start_page)`` of the embedded outlines."""
    return documents.select("source_slug", F.posexplode("toc").alias("ord", "e")).select("source_slug", "ord", "e.*")


def document_fragments(documents: DataFrame) -> DataFrame:
    """``(source_slug, page, frag_ord, text, x0, x1, y, size, bold)``."""
    from ..operators.geometry import fragments

    return fragments(documents.select("source_slug", F.posexplode("fragments").alias("frag_ord", "f")).select("source_slug", "frag_ord", "f.*"))


def read_options(spark: SparkSession, path: str, defaults: Mapping[str, object]) -> dict:
    """Options of a JSON file over their defaults; unknown ones are left out, and so is a file that is not there."""
    import json

    from .vault_files import exists

    if not exists(spark, path):
        return dict(defaults)
    text = spark.read.text(path, wholetext=True).head()
    given = json.loads(text[0]) if text else {}
    return dict(defaults) | {k: tuple(v) if isinstance(v, list) else v for k, v in given.items() if k in defaults}


def passthrough(options: Mapping[str, object], defaults: Mapping[str, object], supported: Iterable[str], takes_any: bool = False) -> tuple[dict, list[str]]:
    """Options that a page parser takes, and warnings for changed ones that it doesn't."""
    known = set(supported)
    taken = {k: options[k] for k in defaults if takes_any or k in known}
    return taken, [f"option '{k}' is not supported and is ignored: {options[k]!r}" for k in defaults if k not in taken and options[k] != defaults[k]]


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Manifest files, one row each."""
    return spark.read.schema(MANIFEST).option("multiLine", "true").json(path)


def manifest_sections(manifests: DataFrame) -> DataFrame:
    """The section table of manifests; titles and texts cleaned again, ``ord`` by position."""
    each = manifests.select("source.source_slug", F.posexplode("sections").alias("ord", "s")).select("source_slug", "ord", "s.*")
    cleaned = {c: X.clean_inline(F.col(c)) for c in ("title", "display_title")} | {"markdown": X.clean_block(F.col("markdown"))}
    return each.withColumns(cleaned)


def write_manifests(manifests: DataFrame, path: str) -> None:
    """One JSON line per document (see ``plans.extract.manifests``), in a folder of its own; those of other documents stay."""
    manifests.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_slug").json(path)


def distinct_slugs(documents: DataFrame, taken: DataFrame | None = None) -> DataFrame:
    """``documents(path, source_slug, ...)`` with slugs of their own: of equal ones all but the first by path get a part of their path's hash.

    A slug that ``taken(path, source_slug)`` holds stays with its path, so documents that are there already keep their names.
    Only paths and slugs are shuffled; the few that change come back by a join on the path.
    """
    own = F.concat_ws("-", "source_slug", F.substring(F.sha2("path", 256), 1, 8))
    asked = documents.select("path", "source_slug", F.lit(1).alias("late"))
    if taken is not None:
        held = taken.join(asked.select("path"), "path", "left_anti").select("path", "source_slug", F.lit(0).alias("late"))
        asked = asked.unionByName(held)
    nth = F.row_number().over(W.partitionBy("source_slug").orderBy("late", "path"))
    changed = asked.withColumn("n", nth).where("n > 1 AND late = 1").select("path", own.alias("__slug"))
    return documents.join(changed, "path", "left").withColumn("source_slug", F.coalesce("__slug", "source_slug")).drop("__slug").select(documents.columns)


def read_patterns(spark: SparkSession, path: str) -> list[str]:
    """Regular expressions of a pattern file, one a line; blank lines and ``#`` lines don't count. A file of options, read to the driver."""
    lines = spark.read.text(path).select(X.strip(F.col("value")).alias("p"))
    return [r.p for r in pattern_lines(lines).collect()]


def pattern_lines(lines: DataFrame) -> DataFrame:
    return lines.where((F.col("p") != "") & ~F.startswith("p", F.lit("#")))


def with_config(sources: DataFrame, overrides: DataFrame, config: Mapping[str, object]) -> DataFrame:
    """Each document with its options: its override, else the configured value."""
    named = overrides.select("source_slug", *[F.col(k).alias(f"__{k}") for k in config if k in overrides.columns])
    joined = sources.join(named, "source_slug", "left")
    for key, value in config.items():
        own = F.col(f"__{key}") if key in overrides.columns else F.lit(None)
        joined = joined.withColumn(key, F.coalesce(own, F.lit(value))).drop(f"__{key}")
    return joined


def scanned_documents(pages: DataFrame, toc_sources: DataFrame, least: int = 200) -> DataFrame:
    """Documents with too little text before any rule ran: ``(source_slug, chars)``; those sliced by page don't count.

    ``pages`` holds ``text``, or ``chars`` that were counted before.
    """
    n = F.col("chars") if "chars" in pages.columns else F.length(F.coalesce("text", F.lit("")))
    chars = pages.groupBy("source_slug").agg(F.sum(n).alias("chars"))
    return chars.join(toc_sources.where("toc_source <> 'pages'").select("source_slug"), "source_slug", "left_semi").where(F.col("chars") < least)


def moved_vaults(records: DataFrame, vault: str) -> DataFrame:
    """Generated records of another vault: ``(source_slug, vault)``; their paths are not cleaned up here."""
    return records.where(F.col("vault") != vault).select("source_slug", "vault").distinct()


def vault_root(paths: DataFrame, roots: DataFrame) -> DataFrame:
    """``(path, root, relative)``: the nearest enclosing root of each path; ancestors are its prefixes, matched by an equi-join."""
    parts = F.split("path", "/", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    hit = paths.select("path", F.explode(above).alias("root")).join(roots.select("root").distinct(), "root")
    best = hit.groupBy("path").agg(F.max_by("root", F.length("root")).alias("root"))
    rest = F.substring(F.col("path"), F.length("root") + 2, F.length("path"))
    return paths.join(best, "path", "left").select("path", "root", F.when(F.col("root").isNotNull(), rest).alias("relative"))


def index_link(relative: Column) -> Column:
    """Link to the library index from inside a larger vault; plain where there is none or the library is its root."""
    return F.when(F.coalesce(relative, F.lit("")) == "", F.lit("index")).otherwise(F.concat(relative, F.lit("/index")))


def sort_target(relative: Column, slug: Column | None = None) -> Column:
    """Folder pattern of a sort spec: the library's children, or everything below one book."""
    base = F.when(F.coalesce(relative, F.lit("")) == "", F.lit("")).otherwise(relative)
    return F.concat(base, F.lit("/*")) if slug is None else F.concat(base, F.lit("/"), slug, F.lit("/**"))


def sort_spec(target: Column) -> Column:
    """Text of a sort-spec note."""
    return F.concat(F.lit(SORT_HEAD), target, F.lit(SORT_TAIL))


# The format that the sorting plug-in reads.
SORT_HEAD, SORT_TAIL = "---\nsorting-spec: |-\n  target-folder: ", (
    "\n  order-asc: a-z\n---\n\nInterleaves files and folders in Obsidian's File Explorer so notes appear in reading order (by their numeric prefixes) "
    "instead of Obsidian's default folders-before-files.\n\nRequires the community plugin \"Custom File Explorer sorting\" (obsidian-custom-sort). "
    "View-only: nothing on disk changes.\n"
)


def missing_specs(planned: DataFrame, present: DataFrame) -> DataFrame:
    """Sort specs to create: those whose path is not there yet; existing ones belong to the user."""
    return planned.join(present.select("path"), "path", "left_anti")
