"""Extraction of what has changed: files are known by their content, only changed documents are worked out, gone ones are retracted.

A store is a folder with ``state`` (a version for each refresh: which file, of which content, is which document), ``sections`` and
``warnings`` (a folder for each document). The state's new version is written last, so a refresh that crashes is repeated by the next one.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import documents as S
from ..sources import vault_files as files
from . import extract
from .lineage import checkpoint

STATE = "path string, length long, modified timestamp, sha256 string, title string, file_name string, page_count int, source_slug string"


@dataclass(frozen=True)
class Refreshed:
    """What a refresh did: ``changes(path, change, source_slug)`` with ``added``, ``changed``, ``removed`` or ``touched`` (same content), and the
    documents that were ``rejected(source_slug, reason)``. Paths without a row are as they were."""

    changes: DataFrame
    rejected: DataFrame


def versions(spark: SparkSession, store: str) -> list[int]:
    """Numbers of the whole versions of the state."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{store}/state")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    named = [s.getPath() for s in system.listStatus(folder)]
    return sorted(int(p.getName()) for p in named if p.getName().isdigit() and files.exists(spark, f"{p.toString()}/_SUCCESS"))


def read_state(spark: SparkSession, store: str) -> DataFrame:
    """The last whole version of the state; no rows before the first."""
    found = versions(spark, store)
    return spark.read.schema(STATE).parquet(f"{store}/state/{found[-1]}") if found else spark.createDataFrame([], STATE)


def changed_files(listed: DataFrame, state: DataFrame) -> DataFrame:
    """``(path, length, modified, change, known)`` of files that may have changed: ``added``, ``changed`` or ``removed``.

    Length and time are compared, both cheap to list; ``known`` is the content hash of the last time.
    """
    was = state.select("path", F.col("length").alias("l"), F.col("modified").alias("m"), F.col("sha256").alias("known"))
    both = listed.withColumn("here", F.lit(True)).join(was, "path", "full")
    change = F.when(F.col("here").isNull(), "removed").when(F.col("known").isNull(), "added").when((F.col("length") != F.col("l")) | (F.col("modified") != F.col("m")), "changed")
    return both.select("path", "length", "modified", change.alias("change"), "known").where("change IS NOT NULL")


def refresh(spark: SparkSession, inbox: str, parse, store: str, options: Mapping[str, object] = {}, fallback: str | None = None) -> Refreshed:
    """Bring the store to what a whole extraction of the inbox would give.

    Unchanged files are listed, not read; files with the content of before are read, not parsed. A document that another title
    or another content gives a new slug is retracted under the old one. Documents keep their slug when others of the same
    title come later (see ``documents.distinct_slugs``).
    """
    state = checkpoint(read_state(spark, store))
    changed = checkpoint(changed_files(S.list_files(spark, inbox), state))
    asked = changed.where("change <> 'removed'").select("path", "known")
    parsed = checkpoint(S.parse_files(asked, parse))
    fresh = S.with_slugs(parsed.where("pages IS NOT NULL"))
    gone = changed.where("change = 'removed'").select("path").unionByName(fresh.select("path"))
    stay = state.join(gone, "path", "left_anti")
    docs = checkpoint(S.distinct_slugs(fresh, stay.select("path", "source_slug")))

    done = extract.extract(
        S.document_pages(docs), docs.select("source_slug", "page_count"), S.document_outlines(docs), S.document_fragments(docs), options, fallback
    )
    sections, warned, rejected = checkpoint(done.sections), checkpoint(done.warnings), checkpoint(done.rejected)
    before = state.join(gone, "path", "left_semi").select("source_slug").distinct()
    written = sections.select("source_slug").distinct()
    for name, rows in (("sections", sections), ("warnings", warned)):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_slug").parquet(f"{store}/{name}")
        # What was there and is not written now: gone documents, old slugs, rejected ones.
        left = before.unionByName(rejected.select("source_slug")).distinct().join(rows.select("source_slug").distinct(), "source_slug", "left_anti")
        files.remove_folders(spark, left.select(F.concat(F.lit("source_slug="), "source_slug").alias("path")), f"{store}/{name}")

    same = parsed.where("pages IS NULL").select("path", F.lit(True).alias("touched"))
    now = changed.where("change <> 'removed'").join(same, "path", "left")
    own = docs.select("path", "sha256", "title", "file_name", "page_count", "source_slug")
    names = [c.split()[0] for c in STATE.split(", ")]
    new = now.where("touched IS NULL").select("path", "length", "modified").join(own, "path")
    touched = now.where("touched").select("path", "length", "modified").join(state.drop("length", "modified"), "path")
    rest = state.join(changed.select("path"), "path", "left_anti")
    number = (versions(spark, store) or [0])[-1] + 1
    rest.select(names).unionByName(new.select(names)).unionByName(touched.select(names)).write.mode("overwrite").parquet(f"{store}/state/{number}")
    slug = docs.select("path", "source_slug").unionByName(state.join(docs.select("path"), "path", "left_anti").select("path", "source_slug"))
    change = F.when(F.col("touched"), "touched").otherwise(F.col("change"))
    return Refreshed(checkpoint(changed.join(same, "path", "left").join(slug, "path", "left").select("path", change.alias("change"), "source_slug")), rejected)


def read_sections(spark: SparkSession, store: str) -> DataFrame:
    """The sections of all documents of a store."""
    return spark.read.option("basePath", f"{store}/sections").option("partitionColumnTypeInference.enabled", "false").parquet(f"{store}/sections")
