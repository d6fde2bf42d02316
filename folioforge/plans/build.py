"""From sections to a vault: guarded writes, assets, library index, sort specs, orphans and the record; and changes to a vault."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import sections as R
from ..operators import vault as V
from ..sources import documents as S
from ..sources import vault_files as files
from ..sources import vault_sink as sink
from .lineage import checkpoint


class VaultConflict(ValueError):
    """A build would overwrite notes that it did not generate."""


@dataclass(frozen=True)
class Built:
    """What a build did: ``written(path)``, ``removed(path)``, and records ``moved(source_slug, vault)`` of other vaults."""

    written: DataFrame
    removed: DataFrame
    moved: DataFrame


def build_vault(
    spark: SparkSession, sections: DataFrame, sources: DataFrame, vault: str, record: str, staged: DataFrame | None = None, owner: str = V.OWNER,
    layout: str = "nested", index_link: str = "auto", sort_specs: bool = True,
) -> Built:
    """Write all notes of ``sections`` and ``sources`` (see ``operators.sections.build_notes``) into a vault; other books in it stay.

    Conflicts are looked for before the first write: a planned path that is there, was not recorded by the last build of its source and
    is not marked as generated raises :class:`VaultConflict`. Notes, staged assets (``staged(source_slug, ref, uri)``) that
    sections use, the library index (its managed region only) and sort specs that are not there yet are then staged and committed
    together, with what goes: paths recorded for these sources that this build does not write, and folders that this empties. The
    record is kept for each source, and rows of other sources are not touched (see ``sources.vault_sink`` for crashes).

    Overviews link to the library index from the root of the larger vault that the library stands in, if it does; ``index_link``
    ``root`` links to a plain ``index``.
    """
    sink.recover(spark, vault)
    inside = files.enclosing(spark, vault)
    slugs = sources.select("source_slug").distinct()
    prior = checkpoint(files.read_record(spark, record).join(slugs, "source_slug", "left_semi"))
    target = "index" if index_link == "root" or not inside else f"{inside}/index"
    planned = checkpoint(R.build_notes(sections, sources, owner, layout, target).select("source_slug", "path", "text", F.lit(None).cast("string").alias("uri")))
    there = checkpoint(files.read_notes(spark, vault))
    present = V.parse_notes(there.join(planned.select("path"), "path", "left_semi"))
    conflicts = V.write_conflicts(planned, present, prior, owner).limit(20).collect()
    if conflicts:
        raise VaultConflict("not generated, move or delete first: " + ", ".join(sorted(r.path for r in conflicts)))
    if staged is not None:
        used = V.referenced_assets(sections, staged)
        to = staged.join(used, ["source_slug", "ref"])
        path = F.concat(X.asset_dir(F.col("source_slug")), F.lit("/"), F.col("ref"))
        planned = planned.unionByName(to.select("source_slug", path.alias("path"), F.lit(None).cast("string").alias("text"), "uri"))
    books = sources.select("source_slug", F.col("source_title").alias("title"))
    index = V.update_library_index(there.where(F.col("path") == V.INDEX), books)
    extra = index.select(F.lit(V.INDEX).alias("path"), "text")
    if sort_specs:
        library = spark.range(1).select(F.lit("sortspec.md").alias("path"), S.sort_spec(S.sort_target(F.lit(inside))).alias("text"))
        extra = extra.unionByName(S.missing_specs(_book_specs(slugs, inside).unionByName(library), there))
    change = sink.stage(spark, planned.select("path", "text", "uri").unionByName(extra.withColumn("uri", F.lit(None).cast("string"))), vault)
    done = sink.staged_paths(spark, change).select("path").distinct()
    written = checkpoint(planned.select("source_slug", "path").distinct().join(done, "path", "left_semi"))
    removed = checkpoint(V.orphans(prior, written))
    sink.commit(spark, change, removed, written.withColumn("vault", F.lit(change.root)), record)
    return Built(written.select("path"), removed, S.moved_vaults(prior, change.root))


def remove_books(spark: SparkSession, books: DataFrame, vault: str, record: str) -> DataFrame:
    """Take ``books(source_slug)`` out of a vault: their recorded files, their entries in the library index and their rows of the record.

    Sort specs go where they are as they were written. Notes that were never recorded stay. Returns ``(path)`` of what went.
    """
    sink.recover(spark, vault)
    slugs = checkpoint(books.select("source_slug").distinct())
    prior = files.read_record(spark, record).join(slugs, "source_slug", "left_semi")
    there = checkpoint(files.read_notes(spark, vault))
    specs = there.join(_book_specs(slugs, files.enclosing(spark, vault)), ["path", "text"], "left_semi").select("path")
    removed = checkpoint(prior.select("path").unionByName(specs).distinct())
    index = there.where(F.col("path") == V.INDEX)
    left = V.update_library_index(index, slugs.limit(0).withColumn("title", F.lit("")), slugs).select(F.lit(V.INDEX).alias("path"), "text")
    change = sink.stage(spark, left.join(index.select("path"), "path", "left_semi"), vault)
    nothing = slugs.select("source_slug", F.lit(change.root).alias("vault"), F.lit(None).cast("string").alias("path"))
    sink.commit(spark, change, removed, nothing, record)
    return removed


def _book_specs(slugs: DataFrame, inside: str) -> DataFrame:
    return slugs.select(F.concat("source_slug", F.lit("/sortspec.md")).alias("path"), S.sort_spec(S.sort_target(F.lit(inside), F.col("source_slug"))).alias("text"))


def enrich_vault(spark: SparkSession, updates: DataFrame, vault: str, owner: str = V.OWNER) -> DataFrame:
    """Write enriched notes over the old ones, all or none; ``(path, outcome)`` of every update."""
    sink.recover(spark, vault)
    done = checkpoint(V.enrich(V.parse_notes(V.scan(files.read_notes(spark, vault))), updates, owner))
    sink.commit(spark, sink.stage(spark, done.where("outcome = 'applied'").select("path", "text"), vault))
    return done.select("path", "outcome")


def repair_vault(spark: SparkSession, proposals: DataFrame, vault: str, owner: str = V.OWNER) -> DataFrame:
    """Write accepted repairs over the old notes, all or none; the findings against the others, as of ``operators.vault.repair``."""
    sink.recover(spark, vault)
    accepted, rejected = V.repair(checkpoint(V.parse_notes(V.scan(files.read_notes(spark, vault)))), proposals, owner)
    accepted, rejected = checkpoint(accepted), checkpoint(rejected)
    sink.commit(spark, sink.stage(spark, accepted, vault))
    return rejected


def clean_vault(spark: SparkSession, vault: str, patterns: Sequence[str], apply: bool = False, report: str | None = None, backup: str | None = None) -> DataFrame:
    """Cut boilerplate out of the notes of a vault; ``(path)`` of the notes that change.

    A dry run unless ``apply``. ``report`` names a folder for the unified diffs (JSON lines), ``backup`` one for the originals.
    """
    if not patterns:
        raise ValueError("no patterns to cut out")
    sink.recover(spark, vault)
    changed = checkpoint(V.clean_notes(V.scan(files.read_notes(spark, vault)), patterns))
    if report:
        V.cleaning_report(changed).write.mode("overwrite").json(report)
    if apply and backup:
        sink.commit(spark, sink.stage(spark, changed.select("path", F.col("old").alias("text")), backup))
    if apply:
        sink.commit(spark, sink.stage(spark, changed.select("path", "text"), vault))
    return changed.select("path")
