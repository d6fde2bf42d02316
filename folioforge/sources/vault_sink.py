"""A sink for vaults: files are staged by tasks, a journal commits them together, and publishing can be taken up again.

A change to a vault goes through three states, each of which a crash may end:

1. *Staging.* The data source writer's tasks write files below ``.commit/<id>/files`` and hand on the name of their own list of
   files. The vault is as it was; without a journal, what was staged is deleted by the next change.
2. *Committed.* What to remove and what to record is written beside the files, then the journal is moved into its place. From now on
   the change counts.
3. *Published.* Tasks move staged files into place and remove what goes, folders that this empties go level by level, the record
   gets its rows, and the journal goes last. Every step may be repeated: the next change, or :func:`recover`, finishes it.

Folders that begin with a dot are no part of a vault. One change at a time may be made to a vault.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .vault_files import RECORD, _each, _store, address, exists, prune_folders, remove_files

FOLDER, JOURNAL = ".commit", ".commit/journal.json"
STAGED = "path string, text string, uri string"
PARTS = "path string, staged string"


@dataclass
class StagedPart(WriterCommitMessage):
    """What a task has staged: the name of its list, and how many files are in it."""

    name: str
    files: int


class VaultWriter(DataSourceWriter):
    """Stages rows ``(path, text, uri)``: the text, or the file at ``uri``; rows whose file isn't there are left out."""

    def __init__(self, root: str, change: str) -> None:
        self.root, self.change = root, change

    def write(self, iterator: Iterator[Row]) -> StagedPart:
        # Every attempt of a task has a name of its own, so an attempt that fails or comes late leaves nothing that counts.
        store, top = _store(self.root)
        name, listed = uuid.uuid4().hex, []
        base = f"{top}/{FOLDER}/{self.change}"
        for row in iterator:
            staged = f"{base}/files/{name}/{len(listed)}"
            if not listed:
                store.create_dir(f"{base}/files/{name}", recursive=True)
            if row["uri"] is None:
                with store.open_output_stream(staged) as out:
                    out.write((row["text"] or "").encode())
            else:
                source, at = _store(row["uri"])
                if not source.get_file_info(at).is_file:
                    continue
                with source.open_input_stream(at) as data, store.open_output_stream(staged) as out:
                    while chunk := data.read(1 << 20):
                        out.write(chunk)
            listed.append({"path": row["path"], "staged": f"{name}/{len(listed)}"})
        store.create_dir(f"{base}/parts", recursive=True)
        with store.open_output_stream(f"{base}/parts/{name}.json") as out:
            out.write("".join(json.dumps(x) + "\n" for x in listed).encode())
        return StagedPart(name, len(listed))

    def commit(self, messages: list[StagedPart | None]) -> None:
        """The names of the tasks' lists, not their files, come to the driver."""
        store, top = _store(self.root)
        with store.open_output_stream(f"{top}/{FOLDER}/{self.change}/staged.json") as out:
            out.write(json.dumps([m.name for m in messages if m]).encode())

    def abort(self, messages: list[StagedPart | None]) -> None:
        _discard(self.root, self.change)


class VaultSink(DataSource):
    """``df.write.format("vault")`` with the options ``root`` (an address) and ``change``."""

    @classmethod
    def name(cls) -> str:
        return "vault"

    def schema(self) -> str:
        return STAGED

    def writer(self, schema: StructType, overwrite: bool) -> VaultWriter:
        return VaultWriter(self.options["root"], self.options["change"])


def _discard(root: str, change: str) -> None:
    from pyarrow import fs

    store, top = _store(root)
    if store.get_file_info(f"{top}/{FOLDER}/{change}").type == fs.FileType.Directory:
        store.delete_dir(f"{top}/{FOLDER}/{change}")


@dataclass(frozen=True)
class Change:
    """A staged change: the vault's address, its own id, and the lists of what was staged."""

    root: str
    id: str
    parts: list[str]

    @property
    def folder(self) -> str:
        return f"{self.root}/{FOLDER}/{self.id}"


def stage(spark: SparkSession, files: DataFrame, vault: str) -> Change:
    """Stage ``files(path, text[, uri])`` for the vault; it stays as it is. An unfinished change before is finished first."""
    recover(spark, vault)
    spark.dataSource.register(VaultSink)
    root, change = address(spark, vault), uuid.uuid4().hex
    rows = files if "uri" in files.columns else files.withColumn("uri", F.lit(None).cast("string"))
    rows.select(*[F.col(c).cast("string") for c in ("path", "text", "uri")]).write.format("vault").option("root", root).option("change", change).mode("append").save()
    store, top = _store(root)
    with store.open_input_stream(f"{top}/{FOLDER}/{change}/staged.json") as data:
        return Change(root, change, json.loads(data.read()))


def staged_paths(spark: SparkSession, change: Change) -> DataFrame:
    """``(path, staged)`` of what was staged."""
    lists = [f"{change.folder}/parts/{p}.json" for p in change.parts]
    return spark.read.schema(PARTS).json(lists) if lists else spark.createDataFrame([], PARTS)


def commit(spark: SparkSession, change: Change, removed: DataFrame | None = None, recorded: DataFrame | None = None, record: str | None = None) -> None:
    """Commit a staged change and publish it.

    ``removed(path)`` go from the vault; ``recorded(source_slug, vault, path)`` take the place of the record's rows of the same
    sources. Until the journal is in its place the vault and the record are as they were; afterwards the change is finished, now or
    by the next one.
    """
    seal(spark, change, removed, recorded, record)
    publish(spark, change.root)


def seal(spark: SparkSession, change: Change, removed: DataFrame | None = None, recorded: DataFrame | None = None, record: str | None = None) -> None:
    """The commit alone: all that publishing needs is written, and the journal with one move."""
    if removed is not None:
        removed.select("path").write.parquet(f"{change.folder}/removed")
    if recorded is not None:
        recorded.select("source_slug", "vault", "path").write.parquet(f"{change.folder}/recorded")
    store, top = _store(change.root)
    journal = {"id": change.id, "parts": change.parts, "removed": removed is not None, "record": record if recorded is not None else None}
    with store.open_output_stream(f"{top}/{FOLDER}/{change.id}/journal.json") as out:
        out.write(json.dumps(journal).encode())
    store.move(f"{top}/{FOLDER}/{change.id}/journal.json", f"{top}/{JOURNAL}")


def recover(spark: SparkSession, vault: str) -> bool:
    """Finish a committed change that was not published whole, and delete what others have staged; whether there was one."""
    from pyarrow import fs

    if not exists(spark, f"{vault}/{FOLDER}"):
        return False
    root = address(spark, vault)
    found = publish(spark, root)
    store, top = _store(root)
    for left in store.get_file_info(fs.FileSelector(f"{top}/{FOLDER}", allow_not_found=True)):
        if left.type == fs.FileType.Directory:
            store.delete_dir(left.path)
    return found


def move_files(moves: DataFrame, root: str, change: str) -> DataFrame:
    """Move staged files of ``moves(path, staged)`` into place; those that are gone have been moved before."""

    def act(frame: pd.DataFrame) -> list[str]:
        store, top = _store(root)
        for path, staged in zip(frame["path"], frame["staged"]):
            at = f"{top}/{FOLDER}/{change}/files/{staged}"
            if store.get_file_info(at).is_file:
                store.create_dir(f"{top}/{path}".rpartition("/")[0], recursive=True)
                store.move(at, f"{top}/{path}")
        return list(frame["path"])

    return _each(moves.select("path", "staged"), act)


def publish(spark: SparkSession, root: str) -> bool:
    """Carry out the journal of a committed change, if there is one."""
    store, top = _store(root)
    if not store.get_file_info(f"{top}/{JOURNAL}").is_file:
        return False
    with store.open_input_stream(f"{top}/{JOURNAL}") as data:
        journal = json.loads(data.read())
    change = Change(root, journal["id"], journal["parts"])
    _run(move_files(staged_paths(spark, change), root, change.id))
    if journal["removed"]:
        gone = spark.read.schema("path string").parquet(f"{change.folder}/removed")
        _run(remove_files(spark, gone, root))
        prune_folders(spark, gone, root)
    if journal["record"]:
        rows = spark.read.schema(f"source_slug string, {RECORD}").parquet(f"{change.folder}/recorded")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_slug").parquet(journal["record"])
    store.delete_file(f"{top}/{JOURNAL}")
    _discard(root, change.id)
    return True


def _run(work: DataFrame) -> None:
    work.write.format("noop").mode("overwrite").save()
