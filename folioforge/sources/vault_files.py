"""Vaults as folders of files: reading notes, writing, copying and removing files, and the record of generated paths.

Files are written by the executors through the store that the vault's address names (a folder that all of them share, HDFS
or an object store). Every action gives the same files when a lost task is run again. Vaults themselves are written by
``vault_sink``, which makes a change's files count together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.lineage import checkpoint

#: Columns of the record below a folder for each source. A source that is gone has one row without a path.
RECORD = "vault string, path string"


def address(spark: SparkSession, folder: str) -> str:
    """The folder with its store's scheme, without a slash at the end."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def enclosing(spark: SparkSession, vault: str, mark: str = ".obsidian") -> str:
    """The vault's path below the nearest folder at or above it that holds ``mark``; empty if that is the vault, or there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    at, below = path(address(spark, vault)), []
    while at is not None:
        if exists(spark, path(at, mark).toString()):
            return "/".join(reversed(below))
        below.append(at.getName())
        at = at.getParent()
    return ""


def _store(uri: str):
    """The file system of an address, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def read_notes(spark: SparkSession, vault: str) -> DataFrame:
    """``(path, text)`` of the Markdown files below the vault, paths relative to it; no rows if there is no such folder."""
    if not exists(spark, vault):
        return spark.createDataFrame([], "path string, text string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").load(vault)
    return files.select(F.substring("path", len(address(spark, vault)) + 2, 1 << 30).alias("path"), F.col("content").cast("string").alias("text"))


def _each(paths: DataFrame, act: Callable[[pd.DataFrame], list[str]]) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"path": act(frame)}, dtype=object)

    return paths.mapInPandas(run, "path string")


def write_files(spark: SparkSession, files: DataFrame, vault: str) -> DataFrame:
    """Write ``files(path, text)`` below the vault, over what is there; ``(path)`` of the written ones. Runs when it is read."""
    root = address(spark, vault)

    def act(frame: pd.DataFrame) -> list[str]:
        store, top = _store(root)
        for path, text in zip(frame["path"], frame["text"]):
            store.create_dir(f"{top}/{path}".rpartition("/")[0], recursive=True)
            with store.open_output_stream(f"{top}/{path}") as out:
                out.write((text or "").encode())
        return list(frame["path"])

    return _each(files.select("path", "text"), act)


def remove_files(spark: SparkSession, paths: DataFrame, vault: str) -> DataFrame:
    """Remove ``paths(path)`` below the vault; ``(path)`` of those that are gone now."""
    root = address(spark, vault)

    def act(frame: pd.DataFrame) -> list[str]:
        store, top = _store(root)
        for path in frame["path"]:
            if store.get_file_info(f"{top}/{path}").is_file:
                store.delete_file(f"{top}/{path}")
        return list(frame["path"])

    return _each(paths.select("path"), act)


def remove_folders(spark: SparkSession, paths: DataFrame, top_folder: str) -> None:
    """Remove the folders ``paths(path)`` below a folder with all that is in them, by the executors."""
    if not exists(spark, top_folder):
        return
    root = address(spark, top_folder)

    def act(frame: pd.DataFrame) -> list[str]:
        from pyarrow import fs

        store, top = _store(root)
        for path in frame["path"]:
            if store.get_file_info(f"{top}/{path}").type == fs.FileType.Directory:
                store.delete_dir(f"{top}/{path}")
        return list(frame["path"])

    _each(paths.select("path"), act).write.format("noop").mode("overwrite").save()


def folders_above(paths: DataFrame) -> DataFrame:
    """``(folder, depth)``: all folders that ``paths(path)`` stand in, each once."""
    parts = F.split("path", "/", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    inside = paths.where(F.contains("path", F.lit("/"))).select(F.explode(above).alias("folder")).where("folder <> ''").distinct()
    return inside.select("folder", F.size(F.split("folder", "/", -1)).alias("depth"))


def prune_folders(spark: SparkSession, removed: DataFrame, vault: str) -> None:
    """Remove folders of ``removed(path)`` that are empty now, and folders that this empties; never the vault.

    From the deepest level up, a job for each level: its folders are looked at and removed by the executors, so the driver sees
    the number of levels only.
    """
    root = address(spark, vault)
    folders = checkpoint(folders_above(removed))

    def act(frame: pd.DataFrame) -> list[str]:
        from pyarrow import fs

        store, top = _store(root)
        for path in frame["path"]:
            if store.get_file_info(f"{top}/{path}").type == fs.FileType.Directory and not store.get_file_info(fs.FileSelector(f"{top}/{path}")):
                store.delete_dir(f"{top}/{path}")
        return list(frame["path"])

    for depth in range(folders.agg(F.max("depth")).head()[0] or 0, 0, -1):
        _each(folders.where(F.col("depth") == depth).select(F.col("folder").alias("path")), act).write.format("noop").mode("overwrite").save()


def read_record(spark: SparkSession, record: str) -> DataFrame:
    """``(source_slug, vault, path)``: what the last build of each source generated; no rows before the first."""
    schema = f"{RECORD}, source_slug string"
    rows = spark.read.schema(schema).parquet(record) if exists(spark, record) else spark.createDataFrame([], schema)
    return rows.select("source_slug", "vault", "path").where("path IS NOT NULL")
