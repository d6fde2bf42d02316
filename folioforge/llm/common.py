"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import json
import os
import re
import tempfile
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the corpus tables below ``sf_dir``; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, its lineage cut.

    The folder is the session's ``spark.checkpoint.dir``. Only a session in one process (tests) may do without; on a
    cluster that is an error, since a folder of one machine would be lost with it.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(shared or os.path.join(tempfile.gettempdir(), "folioforge-checkpoints"))
    # What the frame was shuffled through is of no use once it is written. The setting counts when a plan is made.
    session, key = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = session.conf.get(key, None)
    session.conf.set(key, "true")
    try:
        return df.select("*").checkpoint(eager=True)
    finally:
        session.conf.unset(key) if was is None else session.conf.set(key, was)


#: Rows of a counted table that a task reads at most on the average, unless the cluster has more cores to read with.
TASK_ROWS = 50_000


def observed(df: DataFrame, **sums: Column) -> tuple[DataFrame, dict]:
    """:func:`checkpoint` of ``df``, its count ``n`` and other aggregates of its rows.

    They are made while the rows are written, so without a job of their own. As the count is known, the files are read back in
    as many tasks as the rows need, not in one for each, however small.
    """
    seen = Observation()
    written = checkpoint(df.observe(seen, F.count(F.lit(1)).alias("n"), *[of.alias(name) for name, of in sums.items()]))
    return written.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-seen.get["n"] // TASK_ROWS))), seen.get


def release(*frames: DataFrame) -> None:
    """Delete the files of frames that :func:`checkpoint` or :func:`observed` gave, so that they don't fill the shared folder until the job's end.

    Only for frames that nothing will read again: all that was made of them must be checkpointed itself, so that no lost
    executor leads back to them.
    """
    for df in frames:
        file = df._jdf.queryExecution().analyzed().collectLeaves().head().rdd().getCheckpointFile()
        if file.isDefined():
            context = df.sparkSession.sparkContext
            path = context._jvm.org.apache.hadoop.fs.Path(file.get())
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes and rows of the record batches that go to Python workers, where the session sets nothing else.
BATCH_BYTES, BATCH_ROWS = "8m", "2000"


def _bounded_batches(spark: SparkSession) -> None:
    """Long texts make large batches; a session that keeps Spark's default sizes gets smaller ones."""
    for key, value in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES), ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)):
        if spark.conf.get(key, None) in (None, "10000", "2147483647", "2147483647b"):
            spark.conf.set(key, value)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """A column name for each of ``names`` that ``df`` doesn't have, whatever its letter case."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def map_batches(
    df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], Iterator[dict[str, object]]]
) -> DataFrame:
    """``df.mapInArrow`` for a function that turns one record batch into column dictionaries (lists or Arrow arrays).

    Nulls of every column stay nulls, since no batch goes through pandas.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    _bounded_batches(df.sparkSession)
    struct = StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in fn(batch):
                arrays = [
                    c.cast(f.type) if isinstance(c := columns[f.name], (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
                    for f in arrow
                ]
                yield pa.RecordBatch.from_arrays(
                    [a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays], schema=arrow
                )

    return df.mapInArrow(run, struct)


def rewrite_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """``df`` with the rows that ``fn`` keeps or rewrites; every column, also unknown ones, stays as it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch)

    _bounded_batches(df.sparkSession)
    return df.mapInArrow(run, df.schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The column's texts, null as the empty text."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def literal_rows(spark: SparkSession, rows: Sequence[dict], schema: str) -> DataFrame:
    """A small table of driver-side rows as a plan literal: no RDD and no Python worker."""
    array = F.from_json(F.lit(json.dumps(list(rows))), f"array<struct<{schema}>>")
    return spark.range(1).select(F.explode(array).alias("r")).select("r.*")


def id_order(*columns: str | Column) -> Column:
    """A pseudo-random but repeatable order of rows: hexadecimal md5 of their identifying columns, null as ``-``."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("-")) for c in columns]
    return F.md5(F.concat_ws("#", *parts))


def ranked(df: DataFrame, key: str, order: str, ties: Sequence[str], rank: str) -> DataFrame:
    """Add ``rank`` (long, from 0): the position of each row within its ``key``, by ``order`` and then ``ties``.

    ``order`` is a string that begins with hexadecimal digits of an evenly spread hash (see :func:`id_order`). A key may
    hold most of the rows: each key is split into 256 ranges of that hash, the ranges are counted and ranked apart,
    and a range's first rank is the number of rows in the ranges before it. Rows are shuffled once, by (key, range).
    """
    from pyspark.sql import Window as W

    part = df.withColumn("__range", F.substring(F.col(order), 1, 2))
    counts = part.groupBy(F.col(key).alias("__key"), F.col("__range").alias("__r")).agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy("__key").orderBy("__r").rowsBetween(W.unboundedPreceding, -1)
    first = counts.select("__key", "__r", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    own = W.partitionBy(key, "__range").orderBy(order, *ties)
    inside = part.withColumn("__row", F.row_number().over(own).cast("long") - 1)
    return (
        inside.join(first, (F.col(key) == F.col("__key")) & (F.col("__range") == F.col("__r")))
        .withColumn(rank, F.col("__first") + F.col("__row"))
        .drop("__range", "__key", "__r", "__first", "__row")
    )
