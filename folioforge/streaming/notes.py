"""Incremental normalisation of arriving documents: a file stream, the same column rules, one batch at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.lines import normalize_body


def normalize_stream(spark: SparkSession, source: str, sink: str, checkpoint: str, patterns: Sequence[str] = (), schema: str = "doc_id long, text string") -> StreamingQuery:
    """Read new Parquet files of ``source``, normalise their texts, append them to ``sink``; stops when all are done.

    The rules are stateless expressions, so the stream needs no watermark; the checkpoint folder makes each file count once.
    """
    docs = spark.readStream.schema(schema).parquet(source)
    clean = docs.withColumn("text", normalize_body(F.col("text"), patterns))
    return clean.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink)
