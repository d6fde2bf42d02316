"""Document tables that lie bucketed by document, so that work on whole documents needs no shuffle."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

KEY = "source_slug"


def write_bucketed(rows: DataFrame, name: str, buckets: int, order: str = "ord", key: str = KEY) -> None:
    """``rows`` as the table ``name``: ``buckets`` buckets by document, each sorted by document and ``order``.

    Give tables that are joined the same number of buckets. One file a bucket is written, since rows are dealt as the buckets are.
    A document is whole in one bucket; corpora of few giant documents are better left unbucketed.
    """
    rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key, order).mode("overwrite").format("parquet").saveAsTable(name)


#: Joins on a document and a number or page may use a partitioning by document alone.
_SETTINGS = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.sources.bucketing.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "-1"}


@contextmanager
def by_document(spark: SparkSession) -> Iterator[None]:
    """Plans that are made and run inside read bucketed tables without shuffling them."""
    before = {k: spark.conf.get(k, None) for k in _SETTINGS}
    for k, v in _SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
