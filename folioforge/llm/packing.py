"""Sequence packing into optimal length buckets and token-budget batches."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, id_order, literal_rows, ranked

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Length of a text in words between ASCII white space; null as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def optimal_buckets(histogram: Mapping[int, int], buckets: int) -> list[int]:
    """Upper lengths of at most ``buckets`` buckets that minimise the padding of all sequences in ``histogram``.

    Dynamic programming over the distinct lengths: best[k][j] is the least padded total of the j shortest lengths in k
    buckets. Of equal totals the fewest buckets, then the shortest last bucket from the left, are taken.
    """
    lengths = np.array(sorted(histogram), dtype=np.int64)
    if not len(lengths):
        return []
    upto = np.concatenate([[0], np.cumsum([histogram[int(x)] for x in lengths])]).astype(np.float64)
    n = len(lengths)
    best = np.full(n + 1, np.inf)
    best[0] = 0
    choice: list[np.ndarray] = []
    totals = []
    for _ in range(min(buckets, n)):
        now, frm = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):
            cost = best[:j] + lengths[j - 1] * (upto[j] - upto[:j])
            frm[j] = int(np.argmin(cost))
            now[j] = cost[frm[j]]
        best = now
        choice.append(frm)
        totals.append(now[n])
    k, j, bounds = int(np.argmin(totals)), n, []
    while k >= 0:
        bounds.append(int(lengths[j - 1]))
        j, k = int(choice[k][j]), k - 1
    return bounds[::-1]


def pack_documents(docs: DataFrame, buckets: int = 8, max_tokens: int = 2048, budget: int = 32768, tokens: Column | None = None) -> DataFrame:
    """Sequences of at most ``max_tokens`` tokens, their bucket, and their place in a batch of the bucket.

    Returns ``(doc_id, chunk, token_start, n_tokens, bucket, bucket_len, batch, slot)``: long documents are cut into
    chunks of ``max_tokens``, none is dropped; every sequence is padded to its bucket's length; a batch holds as many
    sequences of one bucket as ``budget`` padded tokens allow (one at least). Batches count from 0 in each bucket.

    The driver sees the histogram of lengths, ``max_tokens + 1`` rows at most. Ranks within a bucket are made in hash
    ranges, so one bucket may hold most rows. ``tokens`` is the length expression, words by default. Null and empty
    texts are sequences of length 0; null ids and repeated rows are rows like others; extra columns are not read.
    """
    spark = docs.sparkSession
    n = F.coalesce((word_count(F.col("text")) if tokens is None else tokens).cast("long"), F.lit(0))
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), n.alias("n")).select(
        "doc_id", "n", F.explode(F.sequence(F.lit(0), F.floor((F.greatest("n", F.lit(1)) - 1) / max_tokens).cast("int"))).alias("chunk")
    )
    start = F.col("chunk").cast("long") * max_tokens
    cut = checkpoint(cut.select("doc_id", "chunk", start.alias("token_start"), F.least(F.col("n") - start, F.lit(max_tokens)).alias("n_tokens")))
    histogram = dict(cut.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect())
    bounds = optimal_buckets(histogram, buckets)
    rows, at = [], 0
    for length in sorted(histogram):
        at += length > bounds[at]
        rows.append({"len": length, "bucket": at, "bucket_len": bounds[at]})
    of = literal_rows(spark, rows, "len long, bucket int, bucket_len long")
    placed = cut.join(F.broadcast(of), F.col("n_tokens") == F.col("len")).drop("len").withColumn("pos", id_order("doc_id", "chunk"))
    placed = ranked(placed, "bucket", "pos", ["doc_id", "chunk", "n_tokens"], "rank")
    each = F.greatest(F.floor(F.lit(budget) / F.greatest("bucket_len", F.lit(1))), F.lit(1))
    return placed.select(
        "doc_id", "chunk", "token_start", "n_tokens", "bucket", "bucket_len",
        F.floor(F.col("rank") / each).alias("batch"), F.pmod("rank", each).cast("int").alias("slot"),
    )
