"""Hard negatives by bit-sliced integer products: bit-planes most significant first, intervals that tighten, early drops."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import _bounded_batches, checkpoint, map_batches, release
from .topk import _matrix, quantised

#: Bytes of anchors that a pass over the table holds in every task.
SLICE_BYTES = 16 << 20
#: Anchors that meet a block at a time; pairs are followed one by one when fewer than a part of them is left.
ROWS, DENSE = 256, 8
NONE = np.iinfo(np.int64).min


@dataclass
class Anchors:
    """A slice of anchors, and for each the windows ``low..high`` in which its ``k`` best scores are looked for."""

    ids: np.ndarray
    labels: np.ndarray
    ints: np.ndarray
    low: np.ndarray
    high: np.ndarray
    k: int
    same: bool
    best: tuple[np.ndarray, ...] = field(default_factory=lambda: (np.zeros(0, np.int64),) * 3)

    def __post_init__(self) -> None:
        self.floor = self.low.copy()
        self.up, self.down = np.maximum(self.ints, 0).sum(axis=1), np.minimum(self.ints, 0).sum(axis=1)

    def take(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Keep the best of what was kept and these; the k-th best of a full window is its new floor."""
        n = self.low.shape[1]
        parts = [self.best]
        for w in range(n):
            good = (scores >= self.floor[rows, w]) & (scores <= self.high[rows, w])
            parts.append((rows[good] * n + w, ids[good], scores[good]))
        keys, ids, scores = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((ids, -scores, keys))
        keys, ids, scores = keys[order], ids[order], scores[order]
        rank = np.arange(len(keys)) - np.searchsorted(keys, keys)
        full = rank == self.k - 1
        self.floor.reshape(-1)[keys[full]] = scores[full]
        self.best = tuple(x[rank < self.k] for x in (keys, ids, scores))


def meet(anchors: Anchors, who: np.ndarray, ids: np.ndarray, ints: np.ndarray, live: np.ndarray, planes: int) -> None:
    """Let the anchors ``who`` meet a block of vectors where ``live`` allows it.

    Vectors are read as two's complement, one bit of all components at a time, the sign first. What the lower bits can still
    add lies between all of the anchor's negative and all of its positive components times the largest rest; a pair whose
    interval touches no window's open part is dropped. While many pairs are left, a plane is one matrix product.
    """
    a, up, down = anchors.ints[who], anchors.up[who], anchors.down[who]
    floor, high = anchors.floor[who], anchors.high[who]
    least, most = floor.min(axis=1), high.max(axis=1)
    part = np.zeros(live.shape)
    wide = a.astype(float)
    pairs = None
    for s in reversed(range(planes)):
        weight, rest = (-(1 << s) if s == planes - 1 else 1 << s), (1 << s) - 1
        bits = ints >> s & 1
        if pairs is None:
            part += weight * (wide @ bits.astype(float).T)
            live &= part >= (least - rest * up)[:, None]
            live &= part <= (most - rest * down)[:, None]
            if np.count_nonzero(live) * DENSE > live.size:
                continue
            pairs = np.nonzero(live)
            sums = part[pairs].astype(np.int64)
            continue
        r, c = pairs
        for at in range(0, len(r), 1 << 14):
            cut = slice(at, at + (1 << 14))
            sums[cut] += weight * (a[r[cut]] * bits[c[cut]]).sum(axis=1)
        keep = ((sums[:, None] + rest * up[r, None] >= floor[r]) & (sums[:, None] + rest * down[r, None] <= high[r])).any(axis=1)
        pairs, sums = (r[keep], c[keep]), sums[keep]
    if pairs is None:
        pairs = np.nonzero(live)
        sums = part[pairs].astype(np.int64)
    anchors.take(who[pairs[0]], ids[pairs[1]], sums)


def _search(blocks: DataFrame, anchors: tuple, dims: int, planes: int, k: int, same: bool) -> DataFrame:
    """``(anchor, window, vec_id, score)``: the k best of every part of the table for each window of the slice's anchors.

    ``anchors`` is a broadcast slice ``(ids, labels, ints, low, high)``; ``same`` looks at equal labels, else at different ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Anchors(*anchors.value, k, same)
        of = {label: np.flatnonzero(own.labels == label) for label in np.unique(own.labels)}
        n = own.low.shape[1]
        for batch in batches:
            for blobs in zip(*(c.to_pylist() for c in batch.columns)):
                ids, labels = (np.frombuffer(b, np.int64) for b in blobs[:2])
                ints = np.frombuffer(blobs[2], np.int64 if len(blobs[2]) == 8 * len(ids) * dims else np.int32).reshape(len(ids), dims).astype(np.int64)
                # Blocks are sorted by label, so equal labels are one stretch.
                for label in np.unique(labels) if same else (None,):
                    at = slice(*np.searchsorted(labels, [label, label + 1])) if same else slice(None)
                    who = of.get(label, ()) if same else np.arange(len(own.ids))
                    for first in range(0, len(who), ROWS):
                        some = who[first : first + ROWS]
                        live = ids[None, at] != own.ids[some, None]
                        if not same:
                            live &= labels[None, :] != own.labels[some, None]
                        meet(own, some, ids[at], ints[at], live, planes)
        keys, ids, scores = own.best
        yield pa.RecordBatch.from_arrays([pa.array(own.ids[keys // n]), pa.array((keys % n).astype(np.int32)), pa.array(ids), pa.array(scores)], names=["anchor", "window", "vec_id", "score"])

    found = blocks.mapInArrow(run, "anchor long, window int, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _packed(rows: DataFrame, dims: int, kind: type) -> DataFrame:
    """A row for each record batch: ``(ids, labels, ints)`` as binary columns, by label."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        if batch.num_rows:
            ids, labels = (batch.column(i).to_numpy() for i in range(2))
            order = np.argsort(labels, kind="stable")
            ints = _matrix(batch.column(2), dims)[order].astype(kind)
            yield {"ids": [ids[order].tobytes()], "labels": [labels[order].tobytes()], "ints": [ints.tobytes()]}

    return map_batches(rows.select("vec_id", "label", "q"), "ids binary, labels binary, ints binary", run)


def mine(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, scale: int = 256, low: int = 50, high: int = 95, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` over ``vectors(vec_id, embedding, label)``.

    Anchors are the rows whose id is divisible by ``every``. Their positives are the ``positives`` best other rows of the same
    (integer) label; the negatives of a pair are the ``negatives`` best rows of other labels whose score is between ``low`` and ``high``
    percent of the positive's. Scores are products of vectors of floor(scale * x); higher ones come first, ties by smaller id.

    The table is packed into blocks once and never shuffled: anchors are cut into slices of ``slice_bytes``, each slice goes over
    all blocks twice as a broadcast of that size, first for the positives, then for the negatives; every task hands on the
    best it has seen. A pass is a job over the whole table, and their number grows with the anchors.

    Rows with a null id, label or vector, or with null or non-finite components, take no part. Shorter vectors count as filled up
    with zeros. Rows that share the anchor's id are its own row, of repeated anchor ids the smallest label and vector asks;
    other repeated rows count each, and a positive that stands twice has its negatives twice. An anchor without positives and pairs without negatives have no rows. Extra columns are not
    read. Scores that 53 bits may not hold are an error.
    """
    spark = vectors.sparkSession
    _bounded_batches(spark)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), quantised(F.col("embedding"), scale).alias("q"))
    rows = checkpoint(rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND q IS NOT NULL"))
    dims, top = rows.agg(F.max(F.size("q")), F.max(F.array_max(F.transform("q", F.abs)))).head()
    if dims is None:
        return spark.createDataFrame([], schema)
    dims, planes = max(dims, 1), int(top or 0).bit_length() + 1
    if 2 * (planes + 1) + dims.bit_length() > 53:
        raise ValueError(f"vectors of {dims} components of up to {top} are too large")
    kind = np.int32 if planes <= 32 else np.int64
    blocks = checkpoint(_packed(rows, dims, kind))
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("m")).select("vec_id", "m.label", "m.q")
    n_slices = max(1, -(-asked.count() * dims * 8 // slice_bytes))
    asked = checkpoint(asked.withColumn("slice", F.pmod(F.xxhash64("vec_id"), F.lit(n_slices))))
    release(rows)
    found = None
    for i in range(n_slices):
        part = [_unpacked(r, dims) for r in _packed(asked.where(F.col("slice") == i), dims, np.int64).toLocalIterator()]
        if part:
            got = _slice(blocks, [np.concatenate(x) for x in zip(*part)], dims, planes, positives, negatives, low, high)
            found = got if found is None else found.unionByName(got)
    return spark.createDataFrame([], schema) if found is None else found


def _unpacked(row, dims: int) -> tuple[np.ndarray, ...]:
    ids, labels, ints = (np.frombuffer(b, np.int64) for b in (row.ids, row.labels, row.ints))
    return ids, labels, ints.reshape(len(ids), dims)


def _slice(blocks: DataFrame, anchors: list[np.ndarray], dims: int, planes: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """The hard negatives of one slice of anchors, checkpointed."""
    context = blocks.sparkSession.sparkContext
    ids = anchors[0]
    order = np.argsort(ids)
    open_low, open_high = np.full((len(ids), 1), NONE // 4), np.full((len(ids), 1), -(NONE // 4))
    sent = context.broadcast((*anchors, open_low, open_high))
    # At most ``positives`` rows for each anchor of the slice.
    best = _search(blocks, sent, dims, planes, positives, True).select("anchor", "rank", "vec_id", "score").toArrow()
    sent.destroy()
    score, known = np.full((len(ids), positives), NONE), np.zeros((len(ids), positives), np.int64)
    at = order[np.searchsorted(ids, best["anchor"].to_numpy(), sorter=order)], best["rank"].to_numpy() - 1
    score[at], known[at] = best["score"].to_numpy(), best["vec_id"].to_numpy()
    # Of a window without a score in it, nothing is open.
    least, most = -(-low * np.maximum(score, 0) // 100), high * np.maximum(score, 0) // 100
    shut = (score < 0) | (least > most)
    sent = context.broadcast((*anchors, np.where(shut, -(NONE // 4), least), np.where(shut, NONE // 4, most)))
    spots = context.broadcast((ids[order], known[order], score[order]))

    def name(batch: pa.RecordBatch) -> Iterator[dict]:
        anchor, window = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        sorted_ids, positive, of = spots.value
        row = np.searchsorted(sorted_ids, anchor)
        yield {"anchor_id": anchor, "positive_id": positive[row, window], "rank": batch.column(4), "negative_id": batch.column(2), "positive_score": of[row, window], "negative_score": batch.column(3)}

    found = _search(blocks, sent, dims, planes, negatives, False)
    named = checkpoint(map_batches(found.select("anchor", "window", "vec_id", "score", "rank"), "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long", name))
    sent.destroy()
    spots.destroy()
    return named
