"""Exact top-k inner products: norm-sorted blocks, SVD-rotated partial sums, Cauchy-Schwarz pruning."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import checkpoint, literal_rows, map_batches

#: Vectors in a block, and blocks of a stripe; a task holds one block of queries and one stripe.
BLOCK, QUERY_BLOCK, STRIPE = 1024, 2048, 8
#: More components than this would make the driver's sums of products too large.
MAX_DIMS = 8192


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component as a long; null for a null vector or one with null or non-finite components."""
    x = F.transform(vector, lambda v: v.cast("double"))
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(F.coalesce(good, F.lit(False)), F.transform(x, lambda v: F.floor(v * scale)))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list<long> column as rows of ``dims`` integers, shorter vectors filled up with zeros."""
    flat, offsets = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    offsets = offsets - offsets[0]
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(-1, dims).astype(np.int64)
    out = np.zeros((len(sizes), dims), np.int64)
    for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
        out[i, : b - a] = flat[a:b]
    return out


def rotation(vectors: DataFrame, dims: int) -> np.ndarray:
    """Right singular vectors of all vectors, strongest first, from the sum of outer products of every partition."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        x = _matrix(batch.column(0), dims).astype(float)
        yield {"row": np.arange(dims), "sums": list(x.T @ x)}

    sums = F.array(*[F.sum(F.element_at("sums", i + 1)) for i in range(dims)])
    rows = map_batches(vectors.select("q"), "row int, sums array<double>", run).groupBy("row").agg(sums.alias("s")).collect()
    gram = np.zeros((dims, dims))
    for r in rows:
        gram[r["row"]] = r["s"]
    return np.linalg.eigh(gram)[1][:, ::-1]


def _blocks(vectors: DataFrame, dims: int, size: int) -> DataFrame:
    """Vectors by descending length, packed: ``(block, top, ids, ints)``, ids and components as binary columns.

    Components take four bytes each where they fit; ``top`` is the length of the block's first, longest vector. Each range partition packs its own rows; blocks are numbered along the lengths from the partitions' block counts.
    """
    ordered = vectors.repartitionByRange(F.desc("norm2"), F.col("vec_id")).sortWithinPartitions(F.desc("norm2"), "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0

        def pack(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts)
            ints = np.concatenate([_matrix(c, dims) for c in table.column("q").chunks])
            small = ints if np.abs(ints).max(initial=0) >> 31 else ints.astype(np.int32)
            blobs = [pa.array([v.tobytes()], pa.binary()) for v in (table.column("vec_id").to_numpy(), small)]
            top = float(np.sqrt(table.column("norm2")[0].as_py()))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([done], pa.int64()), pa.array([top]), *blobs], names=["part", "own", "top", "ids", "ints"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, size - sum(b.num_rows for b in held))
                held.append(piece)
                at += piece.num_rows
                if sum(b.num_rows for b in held) == size:
                    yield pack(held)
                    held, done = [], done + 1
        if held:
            yield pack(held)

    packed = checkpoint(ordered.select("vec_id", "q", "norm2").mapInArrow(run, "part int, own long, top double, ids binary, ints binary"))
    counts = dict(packed.groupBy("part").agg(F.count(F.lit(1))).collect())
    before, rows = 0, []
    for part in sorted(counts):
        rows.append({"part": part, "before": before})
        before += counts[part]
    first = literal_rows(vectors.sparkSession, rows, "part int, before long")
    return packed.join(F.broadcast(first), "part").select((F.col("before") + F.col("own")).alias("block"), "top", "ids", "ints")


def best_of(queries: tuple, blocks: Iterable[tuple], longest: float, k: int, head: int, floor: np.ndarray) -> list[tuple[int, int, int]]:
    """The ``k`` best ``(query_id, vec_id, score)`` of each query among the blocks, which come by descending length, one at
    a time; no vector is longer than ``longest``.

    ``floor`` holds, for each query, a score that its k-th best is known to reach (-inf: none). A candidate is dropped when
    its partial sum over the first ``head`` rotated dimensions plus the product of the lengths of the rest is below that;
    the others get their integer product. Bounds have room for rounding, so no tie is lost.
    """
    q_ids, q_ints, q_turned, q_norms = queries
    n = len(q_ids)
    rest_q = np.sqrt(np.maximum(q_norms**2 - (q_turned[:, :head] ** 2).sum(axis=1), 0))
    best_s = [np.zeros(0, np.int64)] * n
    best_v = [np.zeros(0, np.int64)] * n
    floor = floor.copy()
    exact = max(float(q_norms.max(initial=0)), 1) * max(longest, 1) < 2**52
    for ids, ints, turned, norms in blocks:
        slack = 1e-6 * (1 + q_norms * norms.max(initial=0))
        live = np.flatnonzero(q_norms * norms.max(initial=0) + slack >= floor)
        if not len(live):
            continue
        rest_x = np.sqrt(np.maximum(norms**2 - (turned[:, :head] ** 2).sum(axis=1), 0))
        bound = q_turned[live, :head] @ turned[:, :head].T
        bound += rest_q[live, None] * rest_x[None, :]
        keep = (bound + slack[live, None] >= floor[live, None]) & (ids[None, :] != q_ids[live, None])
        for row, i in enumerate(live):
            cols = np.flatnonzero(keep[row])
            if not len(cols):
                continue
            score = (ints[cols].astype(float) @ q_ints[i].astype(float)).astype(np.int64) if exact else ints[cols] @ q_ints[i]
            if len(best_s[i]) >= k:
                good = score >= floor[i]
                cols, score = cols[good], score[good]
            s, v = np.concatenate([best_s[i], score]), np.concatenate([best_v[i], ids[cols]])
            order = np.lexsort((v, -s))[:k]
            best_s[i], best_v[i] = s[order], v[order]
            if len(order) == k:
                floor[i] = max(floor[i], best_s[i][-1])
    return [(int(q_ids[i]), int(v), int(s)) for i in range(n) for v, s in zip(best_v[i], best_s[i])]


def top_k(
    vectors: DataFrame, every: int = 20, k: int = 20, scale: int = 64, head_share: float = 0.5, block: int = BLOCK, query_block: int = QUERY_BLOCK, stripe: int = STRIPE
) -> DataFrame:
    """For each row whose vec_id is divisible by ``every``, its ``k`` largest inner products with other rows.

    Returns ``(query_id, rank, vec_id, score)`` over the quantised vectors, ties to the smaller vec_id. Blocks of queries
    meet stripes of blocks of candidates, both by descending length; the first stripe gives every query a score that its
    k-th best reaches. A block of candidates then meets only the query blocks of which some query could reach its k-th
    best with the block's longest vector; the others are left out before the shuffle. A task holds one query block, one
    stripe as it was packed, and one block of it unpacked.

    Vectors that are null or hold null or non-finite components, and rows with a null vec_id, take no part. Shorter vectors
    count as filled up with zeros. Rows that share a vec_id with the query are its own row; of repeated query ids the
    smallest vector asks; repeated candidate rows are candidates each. Extra columns are not read; no rows give no rows.
    More than ``MAX_DIMS`` components, and scores that 64 bits may not hold, are errors.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    q = quantised(F.col("embedding"), scale)
    ints = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), q.alias("q")).where("vec_id IS NOT NULL AND q IS NOT NULL")
    norm2 = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    ints = checkpoint(ints.withColumn("norm2", norm2))
    dims, longest = ints.agg(F.max(F.size("q")), F.sqrt(F.max("norm2"))).head()
    if dims and (dims > MAX_DIMS or longest >= 2.0**31):
        raise ValueError(f"vectors of {dims} components and a length of {longest} are too large")
    if not dims:
        return spark.createDataFrame([], schema) if dims is None else _zeros(ints, every, k)
    turn = rotation(ints, dims)
    head = max(1, int(dims * head_share))
    asked = ints.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("q", "norm2")).alias("m")).select("vec_id", "m.q", "m.norm2")
    query_blocks = _blocks(asked, dims, query_block).withColumnRenamed("block", "qb")
    stripes = _blocks(ints, dims, block).withColumn("stripe", F.floor(F.col("block") / stripe))
    n_blocks = query_blocks.count()
    n_stripes = stripes.agg(F.max("stripe")).head()[0] + 1
    if not n_blocks:
        return ints.sparkSession.createDataFrame([], schema)

    def unpack(row) -> tuple:
        ids = np.frombuffer(row.ids, np.int64)
        ints = np.frombuffer(row.ints, np.int32 if len(row.ints) == 4 * len(ids) * dims else np.int64).reshape(len(ids), dims).astype(np.int64)
        return ids, ints, ints.astype(float) @ turn, np.sqrt((ints.astype(float) ** 2).sum(axis=1))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, int]] = []
        right = right.sort_values("block")
        for row in left.itertuples():
            queries = unpack(row)
            floor = np.frombuffer(row.floors) if row.floors is not None else np.full(len(queries[0]), -np.inf)
            found += best_of(queries, map(unpack, right.itertuples()), longest, k, head, floor)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    def search(asking: DataFrame, pairs: DataFrame) -> DataFrame:
        """``asking(qb, stripe, ...)`` against the blocks of ``pairs(qb, stripe, ...)``."""
        return asking.groupBy("qb", "stripe").cogroup(pairs.groupBy("qb", "stripe")).applyInPandas(meet, "query_id long, vec_id long, score long")

    no_floor = query_blocks.drop("top").withColumn("floors", F.lit(None).cast("binary"))
    every_block = F.explode(F.expr(f"sequence(0L, {n_blocks - 1}L)"))
    found = search(no_floor.withColumn("stripe", F.lit(0).cast("long")), stripes.where("stripe = 0").withColumn("qb", every_block))
    if n_stripes > 1:
        found = checkpoint(found)
        reached = found.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
        later = checkpoint(_with_floors(query_blocks.drop("top"), reached, dims))
        pairs = surviving_pairs(stripes.where("stripe > 0"), later)
        asking = checkpoint(pairs.select("qb", "stripe").distinct())
        found = found.unionByName(search(later.drop("least").join(asking, "qb"), pairs))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def surviving_pairs(blocks: DataFrame, query_blocks: DataFrame) -> DataFrame:
    """``blocks`` once for each block ``qb`` of ``query_blocks(qb, least)`` that its longest vector is long enough for.

    The driver sees one number for each query block, that is for each 2048 queries.
    """
    least = query_blocks.select("qb", "least").orderBy("qb").collect()
    needed = F.array(*[F.struct(F.lit(r.qb).cast("long").alias("qb"), F.lit(float(r.least)).alias("least")) for r in least])
    return blocks.withColumn("qb", F.explode(F.transform(F.filter(needed, lambda x: x["least"] <= F.col("top")), lambda x: x["qb"])))


def _with_floors(query_blocks: DataFrame, reached: DataFrame, dims: int) -> DataFrame:
    """Query blocks with the reached scores of their queries as a binary column, in the block's order, and ``least``: the
    length below which no vector can reach any of them."""

    def members(batch: pa.RecordBatch) -> Iterator[dict]:
        ids = [np.frombuffer(b, np.int64) for b in batch.column(1).to_pylist()]
        qb = np.repeat(batch.column(0).to_numpy(), [len(i) for i in ids])
        yield {"qb": qb, "at": np.concatenate([np.arange(len(i)) for i in ids]), "query_id": np.concatenate(ids)}

    listed = map_batches(query_blocks.select("qb", "ids"), "qb long, at int, query_id long", members)
    floors = listed.join(reached, "query_id", "left").groupBy("qb").agg(F.sort_array(F.collect_list(F.struct("at", "floor"))).alias("f"))

    def pack(batch: pa.RecordBatch) -> Iterator[dict]:
        found, least = [], []
        for r, blob in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            floor = np.array([-np.inf if x["floor"] is None else x["floor"] for x in r], float)
            ints = np.frombuffer(blob, np.int32 if len(blob) == 4 * len(floor) * dims else np.int64).reshape(len(floor), dims)
            norms = np.sqrt((ints.astype(float) ** 2).sum(axis=1))
            # The room for rounding is more than that of the search. A vector without length scores 0 with all.
            with np.errstate(divide="ignore", invalid="ignore"):
                needed = np.where(norms > 0, (floor - 1e-5) / norms * (1 - 1e-5), np.where(floor <= 0, -np.inf, np.inf))
            found.append(floor.tobytes())
            least.append(float(np.where(floor <= 0, -np.inf, needed).min()))
        yield {"qb": batch.column(0), "floors": found, "least": least}

    blobs = floors.join(query_blocks.select("qb", "ints"), "qb").select("qb", "f", "ints")
    return query_blocks.join(map_batches(blobs, "qb long, floors binary, least double", pack), "qb")


def _zeros(ints: DataFrame, every: int, k: int) -> DataFrame:
    """All vectors are empty: every product is 0, and each query gets the smallest other ids."""
    least = ints.select(F.col("vec_id").alias("v")).orderBy("v").limit(k + 1)
    asked = ints.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id")).distinct()
    found = asked.join(F.broadcast(least), F.col("v") != F.col("query_id"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("v"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("v").alias("vec_id"), F.lit(0).cast("long").alias("score"))
