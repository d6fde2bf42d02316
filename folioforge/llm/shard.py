"""Consistent-hash sharding with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, id_order, literal_rows, ranked

CELLS = 1 << 14


def ring(shards: int, vnodes: int, cells: int = CELLS) -> list[tuple[int, int]]:
    """The virtual nodes ``(cell, shard)`` in clockwise order.

    A shard's k-th virtual node stands at a cell that depends on the shard and k alone, so that further shards add nodes
    and move none. Where nodes fall on one cell, the smallest shard has it.
    """
    at: dict[int, int] = {}
    for shard in range(shards):
        for k in range(vnodes):
            cell = int(hashlib.md5(f"shard {shard} node {k}".encode()).hexdigest()[:4], 16) * cells >> 16
            at.setdefault(cell, shard)
    return sorted(at.items())


def owners(nodes: Sequence[tuple[int, int]], cells: int = CELLS) -> list[int]:
    """For each cell, the index of the first virtual node at it or clockwise from it."""
    out, node = [], 0
    for cell in range(cells):
        while node < len(nodes) and nodes[node][0] < cell:
            node += 1
        out.append(node % len(nodes))
    return out


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Rows that each shard takes at most. Without slack they add up to ``rows``, at most one apart."""
    if slack <= 0:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [int(-(-rows * (1 + slack) // shards))] * shards


def assign(nodes: Sequence[tuple[int, int]], counts: Sequence[int], limits: Sequence[int]) -> list[dict]:
    """Where the rows of every virtual node go: ``(node, first, last, shard, slot)`` by rank within the node.

    First each node, in clockwise order, gives its first rows to its own shard while that has room. Then, in the same
    order, the rows left go clockwise from their node, each to the first node whose shard has room. Works on counts.
    """
    room, used = list(limits), [0] * len(limits)
    out: list[dict] = []

    def give(node: int, first: int, shard: int, n: int) -> int:
        n = min(n, room[shard])
        if n:
            out.append({"node": node, "first": first, "last": first + n - 1, "to": shard, "base": used[shard] - first})
            room[shard] -= n
            used[shard] += n
        return n

    placed = [give(i, 0, shard, counts[i]) for i, (_, shard) in enumerate(nodes)]
    for i in range(len(nodes)):
        step = 0
        while placed[i] < counts[i]:
            placed[i] += give(i, placed[i], nodes[(i + step) % len(nodes)][1], counts[i] - placed[i])
            step += 1
    return out


def shard_documents(docs: DataFrame, shards: int = 16, vnodes: int = 64, slack: float = 0.0) -> DataFrame:
    """Put rows on shards: ``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``, one row each.

    A row's key is its text, so copies of a text share a place on the ring and part only where a shard is full. Its cell
    leads to the next virtual node clockwise; rows that find its shard full go on clockwise. With ``slack`` 0 the row
    counts of shards are at most one apart (law ``rows``); with more slack a shard holds at most ``(1 + slack)`` times its
    share and fewer rows move. ``slot`` counts the rows of a shard from 0.

    Counts per virtual node, of which there are ``shards * vnodes`` at most, are all that the driver sees. Ranks within
    a node are made in 256 hash ranges, so one text may hold most rows. Null texts are empty texts of size 1; null ids
    and repeated rows are rows like others; extra columns are not read; no rows give no rows.
    """
    spark = docs.sparkSession
    nodes = ring(shards, vnodes)
    text = F.coalesce(F.col("text"), F.lit(""))
    cell = F.floor(F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("long") * CELLS / 65536).cast("int")
    lookup = literal_rows(spark, [{"cell": c, "node": n} for c, n in enumerate(owners(nodes))], "cell int, node int")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        cell.alias("cell"),
    ).join(F.broadcast(lookup), "cell")
    rows = checkpoint(rows.select("doc_id", "size", "text_crc32", "node", id_order("doc_id", "text_crc32").alias("pos")))
    counts = dict(rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).collect())
    per_node = [counts.get(i, 0) for i in range(len(nodes))]
    plan = assign(nodes, per_node, capacities(sum(per_node), shards, slack))
    pieces = literal_rows(spark, plan, "node int, first long, last long, to int, base long").withColumnRenamed("node", "n")
    placed = ranked(rows, "node", "pos", ["doc_id", "text_crc32", "size"], "rank").join(
        F.broadcast(pieces), (F.col("node") == F.col("n")) & F.col("rank").between(F.col("first"), F.col("last"))
    )
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("to").alias("shard"),
        (F.col("base") + F.col("rank")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
