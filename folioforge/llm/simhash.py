"""SimHash near-duplicate detection with multi-index hashing over fingerprint segments."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, map_batches, texts_of
from .components import connected_components

SEED = 42
_CHUNK = 255 * 256


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    whole = len(bits) // 255 * 255
    counts = bits[whole:].sum(axis=0, dtype=np.int64)
    if whole:
        counts += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(text: str, shingle: int = 3) -> int:
    """The SimHash of a text: A-Z lower-cased, words between ASCII white space, shingles of ``shingle`` words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    shingles = map(b" ".join, zip(*(islice(words, i, None) for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, np.int64), 0
    while chunk := [digest(s, SEED) for s in islice(shingles, _CHUNK)]:
        counts += _bit_counts(np.array(chunk, dtype="<u8"))
        n += len(chunk)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fp)``, the fingerprint as a signed long. Null texts count as empty; their fingerprint is zero."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        values = np.array([fingerprint(t, shingle) for t in texts_of(batch, "text")], dtype=np.uint64)
        yield {"doc_id": batch.column(0), "fp": pa.array(values.view(np.int64))}

    return map_batches(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), "doc_id long, fp long", run)


@dataclass(frozen=True)
class Segment:
    """A run of fingerprint bits that is looked up within a Hamming ball of its own."""

    shift: int
    width: int
    radius: int

    def value(self, fp: Column) -> Column:
        return F.shiftrightunsigned(fp, self.shift).bitwiseAND(F.lit((1 << self.width) - 1))

    def ball(self) -> list[int]:
        return [sum(1 << b for b in bits) for r in range(self.radius + 1) for bits in combinations(range(self.width), r)]


def segments(distance: int, parts: int) -> list[Segment]:
    """Segments and radii by the pigeonhole rule.

    With ``distance = parts * a + b``, two fingerprints within ``distance`` bits agree to within ``a`` bits in one of the
    first ``b + 1`` segments or to within ``a - 1`` bits in one of the others.
    """
    a, b = divmod(distance, parts)
    edges = [64 * i // parts for i in range(parts + 1)]
    found = [Segment(lo, hi - lo, a if i <= b else a - 1) for i, (lo, hi) in enumerate(zip(edges, edges[1:]))]
    return [s for s in found if s.radius >= 0]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, distance: int = 2, parts: int = 2, hot: int = 4096) -> DataFrame:
    """Pairs ``(a, b)`` of different fingerprints within ``distance`` bits, out of the distinct ``fps(fp)``.

    Each fingerprint stands in one table entry per segment. A probe is a segment value within the segment's Hamming
    ball; of the two ends of a pair only the one whose lowest differing bit is 0 probes, and equal segment values are
    taken once by order. Whole distances are verified inside the join, so it emits links only.

    An entry that holds more than ``hot`` different fingerprints is not scanned: probes of it enumerate the remaining
    difference bits instead and look up whole fingerprints. That gives the same links and grows with the probes, not
    with the square of the entry.
    """
    fp = F.col("fp")
    plan = segments(distance, parts)
    entries = fps.select(
        fp, F.explode(F.array(*[F.struct(F.lit(i).alias("seg"), s.value(fp).alias("key")) for i, s in enumerate(plan)])).alias("e")
    ).select("fp", "e.seg", "e.key")
    balls = F.array(*[F.array(*[F.lit(m) for m in s.ball()]) for s in plan])
    mask = F.col("mask")
    probes = (
        entries.withColumn("mask", F.explode(F.element_at(balls, F.col("seg") + 1)))
        .where((mask == 0) | (F.col("key").bitwiseAND(mask).bitwiseAND(-mask) == 0))
        .select(F.col("fp").alias("a"), "seg", "mask", F.col("key").bitwiseXOR(mask).alias("key"))
    )
    crowded = checkpoint(entries.groupBy("seg", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("seg", "key"))
    table = entries.select(F.col("fp").alias("b"), "seg", "key")
    on = [F.col("p.seg") == F.col("t.seg"), F.col("p.key") == F.col("t.key")]
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    once = (F.col("mask") != 0) | (F.col("a") < F.col("b"))
    condition = on[0] & on[1] & near & once
    some = bool(crowded.head(1))
    cold = table.join(crowded, ["seg", "key"], "left_anti") if some else table
    found = probes.alias("p").join(cold.alias("t"), condition).select("a", "b")
    if some:
        rest = F.expr("CASE " + " ".join(f"WHEN seg = {i} THEN {i}" for i in range(len(plan))) + " END")
        masks = F.array(*[F.array(*[F.array(*[F.lit(_signed(m)) for m in _rest(s, distance - r)]) for r in range(s.radius + 1)]) for s in plan])
        whole = (
            probes.join(crowded, ["seg", "key"], "left_semi")
            .withColumn("more", F.explode(F.element_at(F.element_at(masks, rest + 1), F.bit_count("mask").cast("int") + 1)))
            .withColumn("shifted", F.expr("CASE " + " ".join(f"WHEN seg = {i} THEN shiftleft(mask, {s.shift})" for i, s in enumerate(plan)) + " END"))
            .select("a", "mask", F.col("a").bitwiseXOR(F.col("shifted")).bitwiseXOR(F.col("more")).alias("b"))
            .where(once)
        )
        found = found.unionByName(whole.join(fps.select(F.col("fp").alias("b")), "b", "left_semi").select("a", "b"))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def _rest(segment: Segment, distance: int) -> list[int]:
    """All differences of at most ``distance`` bits outside the segment."""
    others = [b for b in range(64) if not segment.shift <= b < segment.shift + segment.width]
    return [sum(1 << b for b in bits) for r in range(distance + 1) for bits in combinations(others, r)]


def near_duplicates(
    docs: DataFrame, shingle: int = 3, distance: int = 2, parts: int = 2, hot: int = 4096, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: ``(doc_id, fp, component_id)``.

    Documents whose fingerprints differ in at most ``distance`` bits are linked; ``component_id`` is the smallest doc_id
    that links reach. Documents with equal fingerprints are one node from the start, so a text with any number of copies
    costs as much as one. Null texts are empty texts; a null doc_id stays null and is no component's smallest id (a
    component of null ids only has a null component_id); repeated rows are returned as often as they come; extra
    columns are not read. An empty table gives an empty result.
    """
    return components(checkpoint(fingerprints(docs, shingle, doc_id, text)), distance, parts, hot)


def components(prints: DataFrame, distance: int = 2, parts: int = 2, hot: int = 4096) -> DataFrame:
    """:func:`near_duplicates` of fingerprints ``prints(doc_id, fp)`` that are there already, written or checkpointed."""
    nodes = checkpoint(prints.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")))
    roots = connected_components(links(nodes.select("fp"), distance, parts, hot))
    linked = nodes.join(roots.withColumnRenamed("node", "fp"), "fp")
    smallest = linked.groupBy("root").agg(F.min("rep").alias("component"))
    moved = linked.join(smallest, "root").select("fp", "component")
    of = checkpoint(nodes.join(moved, "fp", "left").select("fp", "n", F.coalesce("component", "rep").alias("component_id")))
    # Fingerprints of more than a thousandth of the rows, so at most 1000 of them, are joined by broadcast.
    often = of.where(F.col("n") * 1000 > prints.count()).select("fp", F.struct("component_id").alias("of"))
    known = prints.join(F.broadcast(often), "fp", "left")
    rest = known.where("of IS NULL").drop("of").join(of.where("n * 1000 <= " + str(prints.count())), "fp")
    return known.where("of IS NOT NULL").select("doc_id", "fp", "of.component_id").unionByName(rest.select("doc_id", "fp", "component_id"))
