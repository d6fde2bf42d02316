"""Near-duplicate removal by exact shingle similarity: SimHash links by multi-index hashing, verified on whole shingle sets, then a
prefix-filtered self-join for the links between texts whose fingerprints lie further apart."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import simhash
from .common import checkpoint, fresh, map_batches, observed, release, texts_of
from .components import connected_components

SEED = 42
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_CACHE = 200_000


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, as in op10."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text: str, shingle: int = 5) -> set[tuple[bytes, ...]]:
    """The different shingles; a shorter text is one shingle, an empty one has none."""
    words = words_of(text)
    return set(zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else {tuple(words)} if words else set()


def similarity(a: set, b: set) -> float:
    """Jaccard similarity; two empty sets are equal."""
    return len(a & b) / len(a | b) if a or b else 1.0


def tokens(words: list[bytes], shingle: int, cache: dict[bytes, int]) -> np.ndarray:
    """64-bit hashes of the different shingles, ascending."""
    if not words:
        return np.zeros(0, np.uint64)
    if len(cache) > _CACHE:
        cache.clear()
    codes = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        c = cache.get(w)
        if c is None:
            c = cache[w] = xxhash.xxh64_intdigest(w, SEED)
        codes[i] = c
    n = max(len(words) - shingle + 1, 1)
    h = np.full(n, min(len(words), shingle), np.uint64)
    for i in range(min(shingle, len(words))):
        h = h * _MULTIPLIER + codes[i : i + n]
        h ^= h >> np.uint64(29)
    return np.unique(h * _MULTIPLIER)


def least_common(n: int, share: float) -> int:
    return math.ceil(share * n - 1e-9)


def frequent_tokens(docs: DataFrame, shingle: int, max_docs: int, max_tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of several different texts of a bounded sample, ascending, with their counts. They only order shingles."""
    share = min(1.0, max_docs / max(docs.count(), 1))
    sample = docs.where(F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        cache: dict[bytes, int] = {}
        for text in texts_of(batch):
            words = words_of(text)
            found = tokens(words, shingle, cache)
            node = xxhash.xxh64_intdigest(b" ".join(words), SEED)
            yield {"token": pa.array(found.view(np.int64)), "node": pa.array(np.full(len(found), node, np.uint64).view(np.int64))}

    seen = map_batches(sample.select("text"), "token long, node long", run).distinct()
    rows = seen.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 2").orderBy(F.desc("n"), "token").limit(max_tokens).collect()
    keys = np.array([r["token"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.array([r["n"] for r in rows], np.int64)[order]


def prefixes(docs: DataFrame, shingle: int, share: float, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``(doc_id, row, node, n, prefix, rare, bits, fp)``: the node of a row's words, its number of shingles and their rarest
    ones, of which the first ``rare`` are not among the frequent ones, a bitmap of 1024 places for all of them, and the SimHash.

    Shingles stand in one order for all texts, rare ones first. Sets of similarity ``share`` or more have a shingle in
    common among the first ``n - ceil(share * n) + 1`` of each, whatever the order.
    """
    keys, counts = frequent

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        cache: dict[bytes, int] = {}
        nodes, sizes, prefix, rare, bits, prints = [], [], [], [], [], []
        for text in texts_of(batch):
            words = words_of(text)
            found = tokens(words, shingle, cache)
            often = np.zeros(len(found), np.int64)
            if len(keys) and len(found):
                at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                often = np.where(keys[at] == found, counts[at], 0)
                found = found[np.argsort(often, kind="stable")]
            n = len(found)
            rare.append(int((often == 0).sum()))
            places = np.zeros(1024, np.uint8)
            places[(found >> np.uint64(54)).astype(np.int64)] = 1
            bits.append(np.packbits(places).view(np.int64))
            prints.append(simhash.fingerprint(text, shingle))
            nodes.append(xxhash.xxh64_intdigest(b" ".join(words), SEED))
            sizes.append(n)
            prefix.append(found[: n - least_common(n, share) + 1].view(np.int64))
        yield {"doc_id": batch.column(0), "row": batch.column(1), "node": pa.array(np.array(nodes, np.uint64).view(np.int64)), "n": sizes, "prefix": pa.array(prefix, pa.list_(pa.int64())), "rare": rare, "bits": pa.array(bits, pa.list_(pa.int64())), "fp": pa.array(np.array(prints, np.uint64).view(np.int64))}

    return map_batches(docs, "doc_id long, row long, node long, n int, prefix array<long>, rare int, bits array<long>, fp long", run)


#: Numbers that give a bucket's members further orders; the first in an order is a pivot.
_ORDERS = tuple((i * 0x9E3779B97F4A7C15 & 0x7FFFFFFFFFFFFFFF) for i in range(1, 13))


def _ordered(left: Column, right: Column) -> list[Column]:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def buckets(nodes: DataFrame) -> DataFrame:
    """``(token, texts, node)``: the prefix shingles that several of ``nodes(node, prefix, rare)`` have, and how many.

    Rare shingles are counted where one shuffle has brought their entries together. Frequent ones are counted with partial
    sums, and the counts, one for each frequent shingle of the sample at most, are broadcast.
    """
    entry = nodes.select("node", "rare", F.posexplode("prefix").alias("pos", "token"))
    rare = entry.where("pos < rare").select("token", "node").withColumn("texts", F.count(F.lit(1)).over(W.partitionBy("token")))
    often = entry.where("pos >= rare").select("token", "node")
    counted = often.join(F.broadcast(often.groupBy("token").agg(F.count(F.lit(1)).alias("texts"))), "token")
    return checkpoint(rare.select("token", "texts", "node").unionByName(counted.select("token", "texts", "node")).where("texts > 1"))


def pairs_of_small(entries: DataFrame, small: int) -> DataFrame:
    """All pairs ``(a, b)``, with repeats, of buckets of at most ``small`` texts: less than ``small / 2`` for each entry."""
    some = entries.where(F.col("texts") <= small)
    on = (F.col("x.token") == F.col("y.token")) & (F.col("x.node") < F.col("y.node"))
    return some.alias("x").join(some.alias("y"), on).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def pairs_with_pivots(entries: DataFrame, orders: Sequence[int]) -> DataFrame:
    """Pairs ``(a, b)``, with repeats, of the members of each of ``entries(token, node)``'s buckets with the bucket's pivots.

    A pivot is the first member in an order of all nodes, so that buckets with the same members have the same one.
    """
    first = [F.min(F.col("node").bitwiseXOR(F.lit(c))).alias(f"p{i}") for i, c in enumerate(orders)]
    pivots = entries.groupBy("token").agg(*first).select("token", F.array(*[F.col(f"p{i}").bitwiseXOR(F.lit(c)) for i, c in enumerate(orders)]).alias("pivots"))
    met = entries.join(pivots, "token").select("node", F.explode(F.array_distinct("pivots")).alias("pivot")).where("node <> pivot")
    return met.select(*_ordered(F.col("node"), F.col("pivot")))


def plausible(x: str, y: str, share: float) -> Column:
    """Whether the ``n`` and ``bits`` of two sides allow similarity ``share``.

    Each place that only one bitmap has stands for a shingle that only one set has, and sets that similar differ in at most
    ``(1 - share) / (1 + share)`` of their added sizes.
    """
    n_x, n_y = F.col(f"{x}n"), F.col(f"{y}n")
    apart = F.aggregate(F.zip_with(f"{x}bits", f"{y}bits", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, k: s + k)
    sizes = F.least(n_x, n_y) >= F.lit(share) * F.greatest(n_x, n_y) - 1e-6
    return sizes & (apart <= F.lit((1 - share) / (1 + share)) * (n_x + n_y) + 1e-6)


def pairs_by_index(nodes: DataFrame, distance: int) -> DataFrame:
    """Pairs ``(a, b)`` of each of ``nodes(node, fp)`` with the first one of its SimHash or, for that one, of the smallest SimHash near by.

    Multi-index hashing finds what is near by. One pair a node at most, however many fingerprints lie close together; the
    pairs alone connect every node with the smallest SimHash around it, so no components of fingerprints are made.
    """
    prints, _ = observed(nodes.groupBy("fp").agg(F.min("node").alias("first")))
    least = simhash.links(prints.select("fp"), distance).groupBy(F.col("b").alias("fp")).agg(F.min("a").alias("near"))
    near = least.join(prints.select(F.col("fp").alias("near"), F.col("first").alias("up")), "near").select("fp", "up")
    of = nodes.select("node", "fp").join(prints.join(near, "fp", "left"), "fp")
    other = of.select("node", F.when(F.col("node") == F.col("first"), F.col("up")).otherwise(F.col("first")).alias("other"))
    pairs, _ = observed(other.where("other IS NOT NULL").select(*_ordered(F.col("node"), F.col("other"))))
    release(prints)
    return pairs


def with_components(pairs: DataFrame, component: DataFrame) -> DataFrame:
    """``pairs(a, b)`` with the components of both sides, ``of_a`` and ``of_b``."""
    moved = component.where("node <> component")
    side = lambda s: moved.select(F.col("node").alias(s), F.col("component").alias(f"of_{s}"))
    both = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return both.select("a", "b", F.coalesce("of_a", "a").alias("of_a"), F.coalesce("of_b", "b").alias("of_b"))


def pairs_apart(pairs: DataFrame, component: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sides are in different components."""
    return with_components(pairs, component).where("of_a <> of_b").select("a", "b")


def open_buckets(entries: DataFrame, component: DataFrame) -> DataFrame:
    """``(token, node, component, major)`` of the buckets whose members are in several components; ``major`` is the largest."""
    of = entries.join(component, "node").select("token", "node", "component")
    sizes = of.groupBy("token", "component").agg(F.count(F.lit(1)).alias("n"))
    several = sizes.groupBy("token").agg(F.max_by("component", "n").alias("major"), F.count(F.lit(1)).alias("k")).where("k > 1").select("token", "major")
    return observed(of.join(several, "token"))[0]


def pairs_across(found: DataFrame, nodes: DataFrame, share: float) -> DataFrame:
    """All :func:`plausible` pairs ``(a, b)`` of members of different components in :func:`open_buckets`.

    One side is always outside the bucket's largest component, so a bucket whose texts are mostly linked gives few, and
    the join itself leaves out pairs that sizes and bitmaps rule out.
    """
    found = found.join(nodes.select("node", "n", "bits"), "node")
    x, y = found.where("component <> major").alias("x"), found.alias("y")
    once = (F.col("y.component") == F.col("y.major")) | (F.col("x.node") < F.col("y.node"))
    on = (F.col("x.token") == F.col("y.token")) & (F.col("x.component") != F.col("y.component")) & once & plausible("x.", "y.", share)
    return x.join(y, on).select(*_ordered(F.col("x.node"), F.col("y.node"))).distinct()


def few_nodes(pairs: DataFrame, count: int, nodes: DataFrame) -> DataFrame:
    """``(node, row, n, bits, shorts, more)`` of those ``nodes`` that the ``count`` rows of ``pairs(a, b)`` name, for :func:`possible`.

    Of a shingle of the prefix 16 bits are kept; ``more`` of them are not told apart by these.
    """
    named = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    # A table of few ids is broadcast, so that the arrays of other nodes are not shuffled for the selection.
    some = nodes.join(F.broadcast(named) if count <= 500_000 else named, "node", "left_semi")
    shorts = F.array_distinct(F.transform("prefix", lambda t: F.shiftright(F.shiftleft(t, 16), 48).cast("smallint")))
    some = some.select("node", "row", "n", "bits", F.size("prefix").alias("all"), shorts.alias("shorts"))
    return observed(some.select("node", "row", "n", "bits", "shorts", (F.col("all") - F.size("shorts")).alias("more")))[0]


def possible(pairs: DataFrame, some: DataFrame, share: float) -> DataFrame:
    """Those of ``pairs(a, b)`` that the sizes, bitmaps and prefixes of their :func:`few_nodes` do not rule out.

    Common shingles up to the end of the prefix that ends first stand in both prefixes; so the overlap is at most the
    number of shingles that the prefixes share and what the longer remainder holds. Of a shingle 16 bits go to its pair: shingles
    of one prefix that these don't tell apart may all be shared, so as many are added.
    """
    short = lambda s: some.select(F.col("node").alias(s), F.col("n").alias(f"{s}_n"), F.col("bits").alias(f"{s}_bits"))
    sized, _ = observed(pairs.join(short("a"), "a").join(short("b"), "b").where(plausible("a_", "b_", share)).select("a", "b", F.col("a_n").alias("n_a"), F.col("b_n").alias("n_b")))
    side = lambda s: some.select(F.col("node").alias(s), F.col("shorts").alias(f"shorts_{s}"), F.col("more").alias(f"more_{s}"))
    both = sized.join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("shorts_a", "shorts_b")) + F.least("more_a", "more_b")
    remainder = F.ceil(F.lit(share) * F.greatest("n_a", "n_b") - 1e-9) - 1
    overlap = F.lit(share / (1 + share)) * (F.col("n_a") + F.col("n_b")) - 1e-6
    found, _ = observed(both.where(shared + remainder >= overlap).select("a", "b"))
    release(sized)
    return found


def similar_pairs(rows: DataFrame, nodes: DataFrame, pairs: DataFrame, shingle: int, share: float) -> DataFrame:
    """Those of ``pairs(a, b)`` whose texts, those of the nodes' ``row`` in ``rows(row, text)``, have similarity ``share``."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    asked, seen = observed(named.join(nodes.select("node", "row"), "node"))
    # A table of few ids is broadcast, so that the texts need no shuffle.
    few = F.broadcast(asked) if seen["n"] <= 200_000 else asked
    texts = checkpoint(rows.select("row", "text").join(few, "row").dropDuplicates(["node"]).select("node", "text"))
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        good, last, left = [], None, set()
        for first, second in zip(texts_of(batch, "text_a"), texts_of(batch, "text_b")):
            if first != last:
                last, left = first, shingle_set(first, shingle)
            good.append(similarity(left, shingle_set(second, shingle)) >= share)
        keep = pa.array(good, pa.bool_())
        yield {"a": batch.column(0).filter(keep), "b": batch.column(1).filter(keep)}

    found, _ = observed(map_batches(both.select("a", "b", "text_a", "text_b"), "a long, b long", run))
    release(asked, texts)
    return found


def similar_components(rows: DataFrame, nodes: DataFrame, shingle: int, share: float, small: int = 2, rounds: int = 2, distance: int = 2) -> DataFrame:
    """``(node, component)``: which of ``nodes(node, row, n, prefix, rare, bits, fp)`` links of similarity ``share`` or more join.

    Only components are asked for, so a group of any number of similar texts need not be expanded into pairs. First come the
    links of fingerprints within ``distance`` bits, each text verified against one near by. What these leave apart is found by prefix
    shingles. Buckets of at most ``small`` texts give all their pairs. Larger ones first give pairs with a few pivots, in ``rounds`` rounds over
    those whose members are still in several components; at last the pairs across the components that are left. A pair
    is left out only if both of its texts are in one component already, so no component is missed.
    """
    entries = buckets(nodes)
    large = entries.where(F.col("texts") > small)

    def verified(pairs: DataFrame) -> DataFrame:
        candidates, seen = observed(pairs)
        some = few_nodes(candidates, seen["n"], nodes)
        able = possible(candidates, some, share)
        links = similar_pairs(rows, some, able, shingle, share)
        release(candidates, some, able)
        return links

    def added(component: DataFrame, links: DataFrame) -> DataFrame:
        """The components with further links, each component taken as one node."""
        if not links.head(1):
            return component
        between = with_components(links, component).select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
        roots = connected_components(between).select(F.col("node").alias("component"), "root")
        both, _ = observed(component.join(roots, "component", "left").select("node", F.coalesce("root", "component").alias("component")))
        release(component, links)
        return both

    close = pairs_by_index(nodes, distance)
    alone, _ = observed(nodes.select("node", F.col("node").alias("component")))
    component = added(alone, verified(close))
    release(close)
    first = pairs_of_small(entries, small).union(pairs_with_pivots(large, _ORDERS[:1])).distinct()
    component = added(component, verified(pairs_apart(first, component)))
    for r in range(1, rounds + 1):
        found = open_buckets(large, component)
        if found.head(1):
            if r == rounds:
                more = pairs_across(found, nodes, share)
            else:
                orders = _ORDERS[2 * r : 2 * r + 2]
                inside, outside = found.where("component = major"), found.where("component <> major")
                first = inside.groupBy("token").agg(F.min(F.col("node").bitwiseXOR(F.lit(orders[0]))).bitwiseXOR(F.lit(orders[0])).alias("pivot"))
                with_major = outside.join(first, "token").select(*_ordered(F.col("node"), F.col("pivot")))
                more = with_major.union(pairs_with_pivots(outside, orders)).distinct()
            component = added(component, verified(more))
        release(found)
    release(entries)
    return component


def drop_similar(docs: DataFrame, shingle: int = 5, share: float = 0.8, max_docs: int = 4000, max_tokens: int = 200_000, **options) -> DataFrame:
    """``docs`` with one row of each group of texts linked by shingle similarity ``share`` or more.

    The row with the smallest doc_id stays, null ids last, ties by a hash of the row; rows equal in all columns are one.
    Every group is found whole: the prefix filter rules out no pair that reaches ``share``, and candidates are verified on
    the words themselves. Texts of the same words are one node from the start; null texts count as empty; extra columns
    stay, whatever their names. Sample sizes only change the order of shingles, so the cost, not the result.
    """
    # Maps can't be hashed; their JSON text can.
    row = F.xxhash64(*[F.to_json(F.struct(f"`{c}`")) if "map<" in kind else F.col(f"`{c}`") for c, kind in docs.dtypes])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row.alias("row"), "text")
    frequent = frequent_tokens(rows, shingle, max_docs, max_tokens)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    of_node = [F.first(c).alias(c) for c in ("n", "prefix", "rare", "bits", "fp")]
    prints = checkpoint(prefixes(rows, shingle, share, frequent).groupBy("node").agg(best.alias("best"), *of_node))
    nodes = prints.select("node", "best", F.col("best.row").alias("row"), "n", "prefix", "rare", "bits", "fp")
    component = similar_components(rows, nodes, shingle, share, **options)
    of = nodes.select("node", "best").join(component, "node")
    best_row = of.groupBy("component").agg(F.min("best").alias("best"))
    again = rows.groupBy("doc_id", "row").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    i, r, kept_i, kept_r, repeated = fresh(docs, "__i", "__r", "__kept_i", "__kept_r", "__repeated")
    again = again.select(F.col("doc_id").alias(i), F.col("row").alias(r))
    kept = best_row.select(F.col("best.doc_id").alias(kept_i), F.col("best.row").alias(kept_r))
    same = F.col(kept_i).eqNullSafe(F.col(i)) & (F.col(kept_r) == F.col(r))
    kept = checkpoint(kept.join(again, same, "left").select(kept_i, kept_r, F.col(r).isNotNull().alias(repeated)))
    release(prints, component)
    joined = docs.withColumn(i, F.col("doc_id").cast("long")).withColumn(r, row).join(kept, same)
    own = [F.col(f"`{c}`") for c in docs.columns]
    once = joined.where(~F.col(repeated)).select(*own)
    one = joined.where(F.col(repeated)).dropDuplicates([i, r]).select(*own)
    return once.unionByName(one)
