"""How document filters interact: a Walsh-Hadamard audit of which documents fail which filters, over every order of them."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLANKS = r"[\x20\x09-\x0D]+"
#: The filter that needs the whole table: an equal text stands under a smaller id.
COPY = "E"


def text_filters(text: Column, least_words: int = 200, distinct_percent: int = 50, capital_percent: int = 2) -> dict[str, Column]:
    """Failure conditions of the filters that look at one text: few words, repeated words, capitals, marks."""
    words = F.array_remove(F.split(text, BLANKS, -1), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]", ""))
    return {
        "A": n < least_words,
        "B": 100 * distinct.cast("long") < distinct_percent * n.cast("long"),
        "C": 100 * capitals.cast("long") > capital_percent * F.length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]"),
    }


def failures(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column] | None = None) -> DataFrame:
    """How many documents of a part fail the same filters: ``(part, good, toxic, mask, n)``, several rows for one mask.

    Bit i of ``mask`` is the i-th filter by name; the last one is :data:`COPY`. Texts don't leave the scan: a row is its id, its
    part, the bits of its own text and the text's SHA-256. Rows meet their labels by id, equal rows are counted where they
    stand, and a text's copies are counted by part before the smallest id of the text is looked up, so copies of one text are
    never gathered. Rows without an id are spread by their texts.
    """
    text = F.coalesce("text", F.lit(""))
    own = filters or text_filters(text)
    bits = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(own.values())]
    mask = F.aggregate(F.array(*bits), F.lit(0), lambda a, b: a + b)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), mask.alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest")
    ).withColumn("spread", F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0).cast("long")))
    yes = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int")).alias(c)
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(yes("quality"), yes("toxic"))
    known = known.withColumn("none", F.lit(0).cast("long"))
    joined = rows.join(known, (F.col("doc_id") == F.col("id")) & (F.col("spread") == F.col("none")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    kind = ["digest", "part", "mask", "good", "toxic"]
    alike = joined.select("doc_id", "spread", "digest", "part", "mask", zero("quality").alias("good"), zero("toxic").alias("toxic")).groupBy("doc_id", "spread", *kind).agg(F.count(F.lit(1)).alias("c"))
    # Of rows with one text, part and labels: how many, how many without an id, the smallest id and its rows.
    counted = alike.groupBy(*kind).agg(
        F.sum("c").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("c")).otherwise(F.lit(0))).alias("nameless"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "c"))).alias("least"),
    )
    # One text has a row here for each part and label at most.
    met = counted.withColumn("first", F.min("least.doc_id").over(W.partitionBy("digest")))
    kept = F.col("nameless") + F.when(F.col("least.doc_id") == F.col("first"), F.col("least.c")).otherwise(F.lit(0))
    copy = F.lit(1 << len(own))
    both = F.array(F.struct(F.col("mask").alias("mask"), kept.alias("n")), F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - kept).alias("n")))
    return met.select("part", "good", "toxic", F.explode(both).alias("b")).select("part", "good", "toxic", "b.mask", "b.n").where("n > 0")


def _sign(a: int | Column, b: int | Column) -> Column:
    """-1 where ``a`` and ``b`` share an odd number of bits, else 1."""
    both = a.bitwiseAND(b) if isinstance(a, Column) else b.bitwiseAND(F.lit(a))
    return F.lit(1) - 2 * (F.bit_count(both) % 2)


def parity_sums(found: DataFrame, n_filters: int) -> DataFrame:
    """``(part, good, toxic, w)``: for each subset s of the filters, the sum of (-1)^|s and mask| over the documents.

    A row of numbers for each part and label: partial sums meet, whatever one part holds.
    """
    sums = [F.sum(_sign(s, F.col("mask")) * F.col("n")) for s in range(1 << n_filters)]
    return found.groupBy("part", "good", "toxic").agg(F.array(*sums).alias("w"))


def cells(sums: Column, n_filters: int) -> Column:
    """The number of documents of each mask, from the signed sums: the transform is its own inverse but for a factor."""
    size = 1 << n_filters
    every = F.sequence(F.lit(0), F.lit(size - 1))
    cell = lambda m: F.aggregate(F.transform(sums, lambda w, s: w * _sign(m, s)), F.lit(0).cast("long"), lambda a, b: a + b)
    return F.transform(every, lambda m: F.shiftright(cell(m), n_filters))


def _passing(cell: Column, subset: Column) -> Column:
    """Documents that fail no filter of ``subset``."""
    each = F.transform(cell, lambda n, m: F.when(m.bitwiseAND(subset) == 0, n).otherwise(F.lit(0).cast("long")))
    return F.aggregate(each, F.lit(0).cast("long"), lambda a, b: a + b)


def audit(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column] | None = None) -> DataFrame:
    """Every order of the filters, step by step, in every part:

    ``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``.

    ``docs`` holds ``doc_id, text, source``, ``labels`` ``doc_id, quality, toxic``; ``filters`` are failure conditions over one row by
    one-letter names before :data:`COPY`, :func:`text_filters` unless given. Signed parity sums are aggregated for each part
    and label and turned back into the counts of masks; orders are evaluated on those. A filter's Shapley share, times the number of
    orders, is a sum over the masks it is part of: each of its documents counts n!/(number of filters that it fails).

    Null texts are empty, a null source is the part with an empty name. A row fails the copy filter if its text stands in a row of a
    smaller id; rows without an id are nobody's smaller id and never fail it, repeated rows of one id don't make each other
    fail. Of several labels of an id, any 1 counts. Extra columns are not read; an empty table has no parts.
    """
    own = filters or text_filters(F.coalesce("text", F.lit("")))
    names = [*own, COPY]
    n = len(names)
    sums = parity_sums(failures(docs, labels, own), n)
    each = sums.select("part", "good", "toxic", cells(F.col("w"), n).alias("cell"))
    size = range(1 << n)
    total = lambda when: F.array(*[F.coalesce(F.sum(F.when(when, F.col("cell")[m])), F.lit(0).cast("long")) for m in size])
    parts = each.groupBy("part").agg(total(F.lit(True)).alias("every"), total(F.col("good") == 1).alias("good"), total(F.col("toxic") == 1).alias("toxic"))
    every = F.sequence(F.lit(0), F.lit((1 << n) - 1))
    passing = lambda c: F.transform(every, lambda s: _passing(F.col(c), s)).alias(f"p_{c}")
    share = lambda i: sum((F.col("every")[m] * (factorial(n) // m.bit_count()) for m in size if m >> i & 1), F.lit(0).cast("long"))
    table = parts.select("part", "every", *map(passing, ("every", "good", "toxic")), F.array(*[share(i) for i in range(n)]).alias("shares"))
    steps = []
    for order in permutations(range(n)):
        for k, i in enumerate(order):
            before = sum(1 << j for j in order[:k])
            steps.append(f"{''.join(names[j] for j in order)}:{k + 1}:{i}:{before}")
    number = lambda i: F.col("s")[i].cast("int")
    rows = table.select("*", F.explode(F.split(F.lit(",".join(steps)), ",")).alias("s")).withColumn("s", F.split("s", ":"))
    rows = rows.withColumns({"filter_order": F.col("s")[0], "step": number(1), "i": number(2), "before": number(3)})
    rows = rows.withColumn("bit", F.expr("shiftleft(1, i)")).withColumn("after", F.col("before") + F.col("bit"))
    at = lambda c, s: F.get(f"p_{c}", F.col(s))
    lost = lambda c: at(c, "before") - at(c, "after")
    fails = F.get("p_every", F.lit(0)) - at("every", "bit")
    return rows.select(
        "part", "filter_order", "step", at("every", "after").alias("kept"), lost("every").alias("removed"), (fails - lost("every")).alias("redundant"),
        F.get("every", F.col("bit")).alias("unique_fails"), lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), F.get("shares", F.col("i")).alias("shapley"),
    )
