"""Outlines by scan against one walk with a stack: random stretches, documents over several partitions, a million entries."""

import random
from collections import Counter

from pyspark.sql import functions as F

from folioforge.operators import outline, toc

TOC = "source_slug string, ord int, level int, title string, start_page int"


def walk_outline(levels, starts, pad_width):
    """``(depth, number, parent's number, plain number, is leaf, start of the next entry that is as shallow)`` of each entry.

    One walk with a stack of the open entries, one for each depth; any depth. Numbers are padded to the width of their
    largest sibling, ``pad_width`` at least.
    """
    parents, places, depths, siblings, nexts = [], [], [], Counter(), [None] * len(levels)
    still: list[int] = []
    for k, level in enumerate(levels):
        depth = min(max(level, 1), len(still) + 1)
        for done in still[depth - 1 :]:
            nexts[done] = starts[k]
        del still[depth - 1 :]
        parent = still[-1] if still else -1
        siblings[parent] += 1
        parents.append(parent)
        places.append(siblings[parent])
        depths.append(depth)
        still.append(k)
    numbers, plain = [], []
    for k, (parent, place) in enumerate(zip(parents, places)):
        part = str(place).rjust(max(pad_width, len(str(siblings[parent]))), "0")
        numbers.append(part if parent < 0 else f"{numbers[parent]}.{part}")
        plain.append(str(place) if parent < 0 else f"{plain[parent]}.{place}")
        yield depths[k], numbers[k], None if parent < 0 else numbers[parent], plain[k], k not in siblings, nexts[k]


def test_merged_stretches_equal_one_walk():
    rng = random.Random(1)
    for _ in range(3000):
        n = rng.randint(1, 14)
        levels, starts = [rng.randint(-1, 5) for _ in range(n)], [rng.choice([None, *range(20)]) for _ in range(n)]
        cuts = sorted(rng.sample(range(1, n), min(n - 1, rng.randint(0, 3)))) if n > 1 else []
        parts, depth, depths = list(zip([0, *cuts], [*cuts, n])), 0, []
        for a, b in parts:
            found, reach = outline.depths_of(levels[a:b], depth)
            assert reach.after(depth) == found[-1]
            depth = found[-1]
            depths.append(found)
        open_, ahead = [[]], [[]]
        for d in depths:
            open_.append(outline.steps_of(d).after(open_[-1]))
        for d, (a, b) in zip(reversed(depths), reversed(parts)):
            ahead.insert(0, outline.back_of(d, starts[a:b]).before(ahead[0]))
        got = [r for i, (d, (a, b)) in enumerate(zip(depths, parts)) for r in outline.finish(d, starts[a:b], open_[i], ahead[i + 1], 1)]
        assert got == list(walk_outline(levels, starts, 1))


def rows_of(frame):
    return sorted((r.source_slug, r.k, r.eff, r.toc_number, r.parent_number, r.plain, r.is_leaf, r.next_page) for r in frame.collect())


def test_documents_over_partitions_equal_one_walk(spark):
    """Documents within a partition, at its edges, over several, and alone in one."""
    rng = random.Random(2)
    docs = {f"d{i:02}": rng.choice([1, 2, 5, 40, 300]) for i in range(25)} | {"z": 1}
    rows = [(s, 3 * i, rng.choice([None, 0, 1, 1, 2, 3, 4, 9]), "t", rng.choice([None, *range(50)])) for s, n in docs.items() for i in range(n)]
    want = []
    for s in docs:
        own = [r for r in rows if r[0] == s]
        want += [(s, k, *x) for k, x in enumerate(walk_outline([1 if r[2] is None else r[2] for r in own], [r[4] for r in own], 2))]
    rng.shuffle(rows)
    frame = spark.createDataFrame([*rows, (None, 1, 1, "t", 1)], TOC)
    for tasks in (1, 7, 40):
        walked = outline.walk(frame, 2, tasks)
        assert rows_of(walked) == sorted(want), tasks
    assert outline.walk(frame.limit(0)).count() == 0


def test_a_million_entries_of_one_document(spark):
    """Many tasks for one document; numbers, ends and leaves as by one walk."""
    n, level = 1_000_000, F.expr("CASE WHEN id % 1000 = 0 THEN 1 WHEN id % 10 = 0 THEN 2 ELSE 3 + id % 2 END")
    frame = spark.range(n).select(F.lit("s").alias("source_slug"), F.col("id").alias("ord"), level.alias("level"), F.lit("t").alias("title"), (F.col("id") % 977).cast("int").alias("start_page"))
    walked = outline.walk(frame, 2, 8)
    levels = [1 if i % 1000 == 0 else 2 if i % 10 == 0 else 3 + i % 2 for i in range(n)]
    want, sample = walk_outline(levels, [i % 977 for i in range(n)], 2), {}
    for k, x in enumerate(want):
        if k % 4999 == 0 or k > n - 50 or k % 125_000 < 3:
            sample[k] = (x[1], x[2], x[4], x[5])
    got = walked.where(F.col("k").isin(*sample)).withColumn("task", F.spark_partition_id()).collect()
    assert {r.k: (r.toc_number, r.parent_number, r.is_leaf, r.next_page) for r in got} == sample
    assert len({r.task for r in got}) > 1


def test_sections_of_many_tasks_have_pages(spark):
    rows = [("s", i, i % 3 + 1, f"t{i}", i + 1) for i in range(90)]
    frame, pages = spark.createDataFrame(rows, TOC), spark.createDataFrame([("s", 95)], "source_slug string, page_count int")
    one, many = (sorted(map(tuple, toc.build_sections(frame, pages, tasks=n).collect())) for n in (1, 9))
    assert one == many and one[-1][-2:] == (90, 95)
