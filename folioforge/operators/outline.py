"""Outlines as a scan: numbers, leaves and ends of sections for documents of any size and depth, in many tasks.

Entries lie sorted by document and place over range partitions, so a document may go through several of them. What a stretch of
entries does to what comes behind it, or stands before it, is a summary of the size of the open sections, and summaries of neighbours
merge into one. Each partition sums up its first and last document (all others lie inside it), the driver merges these few summaries
along the partitions, and a last pass works out each entry with what came in from the left and from the right.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import astuple, dataclass

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import checkpoint

#: The open sections, the outermost first: their places among siblings.
Places = list[int]
#: What comes behind, by depth: siblings still to come before a shallower entry, and the start of the next entry that is as shallow.
Ahead = list[tuple[int, "int | None"]]


@dataclass(frozen=True)
class Reach:
    """What a stretch does to the depth before it: of n entries, the last has depth min(before + n, most)."""

    n: int
    most: int

    def after(self, depth: int) -> int:
        return min(depth + self.n, self.most)


@dataclass(frozen=True)
class Steps:
    """What a stretch does to the open sections: all up to its shallowest depth stay, ``n`` siblings come at that depth, below
    it ``tail`` is open."""

    least: int
    n: int
    tail: Places

    def after(self, open_: Places) -> Places:
        at = open_[self.least - 1] if len(open_) >= self.least else 0
        return [*open_[: self.least - 1], at + self.n, *self.tail]


@dataclass(frozen=True)
class Back:
    """The same from the right: ``n`` entries of the shallowest depth, the first of them with ``start``, deeper ones before it."""

    least: int
    n: int
    start: int | None
    tail: Ahead

    def before(self, ahead: Ahead) -> Ahead:
        at = ahead[self.least - 1][0] if len(ahead) >= self.least else 0
        return [*_filled(ahead, self.least - 1), (at + self.n, self.start), *self.tail]


def _filled(ahead: Ahead, depth: int) -> Ahead:
    """Up to ``depth``; a depth without an entry of its own has the start of the next shallower one."""
    return [*ahead[:depth], *[(0, ahead[-1][1] if ahead else None)] * (depth - len(ahead))]


def depths_of(levels: Sequence[int], before: int = 0) -> tuple[list[int], Reach]:
    """The depth of each entry, at least 1 and at most one below its predecessor's, and what the stretch does to others."""
    out, depth, most = [], before, len(levels)
    for i, level in enumerate(levels):
        depth = min(max(level, 1), depth + 1)
        out.append(depth)
        most = min(most + 1, max(level, 1)) if i else max(level, 1)
    return out, Reach(len(levels), most)


def steps_of(depths: Sequence[int]) -> Steps:
    """The forward summary of a stretch of entries with known depths."""
    least = min(depths)
    n, tail = 0, []
    for d in depths:
        if d == least:
            n, tail = n + 1, []
        elif n:
            # Behind the first shallowest entry depths rise by one at most, so there are no gaps.
            tail = [*tail[: d - least - 1], (tail[d - least - 1] if len(tail) >= d - least else 0) + 1]
    return Steps(least, n, tail)


def back_of(depths: Sequence[int], starts: Sequence[int | None]) -> Back:
    """The backward summary."""
    least = min(depths)
    n, start, tail = 0, None, []
    for d, s in zip(reversed(depths), reversed(starts)):
        if d == least:
            n, start, tail = n + 1, s, []
        elif n:
            known = _filled([(0, start), *tail], d - least)
            tail = [*known[1:], ((tail[d - least - 1][0] if len(tail) >= d - least else 0) + 1, s)]
    return Back(least, n, start, tail)


def finish(depths: Sequence[int], starts: Sequence[int | None], open_: Places, ahead: Ahead, pad_width: int) -> Iterator[tuple[int, str, str | None, str, bool, int | None]]:
    """``(depth, number, parent's number, plain number, is leaf, start of the next entry that is as shallow)`` of each entry.

    ``open_`` came in from the left, ``ahead`` from the right. Numbers are padded to the width of their largest sibling,
    ``pad_width`` at least; the number of siblings is what came and what is to come.
    """
    left, nexts, leaf = [0] * len(depths), [None] * len(depths), [True] * len(depths)
    ahead = list(ahead)
    for i in range(len(depths) - 1, -1, -1):
        d = depths[i]
        leaf[i] = len(ahead) <= d
        if ahead:
            nexts[i] = ahead[min(d, len(ahead)) - 1][1]
        if len(ahead) >= d:
            left[i] = ahead[d - 1][0]
            del ahead[d:]
            ahead[d - 1] = (left[i] + 1, starts[i])
        else:
            ahead.extend(_filled(ahead, d - 1)[len(ahead) :])
            ahead.append((1, starts[i]))
    pad = lambda place, more: str(place).rjust(max(pad_width, len(str(place + more))), "0")
    places = list(open_)
    numbers, plain = [""], [""]
    for i, place in enumerate(places):
        more = ahead[i][0] if i < len(ahead) else 0
        numbers.append(f"{numbers[-1]}.{pad(place, more)}".lstrip("."))
        plain.append(f"{plain[-1]}.{place}".lstrip("."))
    for i, d in enumerate(depths):
        place = places[d - 1] + 1 if len(places) >= d else 1
        del places[d - 1 :], numbers[d:], plain[d:]
        places.append(place)
        part = pad(place, left[i])
        numbers.append(f"{numbers[-1]}.{part}" if d > 1 else part)
        plain.append(f"{plain[-1]}.{place}" if d > 1 else str(place))
        yield d, numbers[d], numbers[d - 1] if d > 1 else None, plain[d], leaf[i], nexts[i]


@dataclass(frozen=True)
class Entries:
    """The entries of one document in one partition."""

    slug: str
    levels: list[int]
    starts: list[int | None]
    rows: pd.DataFrame


def _stretches(frames: Iterator[pd.DataFrame]) -> list[Entries]:
    whole = [f for f in frames if len(f)]
    if not whole:
        return []
    frame = pd.concat(whole, ignore_index=True)
    slugs = frame["source_slug"].to_numpy()
    cuts = [0, *(i for i in range(1, len(slugs)) if slugs[i] != slugs[i - 1]), len(slugs)]
    number = lambda c, a, b: [None if pd.isna(x) else int(x) for x in frame[c].iloc[a:b]]
    return [Entries(slugs[a], [1 if x is None else x for x in number("level", a, b)], number("start_page", a, b), frame.iloc[a:b]) for a, b in zip(cuts, cuts[1:])]


def _summaries(entries: DataFrame, sum_up: Callable[[int, Entries], object]) -> list[tuple[int, str, bool, object]]:
    """``(partition, document, is it the partition's first)`` and a summary, for the first and the last document of each partition.

    Two rows a partition come to the driver, each of the size of the open sections.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, own = TaskContext.get().partitionId(), _stretches(frames)
        rows = [(part, s.slug, first, json.dumps(sum_up(part, s))) for s, first in ((own[0], True), (own[-1], False))] if own else []
        yield pd.DataFrame(rows, columns=["part", "slug", "first", "summary"])

    found = entries.mapInPandas(run, "part int, slug string, first boolean, summary string").collect()
    return [(r["part"], r["slug"], r["first"], json.loads(r["summary"])) for r in sorted(found, key=lambda r: (r["part"], not r["first"]))]


def _carried(summaries: list[tuple[int, str, bool, object]], nothing: object, apply: Callable[[object, object], object], single: set[int], leftwards: bool = False) -> dict[int, object]:
    """What comes into each partition from its neighbours, for the document at the edge that they share."""
    came, running, of = {}, nothing, None
    for part, slug, first, summary in reversed(summaries) if leftwards else summaries:
        # The edge that is met first takes what was carried; a partition of one document hands it on, merged.
        meets = first != leftwards
        if meets:
            came[part] = running if of == slug else nothing
            if part in single:
                running, of = apply(summary, came[part]), slug
        elif part not in single:
            running, of = apply(summary, nothing), slug
    return came


def walk(entries: DataFrame, pad_width: int = 2, tasks: int | None = None) -> DataFrame:
    """Each entry of ``entries(source_slug, ord, level, title, start_page)`` with its place in its document's outline:

    ``(source_slug, k, eff, toc_number, parent_number, plain, is_leaf, title, start_page, next_page)``, ``k`` from 0. Three passes over a
    checkpoint of the sorted entries; a task holds one partition. A null level is 1; rows without a document are left out.
    """
    by = [F.col("source_slug"), F.col("ord")]
    named = entries.where("source_slug IS NOT NULL").select("source_slug", "ord", "level", "title", F.col("start_page").cast("int").alias("start_page"))
    dealt = named.repartitionByRange(tasks, *by) if tasks else named.repartitionByRange(*by)
    lying = checkpoint(dealt.sortWithinPartitions(*by))

    def reach(part: int, s: Entries) -> tuple:
        return astuple(depths_of(s.levels)[1])

    found = _summaries(lying, reach)
    # A document is met at both edges of a partition that holds nothing else: a partition has one stretch of each document.
    single = {p for p, slug, first, _ in found if first and (p, slug, False) in {x[:3] for x in found}}
    depth = _carried(found, 0, lambda r, d: Reach(*r).after(d), single)
    before = _carried(found, 0, lambda r, k: k + r[0], single)
    first_of = {p: slug for p, slug, first, _ in found if first}
    last_of = {p: slug for p, slug, first, _ in found if not first}

    def both(part: int, s: Entries) -> tuple:
        depths = depths_of(s.levels, depth[part] if first_of[part] == s.slug else 0)[0]
        return astuple(steps_of(depths)), astuple(back_of(depths, s.starts))

    edges = _summaries(lying, both)
    open_ = _carried([(p, s, f, b[0]) for p, s, f, b in edges], [], lambda x, state: Steps(*x).after(state), single)
    ahead = _carried([(p, s, f, b[1]) for p, s, f, b in edges], [], lambda x, state: Back(*x).before(state), single, leftwards=True)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        for s in _stretches(frames):
            left, right = s.slug == first_of[part], s.slug == last_of[part]
            depths = depths_of(s.levels, depth[part] if left else 0)[0]
            rows = finish(depths, s.starts, open_[part] if left else [], ahead[part] if right else [], pad_width)
            walked = pd.DataFrame(rows, columns=["eff", "toc_number", "parent_number", "plain", "is_leaf", "next_page"], dtype=object)
            k = before[part] if left else 0
            yield walked.assign(source_slug=s.slug, k=range(k, k + len(walked)), title=s.rows["title"].to_numpy(), start_page=pd.Series(s.starts, dtype=object))[list(SHAPE)]

    return lying.mapInPandas(run, ", ".join(f"{c} {t}" for c, t in SHAPE.items()))


SHAPE = {
    "source_slug": "string", "k": "int", "eff": "int", "toc_number": "string", "parent_number": "string", "plain": "string", "is_leaf": "boolean",
    "title": "string", "start_page": "int", "next_page": "int",
}
