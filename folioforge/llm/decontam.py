"""Benchmark decontamination: q-gram lemma filtering in diagonal bands, verified by banded alignment."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, map_batches, rewrite_rows, texts_of

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
_FILTER_BITS = 22
_CHUNK = 1 << 18
_START_BITS = 20
#: Alignments whose tables advance together.
_TOGETHER = 512
#: Shared q-grams (places in texts times places in windows) that are looked at together.
_HITS = 1 << 20


def _fold_table() -> np.ndarray:
    """Lower case where it is one character, and a blank for white space; one code point stays one code point."""
    table = np.arange(0x10000, dtype=np.uint32)
    for c in range(0x10000):
        low = chr(c).lower()
        table[c] = ord(low) if len(low) == 1 else c
        if chr(c).isspace():
            table[c] = 32
    return table


_FOLD = _fold_table()


def folded(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes) or int(codes.max()) < 0x10000:
        return _FOLD[codes]
    low = codes < 0x10000
    return np.where(low, _FOLD[np.where(low, codes, 0)], codes)


def collapsed(text: str) -> tuple[str, np.ndarray]:
    """The text with one blank for each run of white space, and the source position of each of its characters."""
    blank = folded(text) == 32
    again = blank[1:] & blank[:-1]
    if not again.any():
        return text, np.arange(len(text))
    places = np.flatnonzero(np.append(True, ~again))
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)[places]
    return codes.tobytes().decode("utf-32-le", "surrogatepass"), places


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q characters from each position on, put together from hashes of 1, 2, 4, ... characters."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    span, part = 1, codes.astype(np.uint64)
    part *= _MULTIPLIER
    whole, done = None, 0
    while True:
        if q & span:
            piece = part[done : done + n]
            whole = piece.copy() if whole is None else whole * _MULTIPLIER + piece
            done += span
        span *= 2
        if span > q:
            break
        part = part[: len(part) - span // 2] * _MULTIPLIER + part[span // 2 :]
        part ^= part >> np.uint64(31)
    whole *= _MULTIPLIER
    return whole


@dataclass(frozen=True)
class Region:
    """A stretch of a text within the edit budget of a benchmark window."""

    item: int
    window: int
    start: int
    end: int
    edits: int


def _equal_stretch(pattern: np.ndarray, text: np.ndarray, origin: int, width: int) -> int:
    """The first place on the band's diagonals where the text equals the pattern, or -1: an alignment without edits."""
    lo = max(origin, 0)
    stretch, key = text[lo : origin + width - 1 + len(pattern)].tobytes(), pattern.tobytes()
    at = stretch.find(key)
    while at >= 0 and at % 4:
        at = stretch.find(key, at + 1)
    return lo + at // 4 if at >= 0 else -1


def banded_alignments(
    patterns: Sequence[np.ndarray], texts: Sequence[np.ndarray], origins: Sequence[int], width: int
) -> list[tuple[int, int, int]]:
    """Least edits of each pattern against any stretch of its text on diagonals ``origin .. origin + width - 1``.

    Patterns have one length. Returns ``(edits, start, end)`` each; of equal edits the earliest end, then the earliest start.
    Positions outside a text match nothing. All tables advance together, one row per pattern character; insertions along
    a row are a running minimum. A cell holds edits in its high bits and the start's diagonal in its low ones.
    """
    n, length = len(patterns), len(patterns[0])
    big = np.int64(1) << _START_BITS
    lanes = np.arange(width, dtype=np.int64)
    at = np.asarray(origins, np.int64)[:, None] + lanes[None, :]
    limit = np.array([len(t) for t in texts], np.int64)[:, None]
    padded = np.full((n, width + length), -1, np.int64)
    for row, (text, origin) in enumerate(zip(texts, origins)):
        lo, hi = max(origin, 0), min(origin + width + length, len(text))
        if hi > lo:
            padded[row, lo - origin : hi - origin] = text[lo:hi]
    signs = np.stack(patterns).astype(np.int64)
    never = big << 12
    cost = np.where((at >= 0) & (at <= limit), lanes[None, :], never)
    slope = lanes[None, :] * big
    for i in range(length):
        step = cost + np.where(padded[:, i : i + width] == signs[:, i : i + 1], 0, big)
        np.minimum(step[:, :-1], cost[:, 1:] + big, out=step[:, :-1])
        cost = np.minimum.accumulate(step - slope, axis=1) + slope
        ends = at + (i + 1)
        cost[(ends < 0) | (ends > limit)] = never
    best = np.argmin(cost >> _START_BITS, axis=1)
    values = cost[np.arange(n), best]
    return [(int(v) >> _START_BITS, o + (int(v) & int(big - 1)), o + length + int(j)) for v, o, j in zip(values, origins, best)]


def banded_alignment(pattern: np.ndarray, text: np.ndarray, origin: int, width: int) -> tuple[int, int, int]:
    """One pattern's :func:`banded_alignments`."""
    return banded_alignments([pattern], [text], [origin], width)[0]


class BenchmarkIndex:
    """Q-grams of the windows of benchmark items.

    An item is covered by windows of ``window`` characters, one every ``stride`` and one at its end, so that each stretch of
    ``window + stride - 1`` characters holds one; a shorter item is a window of its own, and one below ``min_chars`` is
    matched without edits between word boundaries. A window of w characters takes ``k = floor(rate * w)`` edits, fewer where the q-gram lemma would
    leave no bound; it then shares at least ``w + 1 - q * (k + 1)`` q-grams with any stretch within k edits, all on
    diagonals at most k apart.
    """

    def __init__(self, items: Sequence[str], q: int = 10, window: int = 70, stride: int = 20, rate: float = 0.08, min_chars: int = 40) -> None:
        self.q = q
        whole, starts_at, at = [], [], 0
        short: dict[int, list[tuple[int, np.ndarray]]] = {}
        owner, grams, gram_window, gram_at, sizes = [], [], [], [], []
        for i, item in enumerate(items):
            codes = folded(" ".join(item.split()))
            if len(codes) < max(min_chars, q):
                if any(chr(c).isalnum() for c in codes):
                    short.setdefault(len(codes), []).append((i, codes))
                continue
            starts = {0} if len(codes) <= window else {*range(0, len(codes) - window + 1, stride), len(codes) - window}
            for start in sorted(starts):
                pattern = codes[start : start + window]
                h = gram_hashes(pattern, q)
                grams.append(h)
                gram_window.append(np.full(len(h), len(owner), np.int32))
                gram_at.append(np.arange(len(h), dtype=np.int16))
                starts_at.append(at + start)
                sizes.append(len(pattern))
                owner.append(i)
            whole.append(codes)
            at += len(codes)
        self.owner = np.array(owner, np.int32)
        #: The items' characters one behind the other; a window is a stretch of them.
        self.codes = np.concatenate(whole) if whole else np.zeros(0, np.uint32)
        self.starts, widths = np.array(starts_at, np.int64), np.array(sizes, np.int64)
        self.widths = widths
        #: Short items by length: their hashes, ascending, with item, window number after the patterns and characters.
        self.short: dict[int, tuple[np.ndarray, list[tuple[int, int, np.ndarray]]]] = {}
        number = len(owner)
        for size, found in sorted(short.items()):
            rows = sorted(((int(gram_hashes(codes, size)[0]), i, number + k, codes) for k, (i, codes) in enumerate(found)), key=lambda r: r[:2])
            self.short[size] = np.array([r[0] for r in rows], np.uint64), [r[1:] for r in rows]
            number += len(found)
        self.edits = np.maximum(np.minimum((widths * rate).astype(np.int64), widths // q - 1), 0)
        self.needed = np.maximum(widths + 1 - q * (self.edits + 1), 1)
        self.step = int(self.edits.max()) + 1 if len(widths) else 1
        every = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.hashes, first = np.unique(every[order], return_index=True)
        self.first = np.append(first, len(every))
        self.of_window = (np.concatenate(gram_window) if grams else np.zeros(0, np.int32))[order]
        self.of_place = (np.concatenate(gram_at) if grams else np.zeros(0, np.int16))[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def pattern(self, window: int) -> np.ndarray:
        """The characters of a window."""
        return self.codes[self.starts[window] : self.starts[window] + self.widths[window]]

    def _candidates(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """``(window, band)`` pairs whose band holds enough shared q-grams; band b spans diagonals b*step .. (b+2)*step.

        The text is gone through in stretches whose q-grams have about ``_HITS`` places in windows, so that a passage of
        many items takes time but no more memory. A pair's count is carried on until the text is past its band.
        """
        h = gram_hashes(codes, self.q)
        at = np.flatnonzero(self.filter[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        place = np.searchsorted(self.hashes, h[at])
        good = place < len(self.hashes)
        at, place = at[good], place[good]
        good = self.hashes[place] == h[at]
        at, place = at[good], place[good]
        if not len(at):
            return
        hits = self.first[place + 1] - self.first[place]
        upto = np.cumsum(hits)
        mask, reach = np.int64((1 << 40) - 1), int(self.widths.max()) + 2 * self.step
        open_keys, open_counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        lo = 0
        while lo < len(at):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + _HITS, side="right")))
            n, frm, here = hits[lo:hi], self.first[place[lo:hi]], at[lo:hi]
            into = np.repeat(frm - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            # Diagonals count from a window's length before the text, so that none is negative.
            band = (np.repeat(here, n) - self.of_place[into] + 4096) // self.step
            key = (self.of_window[into].astype(np.int64) << np.int64(40)) | band
            keys, counts = np.unique(np.concatenate([key, key - 1]), return_counts=True)
            if len(open_keys):
                keys, back = np.unique(np.concatenate([open_keys, keys]), return_inverse=True)
                counts = np.bincount(back, np.concatenate([open_counts, counts])).astype(np.int64)
            past = (keys & mask) * self.step - 4096 + reach < at[hi] if hi < len(at) else np.ones(len(keys), bool)
            good = keys[past & (counts >= self.needed[keys >> np.int64(40)])]
            open_keys, open_counts = keys[~past], counts[~past]
            yield from zip((good >> np.int64(40)).tolist(), (good & mask).tolist())
            lo = hi

    def find(self, texts: Sequence[str]) -> list[list[Region]]:
        """For each text its regions, one for each window and place, in the order of item, window and start."""
        out: list[list[Region]] = [[] for _ in texts]
        for i, text in enumerate(texts if self.short else ()):
            out[i] = self._exact(folded(text))
        if not len(self.owner):
            return out
        group: list[tuple[int, np.ndarray]] = []
        held = 0
        for i, text in enumerate(texts):
            if len(text) < self.q:
                continue
            codes = folded(text)
            group.append((i, codes))
            held += len(codes) + self.q
            if held >= _CHUNK:
                self._search(group, out)
                group, held = [], 0
        self._search(group, out)
        return out

    def _exact(self, codes: np.ndarray) -> list[Region]:
        """The places of short items that no letter or digit continues."""
        out = []
        inside = lambda a, b: a >= 0 and b < len(codes) and chr(codes[a]).isalnum() and chr(codes[b]).isalnum()
        for size, (hashes, items) in self.short.items():
            h = gram_hashes(codes, size)
            first, last = np.searchsorted(hashes, h), np.searchsorted(hashes, h, side="right")
            for at in np.flatnonzero(last > first).tolist():
                if inside(at - 1, at) or inside(at + size - 1, at + size):
                    continue
                for item, window, signs in items[first[at] : last[at]]:
                    if np.array_equal(codes[at : at + size], signs):
                        out.append(Region(item, window, at, at + size, 0))
        return sorted(out, key=lambda r: (r.item, r.window, r.start))

    def find_in(self, texts: Sequence[str]) -> list[list[Region]]:
        """:func:`find` in texts whose runs of white space count as one blank; starts and ends are those of the source."""
        pairs = [collapsed(t) for t in texts]
        out = []
        for (_, places), regions in zip(pairs, self.find([t for t, _ in pairs])):
            source = lambda r: (int(places[max(r.start, 0)]), int(places[min(r.end, len(places)) - 1]) + 1)
            out.append([replace(r, start=a, end=b) for r in regions for a, b in [source(r)]])
        return out

    def _search(self, group: Sequence[tuple[int, np.ndarray]], out: list[list[Region]]) -> None:
        if not group:
            return
        gap = np.full(self.q, 0xFFFFFFFF, np.uint32)
        joined = np.concatenate([x for _, codes in group for x in (codes, gap)])
        starts = np.cumsum([0] + [len(codes) + self.q for _, codes in group])[:-1]
        seen: set[tuple[int, int, int]] = set()

        def keep(t: int, window: int, edits: int, start: int, end: int) -> None:
            if edits <= self.edits[window] and (t, window, end) not in seen:
                seen.add((t, window, end))
                out[group[t][0]].append(Region(int(self.owner[window]), window, start, end, edits))

        later: dict[tuple[int, int], list[tuple[int, int, int]]] = {}

        def align(tasks: list[tuple[int, int, int]], width: int) -> None:
            done = banded_alignments([self.pattern(w) for _, w, _ in tasks], [group[t][1] for t, _, _ in tasks], [o for _, _, o in tasks], width)
            for (t, window, _), (edits, start, end) in zip(tasks, done):
                keep(t, window, edits, start, end)

        for window, band in self._candidates(joined):
            pattern, k = self.pattern(window), int(self.edits[window])
            diagonal, width = band * self.step - 4096, 2 * self.step + 2 * k
            # The band may touch two texts; each is aligned by itself.
            lo = int(np.searchsorted(starts, max(diagonal - k, 0), side="right")) - 1
            hi = int(np.searchsorted(starts, diagonal + 2 * self.step + len(pattern) + k, side="right"))
            for t in range(max(lo, 0), hi):
                origin = diagonal - int(starts[t]) - k
                equal = _equal_stretch(pattern, group[t][1], origin, width)
                if equal >= 0:
                    keep(t, window, 0, equal, equal + len(pattern))
                else:
                    tasks = later.setdefault((len(pattern), width), [])
                    tasks.append((t, window, origin))
                    if len(tasks) >= _TOGETHER:
                        align(tasks, width)
                        tasks.clear()
        for (_, width), tasks in later.items():
            if tasks:
                align(tasks, width)
        for i, _ in group:
            out[i].sort(key=lambda r: (r.item, r.window, r.start))


def benchmark_slices(benchmark: DataFrame, max_chars: int) -> Iterator[tuple[list[tuple[int | None, str]], bool]]:
    """The different ``(item_id, text)`` of the benchmark in slices of about ``max_chars`` characters, and whether there are several.

    A slice's index, about 50 bytes a character, is broadcast; a larger benchmark takes more passes over the documents. Of
    several slices, each one's result is written and its index destroyed before the next is built.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).head()[0]
    parts = max(1, -(-total // max_chars))
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for part in range(parts):
        yield [(r["item_id"], r["text"]) for r in items.where(place == part).orderBy("item_id", "text").collect()], parts > 1


def find_contamination(docs: DataFrame, benchmark: DataFrame, max_chars: int = 2_000_000, **options) -> DataFrame:
    """One row per document and benchmark item that it repeats: ``(doc_id, item_id, n_windows, start, end, edits)``.

    ``n_windows`` counts the item's windows found, ``start`` and ``end`` span them in code points of the text, ``edits`` is
    the least number of edits of any. Letter case and the kind and amount of white space don't count. Items of fewer than 40
    characters are searched whole, without edits and between word boundaries. Null texts hold nothing; null ids and repeated rows are
    rows like others; extra columns are not read; an empty benchmark finds nothing.
    """
    schema = "doc_id long, item_id long, n_windows int, start int, end int, edits int"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found: DataFrame | None = None
    for items, several in benchmark_slices(benchmark, max_chars):
        ids = [i for i, _ in items]
        shared = docs.sparkSession.sparkContext.broadcast(BenchmarkIndex([t for _, t in items], **options))

        def run(batch: pa.RecordBatch, ids=ids, shared=shared) -> Iterator[dict]:
            index = shared.value
            doc_ids = batch.column(0).to_pylist()
            out: dict[str, list] = {c: [] for c in ("doc_id", "item_id", "n_windows", "start", "end", "edits")}
            for doc_id, regions in zip(doc_ids, index.find_in(texts_of(batch))):
                by_item: dict[int, list[Region]] = {}
                for r in regions:
                    by_item.setdefault(r.item, []).append(r)
                for item, own in by_item.items():
                    row = (doc_id, ids[item], len({r.window for r in own}), min(r.start for r in own), max(r.end for r in own), min(r.edits for r in own))
                    for c, x in zip(out, row):
                        out[c].append(x)
            yield out

        part = map_batches(rows, schema, run)
        if several:
            part = checkpoint(part)
            shared.destroy()
        found = part if found is None else found.unionByName(part)
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, max_chars: int = 2_000_000, **options) -> DataFrame:
    """``docs`` without the rows that repeat a benchmark passage; columns stay as they are."""
    for items, several in benchmark_slices(benchmark, max_chars):
        shared = docs.sparkSession.sparkContext.broadcast(BenchmarkIndex([t for _, t in items], **options))

        def run(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            index = shared.value
            return batch.filter(pa.array([not r for r in index.find_in(texts_of(batch))], pa.bool_()))

        docs = rewrite_rows(docs, run)
        if several:
            docs = checkpoint(docs)
            shared.destroy()
    return docs
