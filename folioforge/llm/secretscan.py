"""Secrets: known patterns, and random-looking strings told from identifiers by character Markov models."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, texts_of

KINDS = ("assign", "access", "hex", "random")
Span = tuple[int, int, int]

_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A | re.I)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")

SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_INDEX = np.full(256, 0, np.int64)
for _i, _c in enumerate(SIGNS):
    _INDEX[ord(_c)] = _i + 1
#: Strings that the models judge: at least 20 signs, not part of a longer run.
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])")
_IDENTIFIER = re.compile(r"[A-Za-z][A-Za-z0-9+/_=-]{3,}")


def base_spans(text: str) -> list[Span]:
    """Spans ``(kind index, start, end)`` of the whole matches of the plain patterns, by start and kind."""
    out = []
    if ":" in text or "=" in text:
        out = [(0, *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    out += [(1, *m.span()) for m in _ACCESS.finditer(text)]
    out += [(2, *m.span()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], s[0]))


class MarkovPair:
    """First-order character models of random strings and of ordinary identifiers.

    A transition's probability is its count with ``blend`` pseudo-counts dealt out by the signs' own frequencies, so that
    a sign never seen behind another is as likely as it is on the whole.
    """

    blend = 20.0

    def __init__(self, random: Iterable[tuple[str, int]], ordinary: Iterable[tuple[str, int]]) -> None:
        labelled = list(random)
        self.ratio = self._fit(labelled) - self._fit(ordinary)
        scores = [self.score(token) for token, _ in labelled]
        #: What all but one in 200 of the labelled random strings reach, and never less than even odds.
        self.threshold = max(0.0, float(np.percentile(scores, 0.5))) if scores else 0.0

    @staticmethod
    def _codes(token: str) -> np.ndarray:
        return _INDEX[np.frombuffer(f" {token}".encode("latin-1", "replace"), np.uint8)]

    @classmethod
    def _fit(cls, samples: Iterable[tuple[str, int]]) -> np.ndarray:
        counts = np.zeros((len(SIGNS) + 1, len(SIGNS) + 1))
        for token, n in samples:
            codes = cls._codes(token)
            np.add.at(counts, (codes[:-1], codes[1:]), n)
        alone = counts.sum(axis=0) + 1
        alone /= alone.sum()
        return np.log((counts + cls.blend * alone) / (counts.sum(axis=1, keepdims=True) + cls.blend))

    def score(self, token: str) -> float:
        """Log-likelihood ratio per character; above 0 a random string is the likelier origin."""
        codes = self._codes(token)
        return float(self.ratio[codes[:-1], codes[1:]].mean())


def _in_question(token: str) -> bool:
    """Whether the models are to judge a string of this kind: 20 signs or more with a letter and a digit."""
    return len(token) >= 20 and any(c.isdigit() for c in token) and any(c.isalpha() for c in token)


def labelled_samples(docs: DataFrame, max_docs: int = 4000, n_random: int = 4000, max_tokens: int = 100_000, seed: int = 7) -> tuple[list[tuple[str, int]], list[tuple[str, int]]]:
    """Labelled strings: random ones and ordinary identifiers with their counts.

    Ordinary identifiers are the letters-first strings of a bounded sample of documents (about ``max_docs``, chosen by a
    hash of the id and text) outside the spans of known secrets, without those of the kind to be judged; a string that comes n
    times weighs 1 + log2(n). Of more than ``max_tokens`` different strings the most frequent ones are samples. Random strings are the values of known secrets in that sample
    and ``n_random`` strings drawn uniformly from base-62, base-64, base-32 and hexadecimal signs, of 20 to 64 signs.
    """
    total = docs.count()
    share = min(1.0, max_docs / max(total, 1))
    sample = docs.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "text"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        tokens, secret = [], []
        for text in texts_of(batch):
            at, parts = 0, []
            for _, a, b in base_spans(text):
                if a >= at:
                    parts.append(text[at:a])
                    value = re.split(r"[:=\"' ]+", text[a:b])[-1]
                    tokens.append(value)
                    secret.append(True)
                    at = b
            words = [w for w in _IDENTIFIER.findall(" ".join([*parts, text[at:]])) if not _in_question(w)]
            tokens += words
            secret += [False] * len(words)
        yield {"token": tokens, "secret": secret}

    found = map_batches(sample.select("text"), "token string, secret boolean", run).groupBy("token", "secret").agg(F.count(F.lit(1)).alias("n"))
    rows = found.orderBy(F.desc("n"), "token", "secret").limit(max_tokens).collect()
    rng = np.random.default_rng(seed)
    alphabets = [SIGNS[:62], SIGNS[:64], SIGNS[:26] + "234567", "0123456789abcdef", "0123456789ABCDEF", SIGNS[:62] + "_-"]
    drawn = [("".join(rng.choice(list(alphabets[i % len(alphabets)]), int(rng.integers(20, 65)))), 1) for i in range(n_random)]
    return drawn + [(r.token, 1) for r in rows if r.secret and r.token], [(r.token, r.n.bit_length()) for r in rows if not r.secret]


def random_spans(text: str, model: MarkovPair, threshold: float) -> list[Span]:
    """Candidates that hold a letter and a digit and whose ratio reaches the threshold."""
    out = []
    for m in _CANDIDATE.finditer(text):
        if _in_question(m.group()) and model.score(m.group()) >= threshold:
            out.append((3, *m.span()))
    return out


def all_spans(text: str, model: MarkovPair, threshold: float) -> tuple[list[Span], list[Span]]:
    """The base spans, and with them the random strings that no base span covers, by start and kind."""
    base = base_spans(text)
    starts = [a for _, a, _ in base]
    #: How far the base spans reach that begin up to each one.
    reach = [0, *accumulate((b for _, _, b in base), max)]
    more = [s for s in random_spans(text, model, threshold) if reach[bisect_right(starts, s[1])] < s[2]]
    return base, sorted(base + more, key=lambda s: (s[1], s[0]))


def spell(spans: Iterable[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find_secrets(docs: DataFrame, model: MarkovPair | None = None, threshold: float | None = None) -> DataFrame:
    """One row per document: ``(doc_id, n_assign, n_access, n_hex, base, spans, n_spans)``.

    Counts and ``base`` are those of the known patterns; ``spans`` adds ``random`` strings, and ``n_spans`` counts all. The models
    judge runs of 20 signs or more that hold a letter and a digit; shorter runs and words are not in question. Spans are ``kind:start:end`` in
    code points. The models and their threshold are fitted on a bounded sample (see
    :func:`labelled_samples`) unless given. Null and empty
    texts have no spans; null ids and repeated rows are rows like others; extra columns are not read.
    """
    pair = model or MarkovPair(*labelled_samples(docs))
    least = pair.threshold if threshold is None else threshold

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        found = [all_spans(t, pair, least) for t in texts_of(batch)]
        columns = {f"n_{kind}": [sum(k == i for k, _, _ in base) for base, _ in found] for i, kind in enumerate(KINDS[:3])}
        yield {"doc_id": batch.column(0), **columns, "base": [spell(b) for b, _ in found], "spans": [spell(s) for _, s in found], "n_spans": [len(s) for _, s in found]}

    return map_batches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        "doc_id long, n_assign long, n_access long, n_hex long, base string, spans string, n_spans long",
        run,
    )
