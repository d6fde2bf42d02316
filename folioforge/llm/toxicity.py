"""Toxicity severity by cumulative-link ordinal regression over sparse text features."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, map_batches, texts_of

_WORD = re.compile(r"[^\W\d_]+")
#: Word beginnings of these lengths are features beside whole words.
PREFIXES = (4, 5)


class Featurizer:
    """Sparse features of a text as 32-bit hashes: each different word and each different word beginning once."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, ...]] = {}

    def of_word(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= 100_000:
                self.known.clear()
            names = [word, *(f"{word[:n]}~" for n in PREFIXES if len(word) >= n)]
            found = self.known[word] = tuple(zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in names)
        return found

    def __call__(self, text: str) -> list[int]:
        return sorted({f for w in set(_WORD.findall(text.lower())) for f in self.of_word(w)})


def cuts_of(params: Sequence[np.ndarray]) -> np.ndarray:
    """Thresholds out of ``(weights, first threshold, logarithms of the gaps)``."""
    return params[1][0] + np.concatenate([[0.0], np.cumsum(np.exp(params[2]))])


def loss_and_gradient(params: Sequence[np.ndarray], flat: np.ndarray, row: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float) -> tuple[float, list[np.ndarray]]:
    """The weighted negative log-likelihood of the grades ``y`` with its penalty, and its derivative by each parameter.

    ``flat`` holds the features of all texts and ``row`` the text of each.
    """
    cuts, n = cuts_of(params), len(y)
    k = len(cuts)
    z = np.bincount(row, params[0][flat], n)
    above = np.ones((n, k + 2))
    above[:, 1:-1] = 1 / (1 + np.exp(np.clip(cuts[None, :] - z[:, None], -40, 40)))
    above[:, -1] = 0
    at = lambda x, grade: np.take_along_axis(x, grade[:, None], 1)[:, 0]
    p = np.maximum(at(above, y) - at(above, y + 1), 1e-12)
    slope = above * (1 - above)
    hi, lo = at(slope, y), at(slope, y + 1)
    dz = -weight * (hi - lo) / p
    dcut = np.zeros(k)
    np.add.at(dcut, np.maximum(y - 1, 0), np.where(y > 0, weight * hi / p, 0))
    np.add.at(dcut, np.minimum(y, k - 1), np.where(y < k, -weight * lo / p, 0))
    dw = np.bincount(flat, dz[row], len(params[0])) + l2 * params[0]
    dgap = np.cumsum(dcut[::-1])[::-1][1:] * np.exp(params[2])
    loss = -(weight * np.log(p)).sum() + l2 / 2 * (params[0] ** 2).sum()
    return float(loss), [dw, np.array([dcut.sum()]), dgap]


class OrdinalModel:
    """P(grade > k) = sigmoid(x.w - threshold[k]): one weight vector, ordered thresholds.

    Thresholds are the first one plus a running sum of exponentials, so they stay ordered. Fitted by full-batch Adam on the
    log-likelihood of the grades with an L2 penalty; grades are balanced by weight.
    """

    def __init__(self, features: int = 0, grades: int = 3) -> None:
        self.weights = np.zeros(features)
        self.thresholds = np.arange(1, grades, dtype=float)

    def fit(self, rows: Sequence[Sequence[int]], grades: Sequence[int], rounds: int = 200, rate: float = 0.1, l2: float = 1e-4) -> OrdinalModel:
        y = np.asarray(grades, np.int64)
        if not len(y):
            return self
        k = len(self.thresholds)
        flat = np.fromiter((f for r in rows for f in r), np.int64)
        row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        share = np.bincount(y, minlength=k + 1).astype(float)
        weight = (1.0 / np.maximum(share, 1))[y]
        weight /= weight.sum()
        params = [self.weights, np.array([0.0]), np.zeros(max(k - 1, 0))]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, rounds + 1):
            _, slopes = loss_and_gradient(params, flat, row, y, weight, l2)
            for i, g in enumerate(slopes):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                params[i] = params[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        self.weights, self.thresholds = params[0], cuts_of(params)
        return self

    def above(self, features: Sequence[int]) -> np.ndarray:
        """P(grade > k) for k = 0, 1, ...; 0 without features."""
        if not len(features):
            return np.zeros(len(self.thresholds))
        z = self.weights[np.asarray(features, np.int64)].sum()
        return 1 / (1 + np.exp(np.clip(self.thresholds - z, -40, 40)))

    def expected(self, features: Sequence[int]) -> float:
        """Expected severity: the sum of the probabilities of exceeding each threshold."""
        return float(self.above(features).sum())


class SeverityModel:
    """An ordinal model over the features that tell toxic from clean texts, and how to read a text into them."""

    def __init__(self, features: Sequence[tuple[int, bool]] = (), rows: Sequence[Sequence[int]] = (), toxic: Sequence[int] = ()) -> None:
        """``features`` are the hashes in use and whether each speaks for toxicity, ``rows`` the labelled texts' features as
        places in it.

        Out of the 0/1 labels come ordered grades: 0 for clean, 1 and 2 for toxic texts with few and with many features
        that speak for toxicity, parted at the median.
        """
        t = np.asarray(toxic, bool)
        self.vocabulary = {h: i for i, (h, _) in enumerate(features)}
        self.model = OrdinalModel(len(features))
        if len(features) and t.any() and not t.all():
            speaks = np.array([s for _, s in features], int)
            many = np.array([speaks[list(r)].sum() for r in rows])
            self.model.fit(rows, np.where(t, 1 + (many > np.median(many[t])), 0))

    def above(self, hashes: Sequence[int]) -> np.ndarray:
        """P(grade > k) for k = 0, 1, ... of a text with these feature hashes."""
        return self.model.above([self.vocabulary[h] for h in hashes if h in self.vocabulary])


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = 6000, min_docs: int = 4, min_gain: float = 20.0) -> SeverityModel:
    """Fit on about ``max_docs`` labelled documents, half of them toxic, chosen by a hash of the id.

    Labels with a null id or null ``toxic`` are not used; documents with equal texts count once. Features are counted on
    the cluster. One stays if ``min_docs`` texts have it and the log-likelihood ratio statistic of its counts among toxic
    and clean texts reaches ``min_gain``; there is no other bound on features. The driver sees these features and each
    sampled text's places in them. The sample's ids are broadcast: ``max_docs`` bounds them.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("__id")).agg((F.max("toxic") > 0).alias("__toxic"))
    sizes = dict(known.groupBy("__toxic").agg(F.count(F.lit(1))).collect())
    scale = 1 << 20
    share = {t: int(min(1.0, max_docs / 2 / max(sizes.get(t, 0), 1)) * scale) for t in (True, False)}
    chosen = known.where(F.pmod(F.xxhash64(F.col("__id").cast("string")), F.lit(scale)) < F.when(F.col("__toxic"), share[True]).otherwise(share[False]))
    named = docs.select(F.col("doc_id").cast("long").alias("__id"), F.coalesce("text", F.lit("")).alias("text"))
    sample = named.join(F.broadcast(chosen), "__id").groupBy("text").agg(F.max(F.col("__toxic").cast("int")).alias("toxic"))
    make = Featurizer()

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        yield {"toxic": batch.column(1), "features": [make(t) for t in texts_of(batch)]}

    read = checkpoint(map_batches(sample.select("text", "toxic"), "toxic int, features array<long>", run))
    n_pos, n = read.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).head()
    if not n_pos or n_pos == n:
        return SeverityModel()
    each = read.select("toxic", F.explode("features").alias("f")).groupBy("f").agg(F.sum("toxic").alias("pos"), F.count(F.lit(1)).alias("both"))
    pos, both = F.col("pos"), F.col("both")
    even = both * (n_pos / n)
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    gain = 2 * (part(pos, even) + part(both - pos, both - even))
    best = each.where(both >= min_docs).select("f", (pos > even).alias("speaks"), gain.alias("gain")).where(F.col("gain") >= min_gain)
    features = [(r["f"], r["speaks"]) for r in best.orderBy(F.desc("gain"), "f").collect()]
    place = {h: i for i, (h, _) in enumerate(features)}

    def look_up(batch: pa.RecordBatch) -> Iterator[dict]:
        yield {"toxic": batch.column(0), "at": [[place[h] for h in row if h in place] for row in batch.column(1).to_pylist()]}

    rows = map_batches(read, "toxic int, at array<int>", look_up).collect()
    rows = sorted((tuple(r["at"]), r["toxic"]) for r in rows)
    return SeverityModel(features, [r[0] for r in rows], [r[1] for r in rows])


def score(docs: DataFrame, model: SeverityModel, threshold: float = 0.6) -> DataFrame:
    """One row per document: ``(doc_id, severity, p_toxic, toxic)``.

    ``severity`` is the expected grade (0 to 2), ``p_toxic`` the probability of a grade above 0, ``toxic`` whether that
    reaches ``threshold``. Whole texts are read. Null and empty texts have no features and severity 0.
    Without labels nothing is toxic. Null ids and repeated rows are rows like others; extra columns are not read.
    """
    make = Featurizer()

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        found = [model.above(make(t)) for t in texts_of(batch)]
        yield {
            "doc_id": batch.column(0),
            "severity": [round(float(f.sum()), 6) for f in found],
            "p_toxic": [round(float(f[0]), 6) for f in found],
            "toxic": [bool(f[0] >= threshold) for f in found],
        }

    return map_batches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id long, severity double, p_toxic double, toxic boolean", run
    )
