"""Language identification: known words first, shorter and shorter character n-grams for the others."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, rewrite_rows, texts_of

UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")
#: Longer letter runs, as of scripts without spaces, are no words: they are read by n-grams, in pieces of this length.
MAX_WORD = 40


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters; numerals such as a half or a circled one are no letters."""
    words = _WORD.findall(text.lower())
    if not text.isascii() and not "".join(set(words)).isalpha():
        words = [p for w in words for p in ("".join(c if c.isalpha() else " " for c in w).split() if not w.isalpha() else (w,))]
    if any(len(w) > MAX_WORD for w in words):
        words = [w[i : i + MAX_WORD] for w in words for i in range(0, len(w), MAX_WORD)]
    return words


class LanguageModel:
    """Per-language log frequencies of words and of character n-grams of 1 to ``order`` signs.

    ``counts`` holds ``(lang, word, n)``. A word seen ``min_count`` times is known and scores its log frequency in each
    language. An unseen word is read from left to right with a sign for its start and end: at each place the longest
    known n-gram is scored given the signs before it. In a language that has not seen it, it scores as the next shorter
    one does there, times ``backoff``, and so on down to single signs.
    """

    def __init__(self, counts: Iterable[tuple[str, str, int]], order: int = 4, min_count: int = 3, backoff: float = 0.4) -> None:
        rows = list(counts)
        self.langs = sorted({lang for lang, _, _ in rows})
        self.order = order
        at = {lang: i for i, lang in enumerate(self.langs)}
        width = len(self.langs)
        words: dict[str, list[int]] = {}
        grams: dict[str, list[int]] = {}
        for lang, word, count in rows:
            i = at[lang]
            words.setdefault(word, [0] * width)[i] += count
            padded = f"^{word}$"
            for size in range(1, order + 1):
                for j in range(len(padded) - size + 1):
                    gram = padded[j : j + size]
                    found = grams.get(gram)
                    if found is None:
                        found = grams[gram] = [0] * width
                    found[i] += count
        total = np.array(list(words.values()), float).sum(axis=0) if words else np.zeros(width)
        known = {w: c for w, c in words.items() if sum(c) >= min_count and len(w) < MAX_WORD}
        self.words = {w: i for i, w in enumerate(known)}
        self.word_scores = np.log((np.array(list(known.values()), float).reshape(len(known), width) + 0.5) / (total + 0.5 * max(len(words), 1)))
        letters = [c for g, c in grams.items() if len(g) == 1]
        single = np.array(letters, float).reshape(len(letters), width).sum(axis=0)
        self.floor = np.log(0.5) - np.log(single + 1.0)
        self.grams: dict[str, int] = {}
        scores: list[np.ndarray] = []
        down = np.log(backoff)
        for gram in sorted((g for g, c in grams.items() if sum(c) >= min_count), key=lambda g: (len(g), g)):
            own = np.array(grams[gram], float)
            given = np.array(grams[gram[:-1]], float) if len(gram) > 1 else single
            shorter = self.grams.get(gram[1:]) if len(gram) > 1 else None
            below = down + (scores[shorter] if shorter is not None else self.floor)
            with np.errstate(divide="ignore", invalid="ignore"):
                scores.append(np.where(own > 0, np.log(own / given), below))
            self.grams[gram] = len(scores) - 1
        self.gram_scores = np.array(scores).reshape(len(scores), width)
        self.cache: dict[str, tuple[np.ndarray, int]] = {}

    def unseen(self, word: str) -> tuple[np.ndarray, int]:
        """Log probabilities of an unseen word, by backing off to shorter n-grams, and how many of its signs are unknown."""
        padded, known, missing = f"^{word}$", [], 0
        get, order = self.grams.get, self.order
        for end in range(2, len(padded) + 1):
            for start in range(max(end - order, 0), end):
                found = get(padded[start:end])
                if found is not None:
                    known.append(found)
                    break
            else:
                missing += 1
        return self.gram_scores[known].sum(axis=0) + missing * self.floor, missing

    def predict(self, text: str) -> tuple[str, float]:
        """The likeliest language and its score: its share of the probability when all languages are as likely
        beforehand, times the share of the text's letters that training texts hold, so that an unlearned script scores low."""
        counts = Counter(words_of(text))
        if not counts or not self.langs:
            return UNKNOWN, 0.0
        known, times, total, strange = [], [], np.zeros(len(self.langs)), 0
        for word, n in counts.items():
            found = self.words.get(word)
            if found is not None:
                known.append(found)
                times.append(n)
                continue
            found = self.cache.get(word)
            if found is None:
                if len(self.cache) >= 100_000:
                    self.cache.clear()
                found = self.cache[word] = self.unseen(word)
            total += n * found[0]
            strange += n * found[1]
        total += np.array(times, float) @ self.word_scores[known]
        best = int(np.argmax(total))
        fit = 1 - strange / sum(n * len(w) for w, n in counts.items()) if strange else 1.0
        return self.langs[best], float(max(fit, 0.0) / np.exp(total - total[best]).sum())


def training_rows(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Rows that may be learned from: a language, and crc32 of the id as text modulo 4 other than 2."""
    return docs.where(F.col("lang").isNotNull() & (F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 != 2))


def fit(docs: DataFrame, docs_per_lang: int = 1200, **options) -> LanguageModel:
    """Learn from about ``docs_per_lang`` labelled documents of each language, chosen by a hash of id and
    text, so that rows of one id are chosen apart.

    That is the only bound: all languages and all words of these documents are learned. Word counts are made on the
    cluster, and the sample's vocabulary reaches the driver.
    """
    rows = training_rows(docs).select("doc_id", "lang", "text")
    sizes = rows.groupBy(F.col("lang").alias("__lang")).agg(F.count(F.lit(1)).alias("__n"))
    scale = 1 << 20
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "text"), F.lit(scale))
    chosen = (F.col("lang") == F.col("__lang")) & (place * F.col("__n") < F.lit(docs_per_lang * scale))
    # One row for each language, as many as the model has columns.
    sample = rows.join(F.broadcast(sizes), chosen).select("lang", "text")

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        counts: Counter = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
            counts.update((lang, w) for w in words_of(text))
        yield {"lang": [k[0] for k in counts], "word": [k[1] for k in counts], "n": list(counts.values())}

    counted = map_batches(sample, "lang string, word string, n long", run).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return LanguageModel(sorted((r["lang"], r["word"], r["n"]) for r in counted.collect()), **options)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per document: ``(doc_id, held_out, lang_pred, score)``.

    ``und`` with score 0 where the text is null, empty or without letters, or nothing was learned. Whole texts are scored.
    A text in a script that no training text has keeps a learned language, with a score near 0.
    Ties go to the first language in alphabetical order. Null ids and repeated rows are rows like others; extra columns,
    also ``lang`` and ``source``, are not read.
    """

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        found = [model.predict(t) for t in texts_of(batch)]
        yield {"doc_id": batch.column(0), "held_out": batch.column(2), "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    return map_batches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out")),
        "doc_id long, held_out boolean, lang_pred string, score double",
        run,
    )


def keep_identified(docs: DataFrame, model: LanguageModel, min_score: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose language is ``und`` or scores below ``min_score``, as mixed and strange scripts do."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [model.predict(t) for t in texts_of(batch)]
        return batch.filter(pa.array([lang != UNKNOWN and score >= min_score for lang, score in found], pa.bool_()))

    return rewrite_rows(docs, run)
