"""The near-duplicate stage finds its first links by SimHash and multi-index hashing."""

import random

import corpus_pipeline
from folioforge.llm import similar, simhash


def test_close_fingerprints_are_linked_by_the_index(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(12):
        text = [rng.choice(words) for _ in range(400)]
        rows.append((len(rows), " ".join(text)))
        rows.append((len(rows), " ".join(text + ["end"])))
        far = list(text)
        for _ in range(4):
            far[rng.randrange(400)] = "x"
        rows.append((len(rows), " ".join(far)))
    prints = [simhash.fingerprint(t, 5) for _, t in rows]
    close = sum((prints[i] ^ prints[i + 1]).bit_count() <= 2 for i in range(0, 36, 3))
    seen, counted = [], []
    index, prefix = similar.pairs_by_index, similar.pairs_apart

    def by_index(*args):
        pairs = index(*args)
        seen.append(pairs.count())
        return pairs

    def apart(pairs, component):
        left = prefix(pairs, component)
        counted.append((pairs.count(), left.count()))
        return left

    monkeypatch.setattr(similar, "pairs_by_index", by_index)
    monkeypatch.setattr(similar, "pairs_apart", apart)
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(r.doc_id for r in got.collect()) == list(range(0, 36, 3))
    (all_pairs, left), = counted
    assert close >= 6 and seen[0] >= close and 0 < left <= all_pairs - close
