"""Removal of similar texts against brute force, and on awkward rows."""

import random

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node int, __range string, rank int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, 7, "x", 1) for i, t in rows], DOCS)


def kept(spark, rows):
    return corpus_pipeline.near_duplicates(spark, docs(spark, rows), "")


def plain_groups(rows):
    sets = {}
    for i, t in rows:
        words = t.lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or {tuple(words)}
    root = {i: i for i in sets}
    for i in sets:
        for j in sets:
            if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = {k: min(a, b) if r in (a, b) else r for k, r in root.items()}
    return set(root.values())


def test_similar_texts_equal_brute_force(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(40):
        text = [rng.choice(words) for _ in range(rng.choice([3, 5, 9, 60, 200, 700]))]
        for _ in range(4):
            copy = list(text)
            for _ in range(rng.choice([0, 1, len(text) // 60, len(text) // 35, len(text) // 20])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy + ["license line of all texts here"] * rng.choice([0, 1]))))
    want = plain_groups(rows)
    got = kept(spark, rows)
    assert {r.doc_id for r in got.collect()} == want and got.columns == docs(spark, []).columns
    assert 40 < len(want) < len(rows)


def test_rows_are_chosen_by_group_not_by_id(spark):
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    rows = [(1, None), (2, ""), (3, "a"), (4, "A"), (4, "a"), (4, "quite another text"), (4, "quite another text"), (None, long), (None, long + " x"), (None, None), (9, long + " y")]
    got = sorted(((r.doc_id, r.text) for r in kept(spark, rows).collect()), key=str)
    assert got == [(1, None), (3, "a"), (4, "quite another text"), (9, long + " y")]
    assert kept(spark, []).count() == 0


def test_large_groups_need_no_pairs_of_all(spark, monkeypatch):
    """Groups above the bucket size: pivots and the pairs across components give the components of brute force."""
    from folioforge.llm import similar

    rng = random.Random(21)
    words = [f"w{i}" for i in range(2000)]
    rows = []
    for _ in range(3):
        first = [rng.choice(words) for _ in range(60)]
        chain = list(first)
        for k in range(40):
            copy = list(chain if k % 2 else first)
            copy[rng.randrange(len(copy))] = rng.choice(words)
            chain = copy if k % 5 == 0 else chain
            rows.append((len(rows), " ".join(copy)))
    want = plain_groups(rows)
    for small, rounds in ((2, 1), (2, 3), (16, 3)):
        got = similar.drop_similar(docs(spark, rows), small=small, rounds=rounds)
        assert {r.doc_id for r in got.collect()} == want


def test_helper_columns_do_not_clash(spark):
    frame = docs(spark, [(1, "a b"), (1, "c d"), (2, "a b")])
    for name in ("__i", "__r", "__kept_i", "__repeated"):
        frame = frame.withColumn(name, frame.doc_id * 10)
    got = corpus_pipeline.near_duplicates(spark, frame, "")
    assert got.columns == frame.columns and sorted((r.text, r["__i"]) for r in got.collect()) == [("a b", 10), ("c d", 10)]


def test_columns_of_maps(spark):
    """Maps can't be hashed as they are; they stay, and tell rows apart."""
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, {"a": 1}), (1, text, {"a": 1}), (2, text + " end", {"b": 2}), (3, "other words here", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `x.y` map<string,int>")
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted((r.doc_id, r["x.y"]) for r in kept) == [(1, {"a": 1}), (3, None)]
