"""Licence scans, hard negatives and the filter audit against brute force, and on awkward rows."""

import math
import random
import re
from itertools import permutations

import numpy as np
import pytest

from folioforge.llm import filteraudit, hardneg, licenses

DOCS = "doc_id long, text string, lang string, source string, n_chars long, part string, mask int, labels string, digest string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None, "x", 1, "y", "z") for i, t, s in rows], DOCS)


AWKWARD = [(1, None, None), (2, "", "a"), (2, "", "a"), (None, "mit license", "a"), (None, None, None), (3, "wort " * 60_000 + "MIT  License", "b"), (4, "mit license", "")]


# --- licences


def plain_scan(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    hits = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + phrase.count(" ") + 1] == phrase.split()]
    starts = [i for i, _ in hits]
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


def test_licence_base_equals_plain_form():
    rng = random.Random(3)
    pieces = ["GNU", "general", "Public", "license", "LICENSE", "apache", "cc", "by", "BY-NC", "mit", "MIT", "É", "é1", " ", "\n", "--", "_", "\x7f", "gnu general public license", "cc by ", "x"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) + rng.choice(["", " ", " ", "-"]) for _ in range(rng.randint(0, 14)))
        found = licenses.scan(text)
        assert tuple(found[k] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == plain_scan(text), text
        assert set(found["base_labels"].split(",")) <= set(found["labels"].split(",")) or not found["base_labels"]


@pytest.mark.parametrize(
    "text,labels,spelled,kind",
    [
        ("SPDX-License-Identifier: MIT", "mit", ["mit"], "permissive"),
        ("// spdx-license-identifier: MIT OR GPL-3.0-or-later */", "gpl-3.0-or-later,mit", ["mit OR gpl-3.0-or-later"], "permissive"),
        ("SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only\nwords", "apache-2.0,gpl-2.0-only,mit", ["(mit OR apache-2.0) AND gpl-2.0-only"], "copyleft"),
        ("SPDX-License-Identifier: mit or apache-2.0 and gpl-2.0", "apache-2.0,gpl-2.0,mit", ["mit OR apache-2.0 AND gpl-2.0"], "permissive"),
        ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", "gpl-2.0-only-with-classpath-exception-2.0", ["gpl-2.0-only WITH classpath-exception-2.0"], "weak-copyleft"),
        ("license expression = BSD-3-Clause, and more", "bsd-3-clause", ["bsd-3-clause"], "permissive"),
        ("SPDX-License-Identifier: MIT AND", "mit", ["mit"], "permissive"),
        ("SPDX-License-Identifier: (MIT OR", "", [], None),
        ("SPDX-License-Identifier:\nMIT", "", [], None),
        ("SPDX-License-Identifier: foo-1.0", "foo-1.0", ["foo-1.0"], None),
        ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0", [], "permissive"),
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc,cc-by-nc-4.0", [], "restricted"),
        ("permit license", "", [], None),
    ],
)
def test_licence_expressions(text, labels, spelled, kind):
    found = licenses.scan(text)
    assert (found["labels"], found["expressions"], found["license_class"]) == (labels, spelled, kind)
    assert (found["score"] > 0.45) == bool(labels) and 0 <= found["score"] <= 1


def test_licence_expressions_equal_recursive_descent():
    """Postfix and value of random expressions, by a parser of another kind."""

    def either(t, i):
        return chain(t, i, "or", both)

    def both(t, i):
        return chain(t, i, "and", one)

    def chain(t, i, op, below):
        got, i = below(t, i)
        while i < len(t) and t[i] == op:
            more, i = below(t, i + 1)
            got = [*got, *more, op]
        return got, i

    def one(t, i):
        if t[i] == "(":
            got, i = either(t, i + 1)
            return got, i + 1
        if i + 1 < len(t) and t[i + 1] == "with":
            return [t[i], t[i + 2], "with"], i + 3
        return [t[i]], i + 1

    rng = random.Random(5)

    def make(depth):
        if depth == 0 or rng.random() < 0.3:
            name = rng.choice(["mit", "gpl-2.0", "x"])
            return [name, "with", "e"] if rng.random() < 0.2 else [name]
        left, right = make(depth - 1), make(depth - 1)
        made = [*left, rng.choice(["and", "or"]), *right]
        return ["(", *made, ")"] if rng.random() < 0.5 else made

    for _ in range(500):
        tokens = make(4)
        assert licenses.parse_expression(tokens) == (either(tokens, 0)[0], len(tokens))
    deep = ["("] * 20_000 + ["mit"] + [")"] * 20_000
    assert licenses.parse_expression(deep) == (["mit"], 40_001)
    assert licenses.evaluate(["mit"] + ["gpl-2.0", "or"] * 20_000)[1] == 1


def test_licences_of_awkward_rows(spark):
    rows = licenses.find_licenses(docs(spark, AWKWARD)).collect()
    assert len(rows) == len(AWKWARD) and {r.n_base for r in rows if r.doc_id == 2} == {0}
    long = next(r for r in rows if r.doc_id == 3)
    assert (long.n_words, long.n_base, long.first_word, long.last_word, long.labels) == (60_002, 1, 60_000, 60_000, "mit")
    assert sorted((r.labels, r.score) for r in rows if r.doc_id is None) == [("", 0.0), ("mit", 0.5)]
    assert licenses.find_licenses(docs(spark, [])).count() == 0


# --- hard negatives

VECTORS = "vec_id long, embedding array<float>, label int, anchor int, q string, ids string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], c, 1, "q", "i") for i, v, c in rows], VECTORS)


def plain_mine(rows, scale=256, every=50):
    good = [(i, [math.floor(scale * float(np.float32(x))) for x in v], c) for i, v, c in rows if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    asks = {}
    for i, v, c in good:
        if i % every == 0:
            asks[i] = min(asks.get(i, (c, v)), (c, v))
    out = []
    for a, (label, q) in asks.items():
        scored = sorted(((-dot(q, v), i, c) for i, v, c in good if i != a))
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            ok = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(a, p, n + 1, x[1], -s, -x[0]) for n, x in enumerate(ok)]
    return sorted(out)


def random_vectors(seed, n, dims, spread):
    rng = np.random.default_rng(seed)
    return [(i, list(rng.normal(size=dims) * spread + (0.3 if i % 3 else 0)), int(rng.integers(3))) for i in range(n)]


@pytest.mark.parametrize("seed,n,dims,spread,slice_bytes", [(1, 400, 8, 0.2, 1 << 20), (2, 300, 16, 0.1, 512), (3, 260, 3, 40.0, 64), (4, 300, 5, 0.004, 1 << 20)])
def test_negatives_equal_brute_force(spark, seed, n, dims, spread, slice_bytes):
    rows = random_vectors(seed, n, dims, spread)
    rows += [(1000 + i, rows[10][1], i % 3) for i in range(60)]  # ties
    found = hardneg.mine(vectors(spark, rows).repartition(3), slice_bytes=slice_bytes)
    assert sorted(map(tuple, found.collect())) == plain_mine(rows)


def test_negatives_of_awkward_rows(spark):
    rows = [(0, [0.5, 0.5], 1), (0, [0.5, 0.5], 1), (1, [0.5, 0.4], 1), (1, [0.5, 0.4], 1), (2, [0.3, 0.4], 2), (2, [0.3, 0.4], 2), (3, [float("nan"), 1], 2), (4, [None, 1], 2), (5, None, 2), (6, [1, 1], None)]
    rows += [(None, [0.4, 0.3], 2), (50, [], 1), (100, [-1, -1], 3), (7, [1], 1), (150, [0.2, float("inf")], 2), (-50, [0.5, -0.5], 2)]
    found = sorted(map(tuple, hardneg.mine(vectors(spark, rows)).collect()))
    assert found == plain_mine(rows)
    for some in ([], [(1, None, 1)], [(0, [], 1), (1, [], 2), (2, [], 1)], [(0, [1.0], 1)]):
        assert sorted(map(tuple, hardneg.mine(vectors(spark, some)).collect())) == plain_mine(some)
    with pytest.raises(ValueError):
        hardneg.mine(vectors(spark, [(0, [1e9], 1)]))


def test_bit_planes_drop_pairs_early():
    """With most significant planes alone, far pairs are gone before the last plane, and no near one is."""
    rng = np.random.default_rng(7)
    ints = rng.integers(-200, 200, (500, 16))
    wanted = np.full((4, 1), int(np.partition(ints[:4] @ ints.T, -3, axis=1)[:, -3].min()))
    own = hardneg.Anchors(np.arange(4), np.zeros(4, int), ints[:4], wanted, np.full((4, 1), 1 << 40), 500, False)
    hardneg.meet(own, np.arange(4), np.arange(500), ints, np.ones((4, 500), bool), 9)
    scores = ints[:4] @ ints.T
    assert set(zip(own.best[0], own.best[1], own.best[2])) == {(i, j, scores[i, j]) for i, j in zip(*np.nonzero(scores >= wanted))}


# --- filter audit


def plain_audit(rows, labels):
    texts = [(i, t or "", s or "") for i, t, s in rows]
    known = [(i, t) for i, t, _ in texts if i is not None]
    fails = []
    for i, t, _ in texts:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        fails.append((len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search(r"[#$%&*|]", t)), i is not None and any(j < i and u == t for j, u in known)))
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in range(2))
    out, removed_by = [], {}
    for part in {s for _, _, s in texts}:
        mine = [(i, f) for (i, _, s), f in zip(texts, fails) if s == part]
        for order in permutations(range(5)):
            left = mine
            for k, f in enumerate(order):
                gone = [x for x in left if x[1][f]]
                left = [x for x in left if not x[1][f]]
                removed_by[part, f] = removed_by.get((part, f), 0) + len(gone)
                row = [part, "".join("ABCDE"[j] for j in order), k + 1, len(left), len(gone), sum(x[1][f] for x in mine) - len(gone)]
                row += [sum(x[1][f] and sum(x[1]) == 1 for x in mine), sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone)]
                out.append((row, (part, f)))
    return sorted((*row, removed_by[key]) for row, key in out)


LABELS = "doc_id long, quality int, toxic int, part string"


def test_audit_equals_brute_force(spark):
    rng = random.Random(11)
    few = ["a b c", "A B # c", "x " * 250, "".join(f"w{i} " for i in range(220)), "".join(f"W{i}\t" for i in range(220)) + "&", "É\x85é \xa0 x", "", None]
    rows = [(rng.choice([None, *range(60)]), rng.choice(few) if rng.random() < 0.7 else f"own {i} {rng.random()}", rng.choice(["s1", "s2", "", None])) for i in range(150)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in [*range(0, 50), 3, 3, None, None, 99]]
    table = spark.createDataFrame([(*x, "p") for x in labels], LABELS)
    found = filteraudit.audit(docs(spark, rows).repartition(5), table)
    assert sorted(tuple(r) for r in found.collect()) == plain_audit(rows, labels)


def test_audit_of_awkward_rows(spark):
    none = spark.createDataFrame([], LABELS)
    assert sorted(tuple(r) for r in filteraudit.audit(docs(spark, AWKWARD), none).collect()) == plain_audit(AWKWARD, [])
    assert filteraudit.audit(docs(spark, []), none).count() == 0


def test_parity_sums_turn_back_into_counts(spark):
    """The transform loses nothing: every mask's count comes back."""
    counts = {m: (m * 37 + 5) % 11 for m in range(32)}
    found = spark.createDataFrame([("p", 0, 1, m, n) for m, n in counts.items()], "part string, good int, toxic int, mask int, n long")
    sums = filteraudit.parity_sums(found, 5)
    assert len(sums.head().w) == 32 and sums.head().w[0] == sum(counts.values())
    assert sums.select(filteraudit.cells(sums.w, 5).alias("c")).head().c == [counts[m] for m in range(32)]
