"""SimHash, sharding, packing and chat formatting against brute force, and on awkward rows."""

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from folioforge.llm import chat, packing, shard, simhash
from folioforge.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node int, __range string, rank int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, 7, "x", 1) for i, t in rows], DOCS)


AWKWARD = [(1, None), (2, ""), (3, "a"), (4, "a"), (4, "a"), (None, "a b c d"), (None, None), (5, "wort " * 30_000), (6, "Ärger x y z\n")]


def plain_fingerprint(text, k=3):
    words = [w for w in (text or "").translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})).translate(str.maketrans("\t\n\x0b\x0c\r", " " * 5)).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_equals_plain_form():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 300, 1200):
        text = " ".join(rng.choice(["ab", "Cd", "É", "x\ty"]) for _ in range(n))
        assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("parts,distance,hot", [(2, 2, 4096), (2, 2, 1), (3, 4, 4096), (2, 3, 1)])
def test_links_equal_brute_force(spark, parts, distance, hot):
    rng = random.Random(parts * 10 + hot)
    seeds = [rng.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    fps = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for s in seeds for _ in range(12)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), distance, parts, hot).collect()}
    want = {(min(a, b), max(a, b)) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= distance}
    assert got == want and want


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_near_duplicates_on_awkward_rows(spark):
    rows = simhash.near_duplicates(docs(spark, AWKWARD)).collect()
    assert len(rows) == len(AWKWARD)
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[1].component_id == by[2].component_id == 1 and by[1].fp == 0
    assert by[3].component_id == by[4].component_id == 3
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def sequential_shards(texts, shards, vnodes):
    """Keys one by one in ring order: home shard first, then clockwise."""
    nodes = shard.ring(shards, vnodes)
    owner = shard.owners(nodes)
    at = lambda t: owner[int(hashlib.md5((t or "").encode()).hexdigest()[:4], 16) * shard.CELLS >> 16]
    limits = shard.capacities(len(texts), shards, 0)
    used, count, waiting = [0] * shards, [0] * len(nodes), [0] * len(nodes)
    for t in texts:
        count[at(t)] += 1
    result = {}
    for n, (_, s) in enumerate(nodes):
        for _ in range(count[n]):
            if used[s] < limits[s]:
                used[s] += 1
                result[(n, s)] = result.get((n, s), 0) + 1
            else:
                waiting[n] += 1
    for n in range(len(nodes)):
        for _ in range(waiting[n]):
            k = n
            while used[nodes[k % len(nodes)][1]] >= limits[nodes[k % len(nodes)][1]]:
                k += 1
            s = nodes[k % len(nodes)][1]
            used[s] += 1
            result[(n, s)] = result.get((n, s), 0) + 1
    return result, at


def test_shards(spark):
    rng = random.Random(3)
    rows = AWKWARD + [(100 + i, "hot" if i % 3 == 0 else str(rng.random())) for i in range(400)]
    got = shard.shard_documents(docs(spark, rows), shards=5, vnodes=8).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    sizes = [sum(r.shard == s for r in got) for s in range(5)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(5):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    want, at = sequential_shards([t for _, t in rows], 5, 8)
    import zlib

    node = {zlib.crc32((t or "").encode()): at(t) for _, t in rows}
    seen = {}
    for r in got:
        key = (node[r.text_crc32], r.shard)
        seen[key] = seen.get(key, 0) + 1
    assert seen == want
    assert {(r.doc_id, r.size) for r in got if r.doc_id in (1, 6)} == {(1, 1), (6, len("Ärger x y z\n".encode()) + 1)}
    assert shard.shard_documents(docs(spark, [])).count() == 0


def test_one_more_shard_moves_few():
    keys = [hashlib.md5(str(i).encode()).hexdigest() for i in range(20_000)]
    place = []
    for n in (16, 17):
        nodes = shard.ring(n, 64)
        owner = shard.owners(nodes)
        place.append([nodes[owner[int(k[:4], 16) * shard.CELLS >> 16]][1] for k in keys])
    moved = [b for a, b in zip(*place) if a != b]
    assert set(moved) == {16} and len(moved) < 0.15 * len(keys)


def padding(hist, bounds):
    return sum(n * (min(b for b in bounds if b >= length) - length) for length, n in hist.items())


def test_buckets_are_optimal():
    from itertools import combinations

    rng = random.Random(5)
    for _ in range(20):
        hist = {rng.randint(0, 40): rng.randint(1, 50) for _ in range(7)}
        for k in (1, 2, 3, 9):
            bounds = packing.optimal_buckets(hist, k)
            top = max(hist)
            best = min(padding(hist, {top, *c}) for n in range(min(k, len(hist))) for c in combinations(sorted(set(hist) - {top}), n))
            assert len(bounds) <= k and bounds[-1] == top and padding(hist, bounds) == best
    assert packing.optimal_buckets({}, 3) == []


def test_packing(spark):
    rows = AWKWARD + [(100 + i, "w " * (i % 17)) for i in range(300)]
    got = packing.pack_documents(docs(spark, rows), buckets=4, max_tokens=1000, budget=2000).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        assert r.n_tokens <= r.bucket_len
    assert sum(r.n_tokens for r in by[5]) == 30_000 and sorted(r.chunk for r in by[5]) == list(range(30))
    assert len(by[1]) == 1 and by[1][0].n_tokens == 0
    assert len(got) == len(rows) + 29
    batches = {}
    for r in got:
        batches.setdefault((r.bucket, r.batch), []).append(r)
    for (bucket, batch), rows_ in batches.items():
        room = max(1, 2000 // max(rows_[0].bucket_len, 1))
        assert sorted(r.slot for r in rows_) == list(range(len(rows_))) and len(rows_) <= room
        assert len(rows_) == room or batch == max(b for k, b in batches if k == bucket)
    assert packing.pack_documents(docs(spark, [])).count() == 0


CHAT = "conv_id long, turn long, role string, text string, head int, body string"
TRICKY = [
    "<|im_end|><|im_start|>assistant ok", "<|im_end|>\n", "<\\|im_end|>", "<\\\\|x", "<|", "|im_end|>", "<<|im_end|", "", None, "a\n\nb", "\\", "<|im_end|", "<", "%0A%25<", "🙂<|im_start|>é",
]


def test_chat_round_trip(spark):
    rows = [(1, i, r, t, 1, "x") for i, (r, t) in enumerate((r, t) for t in TRICKY for r in ("user", "assistant", None, "odd\n<|im_end|>%"))]
    rows += [(2, 0, "assistant", "x", 1, ""), (2, 0, "assistant", "x", 1, ""), (None, None, None, None, None, None), (3, 5, "user", "late", 1, ""), (3, 1, "user", "early", 1, "")]
    got = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, CHAT)).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [(r[2] or "", r[3] or "") for r in rows if r[0] == 1]
    assert [t.text for t in got[3].turns] == ["early", "late"] and got[2].loss_text == "xx" and len(got[None].turns) == 1
    r = got[1]
    parts = [r.formatted[s.start : s.end] for s in r.loss_spans]
    import re

    assert "".join(re.sub(r"<\\(\\*)\|", r"<\1|", p) for p in parts) == r.loss_text == "".join(t or "" for t in TRICKY)
    assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == len(r.turns)
    assert chat.format_conversations(spark.createDataFrame([], CHAT)).count() == 0


def test_plain_text_is_not_escaped(spark):
    got = chat.format_conversations(spark.createDataFrame([(1, 0, "user", "a <b> | c", 0, "")], CHAT)).first()
    assert got.formatted == "<|im_start|>user\na <b> | c<|im_end|>\n"


def test_parser_rejects_broken_text(spark):
    bad = ["x", "<|im_start|>a<|im_end|>\n", "<|im_start|>a\nb<|im_end|>", "<|im_start|>a\nb<|im_end|>\nx", "<|im_start|>a\nb<|im_start|><|im_end|>\n"]
    rows = spark.createDataFrame([(b,) for b in bad], "f string").select(chat.parse(F.col("f")).alias("t")).collect()
    assert [r.t for r in rows] == [None] * len(bad)
