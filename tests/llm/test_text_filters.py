"""Personal data, secrets, language, toxicity, decontamination and top-k: brute force, planted cases, awkward rows."""

import random
import re

import numpy as np
import pytest

from folioforge.llm import decontam, langid, pii, secretscan, topk, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, base string, spans string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, None, None, "b", "s") for i, t, lang in rows], DOCS)


AWKWARD = [(1, None, None), (2, "", "en"), (3, "a@b.c", "en"), (3, "a@b.c", "en"), (None, "12 !?", None), (4, "wort " * 40_000, "de")]


def plain_pii(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[ -]", "", m.group())
        if 13 <= len(d) <= 19 and sum(int(x) if i % 2 == 0 else sum(map(int, str(2 * int(x)))) for i, x in enumerate(reversed(d))) % 10 == 0:
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub(r"\D", "", m.group())) <= 15]
    return out


def test_pii_base_equals_plain_patterns():
    rng = random.Random(2)
    pieces = ["a@b.c", "@", ".", "x_y@z-1.com", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111111111111111", "+1 (555) 010-9999", "+", " ", "-", "9", "0", "é", "\n", "a", "%", "@a.b"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        assert pii.base_spans(text) == plain_pii(text), text


@pytest.mark.parametrize(
    "text,kind,source",
    [
        ("mail jаne@exаmple.com now", "email", "jаne@exаmple.com"),
        ("mail jane [at] example [dot] com now", "email", "jane [at] example [dot] com"),
        ("mail jane (at) example.com now", "email", "jane (at) example.com"),
        ("mail jane at example dot com.", "email", "jane at example dot com"),
        ("ip one nine two dot one six eight dot one dot seven.", "ip", "one nine two dot one six eight dot one dot seven"),
        ("call plus one five five five zero one zero nine nine nine nine.", "phone", "plus one five five five zero one zero nine nine nine nine"),
        ("card ４１１１ １１１１ １１１１ １１１１!", "card", "４１１１ １１１１ １１１１ １１１１"),
        ("card four one one one 1111 1111 one one one one!", "card", "four one one one 1111 1111 one one one one"),
        ("ip 10​.0.0.1 x", "ip", "10​.0.0.1"),
    ],
)
def test_pii_disguises(text, kind, source):
    base, spans = pii.all_spans(text)
    found = [(pii.KINDS[k], text[a:b]) for k, a, b in spans if (k, a, b) not in base]
    assert (kind, source) in found


@pytest.mark.parametrize("text", ["we met at noon. dot", "look at example.com now", "one at a time", "five or six dogs", "one two three", "that at reat. Of nt", "Straße 7 at the end"])
def test_pii_leaves_plain_text(text):
    assert pii.all_spans(text) == ([], [])


@pytest.mark.parametrize(
    "source",
    [
        "192[.]168[.]1[.]7", "192 (dot) 168 (dot) 1 (dot) 7", "192 dot 168 dot 1 dot 7", "192.168[dot]1 DOT 7", "192 point 168 point 1 point 7",
        "eight dot eight dot eight dot eight", "eight point eight point eight point eight", "eight [dot] eight [dot] eight [dot] eight", "eight.eight.eight.eight",
    ],
)
def test_pii_dots_between_digits(source):
    text = f"ip {source}, then"
    base, spans = pii.all_spans(text)
    assert base == [] and spans == [(1, 3, 3 + len(source))]
    assert pii.redact(text) == "ip [IP], then"


def test_pii_dashes_between_spelled_digits():
    source = "plus one dash five five five dash zero one zero dash nine nine nine nine"
    assert pii.redact(f"call {source}.") == "call [PHONE]."
    apart = "plus one dash five dash five dash five dash zero dash one dash zero dash nine dash nine dash nine"
    assert pii.redact(f"call {apart}.") == "call [PHONE]."


@pytest.mark.parametrize("text", ["release 2 dot 5 is out", "at 3 point 7 of 10", "one dot two", "1 dot 300 dot 1 dot 1", "a 1 (dot) b 2"])
def test_pii_dots_in_plain_text(text):
    assert pii.redact(text) == text


def test_pii_tables(spark):
    rows = {r.doc_id: r for r in pii.find_pii(docs(spark, AWKWARD)).collect()}
    assert rows[3].n_email == 1 and rows[3].spans == "email:0:5" and rows[1].spans == "" and len(rows) == 5
    assert pii.find_pii(docs(spark, [])).count() == 0
    out = pii.redact_documents(docs(spark, AWKWARD))
    assert out.columns == docs(spark, []).columns and sorted(str(r.text)[:9] for r in out.collect()).count("[EMAIL]") == 2


def plain_secrets(text):
    key = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY]"
    out = [(0, *m.span()) for m in re.finditer(rf"({key})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m.group(2)) >= 8]
    out += [(1, *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    out += [(2, *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(out, key=lambda s: (s[1], s[0]))


def test_secret_base_equals_plain_patterns():
    rng = random.Random(4)
    pieces = ["password", "PassWD", "ſecret", "secret", "toKen", "toKen", "api_key", "APIKEY", " ", "=", ":", "'", '"', "abcdefgh", "x.1", "AKIA", "ABCDEFGHIJKL", "0123456789abcdef", "0123456789abcdef0123456789abcdef", "\t", "é"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 10)))
        assert secretscan.base_spans(text) == plain_secrets(text), text


def test_markov_ratio_equals_direct_form():
    import math

    ordinary = [("abba_cab", 3), ("cabbage", 2)]
    pair = secretscan.MarkovPair([("q7Z", 1), ("Z7q", 1)], ordinary)

    def log_probability(samples, before, sign):
        seen = [(a, b, n) for token, n in samples for a, b in zip(f" {token}", token)]
        alone = (sum(n for _, b, n in seen if b == sign) + 1) / (sum(n for _, _, n in seen) + len(secretscan.SIGNS) + 1)
        given, from_it = sum(n for a, b, n in seen if (a, b) == (before, sign)), sum(n for a, _, n in seen if a == before)
        return math.log((given + pair.blend * alone) / (from_it + pair.blend))

    token = "cabZ7"
    want = sum(log_probability([("q7Z", 1), ("Z7q", 1)], a, b) - log_probability(ordinary, a, b) for a, b in zip(f" {token}", token)) / len(token)
    assert math.isclose(pair.score(token), want)


def test_secrets_take_time_in_proportion(spark):
    import time

    pair = secretscan.MarkovPair([("q7Zk2PxV9rT4mWc8LsYb1NdH", 1)], [("configuration_values", 5)])
    hexes = "0123456789abcdef0123456789abcdef zz "
    for text in (hexes * 30_000, "q7Zk2PxV9rT4mWc8LsYb " * 50_000, "a1" * 500_000, "token" + " " * 1_000_000, "AKIA" * 250_000, hexes * 20_000 + "q7Zk2PxV9rT4mWc8LsYb " * 20_000):
        began = time.process_time()
        secretscan.all_spans(text, pair, 0.0)
        assert time.process_time() - began < 20


def test_markov_models_part_random_from_ordinary(spark):
    words = "the quick brown fox jumps over lazy dogs while configuration values remain in repository_settings and getUserAccountName".split()
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(words) for _ in range(60)), "en") for i in range(40)]
    token = "q7Zk2PxV9rT4mWc8LsYb1NdH"
    rows += [(100, f"key {token} end", "en"), (101, "some_repository_settings_value_2 configuration_values_remain_10", "en"), *AWKWARD]
    got = {r.doc_id: r for r in secretscan.find_secrets(docs(spark, rows)).collect()}
    assert got[100].spans == f"random:4:{4 + len(token)}" and got[101].spans == "" and got[1].spans == ""
    assert secretscan.find_secrets(docs(spark, [])).count() == 0


LANGS = {"aa": ["kato", "mira", "solun", "tarik"], "bb": ["wex", "quib", "zorp", "yexx"]}


def test_language(spark):
    rng = random.Random(7)
    rows = []
    for i in range(10, 210):
        lang = ("aa", "bb")[i % 2]
        rows.append((i, " ".join(rng.choice(LANGS[lang]) for _ in range(12)), lang))
    rows += [(900, "katomira solunkato", None), (901, "zorpwexx quibzo", None), *AWKWARD]
    table = docs(spark, rows)
    model = langid.fit(table)
    got = {r.doc_id: r for r in langid.identify(table, model).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows[:200]) and got[900].lang_pred == "aa" and got[901].lang_pred == "bb"
    import zlib

    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(10, 210))
    assert got[1].lang_pred == got[2].lang_pred == got[None].lang_pred == "und" and got[1].score == 0
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = {r.doc_id for r in langid.keep_identified(table, model).collect()}
    assert {1, 2, None}.isdisjoint(kept) and set(range(10, 210)) <= kept
    none = langid.fit(docs(spark, []))
    assert none.predict("kato") == ("und", 0.0)


def test_language_backs_off_step_by_step():
    """Scores of unseen words against a direct recursion over the same counts."""
    import math
    from collections import Counter

    counts = [("aa", "kato", 5), ("aa", "mira", 4), ("bb", "kazo", 6), ("bb", "wex", 3)]
    model = langid.LanguageModel(counts, order=3, min_count=1)
    grams = {lang: Counter() for lang in ("aa", "bb")}
    for lang, word, n in counts:
        for size in (1, 2, 3):
            for i in range(len(word) + 3 - size):
                grams[lang][f"^{word}$"[i : i + size]] += n
    every = set(grams["aa"]) | set(grams["bb"])

    def score(lang, gram):
        if not gram:
            return math.log(0.5) - math.log(sum(n for g, n in grams[lang].items() if len(g) == 1) + 1)
        if grams[lang][gram]:
            given = grams[lang][gram[:-1]] if len(gram) > 1 else sum(n for g, n in grams[lang].items() if len(g) == 1)
            return math.log(grams[lang][gram] / given)
        return math.log(0.4) + score(lang, gram[1:])

    word, want = "^kamx$", []
    for lang in ("aa", "bb"):
        total = 0.0
        for end in range(2, len(word) + 1):
            known = next((word[s:end] for s in range(max(end - 3, 0), end) if word[s:end] in every), "")
            total += score(lang, known)
        want.append(total)
    assert np.allclose(model.unseen("kamx")[0], want) and model.unseen("kamx")[1] == 0


def test_language_prediction_equals_direct_form():
    import math

    counts = [("aa", "kato", 5), ("aa", "mira", 4), ("bb", "kato", 1), ("bb", "wex", 3)]
    model = langid.LanguageModel(counts, order=3, min_count=1)
    totals = {"aa": 9, "bb": 4}
    scores = []
    for i, lang in enumerate(("aa", "bb")):
        known = sum(t * math.log((dict(((a, w), n) for a, w, n in counts).get((lang, word), 0) + 0.5) / (totals[lang] + 1.5)) for word, t in (("kato", 2), ("wex", 1)))
        scores.append(known + model.unseen("zorp")[0][i])
    want = 1 / sum(math.exp(s - max(scores)) for s in scores)
    lang, score = model.predict("Kato wex, kato 12 zorp")
    # z, p and one more sign of "zorp" are in no training text.
    strange = model.unseen("zorp")[1]
    assert lang == ("aa", "bb")[scores.index(max(scores))] and math.isclose(score, want * (1 - strange / 15)) and strange == 2


@pytest.mark.parametrize("text", ["½ ²", "①Ⅷ", "१२", "🙂", "_", None, ""])
def test_language_needs_letters(text):
    assert langid.LanguageModel([("aa", "kato", 5)]).predict(text or "") == ("und", 0.0)


def test_language_of_strange_scripts_scores_low(spark):
    rows = [(i, "kato mira solun tarik " * 3, "aa") for i in range(40)] + [(100, "като мира " * 20, None), (101, "कातो" * 5000, None), (102, "kato мира", None)]
    model = langid.fit(docs(spark, rows))
    kept = {r.doc_id for r in langid.keep_identified(docs(spark, rows), model).collect()}
    assert kept == set(range(40)) | {102} or kept == set(range(40))
    assert model.predict("като мира")[0] == "aa" and model.predict("като мира")[1] == 0


def test_toxicity(spark):
    rng = random.Random(8)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(10) for j in range(10)]
    rows, labels = [], []
    for i in range(600):
        n = i % 4 if i % 3 == 0 else 0
        text = [rng.choice(words) for _ in range(40)] + ["vilefoe"] * (n > 0) + ["scornix"] * (n > 1) + ["grubbel"] * (n > 2)
        rng.shuffle(text)
        rows.append((i, " ".join(text), "en"))
        labels.append((i, int(n > 0)))
    rows += [(1000 + i, t, "en") for i, t in enumerate(["wab vilefoe wcd", "wab wcd", "vilefoe scornix grubbel"])] + [(2000, None, None), (2001, "", None)]
    table = docs(spark, rows)
    known = spark.createDataFrame([*labels, (None, 1), (5, None), (99_999, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(table, toxicity.fit(table, known)).collect()}
    assert all(got[i].toxic == bool(t) for i, t in labels)
    assert got[1000].toxic and not got[1001].toxic and got[1002].severity > got[1000].severity > got[1001].severity
    assert got[2000].severity == got[2001].severity == 0
    flat = toxicity.fit(table, spark.createDataFrame([], "doc_id long, toxic int"))
    assert not any(r.toxic for r in toxicity.score(table, flat).collect())


def test_ordinal_likelihood_and_gradient_equal_brute_force():
    rng = np.random.default_rng(3)
    rows = [sorted(rng.choice(6, rng.integers(0, 5), replace=False).tolist()) for _ in range(40)]
    y = rng.integers(0, 4, 40)
    flat, row = np.array([f for r in rows for f in r], np.int64), np.repeat(np.arange(40), [len(r) for r in rows])
    weight = rng.random(40)
    params = [rng.normal(size=6), np.array([0.3]), rng.normal(size=2)]
    loss, slopes = toxicity.loss_and_gradient(params, flat, row, y, weight, 0.01)
    cuts = [0.3, 0.3 + np.exp(params[2][0]), 0.3 + np.exp(params[2][0]) + np.exp(params[2][1])]
    want = 0.005 * float((params[0] ** 2).sum())
    for features, grade, w in zip(rows, y, weight):
        above = [1, *(1 / (1 + np.exp(c - params[0][features].sum())) for c in cuts), 0]
        want -= w * np.log(above[grade] - above[grade + 1])
    assert np.isclose(loss, want)
    for p, slope in zip(params, slopes):
        for i in range(len(p)):
            p[i] += 1e-6
            up = toxicity.loss_and_gradient(params, flat, row, y, weight, 0.01)[0]
            p[i] -= 2e-6
            down = toxicity.loss_and_gradient(params, flat, row, y, weight, 0.01)[0]
            p[i] += 1e-6
            assert np.isclose(slope[i], (up - down) / 2e-6, atol=1e-4)


def test_ordinal_thresholds_are_ordered():
    model = toxicity.OrdinalModel(3).fit([[0], [0, 1], [0, 1, 2], [1], []] * 20, [0, 1, 2, 1, 0] * 20)
    assert model.thresholds[0] < model.thresholds[1]
    assert model.expected([0, 1, 2]) > model.expected([1]) > model.expected([0])


def edit_distance_within(pattern, text):
    """Least edits of the pattern against any stretch of the text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_banded_alignment_equals_full_table():
    rng = random.Random(9)
    for _ in range(60):
        pattern = "".join(rng.choice("abc ") for _ in range(20))
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 50)))
        a, b = decontam.folded(pattern), decontam.folded(text)
        edits, start, end = decontam.banded_alignment(a, b, -25, len(text) + 50)
        assert edits == edit_distance_within(pattern, text)
        if edits < 20:
            assert edit_distance_within(pattern, text[max(start, 0) : end]) == edits


def noisy(text, k, rng):
    out = list(text)
    for _ in range(k):
        at = rng.randrange(len(out))
        what = rng.random()
        out[at : at + 1] = [] if what < 0.33 else [rng.choice("xyz")] if what < 0.66 else [out[at], "q"]
    return "".join(out)


@pytest.mark.parametrize("hits", [20, 1 << 20])
def test_contamination_equals_brute_force(monkeypatch, hits):
    monkeypatch.setattr(decontam, "_HITS", hits)
    rng = random.Random(10)
    items = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (60, 90, 130, 250, 20)]
    index = decontam.BenchmarkIndex(items)
    texts = [""] + ["".join(rng.choice("abcdefgh ") for _ in range(200)) for _ in range(5)]
    for i in range(30):
        item = items[i % 4]
        texts.append("lead " * rng.randint(0, 8) + noisy(" ".join(item.split()), i % 9, rng) + " tail" * rng.randint(0, 8))
    found = index.find(texts)
    for text, regions in zip(texts, found):
        low = "".join(map(chr, decontam.folded(text)))
        want = {w for w in range(len(index.owner)) if edit_distance_within("".join(map(chr, index.pattern(w))), low) <= index.edits[w]}
        assert {r.window for r in regions} == want
    assert any(found) and not any(found[:6])


def test_contamination_tables(spark):
    item = "Thtieding. Onhe in haedea it ha with orbleat thesstea heerthly. Erensh oron nt thinorsh erresh that anonhath to thntin onst"
    bench = spark.createDataFrame([(1, item), (2, None), (None, "x" * 60), (3, "short"), (1, item)], "item_id long, text string")
    rows = [*AWKWARD, (10, "before " + item.upper().replace(" ", "\n") + " after", "en"), (11, "before " + item[:60], "en"), (12, "y" * 500 + "x" * 60, "en")]
    got = {(r.doc_id, r.item_id) for r in decontam.find_contamination(docs(spark, rows), bench).collect()}
    assert got == {(10, 1), (12, None)}
    sliced = {(r.doc_id, r.item_id) for r in decontam.find_contamination(docs(spark, rows), bench, max_chars=50).collect()}
    assert sliced == got
    kept = decontam.drop_contaminated(docs(spark, rows), bench)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in rows if r[0] not in (10, 12))
    assert decontam.find_contamination(docs(spark, rows), bench.limit(0)).count() == 0


def test_contamination_with_runs_of_white_space(spark):
    item = "for each row in rows:\n        total += row.value\n        if total > limit:\n            break\n    report the total of all rows to the caller"
    bench = spark.createDataFrame([(1, item), (2, "Onhe in haedea it ha with orbleat thesstea heerthly and erensh oron nt thinorsh erresh that anonhath")], "item_id long, text string")
    spaced = "Onhe in haedea it ha with orbleat thesstea heerthly and erensh oron nt thinorsh erresh that anonhath".replace(" ", " \n\t ")
    rows = [(1, "x  y " + item + "  z", "en"), (2, "  a\n\n" + spaced + "\n\n b", "en"), (3, " \n ", "en"), *AWKWARD[1:]]
    got = {(r.doc_id, r.item_id): r for r in decontam.find_contamination(docs(spark, rows), bench).collect()}
    assert set(got) == {(1, 1), (2, 2)}
    assert (got[1, 1].start, got[1, 1].end, got[1, 1].edits) == (5, 5 + len(item), 0)
    assert (got[2, 2].start, got[2, 2].end, got[2, 2].edits) == (5, 5 + len(spaced), 0)


def test_contamination_by_shorter_passages_and_short_items():
    rng = random.Random(13)
    letters = "abcdefghijklmnopqrstuvwxyz"
    long = " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(60))
    index = decontam.BenchmarkIndex([long, "What is 2 + 2?", "Paris", "?!"])
    for start in range(0, len(long) - 92):
        assert [r.item for r in index.find_in(["lead " + long[start : start + 92] + " tail"])[0]][:1] == [0], start
    texts = ["so, what  is 2 + 2?", "go to PARIS.", "comparison parisian", "what is 2 + 3?", "?!", ""]
    assert [[(r.item, r.start, r.end) for r in found] for found in index.find_in(texts)] == [[(1, 4, 19)], [(2, 6, 11)], [], [], [], []]


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(11)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6) * (1 + i % 5)]) for i in range(400)]
    rows += [(1000 + i, [0.5] * 6) for i in range(60)]
    rows += [(2000, None), (2020, [1.0, None]), (2040, [float("nan")] * 6), (2060, [float("inf")] * 6), (None, [1.0] * 6), (2080, [0.25, 0.5]), (2081, [])]
    frame = spark.createDataFrame([(i, v, 3, "x") for i, v in rows], "vec_id long, embedding array<double>, norm2 int, q string")
    good = [(i, np.pad(np.floor(64 * np.array(v)).astype(np.int64), (0, 6 - len(v)))) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for i, v in good:
        if i % 20 == 0:
            best = sorted((-int(v @ w), j) for j, w in good if j != i)[:20]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for sizes in ({}, {"block": 32, "query_block": 8, "stripe": 2}):
            got = [tuple(r) for r in topk.top_k(frame, **sizes).collect()]
            assert sorted(got) == sorted(want)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert topk.top_k(frame.limit(0)).count() == 0


def test_pii_takes_time_in_proportion():
    import time

    big = 1_000_000
    texts = [
        "a" * big + " x dot y", "a dot " * (big // 6) + "b", "x at " * (big // 5) + "y", " " * big + "at x dot y", "a (at) " * (big // 7), "+1" + "(" * big, "1" * big + "a", "@" * big,
        "one " * (big // 4), "1 dot " * (big // 6), "а" + "me@mail.example " * 50_000, "a[.]" * (big // 4) + "b (at) c.d",
    ]
    for text in texts:
        began = time.process_time()
        pii.all_spans(text)
        assert time.process_time() - began < 20, text[:20]
    base, spans = pii.all_spans("а" + "me@mail.example " * 1000)
    assert len(base) == 1000 and len(spans) == 1001
    assert pii.redact("jane dot van (dot) doe at mail dot example dot org or x@y dot z") == "[EMAIL] or [EMAIL]"


def test_shared_templates_take_bounded_memory():
    import tracemalloc

    rng = random.Random(17)
    letters = "abcdefghijklmnopqrstuvwxyz "
    prefix = "".join(rng.choice(letters[:26]) for _ in range(60))
    items = [prefix + "".join(rng.choice(letters[:26]) for _ in range(40)) for _ in range(1000)]
    index = decontam.BenchmarkIndex(items)
    tracemalloc.start()
    found = index.find_in([(prefix + " ") * 60 + items[7] + " end"])[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {r.item for r in found if r.edits == 0} == {7} and peak < 300e6, peak


def test_recall_of_verbatim_passages_by_length():
    rng = random.Random(18)
    item = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(80))
    index = decontam.BenchmarkIndex([item])
    for size, least in ((89, 1.0), (100, 1.0), (80, 0.9)):
        starts = range(0, len(item) - size, 3)
        found = index.find_in([f"lead {item[s : s + size]} tail" for s in starts])
        assert sum(bool(f) for f in found) >= least * len(starts), size


def test_top_k_leaves_out_short_blocks(spark):
    """Lengths that fall off: most pairs of blocks are gone before the shuffle, and the result is that of brute force."""
    rng = np.random.default_rng(19)
    vectors = rng.normal(size=(600, 4)) * np.exp(-np.arange(600) / 60)[:, None] * 50
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    seen = []
    keep = topk.surviving_pairs
    topk.surviving_pairs = lambda blocks, asked: seen.append((keep(blocks, asked).count(), blocks.count() * asked.count())) or keep(blocks, asked)
    try:
        got = sorted(tuple(r) for r in topk.top_k(frame, k=5, block=16, query_block=8, stripe=2).collect())
    finally:
        topk.surviving_pairs = keep
    ints = np.floor(64 * vectors).astype(np.int64)
    want = []
    for i in range(0, 600, 20):
        best = sorted((-int(s), j) for j, s in enumerate(ints @ ints[i]) if j != i)[:5]
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert got == sorted(want) and seen[0][0] < seen[0][1] / 2, seen


def test_top_k_refuses_what_does_not_fit(spark):
    frame = spark.createDataFrame([(0, [1e9]), (1, [1e9])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="too large"):
        topk.top_k(frame)


def test_samples_take_rows_of_one_id_apart(spark):
    """Rows without an id, more than the sample holds: some are learned from, not all or none."""
    own = lambda i: "wort" + "".join(chr(97 + int(c)) for c in str(i))
    rows = [(None, f"kato mira {own(i)} solun", "aa") for i in range(400)] + [(None, f"le petit {own(i + 1000)} vert", "bb") for i in range(400)]
    model = langid.fit(docs(spark, rows), docs_per_lang=60, min_count=1)
    assert model.langs == ["aa", "bb"] and model.predict("kato mira solun")[0] == "aa" and model.predict("petit vert")[0] == "bb"
    assert 20 < sum(own(i) in model.words for i in range(400)) < 140


def test_benchmarks_in_slices_equal_one(spark):
    """Items over several slices: the same rows, each slice's index gone before the next."""
    items = [(i, " ".join(f"{w}{i}" for w in ("kato", "mira", "velon", "tarik", "basta", "nidorupa", "gelon"))) for i in range(12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = docs(spark, [(i, f"before {t} after" if i % 2 else f"clean words {i}", "aa") for i, t in items])
    one = sorted(map(tuple, decontam.find_contamination(rows, bench).collect()))
    many = sorted(map(tuple, decontam.find_contamination(rows, bench, max_chars=150).collect()))
    assert one == many and {r[0] for r in one} == {i for i, _ in items if i % 2}
    assert {r.doc_id for r in decontam.drop_contaminated(rows, bench, max_chars=150).collect()} == {i for i, _ in items if i % 2 == 0}
