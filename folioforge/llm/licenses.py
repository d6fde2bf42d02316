"""Licence scans: Aho-Corasick finds identifier tags and notice phrases, a shunting-yard parser reads licence expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, texts_of

# The phrases and labels that every scan looks for.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Further notices, in words, and what they say as a licence expression. Longer ones say more than those they begin with.
NOTICES = {
    "apache license version 2 0": "apache-2.0",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "mozilla public license version 2 0": "mpl-2.0",
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "bsl-1.0",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc 4 0": "cc-by-nc-4.0",
    "cc by sa 4 0": "cc-by-sa-4.0",
    "cc by 4 0": "cc-by-4.0",
    "cc0 1 0": "cc0-1.0",
    "all rights reserved": "proprietary",
}
#: Words behind which an expression stands, in the rest of the line.
TAGS = ("spdx license identifier", "license expression", "licence expression")
#: How far the kinds of licences bind: of a choice the least counts, of a conjunction the most. By the identifier's beginning.
STRICTNESS = {
    "mit": 1, "bsd": 1, "apache": 1, "isc": 1, "bsl": 1, "zlib": 1, "unlicense": 0, "cc0": 0, "cc-by": 1, "cc-by-sa": 3, "mpl": 2, "lgpl": 2, "epl": 2,
    "gpl": 3, "agpl": 4, "cc-by-nc": 5, "cc-by-nd": 5, "proprietary": 6,
}
CLASSES = ("public-domain", "permissive", "weak-copyleft", "copyleft", "network-copyleft", "restricted", "proprietary")
#: What an expression, a notice and a base phrase add to the certainty that the text is under the licences it names.
WEIGHTS = {"expression": 0.9, "notice": 0.7, "base": 0.5}

#: Bytes of words as they are, capitals small, all others blank.
_KEEP = bytes(i if i >= 128 or chr(i).isalnum() else 32 for i in range(256)).lower()
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_CAPITALS = {i: i + 32 for i in range(65, 91)}
_TOKEN = re.compile(r"[ \t]*(?:([()])|([A-Za-z0-9][A-Za-z0-9.+:_-]*))")
_MARK = re.compile(r"[ \t]*[:=]?")
_BINDS = {"or": 1, "and": 2, "with": 3}


def words_of(text: str) -> list[str]:
    """Words of a text in lower case (A to Z only): runs of digits, of these letters and of all code points above 127."""
    return text.encode().translate(_KEEP).decode().split(" ")


@cache
def automaton() -> ahocorasick.Automaton:
    """All phrases and tags, each between blanks, so that only whole words match."""
    found = ahocorasick.Automaton()
    known: dict[str, list] = {}
    for kind, phrases in (("base", BASE), ("notice", NOTICES), ("tag", dict.fromkeys(TAGS, ""))):
        for phrase, label in phrases.items():
            known.setdefault(phrase, []).append((kind, label, len(phrase), phrase.count(" ") + 1))
    for phrase, says in known.items():
        found.add_word(f" {phrase} ", says)
    found.make_automaton()
    return found


def expression_tokens(text: str, at: int = 0) -> list[str]:
    """Identifiers, operators and parentheses behind a tag that ends at ``at``, up to the line's end or the first other sign."""
    out, at = [], _MARK.match(text, at).end()
    while m := _TOKEN.match(text, at):
        out.append(m[1] or m[2].lower())
        at = m.end()
    return out


def parse_expression(tokens: list[str]) -> tuple[list[str], int] | None:
    """The longest beginning that is an expression: ``(postfix, tokens used)``; None if there is none.

    Shunting-yard: identifiers go out at once, operators wait until one that binds less, a parenthesis or the end lets them
    go. ``with`` binds tighter than ``and``, that than ``or``; it stands between two identifiers. A second identifier without an operator before it ends
    the expression.
    """
    out: list[str] = []
    waiting: list[str] = []
    depth, want, best = 0, True, None
    for i, token in enumerate(tokens):
        last, behind_with = tokens[i - 1] if i else "", tokens[max(i - 2, 0) : max(i - 1, 0)] == ["with"]
        if want and token == "(" and last != "with":
            waiting.append(token)
            depth += 1
        elif want and token not in _BINDS and token not in ("(", ")"):
            out.append(token.rstrip(".:"))
            want = False
        elif not want and token in _BINDS and not (token == "with" and (last == ")" or behind_with)):
            while waiting and _BINDS.get(waiting[-1], 0) >= _BINDS[token]:
                out.append(waiting.pop())
            waiting.append(token)
            want = True
        elif not want and token == ")" and depth:
            while (op := waiting.pop()) != "(":
                out.append(op)
            depth -= 1
        else:
            break
        if not want and not depth:
            best = len(out), waiting[::-1], i + 1
    return best and (out[: best[0]] + best[1], best[2])


def _class(name: str) -> int | None:
    starts = [k for k in STRICTNESS if name == k or name.startswith((f"{k}-", f"{k}+"))]
    return STRICTNESS[max(starts, key=len)] if starts else None


def evaluate(postfix: list[str]) -> tuple[list[str], int | None]:
    """Labels of an expression, an exception as part of its licence's, and how far it binds (None: unknown)."""
    labels: list[str] = []
    binds: list[int | None] = []
    for token in postfix:
        if token not in _BINDS:
            labels.append(token)
            binds.append(_class(token))
            continue
        right, left = binds.pop(), binds.pop()
        if token == "with":
            exception = labels.pop()
            labels[-1] += f"-with-{exception}"
            # An exception loosens copyleft by one class.
            binds.append(left - 1 if left in (3, 4) else left)
        elif token == "and":
            binds.append(None if left is None or right is None else max(left, right))
        else:
            binds.append(min((x for x in (left, right) if x is not None), default=None))
    return labels, binds[0]


def spell(tokens: list[str]) -> str:
    """An expression in one way: identifiers small, operators in capitals, one blank between them."""
    return " ".join(t.upper() if t in _BINDS else t for t in tokens).replace("( ", "(").replace(" )", ")")


def _count_blanks(text: str, marks: list[int]) -> list[int]:
    """Blanks before each of the ascending places."""
    out, at, n = [], 0, 0
    for m in marks:
        n += text.count(" ", at, m)
        at = m
        out.append(n)
    return out


def scan(text: str) -> dict[str, object]:
    """What one text says about its licences (see :func:`find_licenses`)."""
    words = [w for w in words_of(text) if w]
    line = f" {' '.join(words)} "
    hits = [(end - n - 1, says) for end, many in automaton().iter(line) for says in many for n in (says[2],)]
    hits.sort(key=lambda h: (h[0], h[1]))
    starts = _count_blanks(line, [at for at, _ in hits])
    base = [(w, says[1]) for w, (_, says) in zip(starts, hits) if says[0] == "base"]
    labels, doubt, binding, spelled = set(), 1.0, [], []
    #: The numbers of the words behind tags.
    tagged = {w + n for w, (_, (kind, _, _, n)) in zip(starts, hits) if kind == "tag"}
    if tagged:
        # Only a text with a tag needs the places of its words.
        for i, m in enumerate(_WORD.finditer(text.translate(_CAPITALS))):
            if i + 1 in tagged:
                tokens = expression_tokens(text, m.end())
                if parsed := parse_expression(tokens):
                    names, binds = evaluate(parsed[0])
                    labels |= set(names)
                    binding.append(binds)
                    spelled.append(spell(tokens[: parsed[1]]))
    for _, (kind, label, *_) in hits:
        if kind != "tag":
            labels.add(label)
            if kind == "notice":
                binding.append(_class(label))
            doubt *= 1 - WEIGHTS[kind]
    doubt *= (1 - WEIGHTS["expression"]) ** len(spelled)
    if not binding:
        binding = [_class(label) for _, label in base]
    known = [b for b in binding if b is not None]
    return {
        "n_words": len(words), "n_base": len(base), "first_word": base[0][0] if base else None, "last_word": base[-1][0] if base else None,
        "base_labels": ",".join(sorted({label for _, label in base})), "labels": ",".join(sorted(labels)), "score": 1 - doubt,
        "expressions": sorted(set(spelled)), "license_class": CLASSES[max(known)] if known else None,
    }


FOUND = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions array<string>, license_class string"


def find_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: ``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, expressions, license_class)``.

    ``n_base`` counts the places where the words of a :data:`BASE` phrase stand one behind the other, ``first_word`` and ``last_word``
    are the smallest and largest of their first words, from 0, null without any. ``labels`` adds those of :data:`NOTICES` and of the
    expressions behind :data:`TAGS`. ``expressions`` are these, spelled in one way; ``license_class`` is the strictest class of
    what expressions and notices say (base phrases alone where there is neither), with a choice counted by its loosest side. ``score``
    is the certainty that grows with each finding: none is 0.

    One pass without a shuffle; memory is one record batch. Null texts are empty; null ids and repeated rows are rows like others; extra
    columns are not read; no rows give no rows. A tag without a readable expression adds nothing.
    """

    def run(batch: pa.RecordBatch) -> Iterator[Mapping[str, object]]:
        found = [scan(t) for t in texts_of(batch)]
        yield {"doc_id": batch.column(0)} | {k: [f[k] for f in found] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions", "license_class")}

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), f"doc_id long, {FOUND}", run)
