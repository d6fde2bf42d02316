"""Personal data: detection in plain and disguised form, with spans of the source text, and redaction."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, rewrite_rows, texts_of

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Letters and signs that look like ASCII ones.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s",
    "т": "t", "у": "y", "х": "x", "ԁ": "d", "ո": "n", "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J",
    "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X", "ɑ": "a", "ɡ": "g", "ı": "i", "ο": "o",
    "ν": "v", "ρ": "p", "α": "a", "ι": "i", "κ": "k", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K",
    "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "․": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-",
    "–": "-", "−": "-", " ": " ", " ": " ", " ": " ", "﹢": "+", "﹫": "@", "٠": "0", "١": "1", "٢": "2", "٣": "3",
    "٤": "4", "٥": "5", "٦": "6", "٧": "7", "٨": "8", "٩": "9",
}
LOOKALIKES |= {chr(0xFEE0 + c): chr(c) for c in range(0x21, 0x7F)}
# Characters that take no room.
INVISIBLE = "­​‌‍⁠﻿"
# Spelled digits (English, French, German, Spanish) and signs.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8",
    "nine": "9", "zéro": "0", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8",
    "neun": "9", "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7",
    "ocho": "8", "nueve": "9",
}
_TABLE = str.maketrans(LOOKALIKES)
_ODD = re.compile("[" + re.escape("".join(LOOKALIKES) + INVISIBLE) + "]")
_DIGIT = "(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + ")"
_BR_DOT = r"[ ]?[\[({<][ ]?(?:dot|\.)[ ]?[\])}>][ ]?"
_ITEM = rf"(?:{_DIGIT}(?![^\W_])|[0-9]+(?![^\W\d_]))"
#: Three or more spelled digits in a row; plain digits, "plus", "dot" and "dash" may stand between them.
_SPELLED = re.compile(
    rf"(?<![^\W_])(?:plus[ -]?)?{_ITEM}(?:(?:[ ,-]{{1,2}}|{_BR_DOT}|[ ]?(?:\.|dot|point|dash|hyphen)[ ]?|[ ]?[()][ ]?){_ITEM})+", re.I
)
_TOKEN = re.compile(rf"(?P<d>{_DIGIT})|(?P<p>plus[ -]?)|(?P<o>{_BR_DOT}|[ ]?(?:dot|point)[ ]?)|(?P<h>[ ]?(?:dash|hyphen)[ ]?)|(?P<s>[ ,-]{{1,2}})|(?P<x>.)", re.I | re.S)
_HINT = re.compile(rf"(?<![^\W_]){_DIGIT}(?:[ ,-]{{1,2}}|[ ]?(?:\.|dot|point|dash|hyphen)[ ]?|[ ]?[()][ ]?|{_BR_DOT}){_DIGIT}(?![^\W_])", re.I)
_BR_AT = r"[ ]?[\[({<][ ]?(?:at|@)[ ]?[\])}>][ ]?"
_WORD_AT, _WORD_DOT = r"(?<![ ])[ ]++at[ ]++", r"[ ]++dot[ ]++"
_PART, _DOT = r"[A-Za-z0-9-]++", rf"(?:{_BR_DOT}|{_WORD_DOT})"
#: The "at" of a disguised address, and what must stand behind it: plain or disguised dots behind a bracketed one,
#: disguised dots only behind a bare one, at least one disguised dot behind "@".
_AT = re.compile(rf"(?P<bracket>{_BR_AT})|(?P<word>{_WORD_AT})|(?P<sign>@)", re.I)
_DOMAINS = {
    "bracket": re.compile(rf"{_PART}(?:(?:{_DOT}|\.){_PART})++", re.I), "word": re.compile(rf"{_PART}(?:{_DOT}{_PART})++", re.I),
    "sign": re.compile(rf"{_PART}(?:\.{_PART})*+(?:{_DOT}{_PART})++", re.I),
}
#: A disguised dot before a place, read from right to left.
_DOT_BACKWARDS = re.compile(r"[ ]?[\])}>][ ]?(?:tod|\.)[ ]?[\[({<][ ]?|[ ]++tod[ ]++", re.I)
#: Dots between digits, bracketed or spelled.
_NUMBER_DOT = re.compile(rf"(?<=[0-9])(?:{_BR_DOT}|[ ]*(?:dot|point)[ ]*)(?=[0-9])", re.I)
_DISGUISE_HINT = re.compile(r"[\[({<][ ]?(?:at|@|dot|\.)[ ]?[\])}>]|[ ]dot[ ]", re.I)
_ANY_DOT = re.compile(_DOT, re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping; each sign is looked at from its own "@" to the left, so long words cost no more."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        else:
            done = max(done, at)
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Spans ``(kind index, start, end)`` of the plain patterns, in the order of kind and start."""
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := m.group().replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((3, *m.span()))
    return out


def _disguised_addresses(text: str) -> Iterator[tuple[int, int, int, int]]:
    """``(start, "at" start, "at" end, end)`` of disguised addresses, leftmost first, non-overlapping.

    Each "at" is looked at once: first what stands behind it, then its local part from right to left, which ends at the
    address before. So the time is in proportion to the text, whatever it is.
    """
    done, backwards = 0, None
    for sign in _AT.finditer(text):
        if sign.start() < done:
            continue
        domain = _DOMAINS[sign.lastgroup].match(text, sign.end())
        if not domain:
            continue
        start = at = sign.start()
        while True:
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start == at:
                break
            backwards = text[::-1] if backwards is None else backwards
            dot = _DOT_BACKWARDS.match(backwards, len(text) - start)
            before = start - (dot.end() - dot.start()) if dot else 0
            if not dot or before <= done or text[before - 1] not in _LOCAL:
                break
            start = before
        if start < at:
            yield start, at, sign.end(), domain.end()
            done = domain.end()


def _undisguise(text: str) -> tuple[str, list[int], list[int]] | None:
    """The normalised text with the source start and end of each of its characters; None if nothing is disguised.

    Four transducers run one after the other, each rewriting pieces and composing the offsets: look-alike and invisible
    characters, spelled digits, dots between digits, then at/dot disguises.
    """
    odd = _ODD.search(text) is not None
    changed = False
    starts: list[int] | range = range(len(text))
    ends: list[int] | range = range(1, len(text) + 1)
    if odd:
        keep = [i for i, c in enumerate(text) if c not in INVISIBLE]
        text = "".join(text[i] for i in keep).translate(_TABLE)
        starts, ends, changed = keep, [i + 1 for i in keep], True

    def apply(edits: list[tuple[int, int, str]]) -> None:
        nonlocal text, starts, ends, changed
        if not edits:
            return
        parts, s, e, at = [], [], [], 0
        for a, b, out in edits:
            parts += [text[at:a], out]
            s += starts[at:a]
            e += ends[at:a]
            s += [starts[a]] * len(out)
            e += [ends[b - 1]] * len(out)
            at = b
        parts.append(text[at:])
        s += starts[at:]
        e += ends[at:]
        text, starts, ends, changed = "".join(parts), s, e, True

    if _HINT.search(text):
        edits = []
        for run in _SPELLED.finditer(text):
            tokens = list(_TOKEN.finditer(text, run.start(), run.end()))
            if sum(t.lastgroup == "d" for t in tokens) < 3:
                continue
            for t in tokens:
                if t.lastgroup in "dpohs":
                    sign = {"p": "+", "o": ".", "h": "-", "s": ""}
                    out = DIGIT_WORDS[t.group().lower()] if t.lastgroup == "d" else sign[t.lastgroup]
                    edits.append((*t.span(), out))
        apply(edits)
    apply([(*m.span(), ".") for m in _NUMBER_DOT.finditer(text)])
    if _DISGUISE_HINT.search(text):
        edits = []
        for start, at, end, done in _disguised_addresses(text):
            edits += [(*t.span(), ".") for t in _ANY_DOT.finditer(text, start, at)]
            edits += [(at, end, "@"), *((*t.span(), ".") for t in _ANY_DOT.finditer(text, end, done))]
        apply(edits)
    return (text, list(starts), list(ends)) if changed else None


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """The base spans, and all spans: the base ones and those of the normalised text that no base span of their kind covers."""
    base = base_spans(text)
    plain = _undisguise(text)
    if plain is None:
        return base, base
    normal, starts, ends = plain
    more = set()
    for kind, a, b in base_spans(normal):
        start, end = starts[a], ends[b - 1]
        # Base spans stand in the order of kind and start, and those of one kind don't overlap.
        i = bisect_right(base, (kind, start, len(text) + 1)) - 1
        if i < 0 or base[i][0] != kind or base[i][2] < end:
            more.add((kind, start, end))
    return base, sorted({*base, *more})


def spell(spans: Iterable[Span], kinds: tuple[str, ...] = KINDS) -> str:
    return ",".join(f"{kinds[k]}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per document: ``(doc_id, n_email, n_ip, n_card, n_phone, base, spans, n_spans)``.

    Counts and ``base`` are those of the plain patterns; ``spans`` adds disguised identifiers, and ``n_spans`` counts all. Spans are
    ``kind:start:end`` in code points of the source text. Null and empty texts have none; null ids and repeated rows are
    rows like others; extra columns are not read.
    """

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        found = [all_spans(t) for t in texts_of(batch)]
        columns = {f"n_{kind}": [sum(k == i for k, _, _ in base) for base, _ in found] for i, kind in enumerate(KINDS)}
        yield {"doc_id": batch.column(0), **columns, "base": [spell(b) for b, _ in found], "spans": [spell(s) for _, s in found], "n_spans": [len(s) for _, s in found]}

    return map_batches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string, n_spans long",
        run,
    )


def redact(text: str) -> str:
    """The text with each stretch of overlapping spans replaced by the name of its first span's kind."""
    parts, at, merged = [], 0, []
    for kind, a, b in sorted(all_spans(text)[1], key=lambda s: (s[1], -s[2], s[0])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        parts += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = b
    return "".join(parts) + text[at:]


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by ``[EMAIL]``, ``[IP]``, ``[CARD]`` or ``[PHONE]``.

    ``n_chars``, where there is one, follows the new text. Null texts stay null; no row and no other column changes.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index("text")
        old = batch.column(at).to_pylist()
        new = [t and redact(t) for t in old]
        columns = list(batch.columns)
        columns[at] = pa.array(new, batch.schema.field(at).type)
        n = batch.schema.get_field_index("n_chars")
        if n >= 0:
            counts = zip(old, new, batch.column(n).to_pylist())
            columns[n] = pa.array([len(b) if a != b else c for a, b, c in counts], batch.schema.field(n).type)
        return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return rewrite_rows(docs, run)
