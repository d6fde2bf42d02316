"""Line normalisers that know code fences and table blocks.

A text is cut into segments by one regular expression: a fenced block (to the end of the text if it isn't closed), a run
of table lines, or another line. Rules then work on the segments they are meant for, inside one projection: no shuffle,
no window, no Python.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as X

_B = X.BLANK
#: Possessive loops, so that long blocks need no stack.
_SEGMENT = (
    rf"(?U)(?:{_B}*+```[^\n]*+\n(?:(?!{_B}*+```)[^\n]*+\n)*+(?:{_B}*+```[^\n]*+\n)?+)"
    rf"|(?:{_B}*+\|[^\n]*+\n)++|[^\n]*+\n"
)
_CODE, _TABLE = rf"(?U)\A{_B}*```", rf"(?U)\A{_B}*\|"


def segments(text: Column) -> Column:
    """Segments of ``text`` with a line feed put behind its last line; joined again they are that text."""
    return F.regexp_extract_all(F.concat(text, F.lit("\n")), F.lit(_SEGMENT), F.lit(0))


def _unended(text: Column) -> Column:
    """Without a line feed at the end."""
    return F.substring(text, F.lit(1), F.length(text) - F.endswith(text, F.lit("\n")).cast("int"))


def join_segments(parts: Column) -> Column:
    return X.let(F.array_join(parts, ""), _unended)


def lines_of(segment: Column) -> Column:
    """The lines of a segment, without the line feeds."""
    return F.split(_unended(segment), "\n", -1)


def is_code(segment: Column) -> Column:
    return segment.rlike(_CODE)


def is_table(segment: Column) -> Column:
    return segment.rlike(_TABLE)


def is_hash_line(line: Column) -> Column:
    """A line whose first sign is ``#``: the loosest of the heading tests."""
    return line.rlike(r"(?U)\A\s*#")


def is_heading(line: Column) -> Column:
    """One to six ``#`` at the start, then white space."""
    return line.rlike(r"(?U)\A#{1,6}\s")


def limit_blank_runs(text: Column) -> Column:
    return F.regexp_replace(text, r"\n{3,}", "\n\n")


def map_lines(text: Column, rule: Callable[[Column], Column], fenced: bool = False) -> Column:
    """Replace every line outside fences (everywhere if ``fenced``) by the lines that ``rule`` gives as an array."""
    if fenced:
        return F.array_join(F.flatten(F.transform(F.split(text, "\n", -1), rule)), "\n")

    def one(segment: Column) -> Column:
        kept = F.flatten(F.transform(lines_of(segment), rule))
        return F.when(is_code(segment), segment).otherwise(F.array_join(F.transform(kept, lambda x: F.concat(x, F.lit("\n"))), ""))

    return join_segments(F.transform(segments(text), one))


# Parts of an expression whose meaning depends on what stands around a line: anchors, boundaries, groups with ``?``, possessive loops.
_AROUND = re.compile(r"[\^$]|\\[AZzbBG]|\(\?|[*+?}]\+")


def _may_change(text: Column, patterns: Sequence[str]) -> Column:
    """Whether a line of the text may be a heading, a page number, or hold a pattern: one look at the whole text.

    A pattern that knows no more than its own characters is found in a text if it is found in one of its lines; with any other all texts may
    change.
    """
    if any(_AROUND.search(p) for p in patterns):
        return F.lit(True)
    return reduce(lambda c, p: c | text.rlike(p), patterns, text.rlike(r"(?dmU)^\s*+(?:#|\*{0,2}\d{1,4}\*{0,2}\s*$)"))


def normalize_body(
    text: Column, patterns: Sequence[str] = (), strip_page_numbers: bool = True, page_count: Column | None = None
) -> Column:
    """Lines without recurring furniture; idempotent; fenced code stays.

    Per line: spaced capitals of ``#`` lines are joined; each pattern is cut out, and where that changed the line its inner
    runs of blanks become one. A table row goes only if cutting emptied it; another line goes if cutting left only
    residue, or if it is a page number. In the end three or more line feeds become two, in fences as well.
    """
    nothing = F.array().cast("array<string>")

    def rule(line: Column) -> Column:
        joined = F.when(is_hash_line(line), X.collapse_spaced_caps(line)).otherwise(line)
        cut = reduce(lambda c, p: F.regexp_replace(c, p, ""), patterns, joined)
        excised = cut != joined
        cut = F.when(excised, X.inner_spaces(cut)).otherwise(cut)
        row = cut.rlike(r"(?U)\A\s*\|")
        emptied = excised & F.when(row, ~X.row_has_content(X.split_cells(cut))).otherwise(X.is_residue(cut))
        number = ~row & X.is_page_number(cut, page_count) if strip_page_numbers else F.lit(False)
        # Most lines are no heading, no number and hold no furniture: one look at each, and none of the rules.
        may = reduce(lambda c, p: c | line.rlike(p), patterns, line.rlike(r"(?U)\A\s*+(?:#|\*{0,2}\d{1,4}\*{0,2}\s*\z)"))
        return F.when(~may, F.array(line)).when(emptied | number, nothing).otherwise(F.array(cut))

    return limit_blank_runs(F.when(_may_change(text, patterns), map_lines(text, rule)).otherwise(text))


# The column labels of the two stat profiles and the form of a value.
FIGHTER = ("M", "WS", "BS", "S", "T", "W", "I", "A", "Ld", "Cl", "Wil", "Int")
VEHICLE = ("M", "Front", "Side", "Rear", "HP", "Hnd", "Sv", "BS", "Ld", "Cl", "Wil", "Int")
STAT_VALUE = r'(?:\d+["”]|\d+\+|\d+|-)\*?'


def tabulate_profiles(text: Column) -> Column:
    """Run-on stat lines as tables: the words before, a 12-column table, the words behind.

    A line counts if it is no table row and no ``#`` line and holds a profile's labels followed by twelve values.
    """
    values = r"\s+".join([f"{STAT_VALUE}"] * 12)

    def shape(labels: Sequence[str]) -> str:
        return r"(?Us)\A(.*?)\*{0,2}\s*" + r"\s+".join(labels) + r"\s*\*{0,2}(?:(?<=\*)|\s)\s*(" + values + r")(?:\s+(.*))?\z"

    def tabulated(labels: Sequence[str]) -> Callable[[Column], Column]:
        def of(part: Column) -> Column:
            before = F.regexp_replace(X.inner_spaces(F.regexp_replace(part[0], r"\.{3,}", " ")), r"\A[ *]+|[ *]+\z", "")
            behind = F.regexp_replace(F.regexp_replace(part[2], r"(?U)\s+", " "), r"\A[ *]+|[ *]+\z", "")
            head = F.lit("| " + " | ".join(labels) + " |")
            # No value holds white space, so what stands between the twelve is all that parts them.
            row = F.concat(F.lit("| "), F.regexp_replace(part[1], r"(?U)\s+", " | "), F.lit(" |"))
            empty = F.array().cast("array<string>")
            table = F.array(F.lit(""), head, F.lit("|" + "|".join(["---"] * 12) + "|"), row)
            first = X.let(before, lambda x: F.when(x != "", F.array(x)).otherwise(empty))
            last = X.let(behind, lambda x: F.when(x != "", F.array(F.lit(""), x)).otherwise(empty))
            return F.concat(first, table, last)

        return of

    def probed(line: Column, probe: Column) -> Column:
        out = F.array(line)
        for labels in (VEHICLE, FIGHTER):
            form = shape(labels)
            part = F.array(*[F.regexp_extract(probe, form, i) for i in (1, 2, 3)])
            out = F.when(probe.rlike(form), X.let(part, tabulated(labels))).otherwise(out)
        return out

    def rule(line: Column) -> Column:
        plain = line.rlike(r"(?U)\A\s*[|#]") | ~F.contains(line, F.lit("Wil"))
        return F.when(plain, F.array(line)).otherwise(X.let(X.breaks_as_spaces(line), lambda probe: probed(line, probe)))

    return F.when(F.contains(text, F.lit("Wil Int")), limit_blank_runs(map_lines(text, rule, fenced=True))).otherwise(text)


def spaced_headings(text: Column, mapping: Column) -> Column:
    """Glued words of heading lines spaced by ``mapping`` (map<string,string>); signs around a word stay.

    Not aware of fences. Only lines of one to six ``#`` and white space take part.
    """
    wrap = r"[*_`#:.,;!?()\[\]’'\"]"

    def word(token: Column) -> Column:
        core = F.regexp_replace(token, rf"\A{wrap}+|{wrap}+\z", "")
        spaced = F.try_element_at(mapping, core)
        at = F.instr(token, core)
        ends = F.concat(F.substring(token, F.lit(1), at - 1), spaced, F.substring(token, at + F.length(core), F.length(token)))
        return F.when((core != "") & spaced.isNotNull(), ends).otherwise(token)

    def rule(line: Column) -> Column:
        mark = F.regexp_extract(line, r"(?U)\A(#{1,6}\s+)", 1)
        tokens = F.regexp_extract_all(F.substring(line, F.length(mark) + 1, F.length(line)), F.lit(r"(?U)\S+|\s+"), F.lit(0))
        return F.array(F.when(mark != "", F.concat(mark, F.array_join(F.transform(tokens, word), ""))).otherwise(line))

    return map_lines(text, rule, fenced=True)


# How a cost is written in an equipment list, and the signs that stand between items.
_COST = r"(?<![A-Za-z\d])\+?\d+\s*credits"
_COST_END = r"(?i)(?<![A-Za-z\d])(\+?\d+)\s*(credits)\s*\z"
_EDGE = r"[-—–•*’]"


def _split_merged(line: Column) -> Column:
    """Items that an extraction put on one line, each as a line; a cost in the middle parts them."""

    def of(text: Column) -> Column:
        marked = F.regexp_replace(text, rf"(?iU)(\+?\d+\s*credits)\s+(?:{_EDGE}\s*)?(?=[A-Z\d])", "$1\x00")
        parts = F.filter(F.transform(F.split(marked, "\x00", -1), X.strip), lambda p: p != "")
        bullet = F.startswith(text, F.lit("- "))

        def item(p: Column, i: Column) -> Column:
            first = F.when(bullet & ~F.startswith(p, F.lit("- ")), F.concat(F.lit("- "), p)).otherwise(p)
            return F.when(i == 0, first).otherwise(F.concat(F.lit("- "), X.strip(F.regexp_replace(p, rf"(?U)\A{_EDGE}\s*", ""))))

        merged = X.let(F.regexp_count(text, F.lit(f"(?iU){_COST}")), lambda n: (n >= 2) | ((n == 1) & ~text.rlike(_COST_END)))
        return F.when(merged, F.transform(parts, item)).otherwise(F.array(line))

    # A line without the word has no cost.
    plain = line.rlike(r"\A[|#]") | ~line.rlike(r"(?iU)credits")
    return F.when(plain, F.array(line)).otherwise(X.let(X.rstrip(line), of))


def _clean_item(line: Column) -> Column:
    """Bullets without leaders and stray marks; a bare line with a leader becomes a bullet."""
    spaced = lambda x: X.strip(X.inner_spaces(F.regexp_replace(x, r"\.{3,}", " ")))

    def of(text: Column) -> Column:
        bullet = F.concat(F.lit("- "), spaced(F.regexp_replace(F.substring(text, F.lit(3), F.length(text)), r"(?U)\A[•*]\s*", "")))
        led = X.let(spaced(text), lambda bare: F.when(bare == "", F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("- "), bare))))
        plain = (text == "") | text.rlike(r"\A[|#]")
        return F.when(plain, F.array(line)).when(F.startswith(text, F.lit("- ")), F.array(bullet)).when(text.rlike(r"\.{3,}"), led).otherwise(F.array(line))

    return X.let(X.rstrip(line), of)


def tabulate_equipment(text: Column) -> Column:
    """Bullet lists of priced items as tables ``Item | Cost``; upgrades (``+`` costs) with a dash.

    Four steps: split merged items; join an item that a column break parted (one regular expression over two bullets with
    at most one blank line between, so that a joined bullet is used up); tidy items; and make a table of each run of
    bullets of which all end in a cost. Texts without the word ``credits`` stay as they are.
    """
    blank = r"[\s&&[^\n]]*+"
    parted = (
        rf"(?mU)^- (?![^\n]*\.{{3}})(?!(?i:[^\n]*{_COST}{blank}$))(?=[^\n]*\S){blank}([^\n]*?){blank}\n(?:{blank}\n)?- (?=[\p{{Ll}}*])([^\n]*?(?i:{_COST})){blank}$"
    )
    split = map_lines(text, _split_merged, fenced=True)
    joined = F.regexp_replace(split, parted, "- $1 $2")
    tidy = map_lines(joined, _clean_item, fenced=True)
    pieces = F.regexp_extract_all(F.concat(tidy, F.lit("\n")), F.lit(r"(?U)(?:- [^\n]*\S[^\n]*+\n)++|[^\n]*+\n"), F.lit(0))

    def row(line: Column) -> Column:
        cost = F.concat(F.regexp_extract(line, _COST_END, 1), F.lit(" "), F.regexp_extract(line, _COST_END, 2))
        item = X.strip(F.regexp_replace(F.substring(line, F.lit(3), F.length(line)), _COST_END, ""))
        mark = lambda c: F.when(F.startswith(c, F.lit("+")), F.lit("— ")).otherwise(F.lit(""))
        return X.let(cost, lambda c: F.concat(F.lit("| "), mark(c), item, F.lit(" | "), c, F.lit(" |\n")))

    def whole(parts: Column) -> Column:
        """The pieces joined again; each sees the one before it, so they are one value, cut once."""

        def one(part: Column, i: Column) -> Column:
            before = F.try_element_at(parts, i)
            gap = F.when((i > 0) & F.coalesce(before != "\n", F.lit(False)), F.lit("\n")).otherwise(F.lit(""))

            def of(run: Column) -> Column:
                table = F.concat(gap, F.lit("| Item | Cost |\n|---|---|\n"), F.array_join(F.transform(run, row), ""), F.lit("\n"))
                plain = F.array_join(F.transform(run, lambda x: F.concat(x, F.lit("\n"))), "")
                return F.when(F.forall(run, lambda x: x.rlike(_COST_END)), table).otherwise(plain)

            return F.when(F.startswith(part, F.lit("- ")), X.let(F.transform(lines_of(part), X.rstrip), of)).otherwise(part)

        return join_segments(F.transform(parts, one))

    done = limit_blank_runs(X.let(pieces, whole))
    return F.when(F.contains(F.lower(text), F.lit("credits")), done).otherwise(text)
