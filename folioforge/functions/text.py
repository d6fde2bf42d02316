"""Scalar text functions as Catalyst expressions.

Regular expressions use Java flags where plain ones would differ from Unicode text rules: ``(?U)`` for white space and
digits, ``(?s)`` and ``\\z`` so that only line feeds end lines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values throughout: control characters that are cut out, the length of blank runs, and the digits of a page number.
#: White space but the line feed, as a character class.
BLANK = r"[\s&&[^\n]]"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` names it.

    A fold over nothing gives its start to ``use`` as it is; ``transform`` would copy the value, and all strings in it.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda v, _: v, use)


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)\A\s++|(?<!\s)\s++\z", "")


def lstrip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)(?<!\s)\s++\z", "")


def collapse_white(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def clean_inline(c: Column) -> Column:
    """Without control characters, tabs and line feeds among them, and stripped."""
    return strip(F.regexp_replace(c, r"[\x00-\x1f\x7f]", ""))


def clean_block(c: Column) -> Column:
    """Without control characters except tab, line feed and carriage return."""
    return F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")


def inner_spaces(c: Column) -> Column:
    """Runs of two or more blanks between other characters as one."""
    return F.regexp_replace(c, r"(?U)(?<=\S) {2,}(?=\S)", " ")


def collapse_spaced_caps(c: Column) -> Column:
    """``C H A P T E R`` as ``CHAPTER`` where three or more single capitals stand apart, then :func:`inner_spaces`."""
    after_first = r"(?<=(?<![A-Za-z])[A-Z]) (?=[A-Z] [A-Z](?![A-Za-z]))"
    before_last = r"(?<=(?<![A-Za-z])[A-Z] [A-Z]) (?=[A-Z](?![A-Za-z]))"
    return inner_spaces(F.regexp_replace(c, f"{after_first}|{before_last}", ""))


def index_key(c: Column) -> Column:
    """Loose key of a term or heading: no emphasis, no leading enumerator, ASCII letters and digits only, lower case."""
    plain = F.regexp_replace(F.regexp_replace(c, r"[*_`#]", ""), r"(?U)^\s*\d+[.)]\s*", "")
    return F.lower(F.trim(F.regexp_replace(plain, r"[^0-9a-zA-Z]+", " ")))


def strip_leaders(c: Column) -> Column:
    """Runs of two or more leader dots as a blank, white space collapsed, no blank before ``,.;:``."""
    plain = collapse_white(F.regexp_replace(c, r"[.·…]{2,}", " "))
    return F.regexp_replace(plain, r" +([,.;:])", "$1")


def split_cells(c: Column) -> Column:
    """Trimmed cells of a table row, one outer pipe dropped at each side; a pipe always parts cells.

    White space at pipes and at both ends goes in one pass over the row, so the work does not grow with its cells. A row without any
    is only cut at its ends.
    """
    tight = F.regexp_replace(c, r"(?U)\A\s++|(?<=\|)\s++|(?<!\s)\s++(?:\z|(?=\|))", "")
    first = F.startswith(c, F.lit("|")).cast("int")
    inner = F.substring(c, first + 1, F.length(c) - first - F.endswith(c, F.lit("|")).cast("int"))
    return F.split(F.when(c.rlike(r"(?U)\s"), F.regexp_replace(tight, r"\A\||\|\z", "")).otherwise(inner), r"\|", -1)


def is_separator(cells: Column, dashes: int = 3) -> Column:
    """Some cell is filled, and all filled ones are dashes (``dashes`` at least) with optional colons."""
    return F.forall(cells, lambda x: (x == "") | x.rlike(rf"\A:?-{{{dashes},}}:?\z")) & F.exists(cells, lambda x: x != "")


def row_has_content(cells: Column) -> Column:
    return F.exists(cells, lambda x: x != "")


def is_page_number(c: Column, page_count: Column | None = None) -> Column:
    """A line that is one to four digits, maybe bold, of at most ``page_count`` where that is known."""
    digits = F.regexp_extract(strip(c), r"(?U)\A\*{0,2}(\d{1,4})\*{0,2}\z", 1)
    known = F.lit(None).cast("int") if page_count is None else page_count
    return (digits != "") & (known.isNull() | (digits.cast("int") <= known))


def breaks_as_spaces(c: Column) -> Column:
    return F.regexp_replace(c, r"(?i)<br\s*/?>", " ")


def is_residue(c: Column) -> Column:
    """What excision left is nothing but white space, line breaks, or one to four digits."""
    return strip(breaks_as_spaces(c)).rlike(r"(?U)\A(?:\d{1,4})?\z")


def quote(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))


def wikilink(target: Column, alias: Column) -> Column:
    return F.concat(F.lit("[["), target, F.lit("|"), alias, F.lit("]]"))


def is_bare(target: Column) -> Column:
    return ~F.contains(target, F.lit("/"))


def is_index_target(target: Column) -> Column:
    return (target == "index") | F.endswith(target, F.lit("/index"))


def asset_path(note_dir: Column, name: Column) -> Column:
    """From a note's folder up to its source's asset folder."""
    ups = F.repeat(F.lit("../"), (F.size(F.split(note_dir, "/", -1)) - 1).cast("int"))
    return F.concat(ups, F.lit("assets/"), name)


_IMAGE = r"!\[[^\]]*\]\((?:[^)]*/)?(?:ASSET:)?([^)/]+)\)"


def image_sentinels(c: Column) -> Column:
    """Image references as ``![](ASSET:<file name>)``; the alternative text goes."""
    return F.regexp_replace(c, _IMAGE, r"![](ASSET:$1)")


def image_names(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(_IMAGE), F.lit(1))


def resolve_assets(body: Column, note_dir: Column) -> Column:
    ups = F.repeat(F.lit("../"), (F.size(F.split(note_dir, "/", -1)) - 1).cast("int"))
    return F.regexp_replace(body, F.lit(r"!\[\]\(ASSET:([^)]+)\)"), F.concat(F.lit("![]("), ups, F.lit(r"assets/$1)")))


def moc_path(slug: Column) -> Column:
    return F.concat(slug, F.lit("/"), slug, F.lit(".md"))


def asset_dir(slug: Column) -> Column:
    return F.concat(slug, F.lit("/assets"))


def segment(number: Column, slug: Column) -> Column:
    return F.concat(number, F.lit("-"), slug)


# Two-word traits that a line wrap may split.
MULTIWORD_TRAITS = ("Assault Shield", "Energy Shield", "Chem Delivery", "Graviton Pulse", "Rapid Fire", "Shield Breaker", "Single Shot")


def splits_trait(before: Column, after: Column) -> Column:
    """The last word of one cell and the first of the next make a known two-word trait."""
    word = F.lit(r"[A-Za-z][A-Za-z'-]*")
    last, first = F.regexp_extract_all(before, word, F.lit(0)), F.regexp_extract_all(after, word, F.lit(0))
    pair = F.concat(F.try_element_at(last, F.lit(-1)), F.lit(" "), F.try_element_at(first, F.lit(1)))
    return F.coalesce(pair.isin(*MULTIWORD_TRAITS), F.lit(False))


def is_name_subheader(c: Column) -> Column:
    """An orphan first cell that is a heading of its own: emphasis, a kind label, or all capitals."""
    t = strip(c)
    low = F.lower(t)
    labels = [F.contains(low, F.lit(x)) for x in ("combi-weapon", "component", "pattern")]
    capitals = t.rlike(r"\p{L}") & ~t.rlike(r"[\p{L}&&[^\p{Lu}]]")
    return (t == "") | t.rlike(r"\A[*_]") | labels[0] | labels[1] | labels[2] | capitals


def frontmatter_end(text: Column) -> Column:
    """Number of characters of a leading frontmatter block with its closing line, or 0."""
    return F.length(F.regexp_extract(text, r"(?s)\A---[ \t\r]*\n(?:.*?\n)??---[ \t\r]*(?:\n|\z)", 0))


def without_frontmatter(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\A---\n.*?\n---\n", "")


def links(text: Column) -> Column:
    """``array<struct<target, alias>>`` of all wikilinks in order; an escaped pipe's backslash is no part of the target."""
    pattern = F.lit(r"\[\[([^\]\|]+)(?:\|([^\]]*))?\]\]")
    targets, aliases = F.regexp_extract_all(text, pattern, F.lit(1)), F.regexp_extract_all(text, pattern, F.lit(2))
    clean = F.transform(targets, lambda t: F.regexp_replace(strip(t), r"(?U)\s*\\\z", ""))
    return F.arrays_zip(clean.alias("target"), F.transform(aliases, strip).alias("alias"))
