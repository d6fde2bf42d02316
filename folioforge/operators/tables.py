"""Rules over Markdown table blocks, as expressions over arrays of rows.

A rule takes a block, ``array<string>`` of its lines, and gives the lines that replace it. Rows that a rule doesn't change
come out as they went in. A block is one table of one text, so the arrays are small.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .lines import is_code, is_table, join_segments, lines_of, segments


def map_blocks(text: Column, rule: Callable[[Column], Column], may: Column | None = None) -> Column:
    """Apply ``rule`` to every table block outside fences; only to texts that ``may`` holds for, where it is given."""

    def one(segment: Column) -> Column:
        new = F.array_join(F.transform(X.let(lines_of(segment), rule), lambda x: F.concat(x, F.lit("\n"))), "")
        return F.when(is_table(segment), new).otherwise(segment)

    return F.when(F.contains(text, F.lit("|")) if may is None else may, join_segments(F.transform(segments(text), one))).otherwise(text)


def map_blocks_with(rows: DataFrame, key: str, text: str, rule: Callable[[list[str]], list[str]]) -> DataFrame:
    """``(<key>, <text>)`` of ``rows`` with a Python ``rule`` applied to the lines of every table block outside fences.

    The rule gets a block's lines and gives those that replace it. Texts are cut into segments by the same expression as for
    all other rules; those with a block go to Python by Arrow, with their segments marked, in their own row: nothing is
    shuffled, and keys need not be unique. Null texts stay null.
    """

    @F.pandas_udf("string")
    def run(parts: pd.Series) -> pd.Series:
        def one(part: dict) -> str:
            lines = lambda s: "".join(x + "\n" for x in rule(s.removesuffix("\n").split("\n")))
            return lines(part["segment"]) if part["block"] else part["segment"]

        return parts.map(lambda p: None if p is None else "".join(one(x) for x in p).removesuffix("\n"))

    parts = F.transform(segments(F.col(text)), lambda s: F.struct(s.alias("segment"), is_table(s).alias("block")))
    cut = rows.select(key, F.col(text).alias("__text"), F.when(F.contains(text, F.lit("|")), parts).alias("__parts"))
    cut = cut.withColumn("__new", run("__parts"))
    return cut.select(key, F.when(F.col("__parts").isNull(), F.col("__text")).otherwise(F.col("__new")).alias(text))


def cells_of(block: Column) -> Column:
    return F.transform(block, X.split_cells)


def render_row(cells: Column) -> Column:
    return F.concat(F.lit("|"), F.array_join(cells, "|"), F.lit("|"))


def width(cells: Column) -> Column:
    return F.array_max(F.transform(cells, F.size))


def at(cells: Column, i: int) -> Column:
    return F.try_element_at(cells, F.lit(i + 1))


def separator_index(cells: Column, dashes: int = 3) -> Column:
    """Index of the first separator row from 0, or null."""
    found = F.array_position(F.transform(cells, lambda c: X.is_separator(c, dashes)), True)
    return X.let(found, lambda n: F.when(n > 0, n.cast("int") - 1))


#: Rows that tell how a table begins; what looks no further takes the cells of these, and cuts the others where it comes to their number.
HEAD = 4


def head_of(block: Column) -> Column:
    """Cells of a table's first rows."""
    return cells_of(F.slice(block, 1, HEAD))


def _sizes(cells: Column, block: Column | None) -> tuple[Column, Callable[[Column], Column]]:
    """The rows whose cells are counted, and how: those of ``cells``, or of all lines of ``block`` where ``cells`` is only its head."""
    return (cells, F.size) if block is None else (block, lambda line: F.size(X.split_cells(line)))


def _is_wide(cells: Column, block: Column | None) -> Column:
    """Some row has six cells or more; looks no further than the first of them."""
    rows, size = _sizes(cells, block)
    return F.exists(rows, lambda r: size(r) >= 6)


def is_demoted_header(cells: Column) -> Column:
    """A group row, the separator, and then the real labels of a weapon chart."""
    return begins_demoted(cells, None)


def begins_demoted(cells: Column, block: Column | None) -> Column:
    """:func:`is_demoted_header` of all ``cells``, or of the head of ``block``."""
    group, labels = at(cells, 0), at(cells, 2)
    names = F.transform(labels, lambda c: F.upper(X.strip(F.regexp_replace(X.strip(c), r"\A\*+|\*+\z", ""))))
    has = lambda n, *xs: F.arrays_overlap(n, F.array(*[F.lit(x) for x in xs]))
    # The cheap tests stand first: most tables fail there.
    good = (
        (F.size(cells) >= 3) & (at(group, 0) == "") & (at(labels, 0) != "") & (F.size(group) == F.size(labels)) & X.is_separator(at(cells, 1))
        & _is_wide(cells, block) & X.let(names, lambda n: has(n, "AP") & has(n, "D") & has(n, "AM", "TRAITS", "AM TRAITS"))
    )
    return F.coalesce(good, F.lit(False))


# First cells that are data, not labels: rolls, ranges and distances.
_DATA_FIRST = r'(?i)\A(?:Unlimited|\d+-\d+|\d+|\d+["”]-\d+["”]|\d+["”]\+)\z'


def is_demoted_label_row(cells: Column) -> Column:
    """A spanning title, the separator, and then the real labels of a table of two to five columns."""
    return begins_labelled(cells, None)


def begins_labelled(cells: Column, block: Column | None) -> Column:
    """:func:`is_demoted_label_row` of all ``cells``, or of the head of ``block``."""
    group, labels = at(cells, 0), at(cells, 2)
    n = F.size(group)
    rows, size = _sizes(cells, block)
    # Five columns at most, so it can't be a demoted header, which has six.
    good = (
        (F.size(cells) >= 4) & n.between(2, 5) & (F.size(labels) == n) & (at(group, 0) != "") & F.forall(F.slice(group, 2, 100), lambda c: c == "")
        & X.is_separator(at(cells, 1)) & F.forall(labels, lambda c: c != "") & ~at(labels, 0).rlike(_DATA_FIRST) & at(at(cells, 3), 0).rlike(_DATA_FIRST)
        & F.forall(rows, lambda r: size(r) <= n)
    )
    return F.coalesce(good, F.lit(False))


def _both(g: Column, h: Column, first_wins: bool) -> Column:
    one = (g, h) if first_wins else (h, g)
    return F.when((g != "") & (h != "") & (g != h), F.concat(g, F.lit(" ("), h, F.lit(")"))).when(one[0] != "", one[0]).otherwise(one[1])


def promote_header_block(block: Column) -> Column:
    def rule(cells: Column) -> Column:
        merged = F.zip_with(at(cells, 0), at(cells, 2), lambda g, h: _both(g, h, first_wins=False))
        return F.when(begins_demoted(cells, block), F.concat(F.array(render_row(merged)), F.slice(block, 2, 1), F.slice(block, F.lit(4), F.size(block)))).otherwise(block)

    return X.let(head_of(block), rule)


def collapse_header_block(block: Column) -> Column:
    def rule(cells: Column) -> Column:
        group, header = at(cells, 0), at(cells, 1)
        merged = render_row(F.zip_with(group, header, lambda g, h: _both(g, h, first_wins=True)))
        rest = F.slice(block, F.lit(3), F.size(block))
        folded = F.when(F.size(group) == F.size(header), F.concat(F.array(merged), rest)).otherwise(F.concat(F.slice(block, 2, 1), rest))
        third = X.is_separator(at(cells, 2)) & ~X.is_separator(at(cells, 0)) & ~X.is_separator(at(cells, 1))
        return F.when(F.coalesce(third, F.lit(False)) & _is_wide(cells, block), folded).otherwise(block)

    return X.let(head_of(block), rule)


def split_fused_block(block: Column) -> Column:
    """A fused ``Am Traits`` column as two: the leading ammo token, and the rest."""
    def rule(cells: Column) -> Column:
        header = at(cells, 0)
        fused = lambda c: c.rlike(r"(?iU)\AAm\s+Traits\z")
        token = r"(?Us)\A(\d+\+|\d+|-)(?:\s+(.*))?\z"

        def split(at: Column) -> Column:
            """The rows, with the places of the separator and of the fused column worked out once."""
            sep, j = at["sep"], at["j"]

            def one(row: Column, i: Column) -> Column:
                cell = F.element_at(row, j)
                ammo = F.regexp_extract(cell, token, 1)
                rest = F.when(ammo != "", F.regexp_extract(cell, token, 2)).otherwise(cell)
                new = F.when(i == sep, F.array(cell, cell)).when(i == 0, F.array(F.lit("Am"), F.lit("Traits"))).otherwise(F.array(ammo, rest))
                return render_row(F.concat(F.slice(row, F.lit(1), j - 1), new, F.slice(row, j + 1, F.size(row))))

            return F.when(sep.isNotNull(), F.transform(cells, one)).otherwise(block)

        places = F.struct(separator_index(cells).alias("sep"), F.array_position(F.transform(header, fused), True).cast("int").alias("j"))
        good = (F.size(F.filter(header, fused)) == 1) & _is_wide(cells, None) & F.forall(cells, lambda c: F.size(c) == F.size(header))
        return F.when(F.coalesce(good, F.lit(False)), X.let(places, split)).otherwise(block)

    return X.let(cells_of(block), rule)


_LINES = "array<string>"
_ROW = "struct<raw:string,cells:array<string>>"
_STATE = f"struct<done:{_LINES},prev:{_ROW},tail:{_LINES},sep:boolean>"


def _merge(block: Column, wraps: Callable[[Column, Column, Column, Column], Column], after_separator: bool) -> Column:
    """Fold rows that continue the last kept data row into it.

    The state is the lines kept so far, the last data row apart as ``prev`` (its line null once it has grown) with lines behind it in
    ``tail`` (separators), since a continuation grows its cell and the next row is tested against the grown one. Rows are looked at
    once before the fold; a block without a row of one filled cell is left as it is.
    """
    single = lambda cells: F.size(F.filter(cells, lambda c: c != "")) == 1
    nothing = F.array().cast(_LINES)

    def row(raw: Column, cells: Column) -> Column:
        sep = X.is_separator(cells)
        k = F.when(single(cells), F.array_position(F.transform(cells, lambda c: c != ""), True).cast("int") - 1)
        return F.struct(raw.alias("raw"), cells.alias("cells"), F.when(~sep, k).alias("k"), sep.alias("sep"))

    def rendered(prev: Column) -> Column:
        return F.when(prev.isNotNull(), F.array(F.coalesce(prev["raw"], render_row(prev["cells"])))).otherwise(nothing)

    def step(state: Column, r: Column) -> Column:
        prev, k = state["prev"], r["k"]
        before, cell = F.get(prev["cells"], k), F.get(r["cells"], k)
        goes_on = F.coalesce(k.isNotNull() & prev.isNotNull() & (k < F.size(prev["cells"])) & wraps(before, cell, k, prev["cells"]), F.lit(False))
        cells = F.transform(prev["cells"], lambda c, i: F.when(i == k, F.concat(c, F.lit(" "), cell)).otherwise(c))
        grown = F.struct(F.lit(None).cast("string").alias("raw"), cells.alias("cells"))
        aside = (r["sep"] | ~state["sep"]) if after_separator else r["sep"]
        name = lambda d, p, t: F.struct(d.alias("done"), p.alias("prev"), t.alias("tail"), (state["sep"] | r["sep"]).alias("sep"))
        return (
            F.when(goes_on, name(state["done"], grown, state["tail"]))
            .when(aside, name(state["done"], prev, F.concat(state["tail"], F.array(r["raw"]))))
            .otherwise(name(F.concat(state["done"], rendered(prev), state["tail"]), F.struct(r["raw"].alias("raw"), r["cells"].alias("cells")), nothing))
        )

    def finish(state: Column) -> Column:
        return F.concat(state["done"], rendered(state["prev"]), state["tail"])

    def rule(cells: Column) -> Column:
        start = F.struct(nothing.alias("done"), F.lit(None).cast(_ROW).alias("prev"), nothing.alias("tail"), F.lit(False).alias("sep")).cast(_STATE)
        folded = F.aggregate(F.zip_with(block, cells, row), start, step, finish)
        return F.when(F.exists(cells, single) & _is_wide(cells, None), folded).otherwise(block)

    return X.let(cells_of(block), rule)


def merge_wrapped_block(block: Column) -> Column:
    """A row with one filled cell below a cell that ends with a comma or splits a known trait goes into the row above."""
    return _merge(block, lambda before, cell, k, cells: F.endswith(before, F.lit(",")) | X.splits_trait(before, cell), after_separator=False)


def merge_names_block(block: Column) -> Column:
    """A row with only its first cell filled, and no subheading, goes into the data row above that has values."""

    def wraps(before: Column, cell: Column, k: Column, cells: Column) -> Column:
        return (k == 0) & (F.size(F.filter(cells, lambda c: c != "")) >= 2) & ~X.is_name_subheader(cell)

    return _merge(block, wraps, after_separator=True)


# One look at a whole text, which a rule needs before it can change anything there. Each expression finds all that the rule takes, and
# may find more: rows inside fences, rows in the middle of a block. A text it doesn't match is not cut.
_IN_LINE = r"[\s|&&[^\n]]"
_ROW_START, _SEP_START = r"^\s*+\|", r"\s*+\|[\s|]*+:?+-{3}"
#: A row whose first cell is empty, and a separator below it.
_MAY_PROMOTE = rf"(?dmU){_ROW_START}\s*+\|[^\n]*+\n{_SEP_START}"
#: A row with only its first cell filled, and a separator below it.
_MAY_LABEL = rf"(?dmU){_ROW_START}\s*+[^\s|][^\n|]*+{_IN_LINE}*+\n{_SEP_START}"
#: A separator below two rows.
_MAY_COLLAPSE = rf"(?dmU){_ROW_START}[^\n]*+\n\s*+\|[^\n]*+\n{_SEP_START}"
_MAY_SPLIT = r"(?iU)Am\s+Traits"
#: A row with one filled cell, or with only the first one filled.
_MAY_WRAP = rf"(?dmU){_ROW_START}[\s|]*+[^\s|][^\n|]*+{_IN_LINE}*+$"
_MAY_NAME = rf"(?dmU){_ROW_START}\s*+[^\s|][^\n|]*+{_IN_LINE}*+$"
#: A cell that goes on in the next row: it ends with a comma, or it holds the first word of a known trait.
_MAY_END = r"(?dmU),[\s&&[^\n]]*+(?:\||$)"
_FIRST_WORDS = sorted({t.split()[0] for t in X.MULTIWORD_TRAITS})


def promote_header(text: Column) -> Column:
    return map_blocks(text, promote_header_block, text.rlike(_MAY_PROMOTE))


def collapse_headers(text: Column) -> Column:
    return map_blocks(text, collapse_header_block, text.rlike(_MAY_COLLAPSE))


def split_fused(text: Column) -> Column:
    return map_blocks(text, split_fused_block, text.rlike(_MAY_SPLIT))


def merge_wrapped_rows(text: Column) -> Column:
    goes_on = reduce(lambda c, word: c | F.contains(text, F.lit(word)), _FIRST_WORDS, F.contains(text, F.lit(",")) & text.rlike(_MAY_END))
    return map_blocks(text, merge_wrapped_block, goes_on & text.rlike(_MAY_WRAP))


def merge_wrapped_names(text: Column) -> Column:
    return map_blocks(text, merge_names_block, text.rlike(_MAY_NAME))


def promote_label_row(text: Column) -> Column:
    """The labels of a demoted label row above the separator, its title as a bold line with blank lines around it."""

    def whole(parts: Column) -> Column:
        def one(segment: Column, i: Column) -> Column:
            new = X.let(lines_of(segment), lambda block: X.let(head_of(block), lambda cells: promoted(segment, i, block, cells)))
            return F.when(is_table(segment), new).otherwise(segment)

        def promoted(segment: Column, i: Column, block: Column, cells: Column) -> Column:
            title = F.regexp_replace(at(at(cells, 0), 0), r"\A\*+|\*+\z", "")
            before = F.try_element_at(parts, i)
            gap = F.when((i > 0) & F.coalesce(before != "\n", F.lit(False)), F.lit("\n")).otherwise(F.lit(""))
            rows = F.concat(F.slice(block, 3, 1), F.slice(block, 2, 1), F.slice(block, F.lit(4), F.size(block)))
            table = F.array_join(F.transform(rows, lambda x: F.concat(x, F.lit("\n"))), "")
            new = F.when(title != "", F.concat(gap, F.lit("**"), title, F.lit("**\n\n"), table)).otherwise(segment)
            return F.when(begins_labelled(cells, block), new).otherwise(segment)

        return join_segments(F.transform(parts, one))

    return F.when(text.rlike(_MAY_LABEL), X.let(segments(text), whole)).otherwise(text)


RULES = (promote_header, promote_label_row, collapse_headers, split_fused, merge_wrapped_rows, merge_wrapped_names)


def repair_tables(texts: DataFrame, text: str = "text", rules: Sequence[Callable[[Column], Column]] = RULES) -> DataFrame:
    """Apply the rules in their order, each in a projection of its own, so that no rule works on another's expression."""
    for rule in rules:
        texts = texts.withColumn(text, rule(F.col(text)))
    return texts


def table_rows(texts: DataFrame, key: str, text: str = "text", dashes: int = 3) -> DataFrame:
    """All table rows: ``(<key>, table_no, row_no, first_line, raw, cells, is_sep)``; tables count from 0 in each text,
    rows from 0 in each table, lines from 1."""
    parts = F.transform(segments(F.col(text)), lambda s: F.struct(s.alias("s"), F.size(lines_of(s)).alias("n")))
    lines = texts.select(key, F.posexplode(parts).alias("p", "part"))
    from pyspark.sql import Window as W

    order = W.partitionBy(key).orderBy("p")
    before = F.coalesce(F.sum("part.n").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) + 1
    lines = lines.withColumn("first_line", before.cast("int")).where(is_table(F.col("part.s")) & ~is_code(F.col("part.s")))
    numbered = lines.withColumn("table_no", F.row_number().over(order) - 1)
    rows = numbered.select(key, "table_no", "first_line", F.posexplode(lines_of(F.col("part.s"))).alias("row_no", "raw"))
    cells = rows.withColumn("cells", X.split_cells(F.col("raw")))
    return cells.select(key, "table_no", "row_no", "first_line", "raw", "cells", X.is_separator(F.col("cells"), dashes).alias("is_sep"))
