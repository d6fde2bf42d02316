"""Drift guards: has an edit changed data, or only its layout?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .lines import is_code, is_hash_line, is_table, lines_of, segments
from .tables import at, begins_demoted, begins_labelled, cells_of, head_of, promote_label_row, separator_index


def blocks(text: Column) -> Column:
    """Table blocks outside fences as arrays of lines."""
    return F.transform(F.filter(segments(text), is_table), lines_of)


def data_lines(block: Column) -> Column:
    """The rows that hold data: behind the separator, and behind a demoted label row; all without a separator.

    Where they begin is told by the cells of the first rows; others are cut only where the separator is not among these.
    """

    def rule(head: Column) -> Column:
        demoted = begins_demoted(head, block) | begins_labelled(head, block)
        first = F.when(demoted, F.lit(3)).otherwise(F.coalesce(separator_index(head) + 1, separator_index(cells_of(block)) + 1, F.lit(0)))
        return F.slice(block, first + 1, F.size(block))

    return X.let(head_of(block), rule)


def data_rows(block: Column) -> Column:
    """Cells of the rows that hold data (see :func:`data_lines`)."""
    return cells_of(data_lines(block))


def _tokens(rows: Column) -> Column:
    """White-space tokens of the cells of table lines, in order: no cell need be cut out, since only pipes part them."""
    return F.regexp_extract_all(F.array_join(rows, "|"), F.lit(r"(?U)[^\s|]++"), F.lit(0))


def _anchors(rows: Column) -> Column:
    return F.filter(F.transform(rows, lambda r: at(X.split_cells(r), 0)), lambda c: c.isNotNull() & (c != ""))


def data_tokens(block: Column) -> Column:
    """White-space tokens of the data cells, sorted."""
    return F.sort_array(_tokens(data_lines(block)))


def anchors(block: Column) -> Column:
    """Filled first cells of the data rows, in order."""
    return _anchors(data_lines(block))


def _runs(tokens: Column, sign: int) -> Column:
    """``array<struct<token, n>>`` of a sorted array: each token once, with its number times ``sign``. Runs are found by their starts."""

    def of(t: Column) -> Column:
        starts = F.filter(F.transform(t, lambda x, i: F.when((i == 0) | (F.get(t, i - 1) != x), i)), lambda i: i.isNotNull())
        return X.let(starts, lambda s: F.transform(s, lambda at, j: F.struct(F.get(t, at).alias("token"), (F.lit(sign) * (F.coalesce(F.get(s, j + 1), F.size(t)) - at)).alias("n"))))

    return X.let(tokens, of)


def multiset_difference(before: Column, after: Column) -> Column:
    """``array<struct<token, delta>>`` of two sorted arrays: tokens whose number differs, and by how much.

    The runs of both are merged by token; each token then stands once or in two neighbours. Nothing is folded or exploded, so
    it takes no more than sorting.
    """

    def merged(runs: Column) -> Column:
        twin = lambda x, y: F.coalesce(x["token"] == y["token"], F.lit(False))
        first = lambda x, i: ~twin(F.get(runs, i - 1), x)
        delta = lambda x, i: x["n"] + F.when(twin(F.get(runs, i + 1), x), F.get(runs, i + 1)["n"]).otherwise(F.lit(0))
        each = F.transform(runs, lambda x, i: F.struct(x["token"].alias("token"), F.when(first(x, i), delta(x, i)).otherwise(F.lit(0)).alias("delta")))
        return F.filter(each, lambda x: x["delta"] != 0)

    return X.let(F.sort_array(F.concat(_runs(before, -1), _runs(after, 1))), merged)


def _first_difference(b: Column, a: Column) -> Column:
    """Place of the first difference from 0; null where there is none."""
    at = F.array_position(F.zip_with(b, a, lambda x, y: ~x.eqNullSafe(y)), True)
    return F.when(at > 0, at.cast("int") - 1)


_FINDING = "struct<kind:string,table_no:int,token:string,delta:int,row_no:int,was:string,now:string>"
_FIELDS = ("kind", "table_no", "token", "delta", "row_no", "was", "now")
_NONE = f"array<{_FINDING}>"


def _finding(**values: Column) -> Column:
    return F.struct(*[values.get(f, F.lit(None)).alias(f) for f in _FIELDS]).cast(_FINDING)


def table_findings(before: Column, after: Column, order: bool = True) -> Column:
    """What an edit did to the tables of one text, as an array of ``kind`` ``tables``, ``token`` and (with ``order``) ``order``.

    Both texts stand in one row, so nothing is joined or shuffled and rows can't answer for one another. Texts are cut into tables
    once; tables whose lines are the same are not looked at.
    """

    def table(x: Column, y: Column, i: Column) -> Column:
        def rows(r: Column) -> Column:
            def counted(t: Column) -> Column:
                changed = F.transform(multiset_difference(t["b"], t["a"]), lambda d: _finding(kind=F.lit("token"), table_no=i, token=d["token"], delta=d["delta"]))
                return F.when(t["b"] != t["a"], changed).otherwise(F.array().cast(_NONE))

            def tokens(t: Column) -> Column:
                # Tokens that stand in the same order need no sorting.
                return F.when(t["b"] != t["a"], X.let(F.struct(F.sort_array(t["b"]).alias("b"), F.sort_array(t["a"]).alias("a")), counted)).otherwise(F.array().cast(_NONE))

            def moved(s: Column) -> Column:
                def at(k: Column) -> Column:
                    one = _finding(kind=F.lit("order"), table_no=i, row_no=k, was=F.get(s["b"], k), now=F.get(s["a"], k))
                    return F.when(k.isNotNull(), F.array(one)).otherwise(F.array().cast(_NONE))

                same = F.sort_array(s["b"]) == F.sort_array(s["a"])
                return F.when((s["b"] != s["a"]) & same, X.let(_first_difference(s["b"], s["a"]), at)).otherwise(F.array().cast(_NONE))

            both = lambda f: F.struct(f(r["b"]).alias("b"), f(r["a"]).alias("a"))
            found = X.let(both(_tokens), tokens)
            # A rule that moves labels leaves the data rows as they were: then neither tokens nor anchors are cut.
            return F.when(r["b"] == r["a"], F.array().cast(_NONE)).otherwise(F.concat(found, X.let(both(_anchors), moved)) if order else found)

        pair = F.struct(data_lines(x).alias("b"), data_lines(y).alias("a"))
        return F.when(x == y, F.array().cast(_NONE)).otherwise(X.let(pair, rows))

    def texts(t: Column) -> Column:
        n_before, n_after = F.size(t["b"]), F.size(t["a"])
        count = _finding(kind=F.lit("tables"), table_no=F.lit(-1), token=F.lit(TABLES), delta=n_after - n_before, was=n_before.cast("string"), now=n_after.cast("string"))
        each = F.flatten(F.transform(F.arrays_zip(t["b"].alias("b"), t["a"].alias("a")), lambda z, i: table(z["b"], z["a"], i)))
        return F.when(n_before != n_after, F.array(count)).otherwise(each)

    whole = lambda c: F.coalesce(c, F.lit(""))
    cut = F.struct(blocks(whole(before)).alias("b"), blocks(whole(after)).alias("a"))
    return F.when(before.eqNullSafe(after), F.array().cast(_NONE)).otherwise(X.let(cut, texts))


def _each(pairs: DataFrame, key: str, findings: Column) -> DataFrame:
    """One row for each finding. No filter on the findings themselves: it would be pushed below the rules, and repeat their work."""
    return pairs.select(key, F.explode_outer(findings).alias("t")).select(key, "t.*").where("kind IS NOT NULL")


def table_count_drift(pairs: DataFrame, key: str) -> DataFrame:
    """``(<key>, n_before, n_after)`` where the numbers of tables differ."""
    found = _each(pairs, key, table_findings(F.col("before"), F.col("after"), order=False)).where("kind = 'tables'")
    return found.select(key, F.col("was").cast("int").alias("n_before"), F.col("now").cast("int").alias("n_after"))


#: The token of a finding about the number of tables; no white-space token of a cell can be this.
TABLES = "number of tables"


def data_drift(pairs: DataFrame, key: str) -> DataFrame:
    """Tokens whose number differs: ``(<key>, table_no, token, delta)``.

    A text with more or fewer tables after the edit has one row instead: table -1, the token :data:`TABLES`, and the
    difference. ``pairs`` holds ``before`` and ``after``; null texts are empty. Each row is compared by itself, also where a key
    stands twice.
    """
    return _each(pairs, key, table_findings(F.col("before"), F.col("after"), order=False)).select(key, "table_no", "token", "delta")


def order_drift(pairs: DataFrame, key: str) -> DataFrame:
    """Tables whose first cells are the same but in another order: ``(<key>, table_no, row_no, was, now)`` of the first."""
    return _each(pairs, key, table_findings(F.col("before"), F.col("after"))).where("kind = 'order'").select(key, "table_no", "row_no", "was", "now")


def _strict(found: Column) -> Column:
    """Findings as ``array<struct<kind, table_no, detail>>``."""

    def one(f: Column) -> Column:
        kind = F.when(f["kind"] != "token", f["kind"]).when(f["delta"] > 0, "added").otherwise("dropped")
        detail = F.when(f["kind"] == "token", F.concat_ws(" x", f["token"], F.abs(f["delta"]))).otherwise(F.concat_ws(" -> ", f["was"], f["now"]))
        return F.struct(kind.alias("kind"), F.when(f["table_no"] >= 0, f["table_no"]).alias("table_no"), detail.alias("detail"))

    return F.transform(found, one)


def strict_drift(pairs: DataFrame, key: str) -> DataFrame:
    """All drift as ``(<key>, kind, table_no, detail)``; no rows mean that the edit kept the data."""
    return _each(pairs, key, _strict(table_findings(F.col("before"), F.col("after"))))


def index_tokens(text: Column) -> Column:
    """Words and numbers of an index note in order: no frontmatter, fences or ``#`` lines; links as their alias."""
    body = X.without_frontmatter(F.coalesce(text, F.lit("")))
    lines = F.flatten(F.transform(F.filter(segments(body), lambda s: ~is_code(s)), lines_of))
    plain = F.transform(
        F.filter(lines, lambda x: ~is_hash_line(x)),
        lambda x: F.lower(F.regexp_replace(F.regexp_replace(x, r"\[\[[^\]|]+\|([^\]]+)\]\]", "$1"), r"\[\[([^\]|]+)\]\]", "$1")),
    )
    return F.flatten(F.transform(plain, lambda x: F.regexp_extract_all(x, F.lit(r"[a-z]+|[0-9]+"), F.lit(0))))


def _index_finding(before: Column, after: Column, use) -> Column:
    """An array with ``use(place, was, now, tokens before, tokens after)`` of the first difference, or an empty one."""

    def rule(t: Column) -> Column:
        token = lambda c, k: F.coalesce(F.get(c, k), F.lit("<end>"))
        found = lambda k: F.filter(F.array(F.when(k.isNotNull(), use(k, token(t["b"], k), token(t["a"], k), F.size(t["b"]), F.size(t["a"])))), lambda x: x.isNotNull())
        return X.let(F.when(t["b"] != t["a"], _first_difference(t["b"], t["a"])), found)

    return X.let(F.struct(index_tokens(before).alias("b"), index_tokens(after).alias("a")), rule)


def index_drift(pairs: DataFrame, key: str) -> DataFrame:
    """The first place where index tokens differ: ``(<key>, position, was, now, n_before, n_after)``, ``<end>`` past the end."""
    named = lambda *values: F.struct(*[v.alias(n) for v, n in zip(values, ("position", "was", "now", "n_before", "n_after"))])
    found = _index_finding(F.col("before"), F.col("after"), named)
    return pairs.select(key, F.explode_outer(found).alias("t")).select(key, "t.*").where("position IS NOT NULL")


def other_lines(text: Column) -> Column:
    """All lines but table rows; fences and what they hold stay."""
    return F.flatten(F.transform(F.filter(segments(text), lambda s: ~is_table(s)), lines_of))


def repair_drift(proposals: DataFrame, key: str) -> DataFrame:
    """What speaks against proposed bodies: ``(<key>, kind, table_no, detail)``; none means accepted.

    ``proposals`` holds ``kind`` (``index`` or ``table``; null is ``table``, any other is a finding), ``before`` and ``after``.
    Index edits must keep the token order. Table edits must keep the data strictly, and all other lines unless they are just
    the promotion of a label row. Line feeds at the end don't count.
    """
    trimmed = proposals.select(key, F.coalesce("kind", F.lit("table")).alias("kind"), *[F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"\n+\z", "").alias(c) for c in ("before", "after")])
    before, after, kind = F.col("before"), F.col("after"), F.col("kind")
    one = lambda name, detail: F.struct(F.lit(name).alias("kind"), F.lit(None).cast("int").alias("table_no"), detail.alias("detail"))
    said = lambda k, was, now, *_: one("index", F.concat(F.lit("position "), k, F.lit(": "), was, F.lit(" -> "), now))
    prose = F.filter(F.array(F.when((before != after) & (after != promote_label_row(before)) & (other_lines(before) != other_lines(after)), one("prose", F.lit("lines outside tables changed")))), lambda x: x.isNotNull())
    unknown = F.array(one("kind", F.concat(F.lit("unknown kind "), kind)))
    return _each(trimmed, key, F.when(kind == "index", _index_finding(before, after, said)).when(kind == "table", F.concat(_strict(table_findings(before, after)), prose)).otherwise(unknown))


def raise_on_drift(drift: DataFrame, what: str = "edit") -> None:
    """Stop where a guard has findings; the message shows the first twenty."""
    found = drift.limit(20).collect()
    if found:
        raise ValueError(f"data drift, {what} not applied: " + "; ".join(str(r.asDict()) for r in found))
