"""Chat formatting with a grammar round trip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: A control string, or one that was escaped: "<", any number of "\", "|".
_ESCAPABLE = r"<(\\*)\|"
_ESCAPED = r"<\\(\\*)\|"


def escape(text: Column) -> Column:
    r"""Put one more backslash into every ``<|``, ``<\|``, ``<\\|`` ..., so that none is a control string."""
    return F.regexp_replace(text, _ESCAPABLE, r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, r"<$1|")


def escape_role(role: Column) -> Column:
    """Roles take no line feed and no ``<``; both and ``%`` are percent-encoded."""
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%3C"), F.lit("<")), F.lit("%25"), F.lit("%"))


def render(role: Column, body: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), body, F.lit(END), F.lit("\n"))


def parse(formatted: Column) -> Column:
    """The turns ``array<struct<role, text>>`` of a formatted conversation, or null where it breaks the grammar.

    Grammar: ``(START role LF body END LF)*``, with no control string inside role or body. Splitting at END is
    deterministic: every piece but the last must begin with START (behind the first, with LF and START), and the last
    must be the line feed that closes the conversation.
    """
    pieces = F.split(F.concat(F.lit("\n"), formatted), r"<\|im_end\|>", -1)
    turns = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))
    opening = "\n" + START
    inner = F.transform(turns, lambda p: F.when(F.startswith(p, F.lit(opening)), F.substring(p, F.lit(len(opening) + 1), F.length(p))))
    good = (F.element_at(pieces, -1) == "\n") & F.forall(
        inner, lambda p: p.isNotNull() & F.contains(p, F.lit("\n")) & ~F.contains(p, F.lit(START))
    )
    out = F.transform(
        inner,
        lambda p: F.struct(
            unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(F.substring(p, F.instr(p, F.lit("\n")) + 1, F.length(p))).alias("text"),
        ),
    )
    return F.when(good, out)


def format_conversations(conversations: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``(conv_id, formatted, turns, loss_spans, loss_text)``.

    Turns are in the order of ``turn`` (null first), ties by role and text; repeated rows are repeated turns. Every turn
    is rendered plainly, reparsed, and compared with its source; where they differ its text is escaped and the test is
    made again. The formatted conversation is reparsed as a whole as well; a difference there is an error.

    ``turns`` and ``loss_text`` are what the parser reads back. ``loss_spans`` gives the trained part of ``formatted``
    as (start, end) in code points: the bodies of ``trained_role``. ``loss_text`` is their text, unescaped, in order.

    Null roles and texts are empty; a null conv_id is a conversation; extra columns are not read; no rows give no rows.
    A conversation becomes one row, so it is gathered in one task: its text is the result's value.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    source = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    plain = render(escape_role(F.col("role")), F.col("text"))
    same = F.col("back") == F.array(F.struct("role", "text"))
    tried = source.withColumn("back", parse(plain)).withColumn("body", F.when(F.coalesce(same, F.lit(False)), F.col("text")).otherwise(escape(F.col("text"))))
    head = F.length(F.lit(START)) + F.length(escape_role(F.col("role"))) + 1
    tail = F.length(F.lit(END)) + 1
    rows = tried.select("conv_id", "turn", "role", "text", "body", head.alias("head"), F.length("body").alias("chars"))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.select("*", F.row_number().over(order.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("ord"), F.sum((F.col("head") + F.col("chars") + tail).cast("long")).over(order).alias("upto"))
    end = F.col("upto") - tail
    turn = F.struct("ord", "role", "text", "body", (end - F.col("chars")).alias("start"), end.alias("end"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("src"))
    formatted = F.array_join(F.transform("src", lambda t: render(escape_role(t.role), t.body)), "")
    read = whole.withColumn("formatted", formatted).withColumn("turns", parse(F.col("formatted")))
    read = read.withColumn(
        "turns",
        F.when(F.col("turns") == F.transform("src", lambda t: F.struct(t.role.alias("role"), t.text.alias("text"))), F.col("turns")).otherwise(
            F.raise_error(F.concat(F.lit("round trip failed for conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
        ),
    )
    masked = F.filter(F.arrays_zip(F.col("turns"), F.col("src")), lambda z: z["turns"]["role"] == trained_role)
    spans = F.transform(F.filter("src", lambda t: t.role == trained_role), lambda t: F.struct(t.start.alias("start"), t.end.alias("end")))
    return read.select("conv_id", "formatted", "turns", spans.alias("loss_spans"), F.array_join(F.transform(masked, lambda z: z["turns"]["text"]), "").alias("loss_text"))
