"""Conversations as text for training, with a loss mask, and back.

A turn is ``### role: body</turn>`` and a line feed. The parser splits at the end marker,
takes the role up to the first ``": "``, and undoes the escapes ``\\\\ \\e \\h \\c`` (for
backslash, end marker, ``###`` and colon). A body that holds a marker as it stands does not
parse. Each turn is rendered plainly, parsed again and compared with its source; where
they differ, its markers are escaped, and where they still differ, its backslashes too.
The third form always parses to the source.

Turns are ordered by turn, then role and text. Null roles and texts are empty, a null turn
comes first, rows with a null conv_id are one conversation. Repeated rows are repeated
turns. Extra columns are ignored. An empty table gives an empty result. A conversation is
one text and so one row, as long as its turns are together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, END = "### ", "</turn>"
_STOP = END + "\n"
_BACKSLASH = "\\"
#: What stands for the markers inside a text.
_CODES = [(END, "\\e"), ("###", "\\h")]
_ROLE_CODES = [*_CODES, (":", "\\c")]


def _swap(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def _escape_markers(text: Column, codes: list[tuple[str, str]]) -> Column:
    for marker, code in codes:
        text = _swap(text, marker, code)
    return text


def _escape_all(text: Column, codes: list[tuple[str, str]]) -> Column:
    return _escape_markers(_swap(text, _BACKSLASH, _BACKSLASH * 2), codes)


def unescape(text: Column) -> Column:
    """Escapes undone from left to right: doubled backslashes part the text first."""

    def undo(part: Column) -> Column:
        for marker, code in _ROLE_CODES:
            part = _swap(part, code, marker)
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), undo), _BACKSLASH)


def _plain(body: Column) -> Column:
    """Whether the parser takes a body: no marker stands in it as it is."""
    return ~(F.contains(body, F.lit(END)) | F.contains(body, F.lit("###")))


def _render_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, and the role and body as rendered."""
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    text = F.col("text")
    forms = [text, _escape_markers(text, _CODES)]
    body = _escape_all(text, _CODES)
    for form in reversed(forms):
        body = F.when(_plain(form) & (unescape(form) == text), form).otherwise(body)
    return rows.withColumn("shown_role", _escape_all(F.col("role"), _ROLE_CODES)).withColumn(
        "body", body
    )


def format_conversations(
    conversations: DataFrame, learned_roles: tuple[str, ...] = ("assistant",)
) -> DataFrame:
    """conv_id, formatted, and segments: one for each turn, in code points.

    A segment has the turn's start, the start and length of its body, and whether the loss
    covers the body.
    """
    turns = _render_turns(conversations)
    rendered = F.concat(
        F.lit(HEAD), F.col("shown_role"), F.lit(": "), F.col("body"), F.lit(_STOP)
    )
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    lead_in = F.length("shown_role") + F.lit(len(HEAD) + 2)
    placed = (
        turns.withColumn("rendered", rendered)
        .withColumn("position", F.row_number().over(in_order))
        .withColumn("start", F.coalesce(F.sum(F.length("rendered")).over(before), F.lit(0)))
        .select(
            "conv_id",
            F.struct(
                "position",
                "rendered",
                "start",
                (F.col("start") + lead_in).alias("body_start"),
                F.length("body").cast("long").alias("body_length"),
                F.col("role").isin(*learned_roles).alias("loss"),
                (F.col("body") != F.col("text")).alias("escaped"),
            ).alias("turn"),
        )
    )
    kept = ("start", "body_start", "body_length", "loss", "escaped")
    return (
        placed.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
        .select(
            "conv_id",
            F.array_join(F.transform("turns", lambda t: t["rendered"]), "").alias("formatted"),
            F.transform(
                "turns", lambda t: F.struct(*[t[name].alias(name) for name in kept])
            ).alias("segments"),
        )
    )


def parse_conversations(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, and turns read back: role, text, and the text under the loss."""
    pieces = F.split("formatted", F.lit(_STOP))
    whole = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def parse(pair: Column) -> Column:
        piece, segment = pair["piece"], pair["segment"]
        colon = F.instr(piece, ": ")
        role = F.substring(piece, F.lit(len(HEAD) + 1), colon - F.lit(len(HEAD) + 1))
        text = F.substring(piece, colon + 2, F.length(piece))
        at = (segment["body_start"] - segment["start"] + 1).cast("int")
        under = F.substring(piece, at, segment["body_length"].cast("int"))
        return F.struct(
            unescape(role).alias("role"),
            unescape(text).alias("text"),
            F.when(segment["loss"], unescape(under)).alias("learned"),
        )

    pairs = F.zip_with(
        whole, F.col("segments"), lambda p, s: F.struct(p.alias("piece"), s.alias("segment"))
    )
    return formatted.select("conv_id", "formatted", F.transform(pairs, parse).alias("turns"))
