"""Operator 6: chat formatting with typed content parts, in DataFrame functions only.

A turn's content is a list of parts. A visitor flattens them in order: text is escaped,
an attachment becomes a placeholder, its reference and the tokens it expands to are
recorded. Turns are put into one text per conversation with a loss mask over what the
assistant says; everything can be read back from that text and the mask.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Tokens that one unit of an attachment expands to: an image's unit is a patch, audio's a
# second, a document's a page.
TOKENS_PER_UNIT = {"image": 1, "audio": 25, "document": 512}
LEARNT_ROLE = "assistant"

OPEN, OPENED, CLOSE = "<turn:", ">\n", "</turn>\n"
# Escapes, in the order in which they are made; undone in reverse. All control strings
# begin with "<", and none of these characters is left bare in a text.
_ESCAPES = [("\\", "\\s"), ("<", "\\l"), (">", "\\g")]

PARTS = "array<struct<type:string,text:string,ref:string,units:long>>"


def escape(text: Column) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), _ESCAPES, text)


def unescape(text: Column) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[1]), F.lit(e[0])), reversed(_ESCAPES), text)


def text_part(text: Column) -> Column:
    """Content of one text part."""
    none = F.lit(None)
    part = F.struct(
        F.lit("text").alias("type"),
        text.cast("string").alias("text"),
        none.cast("string").alias("ref"),
        none.cast("long").alias("units"),
    )
    return F.array(part).cast(PARTS)


def _visit(part: Column, place: Column) -> Column:
    """Text of a part: escaped text, or a placeholder for anything else."""
    kind = F.coalesce(part["type"], F.lit("text"))
    held = F.concat(F.lit("<attach:"), escape(kind), F.lit(":"), place.cast("string"), F.lit(">"))
    return F.when(kind == "text", escape(F.coalesce(part["text"], F.lit("")))).otherwise(held)


def _attachment(part: Column, place: Column) -> Column:
    rate = F.lit(1)
    for kind, tokens in TOKENS_PER_UNIT.items():
        rate = F.when(part["type"] == kind, F.lit(tokens)).otherwise(rate)
    return F.struct(
        place.alias("part"),
        part["type"].alias("type"),
        part["ref"].alias("ref"),
        (F.coalesce(part["units"], F.lit(1)) * rate).cast("long").alias("tokens"),
    )


def format_conversations(messages: DataFrame) -> DataFrame:
    """`conv_id, formatted, n_turns, loss_spans, attachments` from `conv_id, turn, role, parts`.

    `loss_spans` has start and length in code points of each assistant turn's content.
    `attachments` has turn (from 0), part, type, ref and tokens, in order. Turns go by
    `turn`, nulls first; among equal ones by role, then content. A null role, text or list
    of parts is empty; a part without a type is text; other types than image, audio and
    document expand to one token per unit, an unknown number of units counts as one. A
    null conv_id is one conversation.
    """
    parts = F.coalesce(F.col("parts"), F.array().cast(PARTS))
    body = F.array_join(F.transform(parts, _visit), "")
    other = F.filter(
        F.transform(parts, _attachment), lambda a: F.coalesce(a["type"], F.lit("text")) != "text"
    )
    rows = messages.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        body.alias("body"),
        other.alias("others"),
    )
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(OPENED))
    rows = rows.withColumn("head", head)
    size = F.length("head") + F.length("body") + len(CLOSE)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    rows = rows.select(
        "conv_id",
        "role",
        "body",
        "head",
        "others",
        (F.row_number().over(order) - 1).alias("at"),
        F.coalesce(
            F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("before"),
    )
    span = F.struct(
        (F.col("before") + F.length("head")).alias("start"), F.length("body").cast("long").alias("length")
    )
    turn = F.struct(
        "at",
        F.concat("head", "body", F.lit(CLOSE)).alias("text"),
        (F.col("role") == LEARNT_ROLE).alias("learnt"),
        span.alias("span"),
        "others",
    )
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    attached = F.flatten(
        F.transform(
            "turns",
            lambda t: F.transform(
                t["others"],
                lambda a: F.struct(
                    t["at"].alias("turn"),
                    a["part"].alias("part"),
                    a["type"].alias("type"),
                    a["ref"].alias("ref"),
                    a["tokens"].alias("tokens"),
                ),
            ),
        )
    )
    return whole.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["text"]), "").alias("formatted"),
        F.size("turns").cast("long").alias("n_turns"),
        F.transform(F.filter("turns", lambda t: t["learnt"]), lambda t: t["span"]).alias("loss_spans"),
        attached.alias("attachments"),
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) of each turn, read back from a formatted conversation.

    Placeholders stay in the text; only escapes are undone.
    """
    pieces = F.split(formatted, CLOSE, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        role = F.regexp_extract(piece, f"^{OPEN}([^>]*){OPENED}", 1)
        skip = F.length(role) + len(OPEN) + len(OPENED) + 1
        text = F.substr(piece, skip)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def read_learnt(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    found = F.transform(
        loss_spans, lambda s: F.substr(formatted, s["start"].cast("int") + 1, s["length"].cast("int"))
    )
    return unescape(F.array_join(found, ""))
