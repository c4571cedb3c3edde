"""Chat formatting: turns of typed content parts as one text with placeholders, attachments and a loss mask.

A turn is ``<turn role>`` LF text ``</turn>`` LF. In texts and roles a backslash becomes two and ``<`` becomes ``\\l``; in
a role, ``>`` LF, which would end it, becomes ``\\n``, as long as itself. So no text holds a control string and every
text and role comes back unchanged. An image, audio or document part becomes a placeholder ``<kind:k>``, where k numbers
the conversation's attachments from 0; its reference and the number of tokens that it stands for are recorded beside the
text. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, SHUT = "<turn ", "</turn>\n"
TRAINED = "assistant"
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
#: Tokens that attachments expand to: a tile of an image, a second of audio, a page of a document.
TILE, TILE_TOKENS, SECOND_TOKENS, PAGE_TOKENS = 448, 256, 25, 800


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.array_join(F.transform(F.split(text, r"\\\\", -1), lambda x: F.replace(
        F.replace(x, F.lit("\\l"), F.lit("<")), F.lit("\\n"), F.lit(">\n"))), "\\")


def text_part(text: Column) -> Column:
    """One text as an array of one part."""
    empty = F.lit(None)
    return F.array(F.struct(F.lit("text"), text, empty, empty, empty, empty, empty)).cast(f"array<{PART}>")


def is_text(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text")) == "text"


def expanded(part: Column) -> Column:
    """Tokens that stand for an attachment; 0 where its size is not known."""
    tiles = F.ceil(part["width"] / TILE) * F.ceil(part["height"] / TILE)
    count = (F.when(part["type"] == "image", tiles * TILE_TOKENS)
             .when(part["type"] == "audio", F.ceil(part["seconds"] * SECOND_TOKENS))
             .when(part["type"] == "document", part["pages"].cast("long") * PAGE_TOKENS))
    return F.coalesce(count, F.lit(0)).cast("long")


def format_conversations(turns: DataFrame, parts: Column | None = None, conv_id: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, formatted, attachments, attachment_tokens, loss_spans), one row a conversation, rows by turn.

    ``parts`` is an array of PART; without it each row is one text part. ``loss_spans`` are the places, in code points
    of ``formatted``, of the assistant's text parts. A null text, role or array is empty; rows without a turn number
    come first; rows of equal turns are ordered by role and content; an unknown part type is a placeholder with 0 tokens;
    a null conv_id is a conversation of its own; an empty table gives an empty result. Other columns are ignored.
    A conversation is the unit of work: its own turns, and no others, meet in one row.
    """
    content = F.coalesce(text_part(F.col(text)) if parts is None else parts, F.array().cast(f"array<{PART}>"))
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.struct(
        F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        content.alias("parts")).alias("t"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # the visitor: all parts in order, each with its turn's place, the attachments numbered as they come
    flat = F.flatten(F.transform("turns", lambda t: F.concat(
        F.array(_piece("open", F.concat(F.lit(OPEN), F.replace(escape(t["role"]), F.lit(">\n"), F.lit("\\n")), F.lit(">\n")))),
        F.transform(t["parts"], lambda p: F.when(is_text(p), _piece(
            F.when(t["role"] == TRAINED, F.lit("loss")).otherwise(F.lit("text")), escape(F.coalesce(p["text"], F.lit("")))))
            .otherwise(_piece("attached", p["type"], p["ref"], expanded(p)))),
        F.array(_piece("shut", F.lit(SHUT))))))
    pieces = ordered.select("conv_id", flat.alias("pieces"))
    attached = pieces.withColumn("attachments", F.filter("pieces", lambda p: p["kind"] == "attached"))
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("k"), F.array().cast("array<string>").alias("out"),
                     F.array().cast("array<struct<start:int,end:int>>").alias("loss"))

    def visit(state: Column, piece: Column) -> Column:
        mark = piece["kind"] == "attached"
        shown = F.when(mark, F.concat(F.lit("<"), escape(piece["text"]), F.lit(":"), state["k"].cast("string"), F.lit(">"))).otherwise(piece["text"])
        end = state["at"] + F.length(shown)
        return F.struct(
            end.alias("at"), (state["k"] + mark.cast("int")).alias("k"), F.concat(state["out"], F.array(shown)).alias("out"),
            F.when((piece["kind"] == "loss") & (F.length(shown) > 0),
                   F.concat(state["loss"], F.array(F.struct(state["at"].alias("start"), end.alias("end")))))
            .otherwise(state["loss"]).alias("loss"))

    visited = attached.withColumn("v", F.aggregate("pieces", start, visit))
    return visited.select(
        "conv_id", F.array_join("v.out", "").alias("formatted"),
        F.transform("attachments", lambda a, k: F.struct(
            k.alias("place"), a["text"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))).alias("attachments"),
        F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"),
        F.col("v.loss").alias("loss_spans"))


def _piece(kind: str | Column, text: Column, ref: Column | None = None, tokens: Column | None = None) -> Column:
    return F.struct(
        (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
        (F.lit(None).cast("string") if ref is None else ref).alias("ref"),
        (F.lit(0).cast("long") if tokens is None else tokens).alias("tokens"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, trained): roles and texts from the formatted text alone, and the text under the loss mask.

    Placeholders stay in a turn's text as they are.
    """
    blocks = F.filter(F.split("formatted", SHUT, -1), lambda b: b != "")
    turns = F.transform(blocks, lambda b: F.struct(
        unescape(F.substring_index(F.substring(b, F.lit(len(OPEN) + 1), F.length(b)), ">\n", 1)).alias("role"),
        unescape(F.substring(b, F.locate(">\n", b) + 2, F.length(b))).alias("text")))
    trained = F.array_join(F.transform("loss_spans", lambda s: unescape(
        F.substring("formatted", s["start"] + 1, s["end"] - s["start"]))), "")
    return formatted.select("conv_id", turns.alias("turns"), trained.alias("trained"), F.length("formatted").cast("long").alias("formatted_chars"))
