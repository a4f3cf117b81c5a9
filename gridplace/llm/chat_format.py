"""Chat formatting: conversations to one marked text each, and back.

A turn's content is an array of typed parts.  A visitor flattens them in
order: text is escaped, an image, audio or document part becomes a numbered
placeholder, and the part is recorded as an attachment with its reference
and the number of tokens that it expands to.  Turns are then marked by the
template and joined, and the loss mask is recorded as character spans.

All control strings of the template are escaped inside texts and roles, by
replacements that can be undone in the opposite order, so a text that looks
like a turn cannot break the format and is read back unchanged.

Everything is column expressions.  The running character offset and the
gathering of a conversation's turns use one shuffle, by conversation.

Defined cases: NULL text and NULL role are empty strings; NULL parts are
skipped; turns are ordered by turn number (NULL first), then role and text,
so ties and repeated rows have one order and all stay; turns with a NULL
conversation id form one conversation; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The template's control strings.
TURN, AFTER_ROLE, END = "### ", ": ", "</turn>\n"
#: What is escaped in texts, in this order; undone from the last to the first.
ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\e"), ("<|", "\\l"))
ROLE_ESCAPES = ESCAPES + ((":", "\\c"),)
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"

#: Expanded tokens: an image's tiles, seconds of audio, pages of a document.
PATCH, TOKENS_PER_TILE, TOKENS_PER_SECOND, TOKENS_PER_PAGE = 512, 256, 25, 512


def escape(text: Column, pairs=ESCAPES) -> Column:
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, text)


def unescape(text: Column, pairs=ESCAPES) -> Column:
    return reduce(lambda c, p: F.replace(c, F.lit(p[1]), F.lit(p[0])), reversed(pairs), text)


def text_part(text: Column) -> Column:
    """A content array of one text part."""
    none = [F.lit(None).cast(t) for t in ("string", "int", "int", "double", "int")]
    names = ("ref", "width", "height", "seconds", "pages")
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *[c.alias(n) for c, n in zip(none, names)]).cast(PART))


def expanded_tokens(part: Column) -> Column:
    """Tokens that an attachment stands for; at least one."""
    tiles = F.ceil(F.coalesce(part["width"], F.lit(PATCH)) / PATCH) * F.ceil(F.coalesce(part["height"], F.lit(PATCH)) / PATCH)
    size = (
        F.when(part["kind"] == "image", tiles * TOKENS_PER_TILE)
        .when(part["kind"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * TOKENS_PER_SECOND))
        .when(part["kind"] == "document", F.coalesce(part["pages"], F.lit(1)) * TOKENS_PER_PAGE)
    )
    return F.greatest(F.coalesce(size, F.lit(0)), F.lit(1)).cast("long")


def visit(parts: Column) -> tuple[Column, Column]:
    """Flattened text and attachments of a content array."""
    parts = F.filter(parts, lambda p: p.isNotNull())
    is_text = lambda p: F.coalesce(p["kind"], F.lit("text")) == "text"
    attached = F.filter(parts, lambda p: ~is_text(p))
    before = lambda i: F.size(F.filter(F.slice(parts, 1, i), lambda p: ~is_text(p)))
    flat = F.transform(
        parts,
        lambda p, i: F.when(is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(
            F.concat(F.lit("<|"), escape(p["kind"]), F.lit(":"), before(i).cast("string"), F.lit("|>"))
        ),
    )
    listed = F.transform(
        attached, lambda p, i: F.struct(i.alias("ordinal"), p["kind"].alias("kind"), p["ref"].alias("ref"), expanded_tokens(p).alias("tokens"))
    )
    return F.array_join(flat, ""), listed


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str | None = "text",
    parts_col: str | None = None,
    loss_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """Per conversation: conv_id, formatted, loss_spans (turn, turn_start,
    start, end: code points of ``formatted``, end exclusive), attachments
    (turn, ordinal, kind, ref, tokens) and expanded_tokens.

    The content is ``parts_col`` (an array of ``PART``) or, without one, the
    text of ``text_col``.
    """
    parts = F.coalesce(F.col(parts_col), F.array().cast(f"array<{PART}>")) if parts_col else text_part(F.coalesce(F.col(text_col), F.lit("")))
    flat, attached = visit(parts)
    role = F.coalesce(F.col(role_col), F.lit(""))
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), flat.alias("body"), attached.alias("attached")
    )
    head = F.concat(F.lit(TURN), escape(F.col("role"), ROLE_ESCAPES), F.lit(AFTER_ROLE))
    rows = rows.select(
        "conv_id", "turn", "role", "attached", F.concat(head, "body", F.lit(END)).alias("piece"),
        F.length(head).cast("long").alias("head"), F.length("body").cast("long").alias("length"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "piece")
    rows = rows.select(
        "*",
        (F.row_number().over(order) - 1).alias("n"),
        (F.sum(F.length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.length("piece")).alias("turn_start"),
    )
    start = F.col("turn_start") + F.col("head")
    span = F.struct(F.col("n").alias("turn"), "turn_start", start.alias("start"), (start + F.col("length")).alias("end"))
    grouped = rows.groupBy("conv_id").agg(
        F.collect_list(F.struct("n", "piece")).alias("pieces"),
        F.collect_list(F.when(F.col("role").isin(*loss_roles), span)).alias("spans"),
        F.collect_list(F.when(F.size("attached") > 0, F.struct("n", "attached"))).alias("attached"),
    )
    attachments = F.flatten(F.transform(
        F.array_sort("attached"),
        lambda t: F.transform(t["attached"], lambda a: F.struct(t["n"].alias("turn"), a["ordinal"].alias("ordinal"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))),
    ))
    return grouped.select(
        "conv_id",
        F.array_join(F.transform(F.array_sort("pieces"), lambda p: p["piece"]), "").alias("formatted"),
        F.array_sort("spans").alias("loss_spans"),
        attachments.alias("attachments"),
    ).withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]))


def parse_chats(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text; placeholders stay) and loss_texts, read
    back from ``formatted`` and ``loss_spans`` of ``format_chats``."""
    pieces = F.split("formatted", F.lit("\\Q" + END + "\\E"), -1)
    cut = formatted.select("*", F.slice(pieces, 1, F.size(pieces) - 1).alias("_pieces"))
    turn = lambda p: F.struct(
        unescape(F.substr(p, F.lit(len(TURN) + 1), F.instr(p, AFTER_ROLE) - F.lit(len(TURN) + 1)), ROLE_ESCAPES).alias("role"),
        unescape(F.substr(p, F.instr(p, AFTER_ROLE) + F.lit(len(AFTER_ROLE)))).alias("text"),
    )
    # a span is cut from its own turn, so long conversations stay linear
    loss = F.transform(
        "loss_spans",
        lambda s: unescape(F.substr(F.get("_pieces", s["turn"]), (s["start"] - s["turn_start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))),
    )
    return cut.select("conv_id", "formatted", F.transform("_pieces", turn).alias("turns"), loss.alias("loss_texts"))


def digest_chats(parsed: DataFrame) -> DataFrame:
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("loss_texts", "")
    return parsed.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
