"""Conversations as training text with typed content parts. DataFrame functions only.

Every turn is a list of typed parts. A visitor turns the list into text: text parts are escaped, each image, audio or
document part becomes a placeholder, its reference and the number of tokens it will expand to are recorded in the order
of the placeholders. Turns are framed by control strings; the loss mask covers the assistant's bodies.

Control strings all start with ``<|``. In texts, ``<``, any number of backslashes and ``|`` gain one backslash, so that
no text holds a control string and dropping one backslash gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

START, END, BREAK = "<|im_start|>", "<|im_end|>\n", "<|nl|>"
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
#: Kinds whose placeholders bear their plain names.
ATTACHED = ["image", "audio", "document"]
#: Tokens of an attachment: image patches of this many pixels a side, audio tokens a second, tokens a document page.
PATCH, PER_SECOND, PER_PAGE = 14, 25, 576


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def text_part(text: Column) -> Column:
    """A list with a text alone."""
    return F.array(F.struct(
        F.lit("text").alias("kind"), text.cast("string").alias("text"), F.lit(None).cast("string").alias("ref"),
        *(F.lit(None).cast(kind).alias(name) for name, kind in
          (("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))),
    ))


def is_text(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("text")) == "text"


def visit(part: Column) -> Column:
    """What a part adds to the body. A kind that is not text is a placeholder named after it; one that is not among
    ``ATTACHED`` stands behind ``part:``, so that no kind spells the start or the end of a turn."""
    name = F.regexp_replace(part["kind"], "[^a-z0-9_]", "_")
    name = F.when(part["kind"].isin(ATTACHED), name).otherwise(F.concat(F.lit("part:"), name))
    return F.when(is_text(part), escape(F.coalesce(part["text"], F.lit("")))).otherwise(
        F.concat(F.lit("<|"), name, F.lit("|>"))
    )


def attachment(part: Column) -> Column:
    """Reference of a part that is not text and the tokens it expands to (1 where its size is unknown)."""
    patches = F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH)
    tokens = (F.when(part["kind"] == "image", patches)
              .when(part["kind"] == "audio", F.ceil(part["seconds"] * PER_SECOND))
              .when(part["kind"] == "document", part["pages"].cast("long") * PER_PAGE))
    return F.struct(part["kind"].alias("kind"), part["ref"].alias("ref"), F.coalesce(tokens, F.lit(1)).alias("n_tokens"))


def format_chats(turns: DataFrame, assistant: str = "assistant") -> DataFrame:
    """One row per conv_id from rows (conv_id, turn, role, parts: array of PART).

    Result: n_turns, formatted, loss_spans (start and end of the assistant's bodies in code points, end exclusive),
    attachments (kind, ref, n_tokens; in the order of the placeholders), attachment_tokens.

    Turns go by turn, then role, then body, nulls first; repeated rows stay. Null roles, parts and texts are empty. Rows
    with a null conv_id form one conversation. A conversation becomes one row, so it has to fit one. Other columns are
    not read; an empty table gives no rows.
    """
    parts = F.filter(F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    role = F.coalesce(F.col("role"), F.lit(""))
    rows = turns.select(
        "conv_id", "turn", role.alias("role"),
        F.array_join(F.transform(parts, visit), "").alias("body"),
        F.transform(F.filter(parts, lambda p: ~is_text(p)), attachment).alias("attachments"),
    )
    head = F.concat(F.lit(START), F.replace(escape(F.col("role")), F.lit("\n"), F.lit(BREAK)), F.lit("\n"))
    framed = rows.select("*", F.char_length(head).alias("head_chars"), F.concat(head, "body", F.lit(END)).alias("line"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body", "attachments")
    start = F.coalesce(F.sum(F.char_length("line")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = framed.select("*", F.row_number().over(order).alias("at"), (start + F.col("head_chars")).alias("start"))
    span = F.struct(F.col("start"), (F.col("start") + F.char_length("body")).alias("end"))
    grouped = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "at", "line", F.when(F.col("role") == assistant, span).alias("span"), "attachments",
    ))).alias("lines"))
    attachments = F.flatten(F.col("lines.attachments"))
    return grouped.select(
        "conv_id", F.size("lines").cast("long").alias("n_turns"), F.array_join("lines.line", "").alias("formatted"),
        F.filter("lines.span", lambda s: s.isNotNull()).alias("loss_spans"), attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda n, a: n + a["n_tokens"]).alias("attachment_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """Roles and texts of a formatted conversation, unescaped, as an array of structs; placeholders stay as they are."""
    lines = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda x: x != "")

    def read(line: Column) -> Column:
        cut = F.locate("\n", line)
        role = F.substring(line, F.lit(len(START) + 1), cut - len(START) - 1)
        return F.struct(
            unescape(F.replace(role, F.lit(BREAK), F.lit("\n"))).alias("role"),
            unescape(F.substring(line, cut + 1, F.char_length(line))).alias("text"),
        )

    return F.transform(lines, read)


def under_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask."""
    cut = lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    return F.array_join(F.transform(spans, cut), "")


def chat_digests(formatted: DataFrame) -> DataFrame:
    """What is read back from formatted conversations."""
    turns = F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = under_loss(F.col("formatted"), F.col("loss_spans"))
    return formatted.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"), F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
