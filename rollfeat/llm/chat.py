"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it as context, then the reply, which alone is
trained on. Turns after the last reply (or a conversation without replies) make one more example that trains nothing, so that
no turn is lost.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts ``<|`` is written ``<||``, so that no control
string can appear there; a line break in a role is written ``<|n|>``. :func:`unescape` gives back the original.

Turns are ordered by ``turn``, then role, then text; a repeated row is a turn of its own. Null role or text counts as empty, a null
``turn`` comes first, a null ``conv_id`` is a conversation like any other. Other columns are ignored. The expansion of a
conversation is as large as its definition says, the sum of its prefixes; each example is a row, and none of them is
shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, BREAK = "<|im_start|>", "<|im_end|>\n", "<|n|>"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def expand(conversations: DataFrame) -> DataFrame:
    """Examples ``(conv_id, example, formatted, loss_start, loss_chars)`` from ``(conv_id, turn, role, text)``.

    ``example`` is the number of turns in the example; ``formatted`` its text; the trained part is its ``loss_chars`` code
    points from ``loss_start`` (from 0) on, null where nothing is trained.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.select(
        "conv_id",
        "turn",
        role.alias("role"),
        text.alias("text"),
        escape(text).alias("body"),
        F.concat(F.lit(START), F.replace(escape(role), F.lit("\n"), F.lit(BREAK)), F.lit("\n"), escape(text), F.lit(END)).alias("piece"),
    )
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    grown = turns.select(
        "conv_id",
        "role",
        "body",
        F.row_number().over(ordered).alias("example"),
        F.lead("piece").over(ordered).isNull().alias("last"),
        F.sum(F.length("piece")).over(so_far).alias("chars"),
        F.collect_list("piece").over(so_far).alias("pieces"),
    )
    reply = F.col("role") == ASSISTANT
    size = F.length("body").cast("long")
    return grown.where(reply | F.col("last")).select(
        "conv_id",
        "example",
        F.array_join("pieces", "").alias("formatted"),
        F.when(reply, F.col("chars") - size - len(END)).alias("loss_start"),
        F.when(reply, size).alias("loss_chars"),
    )


def trained_text(formatted: Column, loss_start: Column, loss_chars: Column) -> Column:
    """The reply, as it was before formatting."""
    return unescape(F.substr(formatted, (loss_start + 1).cast("int"), loss_chars.cast("int")))


def turns_of(formatted: Column) -> Column:
    """The turns written in an example, as an array of ``(role, text)``."""
    marked = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda piece: piece != "")

    def parse(piece: Column) -> Column:
        inner = F.substr(piece, F.lit(len(START) + 1))
        line = F.instr(inner, "\n")
        role = unescape(F.replace(F.substr(inner, F.lit(1), line - 1), F.lit(BREAK), F.lit("\n")))
        return F.struct(role.alias("role"), unescape(F.substr(inner, line + 1)).alias("text"))

    return F.transform(marked, parse)
