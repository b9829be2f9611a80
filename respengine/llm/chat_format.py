"""Chat formatting with relational operations only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one
role share a block; blocks are joined to one string::

    <s>[INST]role[/INST]text[NEXT]text</s>

Control strings inside roles and texts are broken by a backslash after their first
character, and backslashes are doubled, so the output reads back exactly. ``loss_mask``
has one flag per block: true where a model is trained on the block's texts.

Defined results: null roles and texts count as empty; turns are ordered by turn (null
first), then role, then text; repeated rows are separate turns; a null conversation id is
a conversation; an empty table gives an empty result; extra columns are ignored. One
conversation is one output string, so its turns must fit into one row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """Control strings. None may hold a backslash, and each starts with a character that
    stands nowhere else in any of them, so none can arise where strings meet."""

    begin: str = "<s>"
    end: str = "</s>"
    role_open: str = "[INST]"
    role_close: str = "[/INST]"
    next_text: str = "[NEXT]"
    trained: tuple[str, ...] = ("assistant",)

    @property
    def controls(self) -> tuple[str, ...]:
        return self.begin, self.end, self.role_open, self.role_close, self.next_text

    def __post_init__(self):
        heads = {c[0] for c in self.controls}
        if any(len(c) < 2 or "\\" in c or heads & set(c[1:]) for c in self.controls):
            raise ValueError("control strings must start with characters of their own")


LLAMA = ChatTemplate()


def escape(text: Column, template: ChatTemplate = LLAMA) -> Column:
    heads = [f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in template.controls]
    return F.regexp_replace(text, "|".join([r"\\", *heads]), r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def chat_format(turns: DataFrame, template: ChatTemplate = LLAMA, *, conv_col: str = "conv_id",
                turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, n_turns, n_blocks, formatted, loss_mask`` for every conversation."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def merged(t: Column, i: Column) -> Column:
        return F.get("turns", i - 1)["role"].eqNullSafe(t["role"])

    def piece(t: Column, i: Column) -> Column:
        text = escape(t["text"], template)
        opened = F.concat(F.lit(template.begin + template.role_open), escape(t["role"], template),
                          F.lit(template.role_close), text)
        return F.when(merged(t, i), F.concat(F.lit(template.next_text), text)) \
            .when(i > 0, F.concat(F.lit(template.end), opened)).otherwise(opened)

    heads = F.filter("turns", lambda t, i: ~merged(t, i))
    return convs.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.size(heads).cast("long").alias("n_blocks"),
        F.concat(F.array_join(F.transform("turns", piece), ""), F.lit(template.end)).alias("formatted"),
        F.transform(heads, lambda t: t["role"].isin(*template.trained)).alias("loss_mask"))


def read_back(formatted: DataFrame, template: ChatTemplate = LLAMA) -> DataFrame:
    """Adds ``blocks``: the role, texts and loss flag of every block of ``formatted``."""
    pieces = F.split("formatted", re.escape(template.end))
    bodies = F.slice(pieces, 1, F.size(pieces) - 1)

    def block(body: Column, trained: Column) -> Column:
        parts = F.split(body, re.escape(template.role_close))
        role = F.substring(F.get(parts, F.lit(0)), len(template.begin + template.role_open) + 1, 1 << 30)
        texts = F.split(F.get(parts, F.lit(1)), re.escape(template.next_text))
        return F.struct(unescape(role).alias("role"), F.transform(texts, unescape).alias("texts"),
                        trained.alias("trained"))

    return formatted.withColumn("blocks", F.zip_with(bodies, F.col("loss_mask"), block))
