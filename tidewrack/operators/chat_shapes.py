"""chats in the shape a model was trained on, as column expressions.

A ``ChatShape`` says what stands around the content of each role, whether contents are
stripped, what begins a chat, what asks for the answer, and whether a chat's first system
message is folded into its first user message. ``SHAPES`` holds three public ones.

``render`` takes an array of messages (one row's chat); ``chats`` takes a table of turns: a
message is rendered in its own row, with at most the chat's first system text added to it,
and finished strings are joined in two levels (``prompts.joined_chats``).

Defined results: a null content is empty; a message of a role that the shape does not have
is rendered as the user's; a system message that is not folded (not the first, or in a chat
without a user message) has the shape's system form.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewrack.functions.text import strip
from tidewrack.operators.prompts import joined_chats


@dataclass(frozen=True)
class ChatShape:
    roles: dict[str, tuple[str, str]]  # role -> text before and after the content; needs "user"
    generation: str
    begin: str = ""
    system: tuple[str, str] | None = None  # around a folded system text, before the user's
    strip: bool = False

    def content(self, text: Column) -> Column:
        text = F.coalesce(text, F.lit(""))
        return strip(text) if self.strip else text

    def message(self, role: Column, text: Column, lead: Column) -> Column:
        """One rendered message; ``lead`` stands before its content."""
        body = F.concat(lead, self.content(text))
        around = lambda r: F.concat(F.lit(self.roles[r][0]), body, F.lit(self.roles[r][1]))
        out = F.when(role == "user", around("user"))
        for r in self.roles:
            out = out.when(role == r, around(r)) if r != "user" else out
        return out.otherwise(around("user"))

    def lead(self, text: Column) -> Column:
        return F.concat(F.lit(self.system[0]), self.content(text), F.lit(self.system[1]))


# --- fixed values: shapes of public instruction models -----------------------------------
SHAPES = {
    "chatml": ChatShape({r: (f"<|im_start|>{r}\n", "<|im_end|>\n") for r in ("user", "assistant", "system")}, "<|im_start|>assistant\n"),
    "inst": ChatShape({"user": ("<s>[INST] ", " [/INST]"), "assistant": (" ", " </s>"), "system": ("<s>[INST] <<SYS>>\n", "\n<</SYS>> [/INST]")}, "",
                      system=("<<SYS>>\n", "\n<</SYS>>\n\n"), strip=True),
    "turns": ChatShape({"user": ("<start_of_turn>user\n", "<end_of_turn>\n"), "assistant": ("<start_of_turn>model\n", "<end_of_turn>\n"), "system": ("<start_of_turn>user\n", "<end_of_turn>\n")},
                       "<start_of_turn>model\n", begin="<bos>", system=("", "\n\n"), strip=True),
}
# ------------------------------------------------------------------------------------------


def render(messages: Column, shape: ChatShape) -> Column:
    """The chat of an ``array<struct<role, content>>`` column."""
    first = F.get(messages, F.lit(0))
    users = F.filter(messages, lambda m: m["role"] == "user")
    none = F.lit("")
    if shape.system is None:
        body = F.transform(messages, lambda m: shape.message(m["role"], m["content"], none))
    else:
        folded = F.coalesce((first["role"] == "system") & (F.size(users) > 0), F.lit(False))
        rest = F.when(folded, F.slice(messages, 2, F.greatest(F.size(messages) - 1, F.lit(0)))).otherwise(messages)
        at = F.array_position(F.transform(rest, lambda m: F.coalesce(m["role"], F.lit(""))), "user") - 1
        body = F.transform(rest, lambda m, i: shape.message(m["role"], m["content"], F.when(folded & (i == at), shape.lead(first["content"])).otherwise(none)))
    return F.concat(F.lit(shape.begin), F.array_join(body, ""), F.lit(shape.generation))


def chats(turns: DataFrame, shape: ChatShape, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """``key, n_messages, chat`` for a table of turns ``key, order, role, text``. A folded
    system message is not a message of its own."""
    rows = turns.select(F.col(key).alias("k"), F.col(order).alias("o"), "role", "text")
    lead = F.lit("")
    if shape.system is not None:
        first = F.min(F.struct("o", "role", "text"))
        heads = rows.groupBy(F.col("k").alias("h_k")).agg(first.alias("h"), F.min(F.when(F.col("role") == "user", F.col("o"))).alias("user_at"))
        heads = heads.select("h_k", F.col("h.o").alias("head_at"), F.col("h.text").alias("head"), "user_at", F.coalesce((F.col("h.role") == "system") & F.col("user_at").isNotNull(), F.lit(False)).alias("folded"))
        rows = rows.join(heads, F.col("k").eqNullSafe(F.col("h_k"))).where(~(F.col("folded") & (F.col("o") == F.col("head_at"))))
        lead = F.when(F.col("folded") & (F.col("o") == F.col("user_at")), shape.lead(F.col("head"))).otherwise(lead)
    msg = rows.select(F.col("k").alias(key), F.col("o").alias(order), shape.message(F.col("role"), F.col("text"), lead).alias("_m"))
    out = joined_chats(msg, key, order, shape.generation)
    return out.withColumn("chat", F.concat(F.lit(shape.begin), "chat"))
