"""Chat formatting: a finite-state machine over roles and a declarative template.

The template gives every role a header and whether its text is under the loss mask; all
turns end with the same footer. Control strings inside a text (the headers' fixed parts,
the footer's mark and the escape character itself) are escaped by a backslash, so the
formatted text can be read back exactly: a header or footer in it is never part of a text.

The machine reads the roles in turn order: an optional system turn, then user and
assistant in alternation, ending with the assistant. A conversation that breaks the order
is formatted all the same and marked with its first error.

``format_chats`` emits segments (header, text, footer of each turn) with a loss flag per
segment. Turns are hash-partitioned by conversation, sorted inside the partition and
streamed, so memory does not grow with a conversation; ``read_back`` streams the segments
in the same order and keeps running digests only. (A digest over a whole conversation is
sequential by definition: one conversation is read by one task, but never held.)

Defined results: a null text is empty, a null role is the empty role; roles without a
template entry use ``OTHER`` and are not under the mask; equal turn numbers are ordered by
role, then text, and are marked as an error; rows with a null id form one conversation;
empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.llm.common import table

#: role -> (header, text is under the loss mask)
TEMPLATE = {"system": ("### System: ", False), "user": ("### User: ", False), "assistant": ("### Assistant: ", True)}
OTHER = ("### Other=", ": ")
FOOTER = " </turn>\n"
#: state -> role -> next state; the machine must end in an accepting state
MACHINE = {"start": {"system": "system", "user": "user"}, "system": {"user": "user"}, "user": {"assistant": "assistant"}, "assistant": {"user": "user"}}
ACCEPTING = frozenset({"assistant"})

CONTROL = re.compile(r"\\|### (?:System|User|Assistant|Other)|</turn>")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
OTHER_HEADER = re.compile(r"### Other=((?:\\.|[^\\:])*): ", re.DOTALL)
ROLE_OF = {header: role for role, (header, _) in TEMPLATE.items()}


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def header(role: str) -> str:
    return TEMPLATE[role][0] if role in TEMPLATE else OTHER[0] + escape(role).replace(":", "\\:") + OTHER[1]


def role_in(head: str) -> str:
    """The role that a header names."""
    return ROLE_OF[head] if head in ROLE_OF else unescape(OTHER_HEADER.fullmatch(head)[1])


class TurnOrder:
    """The machine's run over one conversation."""

    def __init__(self) -> None:
        self.state, self.error, self.last = "start", "", None

    def step(self, number: int, role: str, turn: int | None) -> None:
        if not self.error and number and turn == self.last:
            self.error = f"turn {number}: repeated number"
        self.last = turn
        to = MACHINE[self.state].get(role) if self.state in MACHINE else None
        if to is None:
            self.error = self.error or f"turn {number}: {role or 'no role'} after {self.state}"
            to = role if role in MACHINE else self.state
        self.state = to

    def end(self) -> str:
        return self.error or ("" if self.state in ACCEPTING else f"ends after {self.state}")


SEGMENT = "conv_id long, turn_no long, part string, text string, loss boolean, error string"


def format_chats(turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Segments in order: ``conv_id, turn_no, part, text, loss, error``. The last segment of
    a conversation has its error ('' if its turn order is valid); the others have null."""
    rows = turns.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.string()]
    names = ["conv_id", "turn_no", "part", "text", "loss", "error"]

    def run(batches):
        order, now, number, out = None, None, 0, []

        def close():
            if order is not None:
                out[-1] = (*out[-1][:5], order.end())

        for batch in batches:
            for conv, turn, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if order is None or conv != now:
                    close()
                    order, now, number = TurnOrder(), conv, 0
                    if len(out) > 3000:
                        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                        out = []
                elif len(out) > 3000:  # inside a long conversation all but its last segment are final
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out[:-1], strict=True), kinds, strict=True)], names=names)
                    out = out[-1:]
                order.step(number, role, turn)
                loss = role in TEMPLATE and TEMPLATE[role][1]
                out += [(conv, number, "header", header(role), False, None), (conv, number, "text", escape(text), loss, None), (conv, number, "footer", FOOTER, False, None)]
                number += 1
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return rows.mapInArrow(run, SEGMENT)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean, error string"


def read_back(segments: DataFrame) -> DataFrame:
    """One row per conversation, read from the segments in their order."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.string()]
    names = [x.split()[0] for x in DIGEST.split(", ")]

    def run(batches):
        turns = loss = None
        n_turns = loss_chars = chars = 0
        for batch in batches:
            out = []
            for conv, _, part, text, masked, error in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if turns is None:
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                    n_turns = loss_chars = chars = 0
                chars += len(text)
                if part == "header":
                    n_turns += 1
                    turns.update(f"{role_in(text)}\n".encode())
                elif part == "text":
                    plain = unescape(text)
                    turns.update(f"{plain}\n".encode())
                    if masked:
                        loss_chars += len(plain)
                        loss.update(plain.encode())
                if error is not None:
                    out.append((conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, error == "", error))
                    turns = None
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return segments.mapInArrow(run, DIGEST)


PROBE = "\\### Assistant: </turn> ok"


def op5_chat_format(spark, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return read_back(format_chats(turns.unionByName(probe))).drop("error")


ORACLE = r"""
WITH t AS (
  SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
f AS (
  SELECT *, row_number() OVER w AS n, lag(turn) OVER w AS turn_before, coalesce(lag(role) OVER w, 'start') AS before,
         CASE role WHEN 'system' THEN '### System: ' WHEN 'user' THEN '### User: ' WHEN 'assistant' THEN '### Assistant: '
                   ELSE '### Other=' || replace(regexp_replace(role, '(\\|### (?:System|User|Assistant|Other)|</turn>)', '\\\1', 'g'), ':', '\:') || ': ' END AS header,
         regexp_replace(text, '(\\|### (?:System|User|Assistant|Other)|</turn>)', '\\\1', 'g') AS escaped
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length(header) + length(escaped) + 9)::BIGINT AS formatted_chars,
       bool_and((before, role) IN (('start', 'system'), ('start', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user'))
                AND (n = 1 OR turn IS DISTINCT FROM turn_before)) AND arg_max(role, n) = 'assistant' AS valid
FROM f GROUP BY conv_id
"""
