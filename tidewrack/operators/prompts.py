"""Prompt assembly.

* S13: the prompt configuration (role, task, rules, examples) is a small YAML file read
  on the driver; its size is bounded by the file, not by the data.
* F1: the instruction block. Examples are kept only if their input exists as a
  ``raw_text`` in the posts table - one bulk semi join instead of one probe per example.
  The block is a one-row DataFrame.
* F2: per-row prompt = block + closing instruction + the raw text, as a column.
* F3: chat messages ``array<struct<role, content>>`` rendered with a template that is a
  parameter (the model's own template is not part of this project).
"""

from __future__ import annotations

from dataclasses import dataclass
from importlib import resources

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.operators.table import probe_raw_text

# --- fixed values: prompt wording ------------------------------------------------------
RULES_INTRO = " You MUST follow these rules:"
EXAMPLES_INTRO = "Here are some examples:"
CLOSING_LINES = (
    "---",
    "Now, normalize the following text according to these rules without any additional explanations or comments:",
)
RAW_LABEL = "RAW TEXT:\n`"
NORMALISED_LABEL = "NORMALIZED TEXT:\n`"
# ------------------------------------------------------------------------------------------
CHAT_BUCKET = 1024  # turns per first-level group


@dataclass(frozen=True)
class PromptConfig:
    role: str
    task: str
    rules: tuple[str, ...]
    examples: tuple[tuple[str, str], ...]  # (input, output)

    @staticmethod
    def parse(text: str) -> "PromptConfig":
        d = yaml.safe_load(text)
        missing = {"role", "task", "rules", "examples"} - set(d)
        if missing:
            raise ValueError(f"prompt config lacks {sorted(missing)}")
        return PromptConfig(str(d["role"]), str(d["task"]), tuple(str(r) for r in d["rules"]),
                            tuple((str(e["input"]), str(e["output"])) for e in d["examples"]))

    @staticmethod
    def default() -> "PromptConfig":
        text = resources.files("tidewrack.resources").joinpath("normaliser_prompt.yml").read_text("utf-8")
        return PromptConfig.parse(text)

    def header(self) -> str:
        lines = [self.role, "", f"{self.task}{RULES_INTRO}"]
        lines += [f"{i + 1}. {rule}" for i, rule in enumerate(self.rules)]
        lines += ["", EXAMPLES_INTRO]
        return "\n".join(lines)

    def examples_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, inp, out) for i, (inp, out) in enumerate(self.examples)]
        return spark.createDataFrame(rows, "idx long, raw_text string, output string")


def example_lines(inp: Column, out: Column) -> Column:
    """The three lines one example adds: blank, RAW TEXT block, NORMALIZED TEXT block."""
    return F.concat(F.lit("\n\n"), F.lit(RAW_LABEL), inp, F.lit("`\n"), F.lit(NORMALISED_LABEL), out, F.lit("`\n"))


def instruction_block(config: PromptConfig, posts: DataFrame, examples: DataFrame | None = None) -> DataFrame:
    """one row ``block`` (plus ``n_examples``). ``examples`` (idx, raw_text, output)
    defaults to the config's examples; those whose input is not a post are skipped."""
    spark = posts.sparkSession
    ex = examples if examples is not None else config.examples_frame(spark)
    present = probe_raw_text(posts, ex).where("exists")
    parts = present.agg(
        F.array_sort(F.collect_list(F.struct("idx", example_lines(F.col("raw_text"), F.col("output")).alias("s")))).alias("_e"))
    body = F.coalesce(F.array_join(F.transform("_e", lambda x: x["s"]), ""), F.lit(""))
    return parts.select(F.concat(F.lit(config.header()), body).alias("block"),
                        F.size("_e").cast("long").alias("n_examples"))


def cleaning_prompt(block: Column, raw_text: Column) -> Column:
    """instruction block, closing lines, the raw text, and the open answer."""
    return F.concat(block, F.lit("\n" + "\n".join(CLOSING_LINES) + "\n" + RAW_LABEL), raw_text,
                    F.lit("`\n" + NORMALISED_LABEL))


def with_prompts(rows: DataFrame, block: DataFrame, text: str = "raw_text", out: str = "prompt") -> DataFrame:
    """Build each row's prompt; the one-row block enters as a scalar subquery (computed
    once, its size bounded by the prompt config)."""
    return rows.withColumn(out, cleaning_prompt(block.select("block").scalar(), F.col(text)))


@dataclass(frozen=True)
class ChatTemplate:
    """``{role}``/``{content}`` message format, and the generation prompt appended last."""
    message: str = "<|{role}|>\n{content}\n"
    generation: str = "<|assistant|>\n"

    def _pieces(self):
        head, rest = self.message.split("{role}")
        mid, tail = rest.split("{content}")
        return head, mid, tail

    def render(self, messages: Column, add_generation_prompt: bool = True) -> Column:
        head, mid, tail = self._pieces()
        rendered = F.array_join(F.transform(messages, lambda m: F.concat(
            F.lit(head), m["role"], F.lit(mid), m["content"], F.lit(tail))), "")
        return F.concat(rendered, F.lit(self.generation)) if add_generation_prompt else rendered


def user_chat(prompt: Column) -> Column:
    """``[{"role": "user", "content": prompt}]``."""
    return F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content")))


def conversation_chats(turns: DataFrame, template: ChatTemplate = ChatTemplate(), key: str = "conv_id",
                       order: str = "turn") -> DataFrame:
    """Multi-turn chats: messages of each conversation in turn order, rendered.

    Rendering is done per message before grouping, so only finished strings travel
    through the shuffle."""
    head, mid, tail = template._pieces()
    msg = turns.select(key, order, F.concat(F.lit(head), "role", F.lit(mid), F.coalesce("text", F.lit("")), F.lit(tail)).alias("_m"))
    return joined_chats(msg, key, order, template.generation)


def joined_chats(msg: DataFrame, key: str, order: str, generation: str) -> DataFrame:
    """``key, n_messages, chat`` from rendered messages ``key, order, _m``."""
    # Two levels: messages are joined per (conversation, turn bucket) first, so a very
    # long conversation is spread over many tasks; then the buckets are joined in order.
    bucket = F.floor(F.col(order) / CHAT_BUCKET).cast("long").alias("_b")
    part = msg.groupBy(key, bucket).agg(F.array_sort(F.collect_list(F.struct(order, "_m"))).alias("_ms"))
    part = part.select(key, F.struct("_b", F.array_join(F.transform("_ms", lambda x: x["_m"]), "").alias("_s"),
                                     F.size("_ms").cast("long").alias("_n")).alias("_p"))
    chats = part.groupBy(key).agg(F.array_sort(F.collect_list("_p")).alias("_ps"))
    return chats.select(key, F.aggregate("_ps", F.lit(0).cast("long"), lambda a, x: a + x["_n"]).alias("n_messages"),
                        F.concat(F.array_join(F.transform("_ps", lambda x: x["_s"]), ""), F.lit(generation)).alias("chat"))


__all__ = ["PromptConfig", "ChatTemplate", "instruction_block", "cleaning_prompt", "with_prompts", "user_chat",
           "conversation_chats"]
