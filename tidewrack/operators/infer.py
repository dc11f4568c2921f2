"""Batch normalisation (F4, P10, P11) and the normalise-posts job (L2).

Backends:

* ``None`` (default): the rule chain of ``functions.rules`` - column expressions only,
  no Python in the plan.
* ``ModelBackend(factory)``: a user-supplied model. ``factory()`` is called once per
  backend and Python worker process (``model_cache``) and returns ``generate(prompts: list[str]) -> list[str]``; rows
  reach it in Arrow batches through ``mapInPandas``. Prompts are built JVM-side (F1-F3)
  and the answer's backticks are trimmed JVM-side (P10).

Blank texts short-circuit to ``""`` and never reach a model (P11).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.functions.rules import apply_rules
from tidewrack.functions.text import is_blank, trim_backticks
from tidewrack.operators import answers as answer_service
from tidewrack.operators import model_cache
from tidewrack.operators import table as TB
from tidewrack.operators.prompts import ChatTemplate, PromptConfig, instruction_block, user_chat, with_prompts

@dataclass(frozen=True)
class ModelBackend:
    factory: Callable[[], Callable[[list[str]], list[str]]]
    template: ChatTemplate = ChatTemplate()
    config: PromptConfig | None = None
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def _generate(backend: ModelBackend, prompt_col: str, out: str):
    key, factory = backend.key, backend.factory

    def run(batches):
        model = model_cache.get(key, factory)
        for pdf in batches:
            pdf[out] = list(model(pdf[prompt_col].tolist())) if len(pdf) else []
            yield pdf.drop(columns=[prompt_col])

    return run


def normalise(rows: DataFrame, text: str = "raw_text", out: str = "clean_text",
              backend: ModelBackend | None = None, posts: DataFrame | None = None, answers: str | None = None) -> DataFrame:
    """F4 over a DataFrame: adds ``out`` (the normalised text) to every row. With ``answers``,
    a folder of the model's, equal prompts are asked once and answers are kept in it
    (``operators.answers``)."""
    if backend is None:
        ruled = apply_rules(rows, text, out)
        return ruled.withColumn(out, F.when(is_blank(text), F.lit("")).otherwise(F.col(out)))
    cfg = backend.config or PromptConfig.default()
    block = instruction_block(cfg, posts if posts is not None else rows)
    blank = rows.where(is_blank(text)).withColumn(out, F.lit(""))
    todo = with_prompts(rows.where(~is_blank(text)), block, text, "_prompt")
    todo = todo.withColumn("_prompt", backend.template.render(user_chat(F.col("_prompt"))))
    if answers is not None:
        answered = answer_service.answered(todo, backend, answers, "_prompt", out).drop("_prompt")
        return answered.withColumn(out, trim_backticks(out)).unionByName(blank)
    schema = todo.drop("_prompt").schema.add(out, "string")
    answered = todo.mapInPandas(_generate(backend, "_prompt", out), schema)
    answered = answered.withColumn(out, trim_backticks(out))
    return answered.unionByName(blank)


def normalise_posts(table: DataFrame, force: bool = False, backend: ModelBackend | None = None) -> DataFrame:
    """L2: normalise rows without a clean text (all rows if ``force``). The rules are a
    column expression on the row itself; a model's answers come back by one keyed update of
    the table (S10)."""
    if backend is None:
        ruled = normalise(table, "raw_text", "_ruled")
        todo = F.lit(True) if force else F.col("clean_text").isNull() | (F.col("clean_text") == "")
        return ruled.withColumn("clean_text", F.when(todo, F.col("_ruled")).otherwise(F.col("clean_text"))).drop("_ruled")
    todo = TB.needs_normalising(table, force).select("id", "raw_text")
    done = normalise(todo, "raw_text", "clean_text", backend, posts=table).select(
        "id", "clean_text", F.lit(1).alias("seq"))
    return TB.update_clean_text(table, done)
