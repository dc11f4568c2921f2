"""L2 and L3 as composed plans.

* L2 ``normalise_table``: read the current posts table version, normalise the rows that
  still lack a clean text (all rows if ``force``), write the next version.
* L3 ``training_sets``: preference pairs -> reward rows (F7), PPO rows (F8), positional
  train/eval split (F9) and the tokenised prompt column (F10, other columns dropped).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.operators import lm as LM
from tidewrack.operators import prefs as PF
from tidewrack.operators.infer import ModelBackend, normalise_posts
from tidewrack.sources import table_store as TS


def normalise_table(spark: SparkSession, root: str, force: bool = False, backend: ModelBackend | None = None) -> int:
    """L2 over a versioned table; returns the version written."""
    return TS.write(normalise_posts(TS.read(spark, root), force, backend), root)


@dataclass
class TrainingSets:
    reward: DataFrame      # chosen, rejected
    ppo: DataFrame         # prompt, chosen, rejected, split, row_number
    tokens: DataFrame      # row_number, split, input_ids


def training_sets(pairs: DataFrame, order: list[str]) -> TrainingSets:
    """``pairs`` in stored order (``order`` columns give that order)."""
    reward = PF.reward_rows(pairs)
    split = PF.positional_split(pairs, order)
    ppo = PF.ppo_rows(split.select("id", "input", "accepted", "rejected", "split", "row_number"))
    prompts = split.select("row_number", "split", F.col("input").alias("prompt"))
    vocab = LM.vocabulary(prompts, "prompt")
    tokens = LM.encode(prompts, vocab, "row_number", "prompt").join(prompts.select("row_number", "split"), "row_number")
    return TrainingSets(reward, ppo, tokens)
