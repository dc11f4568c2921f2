"""preference scorer (re-aim of the reward model: one scalar score per text, learned
from chosen/rejected pairs), and how well it ranks.

A Bradley-Terry model: the chance that ``chosen`` is preferred is
``sigmoid(score(chosen) - score(rejected))`` with ``score(text) = w . features(text)``. The
features are counts of what the normalisation changes (words, mentions, tags, links,
capitals ...), as column expressions.

The fit maximises the ridge-penalised likelihood by ``STEPS`` steps of

    w_j += (sum_i (1 - p_i) x_ij - RIDGE w_j) / (RIDGE + sum_i |x_ij| sum_k |x_ik| / 4)

The denominator bounds the second derivatives for every w, so the likelihood rises at each
step without a step size, and a step is one aggregate over the pairs: ``len(FEATURES)`` sums
are all that reaches the driver. Equal difference vectors are one row with a count first.

Defined results: null texts count as empty; pairs of equal features move nothing; without
pairs all weights are 0. ``ranking`` is null where there is nothing to rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewrack.operators.order import global_running_sum
from tidewrack.session import stage

#: name -> pattern whose matches are counted (both Java's engine and RE2 read it the same way)
COUNTED = {
    "words": r"[^ \n\t\r]+",
    "mentions": r"@[A-Za-z0-9_]",
    "tags": r"#[A-Za-z0-9_]",
    "links": r"://",
    "capitals": r"[A-Z][A-Z]",
    "digits": r"[0-9]",
    "marks": r"[!?]",
    "dashes": r"--|–|—|…",
}
FEATURES = (*COUNTED, "final_mark")
FINAL_MARK = r"[.!?]$"
STEPS = 12
RIDGE = 1.0


def features(text: Column | str) -> Column:
    """``array<double>``: ln(1 + count) of every pattern, and whether the text ends in a mark."""
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    counts = [F.log1p(F.regexp_count(t, F.lit(p)).cast("double")) for p in COUNTED.values()]
    return F.array(*counts, F.when(t.rlike(FINAL_MARK.replace("$", r"\z")), 1.0).otherwise(0.0))


def fit(reward_rows: DataFrame, steps: int = STEPS, ridge: float = RIDGE) -> list[float]:
    """Weights from ``(chosen, rejected)`` rows."""
    k = len(FEATURES)
    x = F.zip_with(features("chosen"), features("rejected"), lambda a, b: a - b)
    pairs = stage(reward_rows.select(x.alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("n")), "preference-pairs")
    each = [F.col("x")[j] for j in range(k)]
    reach = sum((F.abs(c) for c in each), F.lit(0.0))
    bounds = pairs.agg(*(F.sum(F.col("n") * F.abs(c) * reach) for c in each)).first()
    w = [0.0] * k
    for _ in range(steps):
        margin = sum((c * F.lit(v) for c, v in zip(each, w, strict=True)), F.lit(0.0))
        miss = F.col("n") / (1 + F.exp(margin))
        slopes = pairs.agg(*(F.sum(miss * c) for c in each)).first()
        w = [v + ((g or 0.0) - ridge * v) / (ridge + (b or 0.0) / 4) for v, g, b in zip(w, slopes, bounds, strict=True)]
    return w


def score(weights: list[float], text: Column | str) -> Column:
    """The score of a text, as a column."""
    parts = F.zip_with(features(text), F.array(*map(F.lit, weights)), lambda a, b: a * b)
    return F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)


def ranking(scored: DataFrame, chosen: str = "score_chosen", rejected: str = "score_rejected") -> DataFrame:
    """One row: ``pairs``, ``accuracy`` (pairs whose chosen text scores higher, ties half) and
    ``auc``, the chance that any chosen text scores higher than any rejected one (rank sum,
    ties half). Scores are grouped first; their order is a global running sum over range
    blocks, so no task holds them all."""
    one = F.when(F.col(chosen) > F.col(rejected), 1.0).when(F.col(chosen) == F.col(rejected), 0.5).otherwise(0.0)
    pairs = scored.agg(F.count(F.lit(1)).alias("pairs"), F.avg(one).alias("accuracy"))
    sides = scored.select(F.explode(F.array(F.struct(F.col(chosen).alias("s"), F.lit(1).alias("good")), F.struct(F.col(rejected).alias("s"), F.lit(0).alias("good")))).alias("x"))
    by_score = sides.groupBy("x.s").agg(F.sum("x.good").alias("good"), F.sum(1 - F.col("x.good")).alias("bad"))
    below = global_running_sum(by_score, ["s"], "bad", "upto")
    auc = below.agg((F.sum(F.col("good") * (F.col("upto") - F.col("bad") / 2)) / F.sum("good") / F.sum("bad")).alias("auc"))
    return pairs.select("pairs", "accuracy", auc.scalar().alias("auc"))
