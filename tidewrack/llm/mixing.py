"""Mixing sources to target weights along a time-varying curriculum (DataFrame functions only).

1. *Targets*. Sources by code point (null last) weigh 3, 1, 2, repeating. They share
   ``budget`` times the words of all documents; a target stops at ``max_epochs`` times
   its source's words and the excess is reshared by weight. With the sources sorted by
   cap / weight, the first j are capped and the rest get (budget - caps) / (weights left)
   per unit of weight: a prefix sum over one row per source, no iteration.
2. *Schedule*. A source's weight over training time t in [0, 1] is linear,
   ``1 + slope * (1 - 2t)``, with slopes ``SLOPES`` by source rank. Its integral, the
   cumulative token demand, is ``D(t) = t + slope * (t - t*t)`` (a share of the target).
3. *Placement*. Each source is a stream of its documents in a fixed pseudo-random order
   (md5 of the id), passed at most twice. A pass of a document at stream offset ``o`` is
   taken while ``o`` is below the target and is cut there, so a source's words taken are
   its target rounded down. The pass's training position inverts the demand:
   ``t = D^-1(o / target)``.
4. ``training_order`` range-sorts the passes by position.

Defined results: a null text has size 0; a source without words has target 0 and takes
nothing; documents of size 0 take 0; equal ids share their place in the order and are
told apart by source, then size (rows that are equal in all three are interchangeable);
an empty table gives an empty result; extra columns are ignored.

Scale: stream offsets are a two-level prefix sum. ``BUCKETS`` slices of the hash order
per source are summed first (map-side combined), a window runs over those few rows per
source, and another window over the documents of one (source, slice). A source with a
third of all rows is therefore split over as many tasks as it has slices. The slices
per source follow the table's row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.session import stage

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MAX_EPOCHS = 2
SLOPES = (0.5, 0.0, -0.5)
DOCS_PER_SLICE = 2_000
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text: ends of runs, counted as a length difference (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def by_rank(values: tuple, rank: Column) -> Column:
    """The value at ``rank`` modulo the number of values."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (rank % len(values) + 1).cast("int"))


def source_targets(sizes: DataFrame, budget: float = BUDGET) -> DataFrame:
    """One row per source: ``source, rank, source_size, target`` (water-filling).

    The windows run over one row per source, not over documents."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs"))
    ranked = totals.select("*", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).alias("rank"))
    ranked = ranked.select("*", by_rank(WEIGHTS, F.col("rank")).cast("double").alias("weight"))
    cap = F.lit(MAX_EPOCHS) * F.col("source_size")
    w = Window.orderBy((cap / F.col("weight")).asc(), F.col("rank").asc())
    every = Window.partitionBy()
    filled = ranked.select(
        "*", cap.cast("double").alias("cap"),
        F.coalesce(F.sum(cap).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("double").alias("caps_before"),
        F.sum("weight").over(w.rowsBetween(0, Window.unboundedFollowing)).alias("weights_left"),
        (F.sum("source_size").over(every) * F.lit(budget)).alias("total"),
    ).select("*", ((F.col("total") - F.col("caps_before")) / F.col("weights_left")).alias("level"))
    # The first source that is not capped fixes the level of all that follow it.
    level = F.min(F.when(F.col("level") * F.col("weight") < F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "rank", "level"))).over(every)
    return filled.select("source", "rank", "source_size", "source_docs", "cap", "weight", level["level"].alias("level")).select(
        "source", "rank", "source_size", "source_docs",
        F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("level") * F.col("weight"))).alias("target"))


def mix(docs: DataFrame, *, budget: float = BUDGET, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken, position``.

    ``position`` is the training position of its first pass in [0, 1] (null if not taken),
    ``position_2`` that of its second pass."""
    sizes = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    sizes = stage(sizes.select("*", F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long").alias("place")), "mix-sizes")
    sources = stage(source_targets(sizes, budget), "mix-sources").select(F.col("source").alias("s_source"), "rank", "source_size", "source_docs", "target")
    placed = sizes.join(sources, F.col("source").eqNullSafe(F.col("s_source")), "inner").drop("s_source")
    # Slices of the 60-bit hash order; their number follows the source's documents.
    slices = F.ceil(F.col("source_docs") / DOCS_PER_SLICE)
    placed = placed.select("*", F.floor(F.col("place") / F.lit(2.0**60) * slices).alias("slice"))
    per_slice = placed.groupBy("rank", "slice").agg(F.sum("size").alias("words"))
    before = per_slice.select(
        F.col("rank").alias("o_rank"), F.col("slice").alias("o_slice"),
        F.coalesce(F.sum("words").over(Window.partitionBy("rank").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = Window.partitionBy("rank", "slice").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    offset = placed.select("*", F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("inside")).join(
        before, (F.col("rank") == F.col("o_rank")) & (F.col("slice") == F.col("o_slice")), "inner").select(
        "*", (F.col("before") + F.col("inside")).alias("offset"))
    whole = F.floor(F.col("target"))

    def words(start: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("size"), whole - start))

    first, second = F.col("offset"), F.col("offset") + F.col("source_size")
    return offset.select(
        "doc_id", "source", "size", "source_size", "target",
        (words(first) + words(second)).cast("long").alias("taken"),
        F.when(words(first) > 0, position(first, F.col("rank"))).alias("position"),
        F.when(words(second) > 0, position(second, F.col("rank"))).alias("position_2"),
    )


def position(start: Column, rank: Column) -> Column:
    """Training time at which the source's cumulative demand reaches ``start``:
    the root in [0, 1] of ``t + slope * (t - t*t) = share``."""
    share, a = start / F.col("target"), by_rank(SLOPES, rank)
    root = 2 * share / ((1 + a) + F.sqrt((1 + a) * (1 + a) - 4 * a * share))
    return F.least(F.lit(1.0), root)


def training_order(mixed: DataFrame) -> DataFrame:
    """The passes in training order: ``doc_id, source, pass, position``, range-sorted."""
    passes = mixed.select("doc_id", "source", F.posexplode(F.array("position", "position_2")).alias("pass", "position")).where("position IS NOT NULL")
    return passes.orderBy("position", "doc_id", "pass")


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    from tidewrack.llm.common import table

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "position").repartitionByRange(F.col("position").asc_nulls_last(), "doc_id").sortWithinPartitions(F.col("position").asc_nulls_last(), "doc_id")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s0),
s2 AS (SELECT *, [3, 1, 2][(rank % 3 + 1)::INT]::DOUBLE AS weight, 2 * source_size AS cap FROM s1),
s3 AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS caps_before,
              sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights_left,
              sum(source_size) OVER () * 1.5::DOUBLE AS total FROM s2),
s4 AS (SELECT *, (total - caps_before) / weights_left AS level FROM s3),
lv AS (SELECT arg_min(level, (cap / weight) * 1.0) FILTER (WHERE level * weight < cap) AS lvl FROM s4),
t AS (SELECT source, rank, source_size, CASE WHEN lvl IS NULL THEN cap::DOUBLE ELSE least(cap::DOUBLE, lvl * weight) END AS target FROM s4, lv),
o AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.rank,
             coalesce(sum(d.size) OVER (PARTITION BY t.rank ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
w AS (SELECT *, greatest(0, least(size, floor(target)::BIGINT - off)) AS w1, greatest(0, least(size, floor(target)::BIGINT - off - source_size)) AS w2,
             [0.5, 0.0, -0.5][(rank % 3 + 1)::INT]::DOUBLE AS a FROM o)
SELECT doc_id, size, source_size, target, (w1 + w2)::BIGINT AS taken,
       CASE WHEN w1 > 0 THEN least(1.0::DOUBLE, 2 * (off / target) / ((1 + a) + sqrt((1 + a) * (1 + a) - 4 * a * (off / target)))) END AS position
FROM w
"""
