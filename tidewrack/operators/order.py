"""Global order without a one-partition window over the data.

Several operators need a position in one global order: the thread merge (a running
count of thread heads), the positional split, paging a sorted table, ranking a
vocabulary. ``row_number() OVER (ORDER BY ...)`` would pull every row into one task.

Instead the data is cut into contiguous *range blocks*:

1. ``repartitionByRange`` over the full order key (so a hot page, or any hot prefix, is
   split across blocks) deals the rows out; Spark samples the keys on the executors.
2. The sorted partitions are written once to the shared checkpoint folder with their
   partition number as a column ``_blk``. The number is then a fact of the file: it does
   not change when a task is run again or the table is read in other splits.
3. A per-block summary (row count and any additive columns) has one row per block; its
   prefix sum is a window over these rows, and that table is joined back.
4. Inside a block, a window partitioned by the block gives the local position or
   running sum; global value = block offset + local value.

The number of blocks is ``spark.sql.shuffle.partitions`` unless it is given. Order keys
must be unique for a well-defined numbering (all callers use unique keys).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.session import stage

Order = Sequence[str | tuple[str, bool]]  # column name, or (column name, ascending)


def _spec(order: Order) -> list[tuple[str, bool]]:
    return [(o, True) if isinstance(o, str) else (o[0], bool(o[1])) for o in order]


def _sort_cols(spec) -> list[Column]:
    return [F.col(c).asc() if asc else F.col(c).desc() for c, asc in spec]


def range_blocks(df: DataFrame, order: Order, num_blocks: int | None = None) -> DataFrame:
    """Add ``_blk``: contiguous ranges of the global order, about equal in size."""
    n = num_blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = _sort_cols(_spec(order))
    # Staged first: the key sampling would otherwise run the work behind ``df`` once more.
    dealt = stage(df, "range-input").repartitionByRange(max(1, int(n)), *keys).sortWithinPartitions(*keys)
    return stage(dealt.withColumn("_blk", F.spark_partition_id()), "blocks")


def block_offsets(blocked: DataFrame, sums: Sequence[str] = ()) -> DataFrame:
    """Exclusive prefix sums per block: ``_off_n`` rows before the block, and
    ``_off_<c>`` for every additive column ``c``. One row per block."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.sum(F.col(c)).alias(f"_s_{c}") for c in sums]
    summary = blocked.groupBy("_blk").agg(*aggs)
    before = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.col("_blk"), F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long").alias("_off_n")]
    cols += [F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).cast("long").alias(f"_off_{c}") for c in sums]
    return summary.select(*cols)


def with_global_offsets(blocked: DataFrame, sums: Sequence[str] = ()) -> DataFrame:
    """Join the offset table back: one row per block, a configured number."""
    return blocked.join(F.broadcast(block_offsets(blocked, sums)), "_blk")


def global_row_number(df: DataFrame, order: Order, name: str = "rn", num_blocks: int | None = None) -> DataFrame:
    """1-based row number in a global order, computed without a global window."""
    spec = _spec(order)
    blocked = with_global_offsets(range_blocks(df, spec, num_blocks))
    inside = Window.partitionBy("_blk").orderBy(*_sort_cols(spec))
    return blocked.withColumn(name, F.col("_off_n") + F.row_number().over(inside)).drop("_blk", "_off_n")


def global_running_sum(df: DataFrame, order: Order, value: str, name: str,
                       num_blocks: int | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` in a global order. Keeps ``_blk`` so callers
    can group by block afterwards."""
    spec = _spec(order)
    blocked = with_global_offsets(range_blocks(df, spec, num_blocks), [value])
    inside = Window.partitionBy("_blk").orderBy(*_sort_cols(spec)).rowsBetween(Window.unboundedPreceding, 0)
    return blocked.withColumn(name, F.col(f"_off_{value}") + F.sum(value).over(inside)).drop("_off_n", f"_off_{value}")
