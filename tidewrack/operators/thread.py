"""M1: thread merge in feed order.

Sequential definition: walk the (cleaned, filtered) feed in order; a text starting with
``...`` is appended to the last kept post as ``" " + text-without-leading-dots``;
otherwise it starts a new post. The very first row always starts a post, dots and all.

Spark form (gaps and islands, no one-partition window over the feed):

* ``island`` = global running count of heads (rows not starting with ``...``), from
  ``order.global_running_sum``. Rows before the first head share island 0, whose first
  row is the global first row - exactly the "first row always starts a post" rule.
* Pre-aggregation inside range blocks: the rows are already hash-partitioned by block
  for the running sum, so grouping by (island, block) needs no new shuffle. Each group
  becomes one partial: its first row (raw and stripped text, head columns) and the
  already joined tail `` piece piece ...``.
* ``groupBy(island)`` then only moves partials: a thread spanning many blocks arrives
  as at most one string per block (bounded by the block count), not as one row per
  feed item. The first partial keeps its first text raw; later ones use the stripped one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.functions.text import WS
from tidewrack.operators.order import global_running_sum


def _strip_dots(c):
    return F.regexp_replace(c, f"^\\.+[{WS}]*", "")


def heads(feed: DataFrame, text: str = "text") -> DataFrame:
    """The feed with ``_head``: 1 where a row starts a post, 0 where it goes on."""
    return feed.withColumn("_head", F.when(F.col(text).startswith("..."), 0).otherwise(1))


def partials(rows: DataFrame, by: Sequence[str], order: Sequence[str], text: str, extra: Sequence[str]) -> DataFrame:
    """``by`` and ``_p``: the rows of each group, in order, as one partial of a thread: its
    first row (raw and stripped text, head columns) and the joined tail."""
    # Sorting the structs orders the rows by the feed order (the leading fields).
    row = F.struct(*[F.col(c) for c in order], F.col(text).alias("_t"), *[F.col(c) for c in extra])
    grouped = rows.groupBy(*by).agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    first = F.col("_rows")[0]
    tail = F.array_join(F.transform(F.slice("_rows", 2, F.size("_rows")),
                                    lambda x: F.concat(F.lit(" "), _strip_dots(x["_t"]))), "")
    return grouped.select(
        *by,
        F.struct(*[first[c].alias(c) for c in order], first["_t"].alias("_raw"),
                 _strip_dots(first["_t"]).alias("_stripped"), tail.alias("_tail"),
                 F.size("_rows").cast("long").alias("_n"), *[first[c].alias(c) for c in extra]).alias("_p"),
    )


def joined(parts: DataFrame, by: Sequence[str], order: Sequence[str], text: str, extra: Sequence[str]) -> DataFrame:
    """One row for each thread ``by`` of partials: ``by``, head columns, ``text``, ``n_parts``."""
    merged = parts.groupBy(*by).agg(F.array_sort(F.collect_list("_p")).alias("_ps"))
    head = F.col("_ps")[0]
    later = F.array_join(F.transform(F.slice("_ps", 2, F.size("_ps")),
                                     lambda x: F.concat(F.lit(" "), x["_stripped"], x["_tail"])), "")
    return merged.select(
        *by,
        *[head[c].alias(c) for c in [*order, *extra]],
        F.concat(head["_raw"], head["_tail"], later).alias(text),
        F.aggregate("_ps", F.lit(0).cast("long"), lambda acc, x: acc + x["_n"]).alias("n_parts"),
    )


def thread_merge(feed: DataFrame, order: Sequence[str] = ("page", "pos"), text: str = "text",
                 carry: Sequence[str] = ("date",), num_blocks: int | None = None) -> DataFrame:
    """Returns one row per merged post: ``order`` columns and ``carry`` columns of the
    head row, the merged ``text`` and ``n_parts`` (rows merged)."""
    order = list(order)
    numbered = global_running_sum(heads(feed, text), order, "_head", "_island", num_blocks)
    extra = [c for c in dict.fromkeys(carry) if c not in order]
    parts = partials(numbered, ["_island", "_blk"], order, text, extra)
    return joined(parts, ["_island"], order, text, extra).drop("_island")
