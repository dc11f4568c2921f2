"""S6, S9 and S10 on a posts table whose writes touch only the rows' own buckets.

The table is a parquet folder partitioned by ``of=N/bucket=B`` with ``B = hash(id) mod N``
(Spark's own partition discovery and dynamic overwrite; N is chosen when the table is
created). A batch of inserts or updates

1. is reduced to one row for each id, with its bucket;
2. reads the buckets that it touches (partition pruning), and makes their new rows;
3. checks the table's constraints on them (S6: ids present and unique, dates and texts
   present): a violation raises and nothing is written. An id lives in one bucket, so checks
   on the touched buckets are checks on the whole table;
4. replaces these buckets in one write job, whose files become visible when it commits. A
   job that fails earlier leaves the table as it was.

Work follows the touched buckets: an update of one id reads and writes 1/N of the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.operators import table as TB
from tidewrack.session import stage
from tidewrack.sources.table_store import _fs

BUCKETS = 64


class ConstraintError(ValueError):
    """A write would break the table's key or NOT NULL constraints."""


def bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")


def bucket_count(spark: SparkSession, root: str) -> int | None:
    """N of the table in this folder; None: there is none."""
    fs, p, _ = _fs(spark, root)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    found = [int(n[3:]) for n in names if n.startswith("of=")]
    return found[0] if found else None


def read(spark: SparkSession, root: str, buckets: list[int] | None = None) -> DataFrame:
    """The table, or these buckets of it."""
    if bucket_count(spark, root) is None:
        return spark.createDataFrame([], TB.POSTS_SCHEMA)
    rows = spark.read.schema("id string, date string, raw_text string, clean_text string, of int, bucket int").parquet(root)
    return (rows if buckets is None else rows.where(F.col("bucket").isin(buckets))).select(*TB.POSTS_COLUMNS)


def checked(rows: DataFrame) -> DataFrame:
    """The rows, staged; raises if they break a constraint."""
    rows = stage(rows.select(*TB.POSTS_COLUMNS), "bucket-rows")
    found = TB.constraint_violations(rows).first().asDict()
    broken = {k: v for k, v in found.items() if k != "rows" and v}
    if broken:
        raise ConstraintError(f"constraints broken: {broken}")
    return rows


def _write(rows: DataFrame, root: str, buckets: int, mode: str) -> None:
    placed = rows.withColumn("of", F.lit(buckets)).withColumn("bucket", bucket(buckets))
    placed.repartition("bucket").write.option("partitionOverwriteMode", mode).partitionBy("of", "bucket").mode("overwrite").parquet(root)


def create(posts: DataFrame, root: str, buckets: int = BUCKETS) -> None:
    """The table becomes exactly these rows."""
    _write(checked(posts), root, buckets, "static")


def change(spark: SparkSession, root: str, batch: DataFrame, make: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
    """Replace the buckets that the batch's ids fall in by ``make(their rows, batch)``.
    Returns the buckets (at most N numbers). An empty table takes ``BUCKETS`` of them."""
    n = bucket_count(spark, root) or BUCKETS
    batch = stage(batch, "bucket-batch")
    touched = sorted(r[0] for r in batch.where("id IS NOT NULL").select(bucket(n)).distinct().collect())
    if batch.where("id IS NULL").limit(1).count():
        raise ConstraintError("constraints broken: a row without an id")
    if touched:
        _write(checked(make(read(spark, root, touched), batch)), root, n, "dynamic")
    return touched


def insert_or_ignore(spark: SparkSession, root: str, batch: DataFrame, order: str = "ord") -> list[int]:
    """Rows of new ids come in (the first of each by ``order``), others are ignored."""
    first = batch.groupBy("id").agg(F.min(F.struct(order, "date", "raw_text", "clean_text")).alias("_r")).select("id", "_r.*")
    return change(spark, root, first, lambda rows, new: TB.insert_or_ignore(rows, new, order))


def update_clean_text(spark: SparkSession, root: str, updates: DataFrame, order: str = "seq") -> list[int]:
    """The last clean text of each id, null included; unknown ids are ignored."""
    last = updates.groupBy("id").agg(F.max(F.struct(order, "clean_text")).alias("_r")).select("id", "_r.*")
    return change(spark, root, last, lambda rows, new: TB.update_clean_text(rows, new, order))
