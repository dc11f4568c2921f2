"""Posts-table operators (S5-S10, S12), as DataFrame -> DataFrame transformations.

The posts table is ``id STRING (key), date STRING NOT NULL, raw_text STRING NOT NULL,
clean_text STRING``. Each operator returns the table's new content; writing it is the
job of ``sources.table_store`` (versioned folders, so a job never overwrites the data
it is still reading).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewrack.operators.joins import small_side
from tidewrack.operators.order import global_row_number

POSTS_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("date", T.StringType(), False),
    T.StructField("raw_text", T.StringType(), False),
    T.StructField("clean_text", T.StringType(), True),
])
POSTS_COLUMNS = [f.name for f in POSTS_SCHEMA.fields]


def full_refresh(posts: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """The table becomes exactly ``posts`` (id, date, raw_text); clean_text is lost
    as in the original refresh, unless ``previous`` is given to carry it over by id."""
    fresh = posts.select("id", "date", "raw_text")
    if previous is None:
        return fresh.withColumn("clean_text", F.lit(None).cast("string"))
    kept = previous.select("id", F.col("clean_text").alias("_prev"))
    return fresh.join(kept, "id", "left").withColumnRenamed("_prev", "clean_text").select(*POSTS_COLUMNS)


def constraint_violations(table: DataFrame) -> DataFrame:
    """Primary-key and NOT NULL checks as one aggregate row."""
    per_id = table.groupBy("id").agg(F.count(F.lit(1)).alias("_n"))
    dup = per_id.agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0)).cast("long")).scalar()
    return table.agg(
        F.count(F.lit(1)).cast("long").alias("rows"),
        F.count_if(F.col("id").isNull()).cast("long").alias("null_ids"),
        F.count_if(F.col("date").isNull()).cast("long").alias("null_dates"),
        F.count_if(F.col("raw_text").isNull()).cast("long").alias("null_raw_texts"),
    ).withColumn("duplicate_ids", dup)


def ordered_scan(table: DataFrame) -> DataFrame:
    """All columns and ``seq``, the 1-based place by date; ties by id (the original
    leaves them unspecified). A written table keeps the order only as a column."""
    return global_row_number(table, ["date", "id"], "seq")


def corpus_texts(table: DataFrame, column: str = "raw_text") -> DataFrame:
    """The training corpus, one text per row (raw text by default), with ``seq``."""
    return ordered_scan(table.select("date", "id", column)).select(column, "seq")


def probe_raw_text(table: DataFrame, probes: DataFrame, column: str = "raw_text") -> DataFrame:
    """S8 in bulk: ``probes`` rows with ``exists`` = some table row has this raw text.

    Both sides meet on the 32-byte digest of the text, so neither a broadcast nor a shuffle
    moves whole texts twice. Digests of the probes are distinct (combined map-side), and
    they are broadcast only if their bytes have been checked."""
    probes = probes.withColumn("_h", F.unhex(F.sha2(F.col(column), 256)))
    keys = small_side(probes.select(F.col("_h").alias("_k")).distinct(), row_bytes=64)
    texts = table.select(F.unhex(F.sha2(F.col("raw_text"), 256)).alias("_k"))
    hits = texts.join(keys, "_k", "left_semi").distinct().withColumn("exists", F.lit(True))
    out = probes.join(hits, probes["_h"] == hits["_k"], "left").drop("_k", "_h")
    return out.withColumn("exists", F.coalesce(F.col("exists"), F.lit(False)))


def insert_or_ignore(target: DataFrame, batch: DataFrame, order: str = "ord") -> DataFrame:
    """INSERT OR IGNORE. The first batch row per id wins inside the batch, and ids
    already in the target are ignored. Partial aggregation runs map-side."""
    first = batch.groupBy("id").agg(F.min(F.struct(order, "date", "raw_text", "clean_text")).alias("_r"))
    first = first.select("id", "_r.date", "_r.raw_text", "_r.clean_text")
    new = first.join(target.select("id"), "id", "left_anti")
    return target.select(*POSTS_COLUMNS).unionByName(new.select(*POSTS_COLUMNS))


def update_clean_text(target: DataFrame, updates: DataFrame, order: str = "seq") -> DataFrame:
    """UPDATE posts SET clean_text = ? WHERE id = ?, for a batch of updates.

    Unknown ids are ignored; the later update per id wins; a null value overwrites
    (so this is a matched/unmatched choice, not a coalesce)."""
    last = updates.groupBy("id").agg(F.max(F.struct(order, "clean_text")).alias("_u"))
    last = last.select("id", F.lit(True).alias("_hit"), F.col("_u.clean_text").alias("_new"))
    joined = target.join(last, "id", "left")
    return joined.select(
        "id", "date", "raw_text",
        F.when(F.col("_hit"), F.col("_new")).otherwise(F.col("clean_text")).alias("clean_text"),
    )


def needs_normalising(table: DataFrame, force: bool = False) -> DataFrame:
    """Rows the normaliser still has to do. Written as two comparisons, not a
    coalesce, so that the predicate reaches the parquet scan."""
    if force:
        return table
    return table.where(F.col("clean_text").isNull() | (F.col("clean_text") == ""))
