"""Incremental page ingest with Structured Streaming.

New page files (``file_key=NNNN/...``, or ``NNNN-R`` for a refreshed page; or packs of many
pages, ``sources.pages``) are picked up by the file source; each micro-batch runs the stateless part of the feed cleaner (P1, P2,
and the P4-P6 keep flag) and lands its rows, those without a text included.

Landing is append-only and idempotent: micro-batch ``b`` writes ``batch=<b>/`` with
overwrite, so a batch retried after a failure replaces its own output (exactly-once
with the checkpointed source offsets). Readers take, per page, the newest (revision,
batch) and only then drop rows without a text (P3): a refreshed page replaces all the rows
it had before, also items that it nulls or no longer holds.

The thread merge (M1) and everything after it run in batch over the landed table
(``landed_posts``), because a continuation can arrive a micro-batch after its head.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewrack.functions.text import clean_feed_text, keep_feed_text
from tidewrack.operators.thread import thread_merge
from tidewrack.plans.corpus import dedupe_posts, keyed_posts
from tidewrack.sources.pages import page_revision, stream_pages

LANDED_COLUMNS = ("item_id", "page", "pos", "date", "platform", "deleted_flag", "text", "keep")


def clean_items(pages: DataFrame) -> DataFrame:
    """Stateless per-row cleaning of pages: ``LANDED_COLUMNS`` and ``revision``. A page
    without items is one row without an item."""
    _, revision = page_revision()
    rows = pages.select(F.col("meta.page").alias("page"), revision.alias("revision"), F.posexplode_outer("data").alias("pos", "item"))
    rows = rows.select(F.col("item.id").alias("item_id"), "page", F.col("pos").cast("long").alias("pos"), "item.date", "item.platform", "item.deleted_flag",
                       F.explode(F.array(clean_feed_text("item.text"))).alias("text"), "revision")
    return rows.withColumn("keep", F.coalesce(keep_feed_text("text"), F.lit(False)))


def start_ingest(spark: SparkSession, pages_dir: str, landed_dir: str, checkpoint_location: str,
                 max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    pages = stream_pages(spark, pages_dir, max_files_per_trigger)
    cleaned = clean_items(pages)

    def land(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch", F.lit(batch_id).cast("long")).write
         .option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("batch").parquet(landed_dir))

    writer = cleaned.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def read_landed(spark: SparkSession, landed_dir: str) -> DataFrame:
    """The rows with a text of every page's newest (revision, batch)."""
    landed = spark.read.parquet(landed_dir)
    newest = landed.groupBy(F.col("page").alias("_page")).agg(F.max(F.struct("revision", "batch")).alias("_newest"))
    rows = landed.join(newest, F.col("page") == F.col("_page")).where(F.struct("revision", "batch") == F.col("_newest"))
    return rows.where(F.col("text").isNotNull()).select(*LANDED_COLUMNS)


def landed_posts(landed: DataFrame) -> DataFrame:
    """The batch part of L1 over landed rows: merge, key, dedupe (with position)."""
    merged = thread_merge(landed.where("keep"), carry=("date",))
    return dedupe_posts(keyed_posts(merged))
