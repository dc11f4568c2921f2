"""L1: feed -> posts, plus the per-stage row funnel (M6).

Order of work, as the original cleaner runs it:
drop null text -> collapse whitespace (P1) -> fold punctuation (P2) -> drop media,
bare reposts and bare links (P4-P6) -> thread merge (M1) -> drop blank posts (P3) ->
content id on the raw offset date (P8) and UTC date (P7) -> dedupe by id (M2) ->
sort by date, ties in feed order (M3).

The cleaned feed is staged once, range-blocked, by the thread merge while the plan is
built; all before and all after it is lazy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.functions.text import clean_feed_text, content_id, is_blank, keep_feed_text, to_utc_iso
from tidewrack.operators.once import materialise_once
from tidewrack.operators.thread import thread_merge


def clean_feed(feed: DataFrame) -> DataFrame:
    """P3 (null) -> P1 -> P2, the cleaning chain evaluated once per row."""
    rows = feed.where(F.col("text").isNotNull())
    return materialise_once(rows, "text", clean_feed_text("text"))


def filter_feed(cleaned: DataFrame) -> DataFrame:
    """Keep rows that are not media, bare reposts or bare links."""
    return cleaned.where(keep_feed_text("text"))


def keyed_posts(merged: DataFrame) -> DataFrame:
    """P3 (blank) -> P8 / P7 on merged posts; keeps the head position for ordering."""
    return merged.where(~is_blank("text")).select(
        content_id("date", "text").alias("id"),
        to_utc_iso("date").alias("date"),
        F.col("text").alias("raw_text"),
        F.col("page"),
        F.col("pos"),
    )


def dedupe_posts(posts: DataFrame) -> DataFrame:
    """M2: one row per id. Equal ids hash equal (date, text), so rows are equal; the
    first feed position is kept for a stable date sort. Partial aggregation runs
    map-side, so a heavily copied post is combined before the shuffle."""
    first = F.min(F.struct("page", "pos", "date", "raw_text")).alias("_r")
    return posts.groupBy("id").agg(first).select(
        "id", F.col("_r.date").alias("date"), F.col("_r.raw_text").alias("raw_text"),
        F.col("_r.page").alias("page"), F.col("_r.pos").alias("pos"),
    )


def sort_posts(posts: DataFrame) -> DataFrame:
    """M3: by date; ties keep feed order (range-partitioned sort, no single partition)."""
    return posts.orderBy("date", "page", "pos")


def feed_to_posts(feed: DataFrame, num_blocks: int | None = None,
                  keep_position: bool = False, sort: bool = True) -> DataFrame:
    """L1. ``sort=False`` leaves out the final date sort (M3) when the posts only feed
    other operators (joins, aggregates), where a global sort would be wasted work."""
    merged = thread_merge(filter_feed(clean_feed(feed)), carry=("date",), num_blocks=num_blocks)
    posts = dedupe_posts(keyed_posts(merged))
    posts = sort_posts(posts) if sort else posts
    return posts if keep_position else posts.select("id", "date", "raw_text")


def feed_to_posts_observed(feed: DataFrame, num_blocks: int | None = None):
    """L1 with the M6 funnel collected while it runs (``DataFrame.observe``): returns
    (posts, observations). Each observation's ``.get`` holds ``{"rows": n}`` once the
    posts have been written; no extra job counts the stages."""
    from pyspark.sql import Observation

    obs = {k: Observation(f"funnel_{k}") for k in ("feed", "with_text", "kept", "merged", "non_blank")}
    count = F.count(F.lit(1)).alias("rows")
    feed = feed.observe(obs["feed"], count)
    cleaned = clean_feed(feed).observe(obs["with_text"], count)
    kept = filter_feed(cleaned).observe(obs["kept"], count)
    merged = thread_merge(kept, carry=("date",), num_blocks=num_blocks).observe(obs["merged"], count)
    keyed = keyed_posts(merged).observe(obs["non_blank"], count)
    return dedupe_posts(keyed).select("id", "date", "raw_text"), obs


def funnel(feed: DataFrame, num_blocks: int | None = None) -> DataFrame:
    """M6: rows per stage of L1, as one small table (stage, seq, rows). The cleaned feed and
    the merged posts are staged, so the chain runs once; the counts scan what is staged."""
    from tidewrack.session import stage

    cleaned = stage(clean_feed(feed).withColumn("_keep", keep_feed_text("text")), "cleaned")
    kept = cleaned.where("_keep").drop("_keep")
    merged = stage(thread_merge(kept, carry=("date",), num_blocks=num_blocks), "merged")
    keyed = keyed_posts(merged)
    stages = [
        ("feed", feed), ("with_text", cleaned), ("kept", kept), ("merged", merged),
        ("non_blank", keyed), ("distinct_ids", keyed.select("id").distinct()),
    ]
    parts = [
        df.agg(F.count(F.lit(1)).cast("long").alias("rows")).select(
            F.lit(name).alias("stage"), F.lit(i).cast("long").alias("seq"), "rows")
        for i, (name, df) in enumerate(stages)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def refresh_posts_table(spark, pages_dir: str, table_root: str, total_pages: int | None = None, validation: str = "failfast", quarantine_dir: str | None = None) -> int:
    """The whole feed job without the HTTP fetch: validate the newest revision of every
    page (S4), scan (S1, completeness checked), build posts (L1), replace the table content
    (S5) as a new version. Returns the version written.

    ``validation``: ``failfast`` raises on any invalid page, as the original does;
    ``quarantine`` writes the invalid pages' items to ``quarantine_dir`` and goes on without
    these pages (and without the completeness check); ``off`` reads as is."""
    from tidewrack.operators.table import full_refresh
    from tidewrack.session import stage
    from tidewrack.sources import pages as PG
    from tidewrack.sources import table_store

    if validation != "off":
        raw = PG.newest_revisions(PG.read_documents(spark, pages_dir))
        checked = stage(PG.validate_items(raw).select("page", "pos", "item", "missing", "wrong", "valid", "page_valid"), "validated")
    if validation == "failfast":
        PG.failfast(checked)
    if validation == "quarantine":
        _, bad = PG.quarantine(checked)
        bad.write.mode("overwrite").json(quarantine_dir)
        pages = PG.newest_revisions(PG.read_pages(spark, pages_dir, "PERMISSIVE")).where("meta.page IS NOT NULL")
        bad_pages = bad.select(F.col("page").alias("bad_page")).distinct()
        items = PG.page_items(pages).join(bad_pages, F.col("page") == F.col("bad_page"), "left_anti")
    else:
        items = PG.scan_pages(spark, pages_dir, total_pages)
    feed = items.select("page", "pos", "date", "platform", "deleted_flag", "text")
    table_store.create_if_absent(spark, table_root)
    return table_store.write(full_refresh(feed_to_posts(feed, sort=True)), table_root)
