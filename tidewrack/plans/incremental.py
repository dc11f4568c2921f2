"""S3 / S16 / L1 incrementally: a merged feed that is kept up to date page by page.

The feed is cut into *ranges* of ``pages_per_range`` pages. Three tables stand in a folder:

``parts``    by range: the thread partials of the range's own rows. ``_local`` counts the
             heads inside the range; 0 is the *lead*, the rows before its first head, which
             go on a thread of an earlier range.
``merged``   by the range of the head row: the merged posts (M1), with their content id and
             UTC date, null ids for blank ones.
``ranges``   one row for each range with its numbers of rows and heads, and the places of its
             rows in the other two, in versions.

A refresh writes the rows of its ranges to a folder of its own, ``v=N/bundle=B/``: a bundle for
each range if they are few, else up to ``RANGES_PER_BUNDLE`` ranges in one, so that files follow
the rows and not the ranges. Nothing is written over: rows that ``ranges`` no longer points to
are not read, and a folder without others is deleted, one refresh later.

When pages change (new, revised, or gone), ``refresh``

1. reads the pages of their ranges only (newest revisions), and replaces these ``parts``;
2. finds the *closure*: a changed range can change the posts whose heads are in it, and the
   last post of the nearest earlier range with a head. A post of that range reaches on over
   the leads of the ranges that follow, up to and including the next one with a head. All
   of this follows from ``ranges``;
3. reads the partials of the closure only, joins them, and replaces the ``merged`` posts of
   the ranges whose posts can have changed;
4. writes the next version of ``ranges``: the commit. Whatever failed before is done again
   with the same pages, and has changed nothing that is read.

The rows before the first head of all belong to one post, whatever they look like; its head
is the first row of the first range with rows.

Pages are files ``file_key=NNNN[-R]``, or packs of them (``sources.pages``); files without a page number in
their name are not part of the feed. Work follows the number of changed ranges, not the
feed; the one scan over all ranges is over ``ranges``, a row for each. A range is worked on
by one task: choose ``pages_per_range`` so that its rows fit (64 pages by default), and keep
it for the life of the folder.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewrack.functions.text import content_id, is_blank, to_utc_iso
from tidewrack.operators.thread import heads, joined, partials
from tidewrack.plans.corpus import clean_feed, dedupe_posts, filter_feed
from tidewrack.session import stage
from tidewrack.sources import pages as PG
from tidewrack.sources import table_store

PAGES_PER_RANGE = 64
ORDER, EXTRA = ["page", "pos"], ["date"]
RANGES_PER_BUNDLE, BUNDLES = 64, 256  # ranges in a bundle, at most; bundles up to which it holds fewer
RANGES = "`range` long, n_rows long, n_heads long, parts_v long, parts_b long, merged_v long, merged_b long"
PARTS = "_local long, _p struct<page: long, pos: long, _raw: string, _stripped: string, _tail: string, _n: long, date: string>, `range` long"
MERGED = "page long, pos long, date string, text string, n_parts long, id string, date_utc string, `range` long"


def _numbers(spark: SparkSession, values: Iterable[int], name: str = "range") -> DataFrame:
    return spark.createDataFrame(pa.table({name: pa.array(list(values), pa.int64())}))


def _one_of(column: str, values: Iterable[int]) -> Column:
    """``column IN (values)``, read as one expression; a few runs of numbers as such."""
    runs: list[list[int]] = []
    for v in sorted(set(values)):
        if runs and v == runs[-1][1] + 1:
            runs[-1][1] = v
        else:
            runs.append([v, v])
    if not runs:
        return F.lit(False)
    if len(runs) <= 32:
        return F.expr(" OR ".join(f"`{column}` BETWEEN {a} AND {b}" for a, b in runs))
    return F.expr(f"`{column}` IN ({','.join(str(v) for a, b in runs for v in range(a, b + 1))})")


def _places(spark: SparkSession, ranges: list[int]) -> DataFrame:
    """``at, bundle``: the bundles of these ranges, in order."""
    size = min(RANGES_PER_BUNDLE, -(-len(ranges) // BUNDLES)) or 1
    return spark.createDataFrame(pa.table({"at": pa.array(ranges, pa.int64()), "bundle": pa.array([i // size for i in range(len(ranges))], pa.int64())}))


def _replace(rows: DataFrame, ranges: list[int], path: str) -> None:
    """Write the rows of ``ranges`` by bundles; an empty range keeps a row of nulls, so that
    every bundle is there."""
    empty = _numbers(rows.sparkSession, ranges)
    for c, kind in rows.dtypes:
        if c != "range":
            empty = empty.withColumn(c, F.lit(None).cast(kind))
    placed = rows.unionByName(empty).join(F.broadcast(_places(rows.sparkSession, ranges)), F.col("range") == F.col("at")).drop("at")
    placed.repartition("bundle").sortWithinPartitions("bundle", "range").write.partitionBy("bundle").mode("overwrite").parquet(path)


def _read(spark: SparkSession, path: str, schema: str, ranges: list[int] | None) -> DataFrame:
    """The rows of ``ranges`` (None: of all) that ``ranges`` points to: only the bundles that
    hold them are listed."""
    root, name = path.rsplit("/", 1)
    known = read_ranges(spark, root)
    known = known if ranges is None else known.where(_one_of("range", ranges))
    found: dict[int, dict[int, int]] = {}
    for r, v, b in known.select("range", f"{name}_v", f"{name}_b").collect():
        found.setdefault(v, {})[r] = b
    if not found:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/v={v}/bundle={b}" for v, held in found.items() for b in sorted(set(held.values()))]
    rows = spark.read.schema(f"{schema}, v long, bundle long").option("basePath", path).parquet(*folders)
    live = F
    for v, held in found.items():
        live = live.when(F.col("v") == v, _one_of("range", held))
    return rows.where(live).drop("v", "bundle")


def _clear(spark: SparkSession, root: str, *tables: DataFrame) -> None:
    """Delete the folders of ``parts`` and ``merged`` that none of these versions of ``ranges``
    points to."""
    for name in ("parts", "merged"):
        held = {r[0] for t in tables for r in t.select(f"{name}_v").distinct().collect()}
        for v in table_store.versions(spark, f"{root}/{name}", committed=False):
            if v not in held:
                fs, p, _ = table_store._fs(spark, f"{root}/{name}/v={v}")
                fs.delete(p, True)


def read_ranges(spark: SparkSession, root: str) -> DataFrame:
    return table_store.read(spark, f"{root}/ranges", RANGES)


def page_files(spark: SparkSession, pages_dir: str, ranges: list[int], pages_per_range: int) -> DataFrame:
    """The pages of these ranges in all revisions. The filter is on the folder names, so
    other pages (of packs: other packs) are not opened."""
    pages, number = PG.read_pages(spark, pages_dir), PG.page_revision()[0]
    size = PG.pack_size(spark, pages_dir)
    if size:
        pages = pages.where(_one_of("pack", sorted({p // size for r in ranges for p in range(r * pages_per_range, (r + 1) * pages_per_range)})))
    return pages.withColumn("_range", F.floor(number / pages_per_range)).where(_one_of("_range", ranges)).drop("_range")


def range_parts(spark: SparkSession, pages_dir: str, ranges: list[int], pages_per_range: int) -> DataFrame:
    """Partials of the kept rows of these ranges (columns of ``PARTS``)."""
    pages = PG.newest_revisions(page_files(spark, pages_dir, ranges, pages_per_range))
    items = PG.page_items(pages).select(*ORDER, *EXTRA, "text")
    kept = heads(filter_feed(clean_feed(items))).withColumn("range", F.floor(F.col("page") / pages_per_range))
    inside = Window.partitionBy("range").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    return partials(kept.withColumn("_local", F.sum("_head").over(inside)), ["range", "_local"], ORDER, "text", EXTRA)


def with_leads(ranges: DataFrame) -> DataFrame:
    """Adds ``lead_range, lead_local``: the thread that the range's lead goes on. One window
    over a row for each range."""
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    some = F.struct("range", F.col("n_heads").alias("local"))
    first = ranges.where("n_rows > 0").agg(F.min("range")).scalar()
    last = F.last(F.when(F.col("n_heads") > 0, some), ignorenulls=True).over(before)
    return ranges.where("n_rows > 0").withColumn("_last", last).select(
        "range", "n_heads", F.coalesce("_last.range", first).alias("lead_range"), F.coalesce("_last.local", F.lit(0)).alias("lead_local"))


def closure(old: DataFrame, new: DataFrame, changed: list[int]) -> tuple[list[int], list[int]]:
    """``(owners, read)``: the ranges whose posts can have changed, and those whose partials
    make these posts up. Both follow the changed ranges (and headless runs next to them)."""
    leads = stage(with_leads(new), "range-leads")
    first = [r[0] for t in (old, new) if (r := t.where("n_rows > 0").agg(F.min("range")).first())[0] is not None]
    # The nearest range with a head before each changed one, whether that has rows or not:
    # the last head in one order of heads and points, a point before the head of its range.
    spark = new.sparkSession
    at = leads.where("n_heads > 0").select(F.col("range").alias("at"), F.lit(1).alias("kind"), "range")
    at = at.unionByName(_numbers(spark, changed, "at").select("at", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("range")))
    near = at.withColumn("r", F.last("range", ignorenulls=True).over(Window.orderBy("at", "kind"))).where("kind = 0 AND r IS NOT NULL").select("r").distinct()
    owners = sorted({*changed, *first, *(x.r for x in near.collect())})
    own = F.broadcast(_numbers(spark, owners, "own"))
    follow = leads.join(own, F.col("lead_range") == F.col("own"), "left_semi").select("range").collect()
    return owners, sorted({*owners, *(r["range"] for r in follow)})


def refresh(spark: SparkSession, pages_dir: str, root: str, changed_pages: Iterable[int], pages_per_range: int = PAGES_PER_RANGE) -> DataFrame:
    """Bring the merged feed up to date with these pages. Returns the posts that went and
    came: ``op`` (-1, 1), ``id, date, raw_text, page, pos``."""
    changed = sorted({int(p) // pages_per_range for p in changed_pages})
    old = stage(read_ranges(spark, root), "ranges-before")
    if not changed:
        return _posts(spark.createDataFrame([], MERGED)).select(F.lit(1).alias("op"), "*")
    numbers = F.broadcast(_numbers(spark, changed))
    version = max([0, *table_store.versions(spark, f"{root}/ranges", committed=False)]) + 1
    # Staged: written, counted and merged; the closure's other ranges are read from the table.
    mine = stage(range_parts(spark, pages_dir, changed, pages_per_range), "range-parts")
    _replace(mine, changed, f"{root}/parts/v={version}")
    fresh = mine.groupBy("range").agg(F.sum("_p._n").alias("n_rows"), F.max("_local").alias("n_heads"))
    fresh = numbers.join(fresh, "range", "left").select("range", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_rows", "n_heads")))
    places = _places(spark, changed).select(F.col("at").alias("range"), F.lit(version).cast("long").alias("parts_v"), F.col("bundle").alias("parts_b"))
    fresh = fresh.join(F.broadcast(places), "range")
    new = stage(old.join(numbers, "range", "left_anti").unionByName(fresh, allowMissingColumns=True), "ranges-after")
    owners, read = closure(old, new, changed)
    leads = with_leads(new).select(F.col("range").alias("l_range"), "lead_range", "lead_local")
    parts = mine.unionByName(_read(spark, f"{root}/parts", PARTS, sorted(set(read) - set(changed))))
    parts = parts.where("_local IS NOT NULL").join(leads, F.col("range") == F.col("l_range"))
    lead = F.col("_local") == 0
    parts = parts.select(F.when(lead, F.col("lead_range")).otherwise(F.col("range")).alias("t_range"), F.when(lead, F.col("lead_local")).otherwise(F.col("_local")).alias("t_local"), "_p")
    own = _numbers(spark, owners)
    posts = joined(parts.join(F.broadcast(own), F.col("t_range") == own["range"], "left_semi"), ["t_range", "t_local"], ORDER, "text", EXTRA)
    blank = is_blank("text")
    posts = stage(posts.select(*ORDER, "date", "text", "n_parts", F.when(~blank, content_id("date", "text")).alias("id"), F.when(~blank, to_utc_iso("date")).alias("date_utc"), F.col("t_range").alias("range")), "merged-new")
    # A range that no refresh has committed has no posts to give back.
    had = sorted(r["range"] for r in old.join(F.broadcast(own), "range", "left_semi").collect())
    before = stage(_posts(_read(spark, f"{root}/merged", MERGED, had)), "merged-old")
    _replace(posts, owners, f"{root}/merged/v={version}")
    merged = new.join(F.broadcast(_places(spark, owners)), F.col("range") == F.col("at"), "left")
    owned = F.col("at").isNotNull()
    merged = merged.withColumn("merged_v", F.when(owned, version).otherwise(F.col("merged_v"))).withColumn("merged_b", F.when(owned, F.col("bundle")).otherwise(F.col("merged_b")))
    table_store.write(merged.select(*old.columns), f"{root}/ranges")
    _clear(spark, root, old, read_ranges(spark, root))
    sides = before.select(F.lit(-1).alias("op"), "*").unionByName(_posts(posts).select(F.lit(1).alias("op"), "*"))
    columns = ["id", "date", "raw_text", "page", "pos"]
    return sides.groupBy(*columns).agg(F.sum("op").cast("int").alias("op")).where("op <> 0").select("op", *columns)


def _posts(merged: DataFrame) -> DataFrame:
    return merged.where("id IS NOT NULL").select("id", F.col("date_utc").alias("date"), F.col("text").alias("raw_text"), *ORDER)


def merged_feed(spark: SparkSession, root: str) -> DataFrame:
    """The merged posts (M1): ``page, pos, date, text, n_parts``."""
    return _read(spark, f"{root}/merged", MERGED, None).where("page IS NOT NULL").select(*ORDER, "date", "text", "n_parts")


def posts(spark: SparkSession, root: str) -> DataFrame:
    """L1 without its sort: ``id, date, raw_text, page, pos`` of the merged feed (M2)."""
    return dedupe_posts(_posts(_read(spark, f"{root}/merged", MERGED, None)))


def start_merge(spark: SparkSession, pages_dir: str, root: str, checkpoint_location: str, max_files_per_trigger: int | None = None,
                pages_per_range: int = PAGES_PER_RANGE, available_now: bool = True) -> StreamingQuery:
    """S16 with M1 in the stream: every micro-batch of new page files refreshes the merged
    feed. A batch that is retried replaces its own output; the order and size of batches
    make no difference to the result, and a page may be revised any number of times."""
    names = PG.stream_names(spark, pages_dir, max_files_per_trigger).select(PG.page_revision()[0].alias("page"))

    def merge(batch: DataFrame, _: int) -> None:
        # A row for each changed range: bounded by the files of a trigger.
        changed = batch.where("page IS NOT NULL").select(F.floor(F.col("page") / pages_per_range).alias("r")).distinct().collect()
        refresh(batch.sparkSession, pages_dir, root, [x.r * pages_per_range for x in changed], pages_per_range)

    writer = names.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint_location)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")).start()
