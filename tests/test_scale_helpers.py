"""Join helpers, versioned L2 job, streaming refresh of a page."""

from pyspark.sql import functions as F

from tidewrack.operators.joins import salted_join, small_side
from tidewrack.session import scratch_path
from tidewrack.sources import pages as PG
from tidewrack.sources import table_store as TS
from tidewrack.streaming import ingest as ST


def test_salted_join_equals_plain_join(spark):
    big = spark.range(0, 3000).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50)).alias("k"), "id")
    dim = spark.range(0, 60).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    a = sorted(tuple(r) for r in salted_join(big, dim, "k", 8, "id", "left").select("k", "id", "v").collect())
    b = sorted(tuple(r) for r in big.join(dim, "k", "left").select("k", "id", "v").collect())
    assert a == b


def test_small_side_checks_size(spark):
    small = spark.range(0, 10)
    big = spark.range(0, 100)
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(small_side(small, 10 * 64, row_bytes=64)) and not hinted(small_side(big, 10 * 64, row_bytes=64))
    texts = spark.createDataFrame([("x" * 1000,), (None,)], "t string")
    assert hinted(small_side(texts, 1064)) and not hinted(small_side(texts, 1063))


def test_aborted_write_does_not_block_the_table(spark):
    root = scratch_path(spark, "aborted")
    df = spark.createDataFrame([("a", "d", "r", None)], TS.POSTS_SCHEMA)
    assert TS.write(df, root) == 1
    spark.range(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/v=00000002")
    assert TS.versions(spark, root) == [1] and TS.write(df, root) == 3
    assert TS.read(spark, root).count() == 1


def test_normalise_table_writes_next_version(spark):
    from tidewrack.plans.training import normalise_table
    root = scratch_path(spark, "l2")
    TS.create_if_absent(spark, root)
    rows = [("a", "d", "See http://x.co/1", None), ("b", "d", "done", "kept"), ("c", "d", "  ", "")]
    TS.write(spark.createDataFrame(rows, "id string, date string, raw_text string, clean_text string"), root)
    v = normalise_table(spark, root)
    got = {r.id: r.clean_text for r in TS.read(spark, root).collect()}
    assert v == 3 and got == {"a": "See.", "b": "kept", "c": ""}


def _page(spark, page, texts):
    feed = spark.createDataFrame([(page - 1, i, "2024-01-01T00:00:00-05:00", "Twitter", False, t) for i, t in enumerate(texts)],
                                 "page long, pos long, date string, platform string, deleted_flag boolean, text string")
    return PG.build_pages(PG.feed_item_json(feed)).withColumn("page", F.lit(page).cast("long"))


def test_stream_refreshed_page_replaces_rows(spark):
    pages_dir, landed = scratch_path(spark, "sp"), scratch_path(spark, "sl")
    ckpt = scratch_path(spark, "sc")
    PG.write_pages(_page(spark, 1, ["A", "...b"]).withColumn("file_key", F.lit("0001-r1")), pages_dir, mode="append")
    ST.start_ingest(spark, pages_dir, landed, ckpt).awaitTermination()
    # The page is refreshed under a new file name: its rows replace the old ones by item id.
    PG.write_pages(_page(spark, 1, ["A2", "...b2", "C"]).withColumn("file_key", F.lit("0001-r2")), pages_dir, mode="append")
    ST.start_ingest(spark, pages_dir, landed, ckpt).awaitTermination()
    got = sorted((r.pos, r.text) for r in ST.read_landed(spark, landed).collect())
    assert got == [(0, "A2"), (1, "...b2"), (2, "C")]
    # A refresh that nulls one item and drops another; an older revision comes late.
    PG.write_pages(_page(spark, 1, [None, "...b3"]).withColumn("file_key", F.lit("0001-r10")), pages_dir, mode="append")
    PG.write_pages(_page(spark, 1, ["late"]).withColumn("file_key", F.lit("0001-r9")), pages_dir, mode="append")
    ST.start_ingest(spark, pages_dir, landed, ckpt).awaitTermination()
    assert [(r.pos, r.text) for r in ST.read_landed(spark, landed).collect()] == [(1, "...b3")]
    assert [r.raw_text for r in ST.landed_posts(ST.read_landed(spark, landed)).collect()] == ["...b3"]
