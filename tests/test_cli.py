"""Command line jobs end to end on sf0.001: pages -> table -> normalise -> sample ->
prepare -> corpus sequences."""

from pyspark.sql import functions as F

from tidewrack.cli import main
from tidewrack.operators import prefs as PF
from tidewrack.session import scratch_path
from tidewrack.sources import pages as PG
from tidewrack.sources import table_store as TS
from tidewrack.sources.feed import load_feed
from conftest import SF0001


def test_jobs(spark):
    pages, table = scratch_path(spark, "cli-pages"), scratch_path(spark, "cli-table")
    PG.write_pages(PG.build_pages(PG.feed_item_json(load_feed(spark, SF0001))), pages)
    main(["ingest", "--pages", pages, "--table", table, "--validation", "off"], spark)
    assert TS.read(spark, table).count() == 45
    main(["normalise", "--table", table], spark)
    t = TS.read(spark, table)
    assert t.where(F.col("clean_text").isNull()).count() == 0
    pairs = scratch_path(spark, "cli-pairs")
    first = t.limit(3).select("id", F.col("raw_text").alias("input"), F.col("clean_text").alias("accepted"),
                              F.array(F.col("raw_text")).alias("rejected"))
    PF.write_pairs(first, pairs)
    decisions = scratch_path(spark, "cli-decisions")
    t.where("clean_text <> ''").limit(2).selectExpr("id", "clean_text AS proposal", "'n' AS choice", "raw_text AS human_text").write.parquet(decisions)
    main(["label", "--table", table, "--decisions", decisions, "--pairs", pairs], spark)
    assert [(r.batch, r.seq) for r in PF.read_pairs(spark, pairs).orderBy("batch", "seq").collect()] == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2)]
    out = scratch_path(spark, "cli-sample")
    main(["sample", "--table", table, "--pairs", pairs, "--n", "5", "--out", out], spark)
    assert spark.read.parquet(out).join(first, "id").count() == 0
    prep = scratch_path(spark, "cli-prep")
    main(["prepare", "--pairs", pairs, "--out", prep], spark)
    assert spark.read.parquet(f"{prep}/tokens").count() == 5
    assert {r.split for r in spark.read.parquet(f"{prep}/ppo").collect()} == {"train", "eval"}
    corp = scratch_path(spark, "cli-corpus")
    main(["corpus", "--table", table, "--out", corp], spark)
    seqs = spark.read.parquet(f"{corp}/sequences")
    assert seqs.count() == 45 and seqs.where(F.size("input_ids") != 128).count() == 0
