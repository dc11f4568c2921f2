"""Plan properties: no Python in column pipelines, pushdown and pruning, exchanges."""

from tidewrack.plans import corpus
from tidewrack.sources.feed import load_feed
from tidewrack.session import read_table
from tidewrack.functions import text as T
from conftest import SF0001


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feed_posts_plan_is_jvm_only(spark):
    p = plan(corpus.feed_to_posts(load_feed(spark, SF0001)))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in p


def test_scan_prunes_columns(spark):
    p = plan(read_table(spark, SF0001, "documents").select("doc_id", T.clean_post_text("text").alias("c")))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_chain_evaluated_once(spark):
    # The cleaning chain is bound by a Generate, so filters on it are not pushed below it.
    p = corpus.filter_feed(corpus.clean_feed(load_feed(spark, SF0001)))._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("Generate") == 1


def test_observed_funnel_matches_counts(spark):
    from tidewrack.session import scratch_path
    posts, obs = corpus.feed_to_posts_observed(load_feed(spark, SF0001))
    posts.write.parquet(scratch_path(spark, "observed"))
    got = {k: o.get["rows"] for k, o in obs.items()}
    want = {r.stage: r.rows for r in corpus.funnel(load_feed(spark, SF0001)).collect()}
    assert all(got[k] == want[k] for k in got)


def test_range_blocks_scan_in_parallel(spark):
    """Every job that builds the blocks of a many-split table runs on its splits: no scan
    in one task, and the build does not depend on the number of blocks."""
    from tidewrack.operators.order import range_blocks
    from tidewrack.session import scratch_path
    path = scratch_path(spark, "splits")
    spark.range(0, 64_000, 1, 40).selectExpr("id", "id % 7 AS k").write.parquet(path)
    df = spark.read.option("mergeSchema", "false").parquet(path)
    splits = df.rdd.getNumPartitions()
    tracker, group = spark.sparkContext.statusTracker(), "range-blocks"
    spark.sparkContext.setJobGroup(group, group)
    range_blocks(df, ["k", "id"], num_blocks=500)
    jobs = tracker.getJobIdsForGroup(group)
    tasks = [tracker.getStageInfo(s).numTasks for j in jobs for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s)]
    spark.sparkContext.setJobGroup("", "")
    assert splits > 1 and 500 in tasks
    assert tasks.count(1) <= 2  # the footers of the two staged tables


def test_only_single_partition_exchange_is_block_offsets(spark):
    # AQE off here so the whole physical plan is visible up front.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(corpus.feed_to_posts(load_feed(spark, SF0001)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("SinglePartition") == 1
    offsets = p[p.index("SinglePartition") - 400: p.index("SinglePartition") + 200]
    assert "_blk" in offsets
