"""Range-block global order helpers."""

from pyspark.sql import functions as F

from tidewrack.operators.order import global_row_number, range_blocks


def test_row_number_matches_sorted_order(spark):
    df = spark.range(0, 1000).select(((F.col("id") * 7919) % 1000).alias("k"), F.col("id"))
    got = global_row_number(df, ["k", "id"], num_blocks=7).orderBy("rn").collect()
    desc = global_row_number(df, [("k", False), "id"], num_blocks=5).orderBy("rn").collect()
    assert [(r.k, r.id) for r in desc] == sorted(((r.k, r.id) for r in desc), key=lambda x: (-x[0], x[1]))
    assert [r.rn for r in got] == list(range(1, 1001))
    assert [r.k for r in got] == sorted(r.k for r in got)


def test_blocks_are_contiguous(spark):
    df = spark.range(0, 500).withColumn("k", F.col("id") % 3)
    b = range_blocks(df, ["k", "id"], num_blocks=5)
    per = b.groupBy("_blk").agg(F.min(F.struct("k", "id")).alias("lo"), F.max(F.struct("k", "id")).alias("hi"))
    spans = sorted((tuple(r.lo), tuple(r.hi)) for r in per.collect())
    for (lo1, hi1), (lo2, _) in zip(spans, spans[1:]):
        assert hi1 < lo2


def test_null_keys_sort_first(spark):
    df = spark.range(0, 300).select(F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 50).alias("k"), "id")
    got = global_row_number(df, ["k", "id"], num_blocks=5).orderBy("rn").collect()
    want = sorted(((r.k, r.id) for r in got), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert [r.rn for r in got] == list(range(1, 301)) and [(r.k, r.id) for r in got] == want
