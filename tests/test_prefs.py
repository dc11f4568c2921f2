"""Feedback fold, pair store, sampling, training rows, positional split."""

import warnings

import pytest

from tidewrack.operators import prefs as PF
from tidewrack.session import scratch_path


def test_feedback_fold(spark):
    posts = spark.createDataFrame([("1", "t1"), ("2", "t2"), ("3", "t3")], "id string, raw_text string")
    props = spark.createDataFrame([(i, "P") for i in "123"], "id string, proposal string")
    dec = spark.createDataFrame([("1", "y", "H"), ("2", "n", "  H "), ("3", "s", "H")], "id string, choice string, human_text string")
    got = [tuple(r) for r in PF.feedback_pairs(posts, props, dec).collect()]
    assert got == [("2", "t2", "H", ["P"])]


@pytest.mark.parametrize("n,train,eval_", [(0, 0, 0), (1, 1, 0), (4, 2, 2), (5, 3, 2)])
def test_positional_split(spark, n, train, eval_):
    df = spark.range(0, n).withColumnRenamed("id", "k")
    got = [r.split for r in PF.positional_split(df, ["k"]).orderBy("k").collect()]
    assert got == ["train"] * train + ["eval"] * eval_


def test_sample_is_top_k_and_checked(spark):
    df = spark.range(0, 100).selectExpr("CAST(id AS STRING) AS id")
    s = PF.sample(df, 10, seed="s")
    assert s.count() == 10 and s.distinct().count() == 10
    assert "TakeOrderedAndProject" in s._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(PF.SampleTooLargeError):
        PF.sample(df, 101)


def test_pair_store_roundtrip_and_missing(spark):
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        assert PF.read_pairs(spark, scratch_path(spark, "absent")).count() == 0
        assert w
    pairs = spark.createDataFrame([("1", "i", "a", ["r"])], "id string, input string, accepted string, rejected array<string>")
    path = scratch_path(spark, "pairs-test")
    PF.write_pairs(pairs, path)
    assert [tuple(r) for r in PF.read_pairs(spark, path).collect()] == [("1", "i", "a", ["r"], 1, 1)]
    PF.append_pairs(spark, path, pairs)
    # The stored set may be rewritten from itself.
    PF.write_pairs(PF.read_pairs(spark, path), path, ["batch", "seq"])
    assert [tuple(r)[4:] for r in PF.read_pairs(spark, path).orderBy("seq").collect()] == [(1, 1), (2, 1)]


def test_reward_and_ppo_rows(spark):
    pairs = spark.createDataFrame([("1", "i", "a", ["r1", "r2"]), ("2", "i", "", ["r"]), ("3", "i", "a", [])],
                                  "id string, input string, accepted string, rejected array<string>")
    assert [tuple(r) for r in PF.reward_rows(pairs).collect()] == [("a", "r1")]
    with pytest.raises(Exception):
        PF.ppo_rows(pairs).collect()  # an empty rejected list fails, as in the original
    tolerant = PF.ppo_rows(pairs, tolerant=True).collect()
    assert tolerant[2].rejected[1].content is None


def test_pair_document_export_roundtrip(spark):
    pairs = spark.createDataFrame([("2", "i2", "a2", ["r2"]), ("1", "i1", "a1", ["r1", "x"])],
                                  "id string, input string, accepted string, rejected array<string>")
    store, path = scratch_path(spark, "pairs-store"), scratch_path(spark, "pairs-doc")
    PF.append_pairs(spark, store, pairs)
    pairs = PF.read_pairs(spark, store)
    PF.export_pairs_document(pairs, path)
    back = [tuple(r)[:5] for r in PF.read_pairs(spark, path).collect()]
    assert sorted(back) == sorted(tuple(r)[:5] for r in pairs.collect())
    with pytest.raises(ValueError):
        PF.export_pairs_document(pairs, scratch_path(spark, "pairs-doc2"), max_pairs=1)


def test_replacing_the_stored_set_from_itself_and_failing(spark, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "pairs")
    df = spark.createDataFrame([(str(i), "in", "acc", ["r"]) for i in range(9)], "id string, input string, accepted string, rejected array<string>")
    PF.write_pairs(df, path)
    PF.write_pairs(PF.read_pairs(spark, path).where("id >= '4'"), path)
    assert sorted((r.id, r.seq) for r in PF.read_pairs(spark, path).collect()) == [(str(i), i - 3) for i in range(4, 9)]
    broken = F.udf(lambda x: str(1 / 0), "string")
    with pytest.raises(Exception, match="ZeroDivisionError"):
        PF.write_pairs(PF.read_pairs(spark, path).withColumn("input", broken("id")), path)
    assert PF.read_pairs(spark, path).count() == 5
    assert [p.name for p in tmp_path.iterdir() if ".old-" in p.name] == []
