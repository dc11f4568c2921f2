"""Upserts touch their own buckets, keep the constraints, and fail without a trace."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewrack.operators import table as TB
from tidewrack.sources import bucketed_table as B

ROWS = [(f"id{i}", f"2024-01-{1 + i % 28:02d}", f"text {i}", None) for i in range(200)]


def frame(spark, rows):
    return spark.createDataFrame(rows, TB.POSTS_SCHEMA)


def files(root):
    return {p.parent.name: p.name for p in Path(root).rglob("*.parquet")}


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def root(spark, tmp_path):
    path = str(tmp_path / "posts")
    B.create(frame(spark, ROWS), path, 16)
    return path


def test_one_id_rewrites_one_bucket(spark, root):
    before = files(root)
    touched = B.update_clean_text(spark, root, spark.createDataFrame([("id7", "a", 1), ("id7", "b", 2), ("gone", "c", 1)], "id string, clean_text string, seq int").where("id = 'id7'"))
    after = files(root)
    assert len(touched) == 1 and {k for k in before if before[k] != after[k]} == {f"bucket={touched[0]}"}
    scan = B.read(spark, root, touched)
    scan.collect()
    leaves = scan._jdf.queryExecution().executedPlan().collectLeaves()
    assert leaves.apply(0).metrics().apply("numFiles").value() == 1
    assert rows(B.read(spark, root)) == sorted((*r[:3], "b") if r[0] == "id7" else r for r in ROWS)


def test_equal_to_the_whole_table_operators(spark, root):
    batch = spark.createDataFrame([("id3", "x", "y", "z", 1), ("new", "d", "second", None, 5), ("new", "d", "first", None, 2), ("other", "d", "t", "c", 1)], "id string, date string, raw_text string, clean_text string, ord int")
    want = rows(TB.insert_or_ignore(frame(spark, ROWS), batch))
    B.insert_or_ignore(spark, root, batch)
    assert rows(B.read(spark, root)) == want
    updates = spark.createDataFrame([("id3", "one", 1), ("id3", None, 2), ("other", None, 1), ("nobody", "x", 1)], "id string, clean_text string, seq int")
    B.update_clean_text(spark, root, updates)
    assert rows(B.read(spark, root)) == rows(TB.update_clean_text(frame(spark, want), updates))


def test_violations_raise_and_write_nothing(spark, root):
    before = files(root)
    schema = "id string, date string, raw_text string, clean_text string, ord int"
    for bad in [("n", None, "t", None, 1), ("n", "d", None, None, 1), (None, "d", "t", None, 1)]:
        with pytest.raises(B.ConstraintError):
            B.insert_or_ignore(spark, root, spark.createDataFrame([bad], schema))
    with pytest.raises(B.ConstraintError, match="duplicate_ids"):
        B.create(spark.createDataFrame(ROWS[:3] + ROWS[:1], "id string, date string, raw_text string, clean_text string"), root, 16)
    assert files(root) == before and rows(B.read(spark, root)) == sorted(ROWS)


def test_a_failed_write_leaves_the_old_rows(spark, root, monkeypatch):
    before = files(root)
    broken = F.udf(lambda x: 1 / 0, "string")
    monkeypatch.setattr(B, "checked", lambda df: df.withColumn("clean_text", broken("id")))
    with pytest.raises(Exception, match="ZeroDivisionError"):
        B.update_clean_text(spark, root, spark.createDataFrame([("id7", "a", 1)], "id string, clean_text string, seq int"))
    monkeypatch.undo()
    assert files(root) == before and rows(B.read(spark, root)) == sorted(ROWS)


def test_empty_table_and_empty_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    assert B.read(spark, path).collect() == [] and B.bucket_count(spark, path) is None
    batch = spark.createDataFrame([("a", "d", "t", None, 1)], "id string, date string, raw_text string, clean_text string, ord int")
    assert B.insert_or_ignore(spark, path, batch.limit(0)) == []
    B.insert_or_ignore(spark, path, batch)
    assert rows(B.read(spark, path)) == [("a", "d", "t", None)] and B.bucket_count(spark, path) == B.BUCKETS
