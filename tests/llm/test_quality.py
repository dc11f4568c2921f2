"""Held-out accuracy, ordered thresholds and odd inputs."""

import numpy as np

from conftest import SF001
from tidewrack.llm import quality as Q


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    model = Q.fit(docs, labels.where("doc_id % 3 <> 0"))
    assert model["cuts"][0] < model["cuts"][1]
    got = Q.score(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    good = (got.quality == 1) & (got.toxic == 0)
    assert (got.kept == good).mean() > 0.95
    assert got[good].expected_grade.mean() > got[(got.quality == 0) & (got.toxic == 0)].expected_grade.mean() > got[got.toxic == 1].expected_grade.mean()
    assert (got.expected_grade >= got.p_good).all()
    again = Q.fit(docs.repartition(5), labels.where("doc_id % 3 <> 0"))
    assert np.array_equal(model["w"], again["w"]) and model["cuts"] == again["cuts"]


def test_fit_recovers_ordered_grades():
    rng = np.random.default_rng(0)
    grade = rng.integers(0, 3, 3000)
    parts = [np.unique(np.concatenate([rng.integers(100, 400, 8), [g] if rng.random() < 0.9 else []])).astype(int) for g in grade]
    model = Q.cumulative_link(parts, grade)
    assert model["w"][0] < model["w"][1] < model["w"][2]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 3), (None, "good text", 4), (2, "", 5), (2, "", 5), (3, "x " * 100_000, 6)], "doc_id long, text string, kept int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Q.fit(docs, none) is None
    assert [r.kept for r in Q.score(docs, None).collect()] == [True] * 5 and Q.select_quality(docs, None).count() == 5
    one = spark.createDataFrame([(1, 1, 0), (None, 0, 1), (2, None, 1)], "doc_id long, quality int, toxic int")
    assert Q.fit(docs, one) is None
    model = {"w": np.zeros(Q.BUCKETS + Q.SHAPES, np.float32), "cuts": (-2.0, -1.0)}
    assert Q.score(docs, model).where("kept").count() == 5 and Q.select_quality(docs, model).columns == docs.columns
    empty = docs.limit(0)
    assert Q.score(empty, model).collect() == [] and Q.select_quality(empty, model).collect() == []


def test_the_sample_leaves_out_long_texts_and_keeps_its_bounds(spark):
    import pytest

    rows = [(i, ("good words here " if i % 2 else "bad stuff !!! ") * 3 + str(i)) for i in range(60)]
    docs = spark.createDataFrame([*rows, (100, "x" * 5000), (5, rows[5][1] + " longer"), (101, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in [*range(60), 100, 101]], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.text for r in Q.fit_sample(docs, labels, 1000, 64_000_000, max_text=1000).collect()}
    assert got == dict(rows)  # the long text is left out, of the repeated id the shorter text stays
    few = Q.fit_sample(docs, labels, 1000, 700, max_text=1000).collect()
    assert 0 < sum(len(r.text) for r in few) <= 700
    assert len(Q.fit_sample(docs, labels, 10, 64_000_000).collect()) <= 10
    with pytest.raises(ValueError, match="bounds"):
        Q.fit(docs, labels, max_bytes=10)
