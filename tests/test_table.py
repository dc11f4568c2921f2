"""Posts-table operators and the versioned table store."""

import pytest
from pyspark.sql import functions as F

from tidewrack.operators import table as TB
from tidewrack.operators.joins import small_side
from tidewrack.session import scratch_path
from tidewrack.sources import table_store as TS

SCHEMA = "id string, date string, raw_text string, clean_text string"


def test_insert_or_ignore_first_writer_wins(spark):
    target = spark.createDataFrame([("a", "d1", "A", None)], SCHEMA)
    batch = spark.createDataFrame([("a", "d9", "X", "x", 0), ("b", "d2", "B", "first", 1), ("b", "d2", "B", "second", 2)],
                                  SCHEMA + ", ord long")
    got = sorted(tuple(r) for r in TB.insert_or_ignore(target, batch).collect())
    assert got == [("a", "d1", "A", None), ("b", "d2", "B", "first")]


def test_update_null_overwrites_and_unknown_ignored(spark):
    target = spark.createDataFrame([("a", "d", "A", "old"), ("b", "d", "B", "keep")], SCHEMA)
    upd = spark.createDataFrame([("a", "new", 1), ("a", None, 2), ("z", "zz", 1)], "id string, clean_text string, seq int")
    got = {r.id: r.clean_text for r in TB.update_clean_text(target, upd).collect()}
    assert got == {"a": None, "b": "keep"}


def test_probe_and_constraints(spark):
    t = spark.createDataFrame([("a", "d", "A", None), ("a", "d", "A", None), ("b", None, "B", None)], SCHEMA)
    probes = spark.createDataFrame([("A",), ("Q",)], "raw_text string")
    assert {r.raw_text: r.exists for r in TB.probe_raw_text(t, probes).collect()} == {"A": True, "Q": False}
    v = TB.constraint_violations(t).first()
    assert (v.rows, v.duplicate_ids, v.null_dates) == (3, 1, 1)


def test_needs_normalising_pushes_filter(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", "d", "A", None), ("b", "d", "B", "x"), ("c", "d", "C", "")], SCHEMA).write.parquet(path)
    df = TB.needs_normalising(spark.read.parquet(path))
    assert sorted(r.id for r in df.collect()) == ["a", "c"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(IsNull(clean_text),EqualTo(clean_text,))]" in plan


def test_versioned_store(spark):
    root = scratch_path(spark, "store")
    TS.create_if_absent(spark, root)
    assert TS.read(spark, root).count() == 0
    TS.write(spark.createDataFrame([("a", "d", "A", None)], SCHEMA), root)
    cur = TS.read(spark, root)
    v = TS.write(TB.update_clean_text(cur, spark.createDataFrame([("a", "c", 1)], "id string, clean_text string, seq int")), root)
    assert v == 3 and TS.read(spark, root).first().clean_text == "c"


def test_probe_large_path_matches(spark, monkeypatch):
    t = spark.createDataFrame([("a", "d", "A", None)] * 5 + [("b", "d", "B", None)], SCHEMA)
    probes = spark.createDataFrame([("A",), ("Q",), ("B",)], "raw_text string")
    small = {r.raw_text: r.exists for r in TB.probe_raw_text(t, probes).collect()}
    hinted = []
    monkeypatch.setattr(TB, "small_side", lambda df, **kw: hinted.append(small_side(df, max_bytes=1, **kw)) or hinted[-1])
    large = {r.raw_text: r.exists for r in TB.probe_raw_text(t, probes).collect()}
    assert "ResolvedHint" not in hinted[0]._jdf.queryExecution().analyzed().toString()
    assert small == large == {"A": True, "Q": False, "B": True}
