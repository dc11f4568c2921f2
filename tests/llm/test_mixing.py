"""Targets by iterative water-filling, whole takes, curriculum positions."""

import random
import re

from tidewrack.llm import mixing as M


def plain_targets(sizes, budget=1.5):
    """sizes: (source, words) in code-point order, null last."""
    weight = [M.WEIGHTS[i % 3] for i in range(len(sizes))]
    cap = [2.0 * n for _, n in sizes]
    target, free, rest = [0.0] * len(sizes), set(range(len(sizes))), budget * sum(n for _, n in sizes)
    while free:
        level = rest / sum(weight[i] for i in free)
        over = {i for i in free if level * weight[i] >= cap[i]}
        if not over:
            for i in free:
                target[i] = level * weight[i]
            break
        for i in over:
            target[i] = cap[i]
            rest -= cap[i]
        free -= over
    return {s: t for (s, _), t in zip(sizes, target, strict=True)}


def fixture():
    rng = random.Random(3)
    rows = []
    for i in range(400):
        source = rng.choice(["big"] * 6 + ["a", "B", "é", "tiny", None, "zz"])
        rows.append((i, " ".join("w" for _ in range(rng.randint(0, 3 if source == "tiny" else 60))), source))
    return rows + [(900, None, "a"), (901, " \t\n", "blank"), (902, "long " * 30_000, "B"), (5, rows[5][1], rows[5][2]), (None, "no id", "a")]


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(M, "DOCS_PER_SLICE", 7)
    rows = fixture()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, rank int").repartition(4)
    mixed = M.mix(df)
    got = mixed.collect()
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = plain_targets(sorted(size.items(), key=lambda x: (x[0] is None, x[0] or "")))
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - want[r.source]) < 1e-6 and 0 <= r.taken <= 2 * r.size
        assert (r.position is None) == (r.taken == 0) and (r.position is None or 0 <= r.position <= 1)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(taken[s] == int(want[s] + 1e-9) for s in size)
    again = M.mix(df.repartition(2)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.source or "", r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    order = M.training_order(mixed).collect()
    assert [r.position for r in order] == sorted(r.position for r in order) and len(order) >= sum(r.taken > 0 for r in got)


def test_position_inverts_the_demand(spark):
    df = spark.range(0, 101).selectExpr("id / 100D * 7 AS start", "7D AS target")
    for rank, slope in enumerate(M.SLOPES):
        from pyspark.sql import functions as F

        for r in df.select("start", M.position(F.col("start"), F.lit(rank)).alias("t")).collect():
            assert abs(r.t + slope * (r.t - r.t**2) - r.start / 7) < 1e-9


def test_empty_table(spark):
    assert M.mix(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []
