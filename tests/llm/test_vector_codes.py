"""Vector codes against a plain loop."""

import math
import random

import pytest

from tidewrack.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int, code string"


def plain(rows, parts, entries, rounds):
    import numpy as np

    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(good[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in good]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(c[p], e, strict=True)), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [c[p] for c, a in zip(cut, codes, strict=True) if a[p][1] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    codes = assign()
    return sorted(((i, label, "".join(f"{e:02x}" for _, e in a), sum(d for d, _ in a)) for (i, _, label), a in zip(good, codes, strict=True)), key=repr), books


def rows(seed, n=260, width=8, scale=1.0):
    rng = random.Random(seed)
    out = [(rng.randrange(10**6), [rng.gauss(0, scale) for _ in range(width)], rng.choice([None, 1, 2])) for _ in range(n)]
    out += [out[7]] * 3 + [(-5, out[0][1], None)] * 90  # copies: a third of the rows
    out += [(3, None, 1), (4, [], 1), (5, [None] + [0.0] * (width - 1), 1), (6, [math.nan] * width, 1), (7, [math.inf] + [0.0] * (width - 1), 2)]
    return out + [(None, [0.5] * width, 2), (-5, [0.25] * width, None), (-5, [-0.25] * width, None)]


@pytest.mark.parametrize("parts, entries, rounds, scale", [(4, 16, 2, 1.0), (2, 7, 3, 0.1), (8, 256, 1, 1.0), (4, 16, 2, 250_000.0)])
def test_against_a_plain_loop(spark, parts, entries, rounds, scale):
    data = rows(entries, scale=scale)
    df = spark.createDataFrame([(*r, "x") for r in data], SCHEMA).repartition(6)
    codes, books = V.vector_codes(df, parts=parts, entries=entries, rounds=rounds)
    want, want_books = plain(data, parts, entries, rounds)
    assert sorted(((r.id, r.label, r.code, r.error) for r in codes.collect()), key=repr) == want
    assert books.tolist() == want_books


def test_small_batches_and_packs(spark, monkeypatch):
    data = rows(3)
    df = spark.createDataFrame([(*r, "x") for r in data], SCHEMA)
    monkeypatch.setattr(V, "AT_ONCE", 10)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        codes, books = V.vector_codes(df, parts=2, entries=9)
        got = sorted(((r.id, r.label, r.code, r.error) for r in codes.collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert (got, books.tolist()) == plain(data, 2, 9, 2)


def test_odd_tables(spark):
    df = spark.createDataFrame([(*r, "x") for r in rows(1)], SCHEMA)
    codes, books = V.vector_codes(df.limit(0))
    assert codes.collect() == [] and books.size == 0
    with pytest.raises(ValueError, match="length"):
        V.vector_codes(df.unionByName(spark.createDataFrame([(1, [0.0] * 9, 1, "")], SCHEMA)), parts=4)
    with pytest.raises(ValueError, match="multiple"):
        V.vector_codes(df, parts=3)
    with pytest.raises(ValueError, match="supported"):
        V.vector_codes(spark.createDataFrame([(1, [1e30] * 4, 1, "")], SCHEMA), parts=2)


def test_only_movers_move(spark):
    """The blocks that keep their entry are read where they were written."""
    df = spark.createDataFrame([(*r, "x") for r in rows(9)], SCHEMA)
    rows_ = V.integers(df.selectExpr("vec_id AS id", "embedding AS v", "label"))
    import numpy as np

    books = np.array([r.v for r in rows_.orderBy("id").limit(8).collect()], np.int64).reshape(8, 2, -1).transpose(1, 0, 2).copy()
    book = spark.sparkContext.broadcast(books)
    first = V.written(V.first_blocks(rows_, book, 2).repartition(4, "position", "entry", "salt"), "t")
    moved = V.migrated(first, book, 4)
    assert moved.where("was <> entry").count() == 0  # nothing changes under the same books
    assert moved.selectExpr("sum(size(keys))").first()[0] == 2 * rows_.count()
