"""Exact removal against brute force over all windows."""

import hashlib
import random

import numpy as np
import pytest

from tidewrack.llm import suffix_dedup as S


def brute(rows, window):
    """rows: (doc_id, text). Windows counted one by one."""
    data = [(i, (t or "").encode()) for i, t in rows]
    count = {}
    for _, b in data:
        for p in range(len(b) - window + 1):
            count[b[p : p + window]] = count.get(b[p : p + window], 0) + 1
    out = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - window + 1):
            if count[b[p : p + window]] > 1:
                gone[p : p + window] = True
        rest = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        n_spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i, len(b), int(gone.sum()), n_spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=repr)


def fixture(rng):
    letters = "ab cdé\n"
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [word(rng.randint(18, 90)) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [word(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            cut = rng.randint(0, 12)
            parts += [p[cut:], word(rng.randint(0, 30))]
        rows.append((i, "".join(parts)))
    rows += [(200, None), (201, ""), (202, "x" * 300), (203, "xy" * 200), (204, rows[3][1]), (204, rows[3][1]), (None, rows[5][1]), (205, "short")]
    return rows


@pytest.mark.parametrize("seed,buckets", [(1, 8), (2, 40)])
def test_matches_brute_force(spark, seed, buckets, monkeypatch):
    monkeypatch.setattr(S, "PIECE", 64)  # long texts go in overlapping pieces
    monkeypatch.setattr(S, "PER_BUCKET", 1500 // buckets)
    monkeypatch.setattr(S, "PER_SPLIT", 10)
    rows = fixture(random.Random(seed))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(buckets))
    try:
        df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, pos int, ctx string").repartition(3)
        got = S.suffix_dedup(df, window=24, seed=4).drop("kept").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 24)


def test_empty_table(spark):
    assert S.suffix_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_solve_equals_all_pairs():
    rng = random.Random(5)
    rows = list({("abcd" + "".join(rng.choice("ab") for _ in range(rng.randint(8, 20))), "".join(rng.choice("ab") for _ in range(rng.randint(0, 20)))) for _ in range(150)})
    suffix, s_len = S.byte_matrix([a.encode() for a, _ in rows], 24)
    prefix, p_len = S.byte_matrix([b.encode() for _, b in rows], 20)
    low, high = S.solve(suffix, s_len, prefix, p_len, 24, 4)

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    for i, (s, p) in enumerate(rows):
        found = [d for j, (s2, p2) in enumerate(rows) if j != i for d in range(0, 21) if common(s, s2) >= 24 - d and common(p, p2) >= d]
        assert (low[i], high[i]) == ((min(found), max(found)) if found else (24, -1))


@pytest.mark.parametrize("where", ["end", "begin", "middle"])
def test_split_runs_send_few_digests(spark, where, monkeypatch):
    """A very common passage: its windows go out in small rows, the others stay."""
    sent = {}
    compare = S.compare_boundaries

    def noted(packs, targets):
        sizes = [r[0] for r in packs.selectExpr("length(digests)").collect()]
        sent.update(total=sum(sizes), most=max(sizes, default=0), batch=int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")))
        return compare(packs, targets)

    monkeypatch.setattr(S, "compare_boundaries", noted)
    monkeypatch.setattr(S, "PER_BUCKET", 200)
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    line = word(500)
    around = {"end": (60, 0), "begin": (0, 60), "middle": (60, 60)}[where]
    # Some surroundings are shared by a few documents, far apart in one order or in both.
    rows = [(i, word(around[0]) + line + word(around[1])) for i in range(400)]
    rows += [(1000 + i, word(40) + rows[i][1][:450] + "x") for i in range(0, 400, 7)]
    rows += [(2000 + i, "y" + rows[i][1][120:] + word(40)) for i in range(0, 400, 9)]
    got = S.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string")).drop("kept").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 400)
    assert 0 < sent["total"] < 40 * 20_000
    assert sent["most"] <= 40 * 400
    assert sent["batch"] <= 4 << 20


def test_windows_across_both_orders_are_open():
    rng = random.Random(11)
    word = lambda n: bytes(rng.choice(b"aaaaaaab") for _ in range(n))
    rows = sorted({(b"abcd" + word(rng.randint(8, 12)), word(rng.randint(0, 12))) for _ in range(200)})
    bounds = [(b"abcd", b""), *rows[20::35]]
    second = sorted((s[:4], p, s) for s, p in rows)[30::40]
    common = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    place = [(S.bisect.bisect_right(bounds, r), S.bisect.bisect_right(second, (r[0][:4], r[1], r[0]))) for r in rows]
    open_ = [S.open_offsets(*r, bounds, second, 16, 4) for r in rows]
    seen = 0
    for i, (s, p) in enumerate(rows):
        for j, (s2, p2) in enumerate(rows):
            if place[i][0] != place[j][0] and place[i][1] != place[j][1]:
                shared = [d for d in range(13) if common(s, s2) >= 16 - d and common(p, p2) >= d]
                assert all(open_[i][0] <= d <= open_[i][1] for d in shared)
                seen += len(shared)
    assert seen
