"""Scores against plain dictionaries; packing round trip."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidewrack.llm import lm_score as S


def plain(rows):
    docs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    one, two = Counter(w for d in docs for w in d), Counter(p for d in docs for p in zip(d, d[1:]))
    out = []
    for (i, _), d in zip(rows, docs, strict=True):
        own1, own2 = Counter(d), Counter(zip(d, d[1:]))
        others, total, n = max(1, sum(one.values()) - len(d)), 0.0, [0, 0, 0]
        for k, w in enumerate(d):
            pair = (d[k - 1], w) if k else None
            if pair and two[pair] > own2[pair]:
                total += math.log((two[pair] - own2[pair]) / (one[pair[0]] - own1[pair[0]]))
                n[0] += 1
                continue
            total += math.log(0.4) if pair else 0
            if one[w] > own1[w]:
                total += math.log((one[w] - own1[w]) / others)
                n[1] += 1
            else:
                total += math.log(0.4 / others)
                n[2] += 1
        out.append((i, len(d), round(total, 6), *n))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [10**6, 700])
def test_matches_plain_counts(spark, size):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["a", "b", "c", "dé", f"r{rng.randrange(200)}"]) for _ in range(rng.randint(0, 40)))) for i in range(120)]
    rows += [(200, None), (201, " \n"), (202, "a " * 20_000), (3, rows[3][1]), (None, rows[4][1]), (None, rows[4][1])]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, chunk int").repartition(3)
    got = S.stupid_backoff(df, chunk_bytes=size, bucket_bytes=size).collect()
    assert sorted(((r.doc_id, r.n_words, round(r.log_prob, 6), r.n_pairs_seen, r.n_backed_off, r.n_unseen) for r in got), key=repr) == plain(rows)


def test_small_corpora(spark):
    df = spark.createDataFrame([(1, "only text")], "doc_id long, text string")
    assert [(r.n_words, r.n_unseen) for r in S.stupid_backoff(df).collect()] == [(2, 2)]
    assert S.stupid_backoff(df.limit(0)).collect() == []


def test_pack_round_trip():
    x = np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64)
    for y in (x, x[:0], x[:1], x % 7):
        assert np.array_equal(S.unpack(S.pack(y)), y)
