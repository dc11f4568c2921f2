"""F13 against numpy: the fit's steps, the scores and the rank sum."""

import math
import random
import re

import numpy as np
import pytest

from tidewrack.operators import score as S


def plain_features(text):
    text = text or ""
    return [math.log1p(len(re.findall(p, text))) for p in S.COUNTED.values()] + [1.0 if re.search(r"[.!?]\Z", text) else 0.0]


def plain_fit(pairs, steps=S.STEPS):
    x = np.array([np.subtract(plain_features(a), plain_features(b)) for a, b in pairs]).reshape(-1, len(S.FEATURES))
    w = np.zeros(len(S.FEATURES))
    bound = (np.abs(x) * np.abs(x).sum(1, keepdims=True)).sum(0) / 4
    likelihood = []
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        likelihood.append(np.log(p).sum() - S.RIDGE * (w @ w) / 2)
        w = w + ((1 - p) @ x - S.RIDGE * w) / (S.RIDGE + bound)
    return w, likelihood


def pairs(n=200):
    rng = random.Random(4)
    words = ["word", "@name", "#tag", "http://t.co/x", "CAPS", "12", "!", "--", "…", "end."]
    text = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(0, 8)))
    out = []
    for _ in range(n):
        raw = text()
        out.append((re.sub(r"[@#]", "", raw).strip() or "x.", raw))
    return out + [(None, "a"), ("same", "same"), ("same", "same")]


def test_fit_scores_and_ranking(spark):
    rows = pairs()
    df = spark.createDataFrame(rows, "chosen string, rejected string").repartition(4)
    w = S.fit(df)
    want, likelihood = plain_fit(rows)
    assert np.allclose(w, want) and all(b > a for a, b in zip(likelihood, likelihood[1:], strict=False))
    scored = df.select("*", S.score(w, "chosen").alias("score_chosen"), S.score(w, "rejected").alias("score_rejected"))
    got = scored.collect()
    assert all(r.score_chosen == pytest.approx(float(np.dot(w, plain_features(r.chosen)))) for r in got)
    good, bad = [r.score_chosen for r in got], [r.score_rejected for r in got]
    better = lambda a, b: 1.0 if a > b else 0.5 if a == b else 0.0
    r = S.ranking(scored).first()
    assert r.pairs == len(rows)
    assert r.accuracy == pytest.approx(sum(map(better, good, bad)) / len(rows))
    assert r.auc == pytest.approx(sum(better(a, b) for a in good for b in bad) / len(rows) ** 2)
    assert r.accuracy > 0.8


def test_nothing_to_learn(spark):
    none = spark.createDataFrame([], "chosen string, rejected string")
    assert S.fit(none) == [0.0] * len(S.FEATURES)
    r = S.ranking(none.selectExpr("1.0D AS score_chosen", "2.0D AS score_rejected")).first()
    assert (r.pairs, r.accuracy, r.auc) == (0, None, None)
