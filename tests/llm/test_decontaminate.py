"""Contained items against brute force over all pairs; nothing is missed."""

import random
import re

import pytest

from tidewrack.llm import decontaminate as D


def words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams(w, k):
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(docs, items):
    out = []
    for d, t in docs:
        w = words(t)
        for i, x in items:
            v = words(x)
            if not v:
                continue
            k = min(5, len(v))
            g = grams(v, k)
            both = len(g & grams(w, k))
            if both >= 0.8 * len(g) - 1e-9 and both:
                out.append((d, i, len(g), both))
    return sorted(out, key=repr)


def fixture():
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "Zü"]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(some(n))) for i, n in enumerate([1, 2, 3, 4, 5, 6, 9, 14, 15, 20, 33, 40, 64, 90] * 2)]
    items += [(90, None), (91, "... !"), (5, items[7][1]), (None, items[8][1])]
    docs = []
    for d in range(150):
        body = some(rng.randint(0, 80))
        for _ in range(rng.randint(0, 2)):
            v = (rng.choice(items)[1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                if v:
                    v[rng.randrange(len(v))] = "changed"
            at = rng.randint(0, len(body))
            cut = rng.randint(0, len(v))
            body[at:at] = v[:cut] if rng.random() < 0.3 else v  # or a part, the rest elsewhere
            if rng.random() < 0.3:
                body += ["between"] + v[cut:]
        docs.append((d, rng.choice([" ", ", ", "\n"]).join(body).upper() if d % 7 == 0 else " ".join(body)))
    return docs + [(900, None), (901, ""), (902, "w1 " * 50_000), (3, docs[3][1]), (None, docs[4][1])], items


@pytest.mark.parametrize("block_bytes", [10**6, 400])
def test_matches_brute_force(spark, block_bytes):
    docs, items = fixture()
    d = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, item_id int").repartition(3)
    b = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    want = brute(docs, items)
    got = D.find_contamination(d, b, block_bytes=block_bytes).collect()
    assert len(want) > 60 and sorted(((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in got), key=repr) == want
    kept = D.drop_contaminated(d, b, block_bytes=block_bytes)
    hit = {x[0] for x in want}
    assert kept.columns == d.columns and sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((i for i, _ in docs if i not in hit), key=repr)


def test_empty_sides(spark):
    docs, items = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert D.find_contamination(docs.limit(0), items).collect() == [] and D.find_contamination(docs, items.limit(0)).collect() == []
    assert D.drop_contaminated(docs, items.limit(0)).count() == 1 and D.drop_contaminated(docs, items).count() == 0
