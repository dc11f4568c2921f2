"""Reversed search against a plain loop."""

import math
import random
import re
from collections import Counter

import pytest

from tidewrack.llm import reversed_search as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, top):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n_docs, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in {(i, t) for i, t in items if t is not None}:
        found = []
        for (i, c), n in zip(counts, sizes, strict=True):
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * c[t] // (1000 * c[t] + 8 * (25 + 75 * n * n_docs // total)))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


def tables(seed, n_docs=150):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma9", "Ünder", "straße", "你好", "x", "rare", "the", "THE", "of"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "-", "."]) for _ in range(rng.randint(0, n)))
    docs = [(k, text(30)) for k in range(n_docs)]
    docs += [docs[3], docs[3], (9000, docs[4][1]), (None, docs[5][1]), (None, None), (9001, ""), (9002, " .. "), (9003, "the rare " * 40_000)]
    items = [(k, text(6)) for k in range(12)]
    items += [items[2], (3, "rare rare THE"), (None, "alpha x"), (50, None), (51, ""), (52, "nowhere")]
    return docs, items


@pytest.mark.parametrize("block_bytes", [R.BLOCK_BYTES, 120])
def test_against_a_plain_loop(spark, monkeypatch, block_bytes):
    docs, items = tables(block_bytes)
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, item_id int, score int").repartition(5)
    q = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, rank int")
    got = sorted(map(tuple, R.search(d, q, 10, block_bytes=block_bytes).collect()), key=repr)
    assert got == plain(docs, items, 10)


def test_heaps_are_cut_while_documents_stream():
    import numpy as np

    rng = random.Random(1)
    heap, want = R.Heaps(7, 3), []
    heap.add(*(np.zeros(0, np.int64),) * 4)
    for k in range(40):
        rows = [(rng.randrange(7), rng.randrange(0, 30), 0, 100 * k + j) for j in range(20)]
        want += [r for r in rows if r[1] > 0]
        heap.add(*np.array(rows, np.int64).T)
        if k % 3 == 0:
            heap.cut()
    heap.cut()
    best = [r for i in range(7) for r in sorted((r for r in want if r[0] == i), key=lambda r: (-r[1], r[3]))[:3]]
    assert [tuple(x) for x in zip(*(c.tolist() for c in heap.kept), strict=True)] == best


def test_slices_keep_terms_whole(monkeypatch):
    text = ("Word" * 5 + " ").encode() * 30 + b"end"
    whole = [t for part in R.term_lists(text) for t in part]
    monkeypatch.setattr(R, "SLICE", 7)
    assert [t for part in R.term_lists(text) for t in part] == whole == [b"word" * 5] * 30 + [b"end"]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert R.search(docs.limit(0), items).collect() == []
    assert R.search(docs, items.limit(0)).collect() == []
    assert [tuple(r) for r in R.search(docs, items).collect()] == plain([(1, "a b")], [(1, "a")], 10)
