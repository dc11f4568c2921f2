"""M1 thread merge: hand-traced cases and random feeds against the sequential fold."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tidewrack.operators.thread import thread_merge


def fold(texts):
    out = []
    for t in texts:
        if not out:
            out.append(t)
        elif t.startswith("..."):
            out[-1] = out[-1] + " " + re.sub(r"^\.+\s*", "", t)
        else:
            out.append(t)
    return out


def merge(spark, rows, num_blocks=None):
    df = spark.createDataFrame(rows, "page long, pos long, date string, text string")
    got = thread_merge(df, num_blocks=num_blocks).orderBy("page", "pos").collect()
    return [r.text for r in got]


def feed(texts, per_page=3):
    return [(i // per_page, i % per_page, f"d{i}", t) for i, t in enumerate(texts)]


def test_hand_traced(spark):
    assert merge(spark, feed(["A", "...b", "B", "....c"])) == ["A b", "B c"]
    assert merge(spark, feed(["...x", "...y"])) == ["...x y"]
    assert merge(spark, feed(["A", "", "...b"])) == ["A", " b"]
    assert merge(spark, feed(["A", "..."])) == ["A "]


def test_head_metadata_is_first_row(spark):
    df = spark.createDataFrame(feed(["A", "...b", "...c", "D"]), "page long, pos long, date string, text string")
    rows = thread_merge(df).orderBy("page", "pos").collect()
    assert [(r.page, r.pos, r.date, r.n_parts) for r in rows] == [(0, 0, "d0", 3), (1, 0, "d3", 1)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.sampled_from(["A", "B c", "...x", "....  y", "...", "", "z..."]), min_size=1, max_size=60),
       st.integers(min_value=1, max_value=7), st.integers(min_value=1, max_value=9))
def test_random_against_fold(spark, texts, per_page, blocks):
    assert merge(spark, feed(texts, per_page), num_blocks=blocks) == fold(texts)


def test_hot_page_is_split_across_blocks(spark):
    # One page holds most rows: range blocks cut it by position, results stay exact.
    rnd = random.Random(7)
    texts = [rnd.choice(["A", "...b", "C"]) for _ in range(400)]
    rows = [(0 if i < 300 else 1 + i, i, "d", t) for i, t in enumerate(texts)]
    assert merge(spark, rows, num_blocks=8) == fold(texts)
