"""Dice over bigrams against plain sets; exact pruning."""

import random
import re

from tidewrack.llm import licenses as L


def plain(rows):
    templates = {k: set(L.bigrams_of(v)) for k, v in L.TEMPLATES.items()}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n") if text is not None else []
        blocks = re.split(L.PARAGRAPHS, text or "")
        for n, unit in [*enumerate(lines), *([(-1, text)] if len(lines) > 1 else []), *((-2 - k, b) for k, b in enumerate(blocks) if len(blocks) > 1 and "\n" in b)]:
            a = set(L.bigrams_of(unit))
            best = max(((2 * len(a & b) / (len(a) + len(b)), k) for k, b in sorted(templates.items()) if a), key=lambda x: x[0], default=(0, ""))
            if best[0] >= 0.8:
                out.append((doc, n, best[1], round(best[0], 9)))
    return sorted(out, key=repr)


def fixture():
    rng = random.Random(4)
    rows = []
    for i in range(150):
        words = rng.choice(list(L.TEMPLATES.values())).split()
        for _ in range(rng.choice([0, 1, 2, len(words) // 8, len(words) // 4])):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], ["changed"], [words[at].upper()], [words[at], "more"]])
        line = " ".join(words)
        rows.append((i, rng.choice([line, f"some text\n{line}\n", f"{line}\n\nand more text that has nothing to do with it", "plain words only"])))
    return rows + [(900, None), (901, ""), (902, "License"), (903, "\n\n"), (None, rows[0][1]), (1, rows[1][1]), (904, "license " * 20_000)]


def test_matches_plain_sets(spark):
    rows = fixture()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, line string")
    want = plain(rows)
    assert len(want) > 60 and sorted(((r.doc_id, r.line, r.license, round(r.dice, 9)) for r in L.scan(df).collect()), key=repr) == want


def test_no_python_in_the_plan(spark):
    plan = L.scan(spark.createDataFrame([], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_empty_table(spark):
    assert L.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
