"""Counts and verdicts against plain loops."""

import random
import re

from tidewrack.llm import line_rules as L

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_metrics(text):
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    inside = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def normal_lines(text):
    out = {}
    for line in text.split("\n"):
        words = WORD.findall(line)
        if words:
            key = re.sub("[A-Z]", lambda m: m[0].lower(), " ".join(words))
            out[key] = out.get(key, 0) + len(words)
    return out


def fixture():
    rng = random.Random(6)
    words = ["a", "b", "c#", "dé", "E|f", "the", "of"]
    common = ["Common  footer line here", "common footer\tLINE here"]
    rows = []
    for i in range(90):
        lines = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 5))]
        lines += [rng.choice(common)] * rng.randint(0, 2)
        if i % 10 == 0:
            lines += [f"unique {i} " + " ".join(f"w{i}{j}" for j in range(30))]
        rows.append((i, "\n".join(lines), f"h{i % 2}"))
    return rows + [(500, None, "h0"), (501, "", None), (502, " \n\t\n", "h1"), (503, "x " * 9 + "\x0b y", None), (504, "long " * 30_000, "h0"), (1, rows[1][1], "h0")]


def test_matches_plain_loops(spark):
    rows = fixture()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, n_words int").repartition(3)
    got = {}
    for r in L.quality_rules(df, min_docs=5, share=0.05).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    df_count, docs = {}, {}
    for _, t, h in rows:
        docs[h] = docs.get(h, 0) + 1
        for line in normal_lines(t or ""):
            df_count[h, line] = df_count.get((h, line), 0) + 1
    for doc, t, h in rows:
        n, chars, symbols, dup, repeat = plain_metrics(t or "")
        r = got[doc][0]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        failed = n < 20 or 100 * repeat > 30 * n
        left = n - sum(w for line, w in normal_lines(t or "").items() if df_count[h, line] > max(5, 0.05 * docs[h]))
        assert (r.base_failed, r.n_words_left, r.kept) == (failed, left, not failed and left >= 0.5 * n)


def test_repeated_and_null_ids_of_one_host(spark):
    """Words are removed per row; a line's documents are counted, not its rows."""
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(70))
    common, copied = " ".join(f"c{j}" for j in range(30)), " ".join(f"d{j}" for j in range(40))
    rows = [(i, f"{own(i)}\n{common}", "h") for i in range(6)] + [(3, f"{own(3)}\n{common}", "h"), (3, own(300), "h")]
    rows += [(None, f"{own(20 + i)}\n{common}", "h") for i in range(8)] + [(None, own(40), "h"), (3, own(41), "other")]
    rows += [(50, f"{own(50)}\n{copied}", "h")] * 9
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = sorted(((r.doc_id, r.n_words, r.n_words_left, r.kept) for r in L.quality_rules(df, min_docs=5, share=0.0).collect()), key=repr)
    want = [(i, 70 + (30 if common in t else 40 if copied in t else 0), 110 if copied in t else 70, True) for i, t, _ in rows]
    assert got == sorted(want, key=repr)
    alone = spark.createDataFrame([(None, f"{own(i)}\n{common}", None) for i in range(6)], "doc_id long, text string, source string")
    assert [r.n_words_left for r in L.quality_rules(alone, min_docs=5, share=0.0).collect()] == [70] * 6


def test_empty_table(spark):
    assert L.quality_rules(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []
