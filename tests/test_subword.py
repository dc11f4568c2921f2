"""Subword ids against the tiktoken library, round trips, pads."""

import base64
import random

import pytest
from conftest import SF0001

from tidewrack.operators import lm, subword

PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return subword.load_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("test", pat_str=subword.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(3)
    yield from ["", " ", "  ", "a  b\n\n c\t\td   ", "don't we'll I'D x's", "  　x   y\u0085", "\x1f a \x1e  \x1fb", "é你好 😀🇫🇷 ½²", "=" * 500, "ab" * 900]
    for _ in range(300):
        yield "".join(rng.choice(["the ", " The", "ing", "'s", " ", "  ", "\n", "12", "½", "é", "你", "😀", "#", "--", "\t", "x", "Zz", " "]) for _ in range(rng.randint(1, 40)))


def test_equal_to_the_library_and_back(spark, ranks, library):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([*rows, (-1, None)], "k long, text string").repartition(3)
    out = subword.decode(subword.encode(df, ranks), ranks)
    got = {r.k: (r.input_ids, r.decoded) for r in out.collect()}
    assert got.pop(-1) == ([], "")
    assert {k: ids for k, (ids, _) in got.items()} == {k: library.encode_ordinary(t) for k, t in rows}
    assert {k: t for k, (_, t) in got.items()} == dict(rows)


def test_whole_documents(spark, ranks, library):
    df = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text")
    for r in subword.encode(df, ranks).collect():
        assert r.input_ids == library.encode_ordinary(r.text or "")


def test_pads_and_skipped_ids(spark, ranks):
    pad = subword.pad_id(ranks)
    assert pad == 50256
    df = spark.createDataFrame([(1, "some text"), (2, "word " * 400), (3, None)], "k long, text string")
    rows = {r.k: r for r in lm.lm_rows(subword.encode(df, ranks), "k", pad_id=pad).collect()}
    assert all(len(r.input_ids) == len(r.attention_mask) == 128 and r.labels == r.input_ids for r in rows.values())
    assert rows[3].input_ids == [pad] * 128 and sum(rows[1].attention_mask) == 2 and sum(rows[2].attention_mask) == 128
    back = subword.decode(spark.createDataFrame(list(rows.values())).select("k", "input_ids"), ranks, skip=frozenset([pad]))
    assert {r.k: r.decoded for r in back.collect()}[1] == "some text"


def test_a_vocabulary_without_all_bytes_is_refused(tmp_path):
    f = tmp_path / "v"
    f.write_bytes(base64.b64encode(b"a") + b" 0\n")
    with pytest.raises(ValueError, match="byte-level"):
        subword.load_ranks(str(f))


def test_words_are_forgotten_without_changing_ids(spark, ranks, library, monkeypatch):
    assert [subword.merge(w.encode(), ranks) for w in [" the", "zqxj", "=" * 77]] == [library.encode_ordinary(w) for w in [" the", "zqxj", "=" * 77]]


def test_slices_and_flat_arrays_match_the_single_merge():
    """Rows cut anywhere, empty rows and a sliced array; each different pretoken is merged once."""
    import numpy as np
    import pyarrow as pa

    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257, b" ab": 258}
    rows = [["ab", " ab", "abcab"], [], ["ab"] * 7, ["é", "xabc"], []]
    array = pa.array([["cut"], *rows], pa.list_(pa.string())).slice(1)
    want = [[i for w in row for i in subword.merge(w.encode(), ranks)] for row in rows]
    for most in (1, 3, 100):
        cuts = list(subword._slices(array.offsets.to_numpy(), most))
        assert [c[0] for c in cuts] + [len(rows)] == [0] + [c[1] for c in cuts]
        seen = {}
        assert [r for a, b in cuts for r in subword.encode_words(array.slice(a, b - a), ranks, seen).to_pylist()] == want
    assert subword._gather(np.arange(10), np.array([8, 0, 3]), np.array([2, 0, 3])).tolist() == [8, 9, 3, 4, 5]


def test_short_and_long_merges_agree(monkeypatch):
    """Stepwise merges and the queue give the same ids, ties to the left included."""
    rng = random.Random(4)
    ranks = {bytes([b]): b for b in range(256)}
    for i in range(60):
        ranks.setdefault(bytes(rng.choice(b"ab") for _ in range(rng.randint(2, 5))), 256 + i)
    words = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, subword.SHORT))) for _ in range(400)]
    short = [subword.merge(w, ranks) for w in words]
    monkeypatch.setattr(subword, "SHORT", 0)
    assert short == [subword.merge(w, ranks) for w in words]
