"""Ids and texts against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tidewrack.llm import piece_tokens as T

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return T.Model.load(PATH)


def random_texts(model, n):
    rng = random.Random(5)
    plain = [p for p, k in zip(model.pieces, model.kinds, strict=True) if k == T.NORMAL]
    for k in range(n):
        yield ("".join(rng.choice(plain) for _ in range(rng.randint(1, 30))).replace(T.MARK, " "),
               "".join(chr(rng.choice([rng.randint(1, 0x250), rng.randint(0x300, 0xD7FF), rng.randint(0x10000, 0x1FFFF)])) for _ in range(rng.randint(0, 40))),
               "".join(rng.choice(" ▁ab\n\t") for _ in range(rng.randint(0, 60))),
               "".join(rng.choice("aeinorst") for _ in range(rng.randint(1, 400))),
               "".join(rng.choice("=-_*#/\\.0123456789abcdef") for _ in range(rng.randint(1, 900))))[k % 5]


def test_equal_to_the_library(library, model):
    texts = [*random_texts(model, 1500), "", " ", "   ", "\x00", "</s><0x41>", " " * 5000 + "x", "a" * 3000, "=" * 4000 + " y"]
    got = T.Encoder(model.tables).encode(texts)
    assert [x.tolist() for x in got] == [library.encode(t) for t in texts]
    assert [T.decode_ids(model.tables, x).decode() for x in got] == [library.decode(x.tolist()) for x in got]


def test_slices_and_forgetting_change_nothing(library, model, monkeypatch):
    monkeypatch.setattr(T, "AT_ONCE", 50)
    monkeypatch.setattr(T, "KEPT", 20)
    monkeypatch.setattr(T, "ROUNDS", 2)
    texts = [*random_texts(model, 60), "one  two   three " * 40, "emoji 😀🇫🇷 und ßtraße" * 9]
    got = T.Encoder(model.tables).encode(texts)
    assert [x.tolist() for x in got] == [library.encode(t) for t in texts]
    assert [T.decode_ids(model.tables, x).decode() for x in got] == [library.decode(x.tolist()) for x in got]


def test_any_ids_decode_as_in_the_library(library, model):
    rng = random.Random(2)
    for _ in range(3000):
        pool = [0, 1, 2, 259, 260, 28705, *(rng.randint(3, 258) for _ in range(6)), *(rng.randint(0, 31999) for _ in range(4))]
        ids = [rng.choice(pool) for _ in range(rng.randint(0, 8))]
        assert T.decode_ids(model.tables, np.array(ids, np.int64)).decode() == library.decode(ids)
    with pytest.raises(ValueError):
        T.decode_ids(model.tables, np.array([32000]))


def test_columns(spark, library):
    rows = [(1, "Some words, some words.", "x"), (1, "Some words, some words.", "x"), (2, None, "y"), (3, "", "z"), (None, "é 你好 \n\n", None), (4, "long text " * 60_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = T.decode(T.encode(docs, PATH), PATH)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    got = sorted(map(repr, out.select("doc_id", *T.digests(out.ids, out.decoded)).collect()))
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        want.append(f"Row(doc_id={i}, n_tokens={len(ids)}, ids_sha256='{sha[0]}', decoded_sha256='{sha[1]}')")
    assert got == sorted(want)
    assert T.decode(T.encode(docs.limit(0), PATH), PATH).collect() == []


def test_query_over_documents(spark, library):
    import duckdb

    from conftest import SF0001

    got = {r.doc_id: r[1:] for r in T.op12_piece_tokens(spark, SF0001).collect()}
    rows = duckdb.execute(f"SELECT doc_id, text FROM '{SF0001}/documents.parquet'").fetchall()
    assert len(got) == len(rows)
    for i, t in rows:
        ids = library.encode(t or "")
        assert got[i] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())


def test_texts_are_encoded_in_runs_of_bounded_bytes():
    import pyarrow as pa

    texts = ["é" * 3, None, "", "a" * 20, "b", "c" * 5]
    array = pa.array(["cut", *texts]).slice(1)
    parts = [p.to_pylist() for p in T.runs(array, 6)]
    assert parts == [["é" * 3, None, ""], ["a" * 20], ["b", "c" * 5]]
    assert list(T.runs(pa.array([], pa.string()), 6)) == []
