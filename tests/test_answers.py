"""F4 as a service: calls, resumption, reuse."""

import pytest

from tidewrack.operators import answers as A
from tidewrack.operators.infer import ModelBackend


def backend(log, fails=None):
    def factory():
        def generate(prompts):
            with open(log, "a") as f:
                f.writelines(p + "\n" for p in prompts)
            if fails and any(fails in p for p in prompts):
                raise RuntimeError("model lost")
            return [p.upper() for p in prompts]

        return generate

    return ModelBackend(factory)


def calls(log):
    return sorted(log.read_text().split("\n")[:-1]) if log.exists() else []


def test_one_call_for_each_distinct_prompt(spark, tmp_path):
    log, store = tmp_path / "log", str(tmp_path / "store")
    df = spark.createDataFrame([(i, f"prompt {i % 7}") for i in range(100)] + [(-1, None)], "k long, prompt string").repartition(4)
    got = {r.k: r.answer for r in A.answered(df, backend(log), store).collect()}
    assert got == {i: f"PROMPT {i % 7}" for i in range(100)} | {-1: None}
    assert calls(log) == [f"prompt {i}" for i in range(7)]
    more = df.unionByName(spark.createDataFrame([(500, "a new one")], "k long, prompt string"))
    got = {r.k: r.answer for r in A.answered(more, backend(log), store).collect()}
    assert got[500] == "A NEW ONE" and got[3] == "PROMPT 3" and len(calls(log)) == 8


def test_a_rerun_after_a_failure_asks_for_the_rest_only(spark, tmp_path):
    log, store = tmp_path / "log", str(tmp_path / "store")
    df = spark.createDataFrame([(i, f"prompt {i}") for i in range(40)], "k long, prompt string")
    bad = "prompt 17"
    with pytest.raises(Exception, match="model lost"):
        A.answered(df, backend(log, fails=bad), store, chunks=8)
    kept = {r.digest for r in A.stored(spark, store).collect()}
    log.unlink()
    got = {r.k: r.answer for r in A.answered(df, backend(log), store, chunks=8).collect()}
    assert got == {i: f"PROMPT {i}" for i in range(40)}
    assert len(calls(log)) == len(set(calls(log))) == 40 - len(kept) < 40


def test_batches_are_of_about_one_length(spark, tmp_path):
    lengths = tmp_path / "lengths"

    def factory():
        def generate(prompts):
            with open(lengths, "a") as f:
                f.write(f"{min(map(len, prompts))} {max(map(len, prompts))}\n")
            return prompts

        return generate

    df = spark.createDataFrame([(f"{i:03d}" + "x" * i,) for i in range(400)], "prompt string")
    A.answer_all(df, ModelBackend(factory), str(tmp_path / "store"), chunks=1)
    spans = sorted(tuple(map(int, line.split())) for line in lengths.read_text().splitlines())
    assert len(spans) > 1 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], "prompt string")
    assert A.answered(df, backend(tmp_path / "log"), str(tmp_path / "store")).collect() == [] and calls(tmp_path / "log") == []
