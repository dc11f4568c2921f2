"""F4 as a batch service: one model call for each distinct prompt, kept for the next run.

``answered(rows, backend, store)`` adds the model's answer to rows with a prompt column:

1. Prompts are reduced to their SHA-256 digests; equal prompts are one. Digests that the
   store has an answer for go no further.
2. The rest is dealt to ``chunks`` chunks by digest. A chunk is one write job: its prompts are
   range-partitioned and sorted by length, so that a batch the model gets holds prompts of
   about one length, and its answers are committed to the store as files of their own. A run
   that fails leaves the chunks before; run again, it calls the model for the others only.
3. The answers come back to the rows by digest (a shuffle join; AQE splits a very common
   prompt's rows).

The store is a parquet folder ``digest string, answer string``; nothing in it is rewritten.
It belongs to one model: give each its own. A null prompt has a null answer and no call.
``resources`` names a Spark resource profile for the stages that run the model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.operators import model_cache
from tidewrack.session import stage
from tidewrack.sources.table_store import _fs

CHUNKS = 16
STORE = "digest string, answer string"


def digest(prompt: str):
    return F.sha2(F.col(prompt), 256)


def stored(spark, store: str) -> DataFrame:
    fs, p, _ = _fs(spark, store)
    return spark.read.schema(STORE).parquet(store) if fs.exists(p) else spark.createDataFrame([], STORE)


def _generate(key: str, factory):
    def run(batches):
        model = model_cache.get(key, factory)
        for pdf in batches:
            if len(pdf):
                pdf["answer"] = list(model(pdf["prompt"].tolist()))
                yield pdf[["digest", "answer"]]

    return run


def answer_all(prompts: DataFrame, backend, store: str, prompt: str = "prompt", chunks: int = CHUNKS, resources=None) -> int:
    """Ask the model for every distinct prompt that the store has no answer for. Returns the
    number of chunks that were run."""
    spark = prompts.sparkSession
    wanted = prompts.where(F.col(prompt).isNotNull()).groupBy(digest(prompt).alias("digest")).agg(F.min(prompt).alias("prompt"))
    todo = stage(wanted.join(stored(spark, store).select("digest"), "digest", "left_anti").withColumn("chunk", F.pmod(F.xxhash64("digest"), F.lit(chunks)).cast("int")), "prompts-to-answer")
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    open_ = sorted(r.chunk for r in todo.select("chunk").distinct().collect())  # at most ``chunks``
    for chunk in open_:
        part = todo.where(F.col("chunk") == chunk).select("digest", "prompt", F.length("prompt").alias("n"))
        part = part.repartitionByRange(parallel, "n", "digest").sortWithinPartitions("n").drop("n")
        answers = part.mapInPandas(_generate(backend.key, backend.factory), STORE, profile=resources)
        answers.write.mode("append").parquet(store)
    return len(open_)


def answered(rows: DataFrame, backend, store: str, prompt: str = "prompt", out: str = "answer", chunks: int = CHUNKS, resources=None) -> DataFrame:
    """The rows with ``out``, the answer to their prompt."""
    answer_all(rows.select(prompt), backend, store, prompt, chunks, resources)
    # One answer for each digest, even if a chunk was committed twice.
    answers = stored(rows.sparkSession, store).groupBy(F.col("digest").alias("a_digest")).agg(F.min("answer").alias("a_answer"))
    joined = rows.withColumn("a_key", digest(prompt)).join(answers, F.col("a_key") == F.col("a_digest"), "left")
    return joined.withColumn(out, F.col("a_answer")).drop("a_key", "a_digest", "a_answer")
