"""Token datasets (F10-F12): corpus vocabulary, encoding, fixed-length LM rows.

Two vocabularies: a pretrained subword one (``operators.subword``, as the original uses),
or, here, one built over the corpus itself: tokens (P12) counted, ranked by (count desc,
token asc), with reserved ids first (F12: ``[PAD]`` = 0, ``[UNK]`` = 1).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewrack.functions.text import word_tokens
from tidewrack.operators.joins import small_side
from tidewrack.operators.order import global_row_number
from tidewrack.session import small_batches, stage

# --- fixed values ---------------------------------------------------------------------
PAD, UNK = "[PAD]", "[UNK]"
RESERVED = (PAD, UNK)
MAX_LENGTH = 128
# ----------------------------------------------------------------------------------------
TOKENS_PER_PACK = 1 << 20


def vocabulary(texts: DataFrame, text: str = "text") -> DataFrame:
    """(token, id, count), staged. Counting is a map-side-combined aggregate; the rank is
    a global row number over range blocks (the vocabulary grows with the corpus)."""
    counts = texts.select(F.explode(word_tokens(text)).alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).cast("long").alias("count"))
    ranked = global_row_number(counts, [("count", False), ("token", True)], "_rank")
    spark = texts.sparkSession
    reserved = spark.createDataFrame([(t, i, 0) for i, t in enumerate(RESERVED)], "token string, id long, count long")
    vocab = reserved.unionByName(ranked.select("token", (F.col("_rank") + len(RESERVED) - 1).alias("id"), "count"))
    # Staged once: the size check and the join then read a small parquet table instead of
    # re-running the ranking (the vocabulary is far smaller than the corpus).
    return stage(vocab, "vocab")


def token_packs(texts: DataFrame, key: str, tokens: Column, tokens_per_pack: int = TOKENS_PER_PACK) -> DataFrame:
    """Runs of texts as one row each, staged: ``_pack``, their ``keys`` and token counts
    ``sizes``, their distinct ``words``, and every token's place in these (``refs``, int32)."""
    key_type = texts.schema[key].dataType

    def run(batches):
        base, packs = TaskContext.get().partitionId() << 32, 0
        held, total = [], 0
        for batch in batches:
            held.append(batch)
            total += len(batch.column(1).flatten())
            if total >= tokens_per_pack:
                yield packed(held, base + packs)
                held, total, packs = [], 0, packs + 1
        if held:
            yield packed(held, base + packs)

    def packed(held: list[pa.RecordBatch], pack: int) -> pa.RecordBatch:
        keys = pa.concat_arrays([b.column(0) for b in held])
        sizes = pa.concat_arrays([pc.fill_null(pc.list_value_length(b.column(1)), 0) for b in held])
        words = pa.concat_arrays([b.column(1).flatten() for b in held]).dictionary_encode()
        whole = lambda x: pa.ListArray.from_arrays([0, len(x)], x)
        refs = words.indices.cast(pa.int32()).to_numpy().tobytes()
        return pa.RecordBatch.from_arrays([pa.array([pack]), whole(keys), whole(sizes.cast(pa.int32())), whole(words.dictionary), pa.array([refs], pa.binary())], names=["_pack", "keys", "sizes", "words", "refs"])

    schema = T.StructType([T.StructField("_pack", T.LongType()), T.StructField("keys", T.ArrayType(key_type)), T.StructField("sizes", T.ArrayType(T.IntegerType())),
                           T.StructField("words", T.ArrayType(T.StringType())), T.StructField("refs", T.BinaryType())])
    with small_batches(texts.sparkSession):
        return stage(texts.select(key, tokens.alias("_tokens")).mapInArrow(run, schema), "token-packs")


def encode(texts: DataFrame, vocab: DataFrame, key: str, text: str = "text", length: int | None = None) -> DataFrame:
    """(key, input_ids), a row for each text, of the first ``length`` tokens if given.

    Tokens never become rows. Runs of texts are packed with their distinct words; only these
    are joined with the vocabulary (broadcast if its bytes are few), each once per pack, so
    a very common token is spread over all of them. Then a pack meets its words' ids, and
    every token takes its own."""
    tokens = word_tokens(text)
    tokens = F.slice(tokens, 1, length) if length else tokens
    packs = token_packs(texts, key, tokens)
    v = small_side(vocab.select("token", F.col("id").alias("_tid")))
    words = packs.select("_pack", F.posexplode("words").alias("i", "token")).join(v, "token", "left")
    ids = words.select(F.col("_pack").alias("_of"), "i", F.coalesce("_tid", F.lit(RESERVED.index(UNK)).cast("long")).alias("_tid"))

    def unpacked(pack: pa.Table, ids: pa.Table) -> pa.Table:
        table = np.empty(len(ids), np.int64)
        table[ids.column("i").to_numpy()] = ids.column("_tid").to_numpy()
        keys, sizes, refs = (pack.column(c)[0] for c in ("keys", "sizes", "refs"))
        offsets = np.concatenate([[0], np.cumsum(sizes.values.to_numpy())]).astype(np.int32)
        flat = pa.array(table[np.frombuffer(refs.as_buffer(), np.int32)])
        return pa.table({key: keys.values, "input_ids": pa.ListArray.from_arrays(pa.array(offsets), flat)})

    schema = T.StructType([texts.schema[key], T.StructField("input_ids", T.ArrayType(T.LongType()))])
    return packs.select("_pack", "keys", "sizes", "refs").groupBy("_pack").cogroup(ids.groupBy("_of")).applyInArrow(unpacked, schema)


def fixed_length(ids: Column, length: int = MAX_LENGTH, pad_id: int = 0):
    """truncate and right-pad to ``length``; mask 1 for real tokens; labels copy the
    padded ids (pads are not masked in the labels, as in the original)."""
    cut = F.slice(ids, 1, length)
    n = F.size(cut)
    padded = F.concat(cut, F.array_repeat(F.lit(pad_id).cast("long"), F.lit(length) - n))
    mask = F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(length) - n))
    return padded, mask


def lm_rows(encoded: DataFrame, key: str, length: int = MAX_LENGTH, pad_id: int = 0) -> DataFrame:
    padded, mask = fixed_length(F.col("input_ids"), length, pad_id)
    return encoded.select(key, padded.alias("input_ids"), mask.alias("attention_mask"), padded.alias("labels"))
