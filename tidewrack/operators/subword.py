"""F10 with a pretrained subword vocabulary: byte-level pair merges by rank.

The vocabulary is a public rank file (a line for each token: its bytes in base64, and its
id, which is its rank); its path is a parameter and it is never trained or copied. Every
single byte is a token, so there is no unknown token and any text round-trips.

* ``pretokens`` splits a text by the vocabulary's pattern, on the JVM.
* ``encode`` merges, in each pretoken, the adjacent pair whose joined bytes have the lowest
  rank (the leftmost of equal ones) until no pair is a token. Pretokens are encoded once for
  each task that meets them: an Arrow UDF keeps the ids of those it has seen, and gathers
  the ids of a slice of rows in flat arrays, so its memory is bounded by the slice.
* ``decode`` joins the bytes of the ids, slice by slice; bytes that are no UTF-8 become U+FFFD.

The reserved ids come after the vocabulary's own: ``[PAD]`` is the first free id (F12: a
vocabulary without a pad token gets one), so ``lm.lm_rows`` takes ``pad_id(ranks)``.

Defined results: a null text has no ids, like an empty one. Nothing is shuffled; the rank
table (some 50,000 tokens, checked against ``MAX_TOKENS``) is broadcast.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: the split pattern of the public byte-level vocabularies -----------------
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# --------------------------------------------------------------------------------------------
MAX_TOKENS = 1_000_000
KEPT_WORDS = 200_000  # pretokens whose ids a task remembers
SHORT = 24  # bytes
MAX_RANK = 1 << 62
AT_ONCE = 250_000  # pretokens or ids that a task works on at a time (and one text at least)

Ranks = dict[bytes, int]


def load_ranks(path: str) -> Ranks:
    """The rank file as a table bytes -> id."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, map(bytes.strip, f)))}
    if len(ranks) > MAX_TOKENS or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError(f"{path}: not a byte-level vocabulary of up to {MAX_TOKENS} tokens")
    return ranks


def pad_id(ranks: Ranks) -> int:
    """the id of ``[PAD]``, the first one that the vocabulary leaves free."""
    return max(ranks.values()) + 1


def pretokens(text: Column | str) -> Column:
    """The text's pretokens in order; joined they are the text. Classes are Unicode's."""
    return F.regexp_extract_all(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit("(?U)" + PATTERN), F.lit(0))


def merge(word: bytes, ranks: Ranks) -> list[int]:
    """Ids of one pretoken. A short one looks at all its pairs in every step; a longer one
    keeps a queue of joinable neighbours by (rank, place)."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    if n <= SHORT:
        cuts = list(range(n + 1))
        pairs = [ranks.get(word[i : i + 2], MAX_RANK) for i in range(n - 1)]
        while pairs and (least := min(pairs)) < MAX_RANK:
            at = pairs.index(least)
            del cuts[at + 1], pairs[at]
            if at < len(pairs):
                pairs[at] = ranks.get(word[cuts[at] : cuts[at + 2]], MAX_RANK)
            if at:
                pairs[at - 1] = ranks.get(word[cuts[at - 1] : cuts[at + 1]], MAX_RANK)
        return [ranks[word[i:j]] for i, j in pairwise(cuts)]
    end = list(range(1, n + 1))  # of the part that begins here
    before = list(range(-1, n - 1))  # beginning of the part before it
    alive = [True] * n
    queue: list[tuple[int, int, int]] = []

    def offer(at: int) -> None:
        if at >= 0 and end[at] < n:
            stop = end[end[at]]
            rank = ranks.get(word[at:stop])
            if rank is not None:
                heapq.heappush(queue, (rank, at, stop))

    for at in range(n - 1):
        offer(at)
    while queue:
        _, at, stop = heapq.heappop(queue)
        if not alive[at] or end[at] >= n or end[end[at]] != stop:
            continue
        alive[end[at]] = False
        end[at] = stop
        if stop < n:
            before[stop] = at
        offer(before[at])
        offer(at)
    return [ranks[word[at : end[at]]] for at in range(n) if alive[at]]


def _slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with at most ``most`` values; a longer row is a run of its own."""
    at, n = 0, len(offsets) - 1
    while at < n:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, stop
        at = stop


def _gather(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The pieces ``pool[start : start + size]``, one after the other."""
    shift = starts - (np.cumsum(sizes) - sizes)
    return pool[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]


def encode_words(words: pa.ListArray, ranks: Ranks, seen: dict[str, list[int]]) -> pa.ListArray:
    """Ids of rows of pretokens: each different pretoken is merged once, the rest is gathered."""
    codes = words.flatten().dictionary_encode()
    parts = []
    for word in codes.dictionary.to_pylist():
        got = seen.get(word)
        if got is None:
            if len(seen) >= KEPT_WORDS:
                seen.clear()
            got = merge(word.encode(), ranks)
            if len(word) <= 64:
                seen[word] = got
        parts.append(got)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    pool = np.fromiter(chain.from_iterable(parts), np.int64, int(sizes.sum()))
    at = codes.indices.to_numpy(zero_copy_only=False)
    each = sizes[at]
    ends = np.concatenate([[0], np.cumsum(each)])
    offsets = words.offsets.to_numpy()
    return pa.ListArray.from_arrays(pa.array(ends[offsets - offsets[0]].astype(np.int32)), pa.array(_gather(pool, (np.cumsum(sizes) - sizes)[at], each)))


def encode(texts: DataFrame, ranks: Ranks, text: str = "text", out: str = "input_ids") -> DataFrame:
    """``texts`` with the ids of a text column (``array<bigint>``, as ``lm`` has them)."""
    held = texts.sparkSession.sparkContext.broadcast(ranks)

    @F.arrow_udf("array<bigint>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table, seen = held.value, {}
        for batch in batches:
            rows = [encode_words(batch.slice(a, b - a), table, seen) for a, b in _slices(batch.offsets.to_numpy(), AT_ONCE)]
            yield pa.concat_arrays(rows) if rows else pa.array([], pa.list_(pa.int64()))

    return texts.withColumn(out, ids(pretokens(text)))


def decode(rows: DataFrame, ranks: Ranks, ids: str = "input_ids", out: str = "decoded", skip: frozenset[int] = frozenset()) -> DataFrame:
    """The text of an id column. Ids of ``skip`` (pads, say) and null ids give nothing."""
    held = rows.sparkSession.sparkContext.broadcast(ranks)

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = sorted((i, t) for t, i in held.value.items() if i not in skip)
        known = np.array([i for i, _ in table], np.int64)
        sizes = np.array([len(t) for _, t in table], np.int64)
        pool, starts = np.frombuffer(b"".join(t for _, t in table), np.uint8), np.cumsum(sizes) - sizes
        for batch in batches:
            texts = []
            for a, b in _slices(batch.offsets.to_numpy(), AT_ONCE):
                some = batch.slice(a, b - a)
                # Null rows may keep values below them: lengths count, not offsets.
                length = pc.fill_null(pc.list_value_length(some), 0).to_numpy(zero_copy_only=False)
                values = some.flatten()
                keep = values.is_valid().to_numpy(zero_copy_only=False)
                flat = values.fill_null(0).to_numpy(zero_copy_only=False)
                if skip:
                    keep &= ~np.isin(flat, list(skip))
                at = np.minimum(np.searchsorted(known, flat), len(known) - 1)
                if (strange := flat[keep & (known[at] != flat)]).size:
                    raise KeyError(int(strange[0]))
                each = np.where(keep, sizes[at], 0)
                ends = np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], np.cumsum(length)])]
                joined = _gather(pool, starts[at], each).tobytes()
                texts.append(pa.array([joined[p:q].decode(errors="replace") for p, q in pairwise(ends.tolist())], pa.string()))
            yield pa.concat_arrays(texts) if texts else pa.array([], pa.string())

    return rows.withColumn(out, text(F.col(ids).cast("array<bigint>")))
