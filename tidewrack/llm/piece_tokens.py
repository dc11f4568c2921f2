"""SentencePiece byte-pair encoding and decoding by vectorised merge rounds.

The model file gives pieces, scores and kinds; the ids are those that the library's BPE
model gives, for whole texts.

*Encoding.* A space becomes U+2581 and one more is put in front (``add_dummy_prefix``). No
piece holds U+2581 after another character (checked when the model is loaded), so a text
falls into *words* that begin with a run of them, and words are encoded on their own: the
distinct new words of about a million characters at once, in flat numpy arrays. A word is
cut further between two characters that stand side by side in no piece. Each *round*

1. looks up the piece that every two neighbouring symbols of a segment make together,
2. takes the smallest rank of each segment (rank: place by falling score, equal scores tie),
3. merges its leftmost non-overlapping occurrences at once, and
4. drops the merged symbols and the segments in which nothing can be merged any more.

One at a time, leftmost first, the merges are the same, unless a merge makes a pair of no
larger rank with a neighbour: that pair would be next. Then the segment's later occurrences
wait for another round. A segment with merges left after ``ROUNDS`` rounds (thousands of
spaces, say, where every merge makes such a pair) is finished by a priority queue.
A symbol that is no piece gives the byte pieces of its UTF-8 form.

*Decoding* gathers the pieces' bytes; U+2581 becomes a space, the first one goes; control
pieces give nothing, the unknown piece its surface; runs of byte pieces are UTF-8, and each
byte that is not gives U+FFFD.

Defined results: a null or empty text has no ids and decodes to the empty string; rows are
independent, so repeats give equal results; an empty table gives an empty result; an
existing column of the output's name is replaced, all others pass through.

Scale: no shuffle. The model (32,000 pieces, 0.5 MB) is the only thing broadcast. A task
holds one Arrow batch and at most ``KEPT`` word ids that it has encoded before.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # kinds of the file format
ROUNDS = 256
AT_ONCE = 1 << 18  # characters encoded together; a longer text goes in slices
KEPT = 500_000  # ids of encoded words that a task remembers
WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
NONE = np.iinfo(np.int64).max


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at : at + size]
            at += size


@dataclass(frozen=True)
class Model:
    """Pieces of a SentencePiece BPE model with byte fallback and no text rewriting."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    unknown: str

    @staticmethod
    def load(path: str) -> Model:
        pieces, trainer, normaliser = [], {}, {}
        with open(path, "rb") as f:
            for number, value in fields(f.read()):
                if number == 1:
                    x = dict(fields(value))
                    pieces.append((x[1].decode(), struct.unpack("<f", x.get(2, bytes(4)))[0], x.get(3, NORMAL)))
                elif number == 2:
                    trainer = dict(fields(value))
                elif number == 3:
                    normaliser = dict(fields(value))
        kinds = [k for *_, k in pieces]
        plain = [p for p, _, k in pieces if k in (NORMAL, UNUSED)]
        if trainer.get(3, 1) != 2 or kinds.count(BYTE) != 256 or USER in kinds:
            raise ValueError(f"{path}: not a BPE model with byte fallback and without user-defined pieces")
        if normaliser.get(2) or not normaliser.get(3, 1) or normaliser.get(4, 1) or not normaliser.get(5, 1) or trainer.get(24):
            raise ValueError(f"{path}: its text rewriting is not the plain one")
        if any(MARK in p.lstrip(MARK) for p in plain):
            raise ValueError(f"{path}: a piece spans words")
        return Model(*zip(*pieces, strict=True), trainer.get(44, " ⁇ ".encode()).decode())

    @cached_property
    def tables(self) -> Tables:
        return Tables(self)


class Tables:
    """Look-up arrays of a model, built once in a worker."""

    def __init__(self, model: Model):
        ids = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k in (NORMAL, UNUSED)}
        self.size = len(model.pieces)
        # Characters that stand in a piece without being one get symbols after the pieces.
        symbols = ids | {c: self.size + i for i, c in enumerate(sorted({c for p in ids for c in p if c not in ids}))}
        self.symbol = np.full(0x110000, -1, np.int64)
        for s, i in symbols.items():
            if len(s) == 1:
                self.symbol[ord(s)] = i
        self.wide = len(symbols) + self.size
        score = np.array(model.scores)
        self.rank = np.unique(-score, return_inverse=True)[1].astype(np.int64)
        pairs = sorted((symbols[p[:i]] * self.wide + symbols[p[i:]], k) for p, k in ids.items() for i in range(1, len(p)) if p[:i] in symbols and p[i:] in symbols)
        self.pair, self.product = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        # Pieces that a neighbour can extend to one of no larger rank.
        self.open = np.zeros(self.size, bool)
        for p, k in ids.items():
            for i in range(1, len(p)):
                for part in (p[:i], p[i:]):
                    if part in ids and self.rank[k] <= self.rank[ids[part]]:
                        self.open[ids[part]] = True
        self.beside = np.unique([ord(p[i]) << 21 | ord(p[i + 1]) for p in ids for i in range(len(p) - 1)])
        self.byte = np.zeros(256, np.int64)
        kinds = np.array(model.kinds)
        for i in np.flatnonzero(kinds == BYTE):
            self.byte[int(model.pieces[i][3:-1], 16)] = i
        # Decoding: the bytes that every id stands for.
        self.is_byte, self.is_control = kinds == BYTE, kinds == CONTROL
        self.marked = np.array([p.startswith(MARK) for p in model.pieces]) & ~self.is_byte & ~self.is_control
        surface = []
        for p, k in zip(model.pieces, model.kinds, strict=True):
            surface.append(bytes([int(p[3:-1], 16)]) if k == BYTE else b"" if k == CONTROL else model.unknown.encode() if k == UNKNOWN else p.replace(MARK, " ").encode())
        self.length = np.array([len(s) for s in surface], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.surface = np.frombuffer(b"".join(surface), np.uint8)

    def made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two symbols make together, -1: none."""
        key = np.where((left < 0) | (right < 0), -1, left * self.wide + right)
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.product[at], -1)

    def ranks(self, piece: np.ndarray) -> np.ndarray:
        return np.where(piece < 0, NONE, self.rank[piece])


def merge_rounds(t: Tables, symbol: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols left of every segment, each with the place of its first character.
    ``segment`` rises with the place."""
    at = np.arange(len(symbol))
    done: list[tuple[np.ndarray, np.ndarray]] = []
    piece = np.full(len(symbol), -1, np.int64)  # what a symbol makes with the next one

    def look_up(i: np.ndarray) -> None:
        i = i[(i >= 0) & (i + 1 < len(symbol))]
        i = i[segment[i] == segment[i + 1]]
        piece[i] = t.made(symbol[i], symbol[i + 1])

    look_up(np.arange(len(symbol)))
    for _ in range(ROUNDS):
        if not len(symbol):
            break
        rank = t.ranks(piece)
        first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
        size = np.diff(np.append(first, len(symbol)))
        least = np.minimum.reduceat(rank, first)
        ended = np.repeat(least == NONE, size)
        done.append((at[ended], symbol[ended]))
        chosen = np.flatnonzero((rank == np.repeat(least, size)) & ~ended)
        # Of overlapping occurrences every second one, from the left.
        run = np.append(True, np.diff(chosen) != 1)
        chosen = chosen[(np.arange(len(chosen)) - np.maximum.accumulate(np.where(run, np.arange(len(chosen)), 0))) % 2 == 0]
        new = piece[chosen]
        wait = np.zeros(len(chosen), bool)
        check = np.flatnonzero(t.open[new])
        if len(check):
            p, i = new[check], chosen[check]
            before = np.where((check > 0) & (chosen[check - 1] == i - 2), new[check - 1], symbol[i - 1])
            before = np.where((i > 0) & (segment[i - 1] == segment[i]), before, -1)
            after = np.minimum(i + 2, len(symbol) - 1)
            after = np.where((i + 2 < len(symbol)) & (segment[after] == segment[i]), symbol[after], -1)
            wait[check] = np.minimum(t.ranks(t.made(before, p)), t.ranks(t.made(p, after))) <= t.rank[p]
        if wait.any():
            stops = np.cumsum(wait) - wait
            of = segment[chosen]
            head = np.append(True, of[1:] != of[:-1])
            allowed = stops == np.maximum.accumulate(np.where(head, stops, 0))
            chosen, new = chosen[allowed], new[allowed]
        symbol = symbol.copy()
        symbol[chosen] = new
        keep = ~ended
        keep[chosen + 1] = False
        merged = (np.cumsum(keep) - 1)[chosen]
        piece[chosen] = -1
        at, symbol, segment, piece = at[keep], symbol[keep], segment[keep], piece[keep]
        look_up(merged)
        look_up(merged - 1)
    bounds = [*np.flatnonzero(np.append(True, segment[1:] != segment[:-1])), len(symbol)] if len(symbol) else []
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        left, rest = merge_queue(t, symbol[lo:hi])
        done.append((at[lo:hi][left], rest))
    places, symbols = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (at, symbol)
    order = np.argsort(places)
    return places[order], symbols[order]


def merge_queue(t: Tables, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for one segment by a priority queue: places and symbols left."""
    s = symbol.tolist()
    table = dict(zip(t.pair.tolist(), t.product.tolist(), strict=True))
    rank = t.rank.tolist()
    after, before = [*range(1, len(s)), -1], list(range(-1, len(s) - 1))
    queue: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j >= 0 and s[i] >= 0 and s[j] >= 0 and (p := table.get(s[i] * t.wide + s[j])) is not None:
            heapq.heappush(queue, (rank[p], i, s[i], s[j]))

    gone = bytearray(len(s))
    for i in range(len(s) - 1):
        offer(i)
    while queue:
        _, i, a, b = heapq.heappop(queue)
        j = after[i]
        if gone[i] or j < 0 or s[i] != a or s[j] != b:
            continue
        s[i] = table[a * t.wide + b]
        gone[j] = 1
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    left = np.flatnonzero(np.frombuffer(gone, np.uint8) == 0)
    return left, np.array(s, np.int64)[left]


def word_ids(t: Tables, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of the words, and how many each has."""
    code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    ends = np.cumsum([len(w) for w in words])
    cut = np.zeros(len(code), bool)
    cut[0] = True
    cut[ends[:-1]] = True
    pair = code[:-1] << 21 | code[1:]
    at = np.minimum(np.searchsorted(t.beside, pair), len(t.beside) - 1)
    cut[1:] |= t.beside[at] != pair
    place, symbol = merge_rounds(t, t.symbol[code], np.cumsum(cut))
    plain = (symbol >= 0) & (symbol < t.size)
    c = code[place]
    count = np.where(plain, 1, 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000))
    out = np.repeat(symbol, count)
    odd = np.flatnonzero(~plain)
    if len(odd):  # UTF-8 bytes: six bits each, the first one with its length marked
        many = np.repeat(count[odd], count[odd])
        char = np.repeat(c[odd], count[odd])
        nth = np.arange(len(many)) - np.repeat(np.cumsum(count[odd]) - count[odd], count[odd])
        bits = (char >> 6 * (many - 1 - nth)) & np.where(nth > 0, 0x3F, 0x7F)
        lead = np.where(many == 1, 0, np.where(nth > 0, 0x80, 0xF00 >> many & 0xFF))
        out[np.repeat(~plain, count)] = t.byte[bits | lead]
    word = np.searchsorted(ends, place, "right")
    return out.astype(np.int32), np.bincount(word, count, minlength=len(words)).astype(np.int64)


def slices(text: str) -> Iterator[str]:
    """The text with marks, in slices of about ``AT_ONCE`` characters that end with a word."""
    if not text:
        return
    text = MARK + text.replace(" ", MARK)
    lo = 0
    while lo < len(text):
        hi = text.find(MARK, lo + AT_ONCE)
        while 0 < hi and text[hi - 1] == MARK:
            hi = text.find(MARK, hi + 1)
        hi = len(text) if hi < 0 else hi
        yield text[lo:hi]
        lo = hi


class Encoder:
    """Ids of texts; remembers words between calls."""

    def __init__(self, tables: Tables):
        self.tables = tables
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.start, self.count = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids, and how many each word has."""
        new = list(set(words).difference(self.index))
        if new:
            if len(self.flat) > KEPT:
                self.forget()
                new = list(set(words))
            ids, count = word_ids(self.tables, new)
            self.index.update(zip(new, range(len(self.count), len(self.count) + len(new)), strict=True))
            self.start = np.append(self.start, len(self.flat) + np.cumsum(count) - count)
            self.count, self.flat = np.append(self.count, count), np.append(self.flat, ids)
        row = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        count = self.count[row]
        return self.flat[np.repeat(self.start[row] - np.cumsum(count) + count, count) + np.arange(count.sum())], count

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        size = 0

        def flush() -> None:
            nonlocal size
            words = [w for _, ws in held for w in ws]
            if words:
                ids, count = self.of_words(words)
                ends = np.append(0, np.cumsum(count))[np.cumsum([0] + [len(ws) for _, ws in held])]
                for (i, _), lo, hi in zip(held, ends[:-1], ends[1:], strict=True):
                    out[i].append(ids[lo:hi])
            held.clear()
            size = 0

        for i, text in enumerate(texts):
            for part in slices(text):
                held.append((i, WORDS.findall(part)))
                size += len(part)
                if size >= AT_ONCE:
                    flush()
        flush()
        return [np.concatenate(x) if len(x) > 1 else x[0] if x else np.zeros(0, np.int32) for x in out]


def decode_ids(t: Tables, ids: np.ndarray) -> bytes:
    """UTF-8 text of the ids."""
    if len(ids) and (ids.min() < 0 or ids.max() >= t.size):
        raise ValueError("an id is not of the model")
    text = np.flatnonzero(~t.is_control[ids])
    marked = len(text) and t.marked[ids[text[0]]]
    out, lo = [], 0
    while lo < len(ids):
        hi = min(len(ids), lo + AT_ONCE)
        while hi < len(ids) and t.is_byte[ids[hi]]:
            hi += 1
        part = ids[lo:hi]
        count = t.length[part]
        data = t.surface[np.repeat(t.start[part] - np.cumsum(count) + count, count) + np.arange(count.sum())].tobytes()
        raw = t.is_byte[part]
        if raw.any():
            data = repaired(data, raw, count)
        out.append(data)
        lo = hi
    return b"".join(out)[1 if marked else 0 :]


def repaired(data: bytes, raw: np.ndarray, count: np.ndarray) -> bytes:
    """The bytes with U+FFFD for each byte of a byte run that is no UTF-8."""
    edge = np.flatnonzero(np.diff(raw.astype(np.int8), prepend=0, append=0))
    place = np.append(0, np.cumsum(count))
    out, last = [], 0
    for lo, hi in zip(place[edge[0::2]].tolist(), place[edge[1::2]].tolist(), strict=True):
        try:
            data[lo:hi].decode()
        except UnicodeDecodeError:
            out += [data[last:lo], valid_or_replaced(data[lo:hi])]
            last = hi
    return b"".join([*out, data[last:]]) if out else data


def valid_or_replaced(run: bytes) -> bytes:
    out, at = [], 0
    while at < len(run):
        n = 1 if run[at] < 0x80 else 2 if run[at] < 0xE0 else 3 if run[at] < 0xF0 else 4
        try:
            run[at : at + n].decode()
        except UnicodeDecodeError:
            n = 1
            out.append("�".encode())
        else:
            out.append(run[at : at + n])
        at += n
    return b"".join(out)


def runs(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """The texts in runs of at most ``most`` bytes; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield texts.slice(at, stop - at)
        at = stop


def encode(docs: DataFrame, model_path: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of the text as ``array<int>``. The model file is read by the
    driver."""
    held = shared(docs.sparkSession, model_path)

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(held.value.tables)
        for batch in batches:
            rows = [pa.array([], pa.list_(pa.int32()))]
            for part in runs(batch, 4 * AT_ONCE):
                got = encoder.encode([x or "" for x in part.to_pylist()])
                ends = np.cumsum([0] + [len(x) for x in got]).astype(np.int32)
                rows.append(pa.ListArray.from_arrays(ends, np.concatenate(got)))
            yield pa.concat_arrays(rows)

    return docs.withColumn(out_col, ids(F.coalesce(F.col(text_col), F.lit(""))))


def decode(docs: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of the ids; null ids give the empty string."""
    held = shared(docs.sparkSession, model_path)

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = held.value.tables
        for batch in batches:
            rows = (np.asarray(x.values, np.int64) if x.is_valid else np.zeros(0, np.int64) for x in batch)
            yield pa.array([decode_ids(tables, x) for x in rows], pa.binary()).cast(pa.string())

    return docs.withColumn(out_col, text(F.col(ids_col).cast("array<int>")))


def shared(spark: SparkSession, model_path: str):
    return spark.sparkContext.broadcast(Model.load(model_path))


def digests(ids: Column, decoded: Column) -> list[Column]:
    return [F.size(ids).cast("long").alias("n_tokens"), F.sha2(F.array_join(ids.cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2(decoded, 256).alias("decoded_sha256")]


def op12_piece_tokens(spark, sf_dir: str, model: str = "piece_bpe_32k.model") -> DataFrame:
    import public_tokenizers

    from tidewrack.llm.common import table

    path = public_tokenizers.path(model)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decode(encode(docs, path), path).select("doc_id", *digests(F.col("ids"), F.col("decoded")))
