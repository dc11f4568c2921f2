"""Removal of long repeated byte strings by a sparse, range-partitioned suffix array.

Every byte covered by a ``WINDOW``-byte string that also starts anywhere else (same
document included) is removed. Exact, on whole texts; matches never cross documents.

*Sampled suffixes.* Sorting the suffix of every byte would move hundreds of times the
input. Instead a document is anchored at the positions whose ``SEED``-byte hash is the
smallest among the seeds of some window (ties all count). The choice depends on the
window's own bytes only, so two equal windows have an anchor at the same offset ``d``,
0 <= d <= WINDOW - SEED. About one byte in 120 is an anchor.

1. *Candidates.* Equal windows share ``WINDOW / 2`` bytes to the right or to the left of
   their anchor. The hashes of these two strings are counted; an anchor with both unique
   takes no further part. (A hash collision keeps a needless candidate, never loses one.)
2. *Suffix buckets.* A remaining anchor carries its context: up to WINDOW - SEED bytes
   before and WINDOW bytes from the anchor on. Of documents with one text only one gives
   contexts, counted twice; equal contexts are combined per task, and those of a bucket are
   packed into one row before they move.
   Sampled splitters range-partition the contexts by the suffix's bytes into buckets of
   bounded size. Each bucket sorts its suffixes, and its reversed prefixes, by
   multikey quicksort (8-byte keys, only ties go on to the next key) and takes the common
   lengths of neighbours. For each ``d``, two contexts hold the same window iff they are in
   one class of prefixes at depth d and one class of suffixes at depth WINDOW - d; the
   classes follow from the neighbours' common lengths, so no pair is ever formed.
3. *Boundaries.* Only contexts with equal seeds can match, and a seed's run is contiguous
   in suffix order, so bounds are moved to the beginning of a run. A run that is longer
   than a bucket (a very common passage) is split, and its contexts go into a second set of
   buckets, by their reversed prefixes. Two of them that meet in neither share with a bound
   of each order what they have in common there, so few windows can be left: these are
   combined inside each bucket and compared by 128-bit digests, dealt out by digest.
4. The windows found at an anchor all contain it, so their union is one span; spans are
   merged per document and cut out.

Defined results: a null text is empty (0 bytes, digest of nothing); texts shorter than the
window keep all bytes; a row that occurs twice is a copy of itself and loses its windows;
rows with a null id are kept like others; extra columns are ignored; an empty table gives
an empty result.

Scale: shuffles are two rows of 40 bytes per anchor, the texts once, the contexts of
repeated regions, and digests of boundary runs. All hot strings are combined per task
before they move.
"""

from __future__ import annotations

import bisect
import ctypes
import hashlib
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.llm.common import BASE, BASE_INV, BYTE_CODE, U64, _powers, map_rows, mix, prefix_hash, span, texts
from tidewrack.session import small_batches, stage

WINDOW = 400
SEED = 16
PIECE = 1 << 18  # bytes handled at once; longer documents go in overlapping pieces


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of ``w`` values: block-wise prefix and suffix minima."""
    n = len(x)
    pad = np.full(-n % w, np.iinfo(np.uint64).max, U64)
    blocks = np.concatenate([x, pad]).reshape(-1, w)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - w + 1], forward[w - 1 : n])


def anchors(p: np.ndarray, starts: np.ndarray, window: int = WINDOW, seed: int = SEED) -> np.ndarray:
    """Anchor positions in a run of texts that begin at ``starts`` (the last entry is the
    end), from its prefix hash. Windows that cross a text's end have no anchor."""
    n, w = len(p) - 1, window - seed + 1
    if n < window:
        return np.zeros(0, np.int64)
    h = mix((p[seed:] - p[:-seed]) * _powers("down", BASE_INV, n)[: n - seed + 1]) >> U64(1)
    least = sliding_min(h, w)
    room = np.repeat(starts[1:], np.diff(starts))[: n - window + 1] - np.arange(n - window + 1)
    top = np.iinfo(np.uint64).max
    # Inverted, so that the largest minimum over the windows around a seed is again a minimum.
    inverted = np.where(room >= window, top - least, top)
    edge = np.full(w - 1, top, U64)
    best = sliding_min(np.concatenate([edge, inverted, edge]), w)
    return np.flatnonzero(top - best == h)


def pieces(sizes: list[int], window: int = WINDOW, piece: int = PIECE):
    """Groups of (text, from, to) of about ``piece`` bytes; pieces of one text overlap by
    window - 1 bytes so that each window lies in exactly one."""
    group, total = [], 0
    for i, n in enumerate(sizes):
        at = 0
        while n - at >= window:
            end = min(n, at + piece + window - 1)
            group.append((i, at, end))
            total += end - at
            if total >= piece:
                yield group
                group, total = [], 0
            if end == n:
                break
            at += piece
    if group:
        yield group


def half_keys(p: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, window: int, seed: int):
    """For the half windows right and left of the anchors that lie in their text, [low, high):
    which anchors have one, and its key."""
    half = window // 2
    for salt, first in ((1, at), (2, at + seed - half)):
        has = np.flatnonzero((first >= low) & (first + half <= high))
        yield has, mix(span(p, first[has], first[has] + half), salt)


def anchor_keys(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """``key, doc_id, th, pos``: the two half-window keys of every anchor."""

    def run(batches):
        for batch in batches:
            col = batch.column(2).cast(pa.binary())
            for group in pieces(pc.binary_length(col).to_pylist(), window):
                p = prefix_hash(np.frombuffer(b"".join(col[i].as_py()[s:e] for i, s, e in group), np.uint8))
                starts = np.concatenate([[0], np.cumsum([e - s for _, s, e in group])])
                at = anchors(p, starts, window, seed)
                which = np.searchsorted(starts, at, "right") - 1
                row, begin = (np.array(x)[which] for x in zip(*((i, s) for i, s, _ in group), strict=True))
                for has, key in half_keys(p, at, starts[which], starts[which + 1], window, seed):
                    rows = pa.array(row[has])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows), pa.array((at - starts[which] + begin)[has].astype(np.int64))],
                        names=["key", "doc_id", "th", "pos"])

    return docs.mapInArrow(run, "key long, doc_id long, th long, pos long")


CONTEXT = "bucket int, contexts binary"
PER_BUCKET = 12_000  # anchors for which a bucket is planned
PER_SPLIT = 40  # sampled contexts for one splitter
IN_PACK = 20  # contexts in one row, at most
PACKS_AT_ONCE = 64  # rows of packs in one Arrow batch, at most
BATCH_BYTES = 1 << 20  # of rows that go to a Python worker at once


def contexts_of(text: bytes, at: list[int], window: int, seed: int):
    for a in at:
        left, right = text[max(0, a - window + seed) : a], text[a : a + window]
        yield xxhash.xxh3_128_digest(len(left).to_bytes(4, "big") + left + right), right, left[::-1]


def splitters(hits: DataFrame, window: int, seed: int, per_bucket: int) -> tuple[list[tuple[bytes, bytes]], list[tuple[bytes, bytes, bytes]], frozenset[bytes]]:
    """Bucket bounds (suffix, reversed prefix) from a sample of documents, one for about
    every ``per_bucket`` anchors, the bounds (seed, reversed prefix, suffix) of the split
    runs in their second order, and the seeds whose run is split.

    A bound moves back to the beginning of its seed's run, so that the run stays in one
    bucket. Only a run that several bounds fall into is split inside, there by whole
    strings, so equal suffixes split by their prefixes."""
    total = hits.agg(F.sum(F.size("at"))).first()[0] or 0
    buckets = max(1, -(-total // per_bucket))
    if buckets == 1:
        return [], [], frozenset()

    def run(batches):
        for batch in batches:
            found = {(r, left) for t, at in zip(texts(batch.column(0)), batch.column(1), strict=True) for _, r, left in contexts_of(t, at.as_py()[::4], window, seed)}
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*found, strict=True)], names=["suffix", "prefix"])

    share = min(1.0, 4 * PER_SPLIT * buckets / total)
    rows = hits.select("text", "at").sample(share, 7).mapInArrow(run, "suffix binary, prefix binary").distinct().toArrow()
    sample = sorted(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True))
    picked = sorted({sample[i * len(sample) // buckets] for i in range(1, buckets)}) if sample else []
    bounds, split, last = [], set(), None
    for suffix, prefix in picked:
        start = suffix[:seed]
        if start == last:
            split.add(start)
            bounds.append((suffix, prefix))
        else:
            bounds.append((start, b""))
        last = start
    inside = sorted((suffix[:seed], prefix, suffix) for suffix, prefix in sample if suffix[:seed] in split)
    return bounds, inside[:: max(1, len(sample) // buckets)][1:], frozenset(split)


def pack_contexts(rows: list[tuple[bytes, int, bytes, bytes]]) -> bytes:
    """(context digest, count, suffix, prefix) rows as one string."""
    head = np.array([[n, len(r), len(left)] for _, n, r, left in rows], "<i4")
    return len(rows).to_bytes(4, "little") + head.tobytes() + b"".join(c + r + left for c, _, r, left in rows)


def unpack_contexts(data: bytes):
    n = int.from_bytes(data[:4], "little")
    at = 4 + 12 * n
    for copies, right, left in np.frombuffer(data, "<i4", 3 * n, 4).reshape(-1, 3).tolist():
        mid, end = at + 16 + right, at + 16 + right + left
        yield data[at : at + 16], copies, data[at + 16 : mid], data[mid:end]
        at = end


def distinct_contexts(hits: DataFrame, held, window: int, seed: int) -> DataFrame:
    """Contexts of the anchors, packed by their buckets, equal ones combined within a few
    thousand. ``hits`` has ``text, at, copies``; ``held`` is a broadcast of the splitters.
    The buckets of the second order come after those of the first."""

    def packed(found: dict):
        bounds, second, split = held.value
        by: dict[int, list] = {}
        for ctx, (n, r, left) in found.items():
            row = (ctx, min(n, 2), r, left)
            by.setdefault(bisect.bisect_right(bounds, (r, left)), []).append(row)
            if r[:seed] in split:
                by.setdefault(len(bounds) + 1 + bisect.bisect_right(second, (r[:seed], left, r)), []).append(row)
        packs = [(b, rows[i : i + IN_PACK]) for b, rows in by.items() for i in range(0, len(rows), IN_PACK)]
        for i in range(0, len(packs), PACKS_AT_ONCE):
            part = packs[i : i + PACKS_AT_ONCE]
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in part], pa.int32()), pa.array([pack_contexts(rows) for _, rows in part], pa.binary())], names=["bucket", "contexts"])

    def run(batches):
        found: dict[bytes, list] = {}
        for batch in batches:
            for text, at, copies in zip(texts(batch.column(0)), batch.column(1), batch.column(2).to_pylist(), strict=True):
                for ctx, right, left in contexts_of(text, at.as_py(), window, seed):
                    if ctx in found:
                        found[ctx][0] += copies
                    else:
                        found[ctx] = [copies, right, left]
                if len(found) >= 8192:
                    yield from packed(found)
                    found = {}
        if found:
            yield from packed(found)

    return hits.select("text", "at", "copies").mapInArrow(run, CONTEXT)


def byte_matrix(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Zero-padded rows of bytes, and the true lengths."""
    width += -width % 8
    rows = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width)
    return rows, np.array([len(s) for s in strings], np.int64)


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Order of the rows by their bytes: multikey quicksort with 8-byte keys. Rows that
    are told apart leave; the ties go on to the next key."""
    keys = np.ascontiguousarray(rows).view(">u8")
    order = np.arange(len(rows))
    group = np.zeros(len(rows), np.int64)  # by place in the order
    open_ = np.arange(len(rows))
    for k in range(keys.shape[1]):
        if not len(open_):
            break
        key = keys[order[open_], k].astype(np.uint64)
        by = np.lexsort((key, group[open_]))
        order[open_] = order[open_][by]
        key, g = key[by], group[open_]
        new = np.ones(len(open_), bool)
        new[1:] = (g[1:] != g[:-1]) | (key[1:] != key[:-1])
        group[open_] = open_[np.maximum.accumulate(np.where(new, np.arange(len(open_)), 0))]
        alone = new & np.append(new[1:], True)
        open_ = open_[~alone]
    return order


def neighbour_lcp(rows: np.ndarray, length: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common length of each row in order with the one before it (first: 0)."""
    out = np.zeros(len(order), np.int64)
    for lo in range(1, len(order), 8192):
        a, b = order[lo - 1 : min(len(order), lo + 8192) - 1], order[lo : lo + 8192]
        diff = rows[a] != rows[b]
        first = np.where(diff.any(axis=1), diff.argmax(axis=1), rows.shape[1])
        out[lo : lo + len(b)] = np.minimum(first, np.minimum(length[a], length[b]))
    return out


def twice(key: np.ndarray) -> np.ndarray:
    """Which entries occur at least twice."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def solve(suffix: np.ndarray, s_len: np.ndarray, prefix: np.ndarray, p_len: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest offset ``d`` of a window that another row holds too
    (largest -1: none). Rows must be distinct contexts."""
    n = len(s_len)
    low, high = np.full(n, window, np.int64), np.full(n, -1, np.int64)
    if n < 2:
        return low, high
    place, reach, lcps = [], [], []
    for rows, length in ((suffix, s_len), (prefix, p_len)):
        order = multikey_order(rows)
        lcp = neighbour_lcp(rows, length, order)
        at = np.empty(n, np.int64)
        at[order] = np.arange(n)
        place.append(at)
        reach.append(np.maximum(lcp, np.append(lcp[1:], 0))[at])
        lcps.append(lcp)
    rows = np.flatnonzero(reach[0] + reach[1] >= window)
    if len(rows) < 2:
        return low, high
    for d in range(int(max(0, window - reach[0][rows].max())), int(min(window - seed, reach[1][rows].max())) + 1):
        live = rows[(reach[0][rows] >= window - d) & (reach[1][rows] >= d)]
        if len(live) < 2:
            continue
        s_class = np.cumsum(lcps[0] < window - d)[place[0][live]]
        p_class = np.cumsum(lcps[1] < d)[place[1][live]]
        live = live[twice(s_class * (n + 1) + p_class)]
        low[live] = np.minimum(low[live], d)
        high[live] = d
    return low, high


def common_length(a: bytes, b: bytes) -> int:
    """Common length of two strings."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))
    return int(differ[0]) if len(differ) else n


def open_offsets(suffix: bytes, prefix: bytes, bounds: list[tuple[bytes, bytes]], second: list[tuple[bytes, bytes, bytes]], window: int, seed: int) -> tuple[int, int]:
    """Smallest and largest offset ``d`` of a window that a context may share with one that
    is in another bucket in both orders (largest below smallest: none). Bounds lie between
    such contexts, so each begins with what the two have in common in its order."""
    i = bisect.bisect_right(bounds, (suffix, prefix))
    low = window - max((common_length(suffix, b) for b, _ in bounds[max(0, i - 1) : i + 1]), default=0)
    if low > len(prefix):
        return low, -1
    i = bisect.bisect_right(second, (suffix[:seed], prefix, suffix))
    return low, max((common_length(prefix, p) for s, p, _ in second[max(0, i - 1) : i + 1] if s == suffix[:seed]), default=-1)


_second = mix(BYTE_CODE, 5) | U64(1)


def window_digests(context: bytes, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the windows that start at ``offsets`` of the context."""
    b = np.frombuffer(context, np.uint8)
    one = span(prefix_hash(b), offsets, offsets + window)
    q = np.zeros(len(b) + 1, U64)
    np.cumsum(_second[b] * _powers("up", BASE, len(b))[: len(b)], out=q[1:])
    return one, mix((q[offsets + window] - q[offsets]) * _powers("down", BASE_INV, len(b))[offsets], 9)


BUCKET = "ctx binary, low int, high int, target int, digests binary"
DIGEST = np.dtype([("a", "<u8"), ("b", "<u8"), ("n", "<i4"), ("d", "<i4"), ("ctx", "S16")])


def combined(rows: np.ndarray) -> np.ndarray:
    """One row for each digest, in digest order; ``n`` is summed, up to 2."""
    order = np.lexsort((rows["b"], rows["a"]))
    rows = rows[order]
    at = first_of(rows)
    out = rows[at].copy()
    out["n"] = np.minimum(np.add.reduceat(rows["n"], at), 2) if len(at) else 0
    return out


def first_of(rows: np.ndarray) -> np.ndarray:
    """Where a new digest begins in sorted rows."""
    new = np.ones(len(rows), bool)
    new[1:] = (rows["a"][1:] != rows["a"][:-1]) | (rows["b"][1:] != rows["b"][:-1])
    return np.flatnonzero(new)


DIGESTS_AT_ONCE = 200_000
IN_DIGESTS = 400  # digests in one row, at most: a page of Parquet takes 100 rows or more


def sort_buckets(contexts: DataFrame, held, window: int, seed: int, targets: int) -> DataFrame:
    """One pass over the range-partitioned contexts, bucket by bucket: the offsets found
    inside the bucket (``ctx, low, high``), and packed digests of the windows of split runs
    that may occur in a bucket met in neither order (``target, digests``). ``held`` is a
    broadcast of the splitters."""

    def run(batches):
        give_back()
        found: dict[bytes, list] = {}
        now = None
        for batch in batches:
            for bucket, contexts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if bucket != now and found:
                    yield from solved(found, now)
                    found = {}
                now = bucket
                for c, n, s, p in unpack_contexts(contexts.as_py()):
                    if c in found:
                        found[c][0] += n
                    else:
                        found[c] = [n, s, p]
        if found:
            yield from solved(found, now)

    def solved(found: dict, bucket: int):
        bounds, second, split = held.value
        ctx = list(found)
        suffix, s_len = byte_matrix([found[c][1] for c in ctx], window)
        prefix, p_len = byte_matrix([found[c][2] for c in ctx], window - seed)
        copies = np.array([found[c][0] for c in ctx])
        low, high = solve(suffix, s_len, prefix, p_len, window, seed)
        # A context that occurs twice repeats all its windows.
        whole = copies > 1
        low[whole] = np.maximum(0, window - s_len[whole])
        high[whole] = p_len[whole]
        sure = np.flatnonzero(high >= 0)
        none = pa.nulls(len(sure))
        names = ["ctx", "low", "high", "target", "digests"]
        yield pa.RecordBatch.from_arrays([pa.array([ctx[i] for i in sure], pa.binary()), pa.array(low[sure], pa.int32()), pa.array(high[sure], pa.int32()), none.cast(pa.int32()), none.cast(pa.binary())], names=names)
        rows = np.zeros(0, DIGEST)
        edge = [(i, *open_offsets(*found[c][1:], bounds, second, window, seed)) for i, c in enumerate(ctx) if found[c][1][:seed] in split] if bucket <= len(bounds) else []
        edge = [x for x in edge if x[1] <= x[2]]
        for k in range(0, len(edge), 128):
            parts = [rows]
            for i, first, last in edge[k : k + 128]:
                d = np.arange(first, last + 1)
                part = np.zeros(len(d), DIGEST)
                part["a"], part["b"] = window_digests(found[ctx[i]][2][::-1] + found[ctx[i]][1], p_len[i] - d, window)
                # One window lies around several anchors: only equal offsets are two places.
                part["a"] = mix(part["a"] + d.astype(U64))
                part["n"], part["d"], part["ctx"] = min(2, copies[i]), d, ctx[i]
                parts.append(part)
            # Equal windows of the bucket go out once; that they repeat is known from above.
            rows = combined(np.concatenate(parts))
            if len(rows) >= DIGESTS_AT_ONCE:
                yield from packs(rows, names)
                rows = rows[:0]
        yield from packs(rows, names)

    def packs(rows: np.ndarray, names: list[str]):
        to = (rows["a"] >> U64(32)).astype(np.int64) * targets >> 32
        cuts = [*np.flatnonzero(np.diff(to, prepend=-1)), len(to)]  # sorted by digest, so by target
        parts = [(i, min(i + IN_DIGESTS, hi)) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True) for i in range(lo, hi, IN_DIGESTS)]
        for k in range(0, len(parts), PACKS_AT_ONCE):
            some = parts[k : k + PACKS_AT_ONCE]
            none = pa.nulls(len(some))
            yield pa.RecordBatch.from_arrays([none.cast(pa.binary()), none.cast(pa.int32()), none.cast(pa.int32()), pa.array([int(to[lo]) for lo, _ in some], pa.int32()), pa.array([rows[lo:hi].tobytes() for lo, hi in some], pa.binary())], names=names)

    return contexts.mapInArrow(run, BUCKET)


def compare_boundaries(packs: DataFrame, targets: int) -> DataFrame:
    """``ctx, low, high`` of windows that are single in their own buckets but occur in
    the boundary run of another one as well."""

    def run(batches):
        for group in by_target(batches):
            rows = np.concatenate([np.frombuffer(x, DIGEST) for x in group])
            rows = rows[np.lexsort((rows["b"], rows["a"]))]
            at = first_of(rows)
            total = np.repeat(np.add.reduceat(rows["n"], at), np.diff(np.append(at, len(rows))))
            hit = rows[(total > 1) & (rows["n"] == 1)]
            if len(hit):
                yield pa.RecordBatch.from_arrays([pa.array([x.ljust(16, b"\0") for x in hit["ctx"].tolist()], pa.binary()), pa.array(hit["d"], pa.int32()), pa.array(hit["d"], pa.int32())], names=["ctx", "low", "high"])

    def by_target(batches):
        held, now = [], None
        for batch in batches:
            for t, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if t != now and held:
                    yield held
                    held = []
                now = t
                held.append(x)
        if held:
            yield held

    return packs.repartition(targets, "target").sortWithinPartitions("target").mapInArrow(run, "ctx binary, low int, high int")


def occurrences(hits: DataFrame, window: int, seed: int) -> DataFrame:
    def make(batch: pa.RecordBatch) -> dict:
        out = {"doc_id": [], "th": [], "pos": [], "ctx": []}
        for i, th, text, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2)), batch.column(3).to_pylist(), strict=True):
            for a, (ctx, _, _) in zip(at, contexts_of(text, at, window, seed), strict=True):
                for k, v in (("doc_id", i), ("th", th), ("pos", a), ("ctx", ctx)):
                    out[k].append(v)
        return out

    return map_rows(hits.select("doc_id", "th", "text", "at"), "doc_id long, th long, pos long, ctx binary", make)


def cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal merged spans, and the text without them."""
    merged: list[list[int]] = []
    for s, e in sorted(spans):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    keep, at = [], 0
    for s, e in merged:
        keep.append(text[at:s])
        at = e
    keep.append(text[at:])
    return [tuple(m) for m in merged], b"".join(keep)


def give_back() -> None:
    """Workers are used again: what earlier stages freed goes back to the system."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def with_copies(docs: DataFrame, at: DataFrame) -> DataFrame:
    """``at`` with ``copies`` for one of the documents of each text: how many have it, up to
    2. Null for the others, whose contexts are the same."""
    rows = docs.select("doc_id", "th", F.md5("text").alias("md"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("first")
    texts_ = rows.groupBy(F.col("md").alias("m_md")).agg(first, F.least(F.count(F.lit(1)), F.lit(2)).cast("int").alias("copies"))
    chosen = texts_.select(F.col("first.doc_id").alias("c_id"), F.col("first.th").alias("c_th"), "copies")
    return at.join(chosen.groupBy("c_id", "c_th").agg(F.max("copies").alias("copies")), (F.col("a_th") == F.col("c_th")) & F.col("a_id").eqNullSafe(F.col("c_id")), "left").drop("c_id", "c_th")


def repeated_spans(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """``(hits, spans)``: the documents that hold candidates with their texts, and the
    byte spans ``doc_id, th, spans`` to remove (they may overlap)."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = stage(anchor_keys(docs.select("doc_id", "th", "text"), window, seed), "anchor-keys")
    common = keys.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("key").alias("k"))
    at = keys.join(common, F.col("key") == F.col("k"), "left_semi").groupBy(F.col("doc_id").alias("a_id"), F.col("th").alias("a_th")).agg(F.sort_array(F.collect_set("pos")).alias("at"))
    at = with_copies(docs, at)
    hits = stage(docs.join(at, (F.col("th") == F.col("a_th")) & F.col("doc_id").eqNullSafe(F.col("a_id")), "inner").select("doc_id", "th", "text", "at", "copies"), "hit-docs")
    single = hits.where("copies IS NOT NULL")
    held = docs.sparkSession.sparkContext.broadcast(splitters(single, window, seed, PER_BUCKET))
    contexts = distinct_contexts(single, held, window, seed).repartition("bucket").sortWithinPartitions("bucket")
    buckets = stage(sort_buckets(contexts, held, window, seed, partitions), "suffix-buckets")
    across = compare_boundaries(buckets.where("target IS NOT NULL").select("target", "digests"), partitions)
    found = (
        buckets.where("target IS NULL").select("ctx", "low", "high").unionByName(across)
        .groupBy("ctx").agg(F.min("low").alias("low"), F.max("high").alias("high")).withColumnRenamed("ctx", "f_ctx")
    )
    where = occurrences(hits, window, seed).join(found, F.col("ctx") == F.col("f_ctx"), "inner")
    spans = where.groupBy(F.col("doc_id").alias("s_id"), F.col("th").alias("s_th")).agg(
        F.collect_list(F.struct((F.col("pos") - F.col("high")).alias("s"), (F.col("pos") - F.col("low") + window).alias("e"))).alias("spans"))
    return hits, stage(spans, "repeated-spans")


def suffix_dedup(docs: DataFrame, *, window: int = WINDOW, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` where
    ``kept`` is the text that is left, null where nothing was removed."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).select("doc_id", F.xxhash64("text").alias("th"), "text")
    with small_batches(docs.sparkSession, size=BATCH_BYTES):
        hits, spans = repeated_spans(docs, window, seed)

    def make(batch: pa.RecordBatch) -> dict:
        out = {"c_id": batch.column(0), "c_th": batch.column(1), "n_removed": [], "n_spans": [], "sha": [], "kept": []}
        for text, at in zip(texts(batch.column(2)), batch.column(3), strict=True):
            merged, rest = cut(text, [(x["s"], x["e"]) for x in at.as_py()])
            out["n_removed"].append(len(text) - len(rest))
            out["n_spans"].append(len(merged))
            out["sha"].append(hashlib.sha256(rest).hexdigest())
            out["kept"].append(rest)
        return out

    rest = map_rows(
        hits.join(spans, (F.col("th") == F.col("s_th")) & F.col("doc_id").eqNullSafe(F.col("s_id")), "inner").select("doc_id", "th", "text", "spans"),
        "c_id long, c_th long, n_removed long, n_spans long, sha string, kept binary", make).dropDuplicates(["c_id", "c_th"])
    every = docs.select("doc_id", "th", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha_all"))
    return every.join(rest, (F.col("th") == F.col("c_th")) & F.col("doc_id").eqNullSafe(F.col("c_id")), "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("sha", "sha_all").alias("kept_sha256"), "kept")


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    from tidewrack.llm.common import table

    return suffix_dedup(table(spark, sf_dir, "documents")).drop("kept")
