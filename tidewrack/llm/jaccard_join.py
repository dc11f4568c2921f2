"""Size-aware heavy-light Jaccard join on word shingles, as linked components.

A document's set holds its distinct word shingles. Two sets link when
``100 * |x & y| >= percent * |x | y|``, that is when their difference (shingles of one but
not of the other) is at most ``(|x| + |y|) * (100 - percent) // (100 + percent)``.

Equal sets are one class (set hash and size); only classes are joined.

*Light sets* (up to ``light_limit`` shingles): a linked pair differs by one shingle, so
the smaller set is a subset of the larger one with one shingle left out. Sets enumerate
these fixed-size subsets and meet on the subset's hash.

*Heavy sets*: inverted lists. By ascending size, sets fall in classes such that a linked
partner lies in the same or one of the next ``steps`` classes; the pairs whose smaller set
is in a class differ by at most H shingles.
The shingles are dealt by hash to m > H blocks, so a linked pair agrees on at least m - H
whole blocks, and the lists are keyed on a block's content instead of one shingle: a
frequent phrase alone makes no list. Blocks with fewer than two shingles say little and
are not entered. If a set has fewer than m - H of them, its deal is good: one of the blocks
it shares with any partner is a larger one. Else it enters the larger blocks of the next
deal as well, and so on up to its first good one of ``DEALS``. A linked pair meets in the
earlier of its first good deals, which both have entered. Only pairs of sets without a good
deal are left: these enter the small blocks of the first deal, each keyed together with the
blocks of another, independent one, of which one must agree, too. ``layout`` picks steps
and m so that a deal is good with a margin that grows with the size: entries are linear in
the size, and only small sets are without a good deal. Of a good deal H + 1 larger blocks are
entered, those that come first: at most H differ, so a shared one is among them.

The boundary is the size up to which enumeration costs less than list entries with their
share of checks.

The sets and their keys are made for many texts at once. A task packs its entries by bucket
of the key, and the lists of one bucket are gathered in a task; lists of the same sets are
kept once, with their number.

A list is not expanded into pairs. Its members are checked against one centre, the one
that stands in most lists (of a group of near copies, the least edited), and linked into
components. In a light list the centre is the subset itself, and no two others can link. The
heavy lists that still lie in several components are taken together by their centre. What
the members of such a group differ in from the centre is worked out once. Groups of up to
``GROUP`` members are settled by these differences: ``|x ^ y| = |(x ^ c) ^ (y ^ c)|``. A group
is cut into tiles of about ``TILE`` members; two tiles at a time, the members of each
component are held against those of the others (frequent differences by a product of 0-1
matrices, rare ones by an inverted index), which gives a link for every pair of components
joined. This takes the square of the group in quick steps. In a larger group, two members that
link, not both of them with the centre c, have ``|(x ^ c) & (y ^ c)| > 0``: they share
shingles in which they differ from the centre. With h the largest difference of linked sets
of this size, the h + 1 smallest of a member's differing shingles hold a shared one (prefix
filter). The members meet again in lists of centre and differing shingle, without the centre
and without what is common to the group; lists inside one component are dropped, the others
go through the same steps. No link between components is lost, and no list is expanded into
pairs.

Defined results: null or word-less texts have the empty set, n_shingles 0 and link with
nothing; with fewer words than a shingle the whole sequence is the one shingle; repeated
rows are copies; a component's id is its smallest non-null doc_id; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.llm.common import NOT_WS, U64, mix, runs, shingle_hashes, texts, word_hashes
from tidewrack.llm.components import connected_components, with_edges
from tidewrack.session import small_batches, stage

CHECK_COST = 4  # list entries that one check of a candidate is worth
MAX_WORDS = 1 << 31
GROUP = 64_000  # members of a centre's lists up to which they are settled tile by tile
TILE = 1_000
TILE_BYTES = 4_000_000  # of differences
DENSE = 8  # a shingle in which one member of so many differs is worth a column of a matrix
DEALS = 12  # deals that a set tries for one in which few blocks are small
LIGHT_LISTS = 255  # a key's low byte: its heavy class, or this
BATCH = 4_000_000  # bytes of rows that a Python task gets at once
CHUNK = 200_000  # bytes of text whose sets are made together
FLUSH = 400_000  # list entries that are packed together
SLOTS = 1 << 22  # by which keys that stand alone are found
ENTRY = np.dtype([("key", "<i8"), ("sk", "<i8"), ("n", "<i4")])


@dataclass(frozen=True)
class Rule:
    """When sets link: shingle length in words and Jaccard similarity in percent."""

    shingle: int = 3
    percent: int = 90

    def links(self, both, n, m):
        return 100 * both >= self.percent * (n + m - both)

    def difference(self, n: int, m: int) -> int:
        return (n + m) * (100 - self.percent) // (100 + self.percent)

    def partner(self, n: int) -> int:
        """Largest size that links with size n."""
        return n * 100 // self.percent

    @cached_property
    def least(self) -> int:
        """Smallest size that links with a different set."""
        n = 1
        while self.difference(n, n + 1) < 1:
            n += 1
        return n

    @cached_property
    def light_limit(self) -> int:
        """Largest size whose pairs differ by one shingle at most and whose subsets cost
        less than its lists."""
        n = self.least - 1
        while self.difference(n + 1, self.partner(n + 1)) <= 1 and 2 + n <= 2 * blocks_for(self.difference(n + 1, self.partner(n + 1))) * (1 + CHECK_COST):
            n += 1
        return n

    @cached_property
    def layout(self) -> tuple[int, int, int]:
        """Classes that a partner may lie ahead, tenths of blocks more than needed, and the
        shingles below which a block is small: the cheapest by which small blocks are rarer
        than spare ones in the smallest set of a class. Single-shingle blocks are entered
        only where it does not go without (some 70 percent); further down, where a block
        mostly is empty, the ones that come nearest, and long sets cost their square."""
        def margin(steps: int, spare: int, small: int) -> float:
            per_block = 1 / ((1 + 100 / self.percent) * (100 - self.percent) / (100 + self.percent) * (1 + spare / 10) * (100 / self.percent) ** (1 / steps))
            return spare / (10 + spare) - math.exp(-per_block) * (1 + per_block * (small - 1))

        options = sorted(((k, c, small) for k in (1, 2, 3, 4) for c in (3, 5, 8, 10) for small in (1, 2)), key=lambda o: (-o[2], (o[0] + 1) * (10 + o[1]), o))
        return next((o for o in options if margin(*o) >= 0.03), max(options, key=lambda o: margin(*o)))

    @property
    def steps(self) -> int:
        return self.layout[0]

    @cached_property
    def classes(self) -> np.ndarray:
        """First sizes of the heavy classes: ``steps`` of them from one size to its partner."""
        first, out = self.light_limit + 1, []
        while first < MAX_WORDS:
            out += [int(first * (100 / self.percent) ** (i / self.steps)) for i in range(self.steps)]
            first = self.partner(first) + 1
        return np.array([*sorted({*out}), first])

    def heavy(self, scheme: int) -> tuple[int, int]:
        """H and the number of blocks for pairs whose smaller set is in the class."""
        top = int(self.classes[scheme + 1]) - 1
        h = self.difference(top, self.partner(top))
        return h, blocks_for(h, self.layout[1])

    @cached_property
    def all_heavy(self) -> np.ndarray:
        """``heavy`` of every class."""
        return np.array([self.heavy(i) for i in range(len(self.classes) - 1)], np.int64)


def blocks_for(difference: int, spare: int = 3) -> int:
    """``spare`` tenths more than needed, so that small blocks can be passed over."""
    return difference + 2 + spare * difference // 10


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    """Distinct shingle hashes, sorted; ASCII letters in lower case."""
    return np.unique(shingle_hashes(word_hashes(np.frombuffer((text or b"").lower(), np.uint8)), k))


def shingle_sets(many: list[bytes | None], k: int) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_set`` of each text, one after the other, and where each begins (and the last
    ends)."""
    b = np.frombuffer(b" ".join([t or b"" for t in many]).lower(), np.uint8)
    starts = np.cumsum([0, *(len(t or b"") + 1 for t in many)])
    spans = runs(NOT_WS.take(b))
    hashes, at = word_hashes(b, spans), np.searchsorted(spans[0], starts)
    words = np.diff(at)
    count = np.where(words < k, np.minimum(words, 1), words - k + 1)
    begin = np.append(0, np.cumsum(count))
    flat = np.zeros(begin[-1], U64)
    for i in np.flatnonzero((words > 0) & (words < k)):
        flat[begin[i]] = shingle_hashes(hashes[at[i] : at[i + 1]], k)[0]
    if (words >= k).any():
        long = np.repeat(words >= k, count)
        flat[long] = shingle_hashes(hashes, k)[(np.arange(begin[-1]) + np.repeat(at[:-1] - begin[:-1], count))[long]]
    for lo, hi in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        flat[lo:hi].sort()
    new = np.append(True, flat[1:] != flat[:-1]) if len(flat) else np.zeros(0, bool)
    new[begin[:-1][count > 0]] = True
    return flat[new], np.append(0, np.cumsum(new))[begin]


def set_key(x: np.ndarray) -> np.uint64:
    return set_keys(x, np.array([0, len(x)]))[0]


def set_keys(x: np.ndarray, begin: np.ndarray) -> np.ndarray:
    total = np.append(U64(0), np.cumsum(mix(x, 3)))[begin]
    return mix(np.diff(total) + np.diff(begin).astype(U64), 4)


BLOCK = U64(0x9E3779B97F4A7C15)


def deal(x: np.ndarray, blocks: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Content hash and number of shingles of each block."""
    to = ((mix(x, salt) >> U64(32)) * U64(blocks) >> U64(32)).astype(np.int64)
    content = np.zeros(blocks, U64)
    np.add.at(content, to, mix(x, salt + 1))
    return mix(content + np.arange(blocks).astype(U64) * BLOCK, salt + 2), np.bincount(to, minlength=blocks)


def tagged(key: np.ndarray, lists: int | np.ndarray) -> np.ndarray:
    return (key & ~U64(255)) | np.asarray(lists).astype(U64)


def list_keys(x: np.ndarray, rule: Rule) -> np.ndarray:
    """Keys of the lists a set stands in."""
    n, out = len(x), []
    if n < rule.least:
        return np.zeros(0, U64)
    if n <= rule.light_limit + 1:
        each = mix(x, 6)
        whole = each.sum(dtype=np.uint64)
        if n <= rule.light_limit:
            out.append(tagged(mix(np.array([whole + U64(n)], U64), 7), LIGHT_LISTS))
        out.append(tagged(mix(whole - each + U64(n - 1), 7), LIGHT_LISTS))
    if n > rule.light_limit:
        own = int(np.searchsorted(rule.classes, n, "right")) - 1
        for scheme in range(max(0, own - rule.steps), own + 1):
            out += scheme_keys(x, rule, scheme)
    return np.concatenate(out)


def scheme_keys(x: np.ndarray, rule: Rule, scheme: int, first: int = 0) -> list[np.ndarray]:
    """Keys of a set's lists of a heavy class, from deal ``first`` on. Of a good deal the first
    ``h + 1`` larger blocks are entered, h being the largest difference: one of them is shared
    with any partner, and no later one of the partner's first ``h + 1``."""
    h, m = rule.all_heavy[scheme].tolist()
    out, small = [], rule.layout[2]
    for turn in range(first, DEALS):
        key, count = deal(x, m, 10 if not turn else 40 + 10 * turn)
        large = np.flatnonzero(count >= small)
        out.append(tagged(mix(key[large[: h + 1]] + U64(scheme), 16), scheme))
        if len(large) > h:
            return out
    key, count = deal(x, m, 10)
    few = mix(key + U64(scheme), 16)[count < small]
    other, _ = deal(x, m, 20)
    return [*out, tagged(mix(few[:, None] ^ (other[None, :] * U64(3)), 17).ravel(), scheme)]


def keys_of_sets(x: np.ndarray, begin: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """``list_keys`` of many sets, and the number of the set that each key is of. Only the sets
    that need a second deal are taken one by one."""
    n, keys, of = np.diff(begin), [], []

    def add(i, more):
        for key in more:
            keys.append(key)
            of.append(np.full(len(key), i))

    for i in np.flatnonzero((n >= rule.least) & (n <= rule.light_limit + 1)):
        add(i, [list_keys(x[begin[i] : begin[i + 1]], rule)])
    to_block, content = mix(x, 10) >> U64(32), mix(x, 11)
    own = np.searchsorted(rule.classes, n, "right") - 1
    for back in range(rule.steps + 1):
        sets = np.flatnonzero((n > rule.light_limit + 1) & (own >= back))
        if not len(sets):
            continue
        scheme = own[sets] - back
        h, m = rule.all_heavy[scheme].T
        first = np.append(0, np.cumsum(m))
        inside = np.repeat(np.isin(np.arange(len(n)), sets), n)
        block = (to_block[inside] * np.repeat(m, n[sets]).astype(U64) >> U64(32)).astype(np.int64) + np.repeat(first[:-1], n[sets])
        total = np.zeros(first[-1], U64)
        np.add.at(total, block, content[inside])
        large = np.flatnonzero(np.bincount(block, minlength=first[-1]) >= rule.layout[2])
        upto = np.searchsorted(large, first)
        held = np.diff(upto)
        entered = np.minimum(held, h + 1)
        set_ = np.repeat(np.arange(len(sets)), entered)
        large = large[np.arange(len(set_)) + np.repeat(upto[:-1] - np.cumsum(entered) + entered, entered)]
        key = mix(total[large] + (large - first[set_]).astype(U64) * BLOCK, 12)
        keys.append(tagged(mix(key + scheme[set_].astype(U64), 16), scheme[set_]))
        of.append(sets[set_])
        for i in np.flatnonzero(held <= h):
            add(sets[i], scheme_keys(x[begin[sets[i]] : begin[sets[i] + 1]], rule, int(scheme[i]), 1))
    return (np.concatenate(keys), np.concatenate(of)) if keys else (np.zeros(0, U64), np.zeros(0, np.int64))


ROWS = "key long, sk long, n int, label long"
LISTS = "doc_id long, th long, n int, sk long, key long, lists long"


def chunks(batches, column: int):
    """A few rows of a batch at a time: the rows, and their texts (``CHUNK`` bytes or one)."""
    for batch in batches:
        first, held, size = 0, [], 0
        for i, t in enumerate(texts(batch.column(column))):
            held.append(t)
            size += len(t or b"")
            if size >= CHUNK or i + 1 == batch.num_rows:
                yield batch.slice(first, i + 1 - first), held
                first, held, size = i + 1, [], 0


def entry_batches(*columns: np.ndarray):
    for lo in range(0, len(columns[0]), 200_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + 200_000]) for c in columns], names=["key", "sk", "n", "label"])


def packed(entries: np.ndarray, buckets: int) -> pa.RecordBatch:
    """The entries of each bucket of keys as one binary value."""
    to = (entries["key"].view(U64) >> U64(32)) * U64(buckets) >> U64(32)
    order = np.argsort(to.astype(np.uint16 if buckets < 1 << 16 else np.int64), kind="stable")
    size = np.bincount(to.astype(np.int64), minlength=buckets)
    held = np.flatnonzero(size)
    ends = np.append(0, np.cumsum(size[held] * ENTRY.itemsize)).astype(np.int32)
    values = pa.Array.from_buffers(pa.binary(), len(held), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(entries[order]))])
    none = pa.nulls(len(held), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), none, none, none.cast(pa.int32()), none, values], names=["bucket", "doc_id", "th", "n", "sk", "entries"])


def postings(docs: DataFrame, rule: Rule, buckets: int) -> DataFrame:
    """A row ``doc_id, th, n, sk`` for each document (sk is null for the empty set), in any
    bucket; and the list entries, packed by ``bucket`` of their key. Equal sets of a task are
    entered once."""

    def run(batches):
        seen, held, size = set(), [], 0
        for batch, many in chunks(batches, 2):
            x, begin = shingle_sets(many, rule.shingle)
            n, sk = np.diff(begin).astype(np.int32), set_keys(x, begin).view(np.int64)
            to = mix(batch.column(1).to_numpy().view(U64) + np.arange(len(n)).astype(U64), 34) % U64(buckets)
            yield pa.RecordBatch.from_arrays([pa.array(to.astype(np.int32)), *batch.columns[:2], pa.array(n), pa.array(sk, mask=n == 0), pa.nulls(len(n), pa.binary())], names=["bucket", "doc_id", "th", "n", "sk", "entries"])
            new = np.zeros(len(n), bool)
            for i in np.flatnonzero(n >= rule.least):
                new[i] = (key := int(sk[i])) not in seen
                seen.add(key)
            if not new.any():
                continue
            keys, of = keys_of_sets(x[np.repeat(new, n)], np.append(0, np.cumsum(n[new])), rule)
            entries = np.empty(len(keys), ENTRY)
            entries["key"], entries["sk"], entries["n"] = keys.view(np.int64), sk[new][of], n[new][of]
            held.append(entries)
            size += len(entries)
            if size >= FLUSH:
                yield packed(np.concatenate(held), buckets)
                held, size = [], 0
        if size:
            yield packed(np.concatenate(held), buckets)

    return docs.select("doc_id", "th", "text").mapInArrow(run, "bucket int, doc_id long, th long, n int, sk long, entries binary")


def scan_postings(postings: DataFrame, buckets: int) -> DataFrame:
    """The documents' rows, and the lists of several sets. One task holds the entries of one
    bucket."""

    def run(batches):
        held = []
        for batch in batches:
            entries = batch.column(5)
            held += [np.frombuffer(e.as_buffer(), ENTRY) for e in entries if e.is_valid]
            rows = batch.filter(entries.is_null())
            if rows.num_rows:
                none = pa.nulls(rows.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([*rows.columns[1:5], none, none], names=["doc_id", "th", "n", "sk", "key", "lists"])
        if held:
            all_ = np.concatenate(held)
            held.clear()
            key, sk, n = (np.ascontiguousarray(all_[c]) for c in ENTRY.names)
            yield from list_batches(*several_sets(key, sk, n, sk))

    return postings.repartitionById(buckets, "bucket").mapInArrow(run, LISTS)


def list_batches(key: np.ndarray, sk: np.ndarray, n: np.ndarray, lists: np.ndarray):
    for lo in range(0, len(key), 200_000):
        at = slice(lo, lo + 200_000)
        none = pa.nulls(len(key[at]), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, *(pa.array(c[at]) for c in (n, sk, key, lists))], names=["doc_id", "th", "n", "sk", "key", "lists"])


def difference_lists(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Entries of lists by (centre ``a``, differing shingle) for the members ``b``."""

    def run(batches):
        last, c = None, None
        for batch in batches:
            keys, sks, sizes, labels, held = [], [], [], [], 0
            for a, sk, label, xa, xb in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if a != last:
                    last, c = a, np.frombuffer(xa, U64)
                x = np.frombuffer(xb, U64)
                differ = np.setxor1d(c, x, assume_unique=True)[: rule.difference(len(x), rule.partner(len(x))) + 1]
                keys.append(tagged(mix(differ ^ mix(np.array([a], np.int64).view(U64), 31), 32), 0).view(np.int64))
                for column, value in ((sks, sk), (sizes, len(x)), (labels, label)):
                    column.append(np.full(len(differ), value, np.int32 if column is sizes else np.int64))
                held += len(differ)
                if held >= 200_000:
                    yield from entry_batches(*map(np.concatenate, (keys, sks, sizes, labels)))
                    keys, sks, sizes, labels, held = [], [], [], [], 0
            if held:
                yield from entry_batches(*map(np.concatenate, (keys, sks, sizes, labels)))

    return with_sets(pairs, sets).mapInArrow(run, ROWS)


def several_sets(key: np.ndarray, sk: np.ndarray, n: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, ...]:
    """``key, sk, n, lists``: the lists whose sets have two or more labels. Lists of the same
    sets become one, with a key of these sets and the number of such ``lists``."""
    # Most lists hold one entry: before the sort, out with keys that are alone in their slot.
    for shift in (40, 16):
        slot = (key.view(U64) >> U64(shift) & U64(SLOTS - 1)).astype(np.int64)
        again = np.bincount(slot, minlength=SLOTS)[slot] > 1
        key, sk, n, label = key[again], sk[again], n[again], label[again]
    if not len(key):
        return key, sk, n, key
    order = np.lexsort((sk, n, key))
    key, sk, n, label = key[order], sk[order], n[order], label[order]
    new_list = np.append(True, key[1:] != key[:-1])
    distinct = new_list | np.append(True, sk[1:] != sk[:-1])
    key, sk, n, label, new_list = key[distinct], sk[distinct], n[distinct], label[distinct], new_list[distinct]
    at = np.flatnonzero(new_list)
    size = np.diff(np.append(at, len(key)))
    light = (key[at] & 255) == LIGHT_LISTS
    # A light list without the subset itself holds no link.
    keep = (np.minimum.reduceat(label, at) != np.maximum.reduceat(label, at)) & (~light | (n[at + size - 1] > n[at]))
    same = mix(np.add.reduceat(mix(sk.view(U64), 33), at) + size.astype(U64), 35)
    same = tagged(same, np.where(light, LIGHT_LISTS, 0)).view(np.int64)
    _, first, lists = np.unique(same[keep], return_index=True, return_counts=True)
    one = np.flatnonzero(keep)[first]
    rows = np.arange(size[one].sum()) + np.repeat(at[one] - np.cumsum(size[one]) + size[one], size[one])
    return np.repeat(same[one], size[one]), sk[rows], n[rows], np.repeat(lists, size[one])


def scan_lists(entries: DataFrame) -> DataFrame:
    """``several_sets`` of list entries. One task holds those of one shuffle partition."""

    def run(batches):
        held = [[c.to_numpy() for c in b.columns] for b in batches if b.num_rows]
        if held:
            yield from list_batches(*several_sets(*(np.concatenate(x) for x in zip(*held, strict=True))))

    return entries.repartition("key").mapInArrow(run, LISTS)


def with_centers(lists: DataFrame) -> DataFrame:
    """Adds ``center, center_n``: in a light list the smallest set, else the one in most
    lists (ties: the smaller key)."""
    weight = lists.groupBy(F.col("sk").alias("w_sk")).agg(F.sum("lists").alias("weight"))
    light = F.col("key").bitwiseAND(255) == LIGHT_LISTS
    first = F.min(F.struct(F.when(light, F.col("n")).otherwise(0).alias("size"), (-F.col("weight")).alias("w"), F.col("sk").alias("center"), F.col("n").alias("center_n")))
    centers = lists.join(weight, F.col("sk") == F.col("w_sk")).groupBy(F.col("key").alias("c_key")).agg(first.alias("c")).select("c_key", "c.center", "c.center_n")
    return lists.join(centers, F.col("key") == F.col("c_key")).select("key", "sk", "n", "center", "center_n")


def packed_sets(wanted: DataFrame, rule: Rule) -> DataFrame:
    """``sk, x`` of ``sk, text``: the set's shingles, sorted and packed."""

    def run(batches):
        for batch, many in chunks(batches, 1):
            x, begin = shingle_sets(many, rule.shingle)
            values = [x[lo:hi].tobytes() for lo, hi in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.binary())], names=["sk", "x"])

    return wanted.select("sk", "text").mapInArrow(run, "sk long, x binary")


def with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b, ...`` with ``x_a, x_b``; rows with one ``a`` stand together."""
    one, two = (sets.select(F.col("sk").alias(f"sk_{x}"), F.col("x").alias(f"x_{x}")) for x in "ab")
    with_b = pairs.join(two.hint("shuffle_merge"), F.col("b") == F.col("sk_b"))
    with_a = with_b.join(one.hint("shuffle_merge"), F.col("a") == F.col("sk_a"))
    return with_a.select(*pairs.columns, "x_a", "x_b")


def differences(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """``a, b, links, n, d`` of the pairs ``a, b``: whether they link, the size of b, and the
    shingles in which it differs from a, packed."""

    def run(batches):
        last, c = None, None
        for batch in batches:
            links, sizes, apart = [], [], []
            for a, xa, xb in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if a != last:
                    last, c = a, np.frombuffer(xa, U64)
                x = np.frombuffer(xb, U64)
                d = np.setxor1d(c, x, assume_unique=True)
                links.append(bool(rule.links((len(c) + len(x) - len(d)) // 2, len(c), len(x))))
                sizes.append(len(x))
                apart.append(d.tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(links, pa.bool_()), pa.array(sizes, pa.int32()), pa.array(apart, pa.binary())], names=["a", "b", "links", "n", "d"])

    return with_sets(pairs, sets).mapInArrow(run, "a long, b long, links boolean, n int, d binary")


def settle(groups: DataFrame, compared: DataFrame, rule: Rule) -> DataFrame:
    """Links ``a, b`` that join components, for whole groups ``center, sk, label`` from their
    differences ``a, b, n, d``; these are wide and move only once before they are dealt."""

    def run(batches):
        last, held = None, []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for *key, own, sk, label, n, d in zip(*columns, strict=True):
                if key != last:
                    yield from links(held)
                    last, held = key, []
                held.append((sk, label, n, np.frombuffer(d, U64), own))
        yield from links(held)

    def links(held):
        found = joining_links([m[:4] for m in held], rule, np.array([m[4] for m in held])) if held else []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=["a", "b"])

    # Each tile is held against itself and every other: a member is in every pair with its own.
    apart = (F.col("center") == F.col("a")) & (F.col("sk") == F.col("b"))
    wide = compared.select("a", "b", F.octet_length("d").alias("wide"))
    sizes = stage(groups.join(wide, apart).groupBy(F.col("center").alias("g_center")).agg(F.count(F.lit(1)).alias("members"), F.sum("wide").alias("bytes")), "jaccard-sizes")
    sizes = sizes.select("g_center", F.ceil(F.greatest(F.col("members") / TILE, F.col("bytes") / TILE_BYTES, F.lit(1))).cast("int").alias("tiles"))
    placed = groups.join(sizes, F.col("center") == F.col("g_center")).join(compared.select("a", "b", "n", "d"), apart).withColumn("own", F.pmod(F.xxhash64("sk"), F.col("tiles")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    pairs = placed.select("center", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "sk", "label", "n", "d")
    return pairs.repartition("center", "i", "j").sortWithinPartitions("center", "i", "j").mapInArrow(run, "a long, b long")


def joining_links(members: list[tuple[int, int, int, np.ndarray]], rule: Rule, tile: np.ndarray | None = None) -> list[tuple[int, int]]:
    """At most one link for each pair of components that the members' links join. Members are
    (set, component, size, differences from the common centre). Those of two tiles are held
    against the other tile's only.

    What two members share of their differences is counted by a product of 0-1 matrices for
    the shingles in which many differ, and by an inverted index for the others."""
    sk = [m[0] for m in members]
    size = np.array([m[2] for m in members])
    apart = np.array([len(m[3]) for m in members])
    comp = np.unique([m[1] for m in members], return_inverse=True)[1]
    rows = cols = np.arange(len(members))
    if tile is not None and (tile != tile[0]).any():
        rows, cols = np.flatnonzero(tile == tile[0]), np.flatnonzero(tile != tile[0])
    if not len(cols) or comp.max() == 0:
        return []
    place = np.full(len(members), -1)
    place[cols] = np.arange(len(cols))
    owner = np.repeat(np.arange(len(members)), apart)
    shingle = np.unique(np.concatenate([m[3] for m in members]), return_inverse=True)[1]
    kinds = int(shingle.max(initial=-1)) + 1
    held = np.bincount(shingle[place[owner] >= 0], minlength=kinds)
    many = held * DENSE > len(cols)
    wide = np.zeros((len(members), int(many.sum())), np.float32)
    column, often = np.cumsum(many) - 1, many[shingle]
    wide[owner[often], column[shingle[often]]] = 1
    rest = ~often & (held[shingle] > 0)
    owner, shingle = owner[rest], shingle[rest]
    begin = np.searchsorted(owner, np.arange(len(members) + 1))
    inside = np.flatnonzero(place[owner] >= 0)
    holders = place[owner[inside[np.argsort(shingle[inside], kind="stable")]]]
    first = np.append(0, np.cumsum(np.bincount(shingle[inside], minlength=kinds)))
    across = wide[cols].T
    out = []
    for lo in range(0, len(rows), 256):
        for i, common in zip(rows[lo : lo + 256].tolist(), (wide[rows[lo : lo + 256]] @ across).astype(np.int64), strict=True):
            if not (comp[cols] != comp[i]).any():
                continue
            own = shingle[begin[i] : begin[i + 1]]
            count = first[own + 1] - first[own]
            at = np.repeat(first[own] - np.cumsum(count) + count, count) + np.arange(count.sum())
            shared = common + np.bincount(holders[at], minlength=len(cols))
            both = (size[i] + size[cols] - (apart[i] + apart[cols] - 2 * shared)) // 2
            for j in cols[np.flatnonzero((comp[cols] != comp[i]) & rule.links(both, size[i], size[cols]))].tolist():
                if comp[j] != comp[i]:
                    out.append((sk[i], sk[j]))
                    comp[comp == comp[j]] = comp[i]
    return out


def components(docs: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id, th, n, label`` for ``doc_id, th, text``; label is null for empty sets."""
    with small_batches(docs.sparkSession, 10_000, BATCH):
        return joined(docs, rule)


def joined(docs: DataFrame, rule: Rule) -> DataFrame:
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    scanned = stage(scan_postings(postings(docs, rule, buckets), buckets), "jaccard-sets")
    sets, lists = scanned.where("key IS NULL").select("doc_id", "th", "n", "sk"), scanned.where("key IS NOT NULL")
    held, labels = None, None
    while labels is None or not lists.isEmpty():
        lists = lists.groupBy("key", "sk").agg(F.min("n").alias("n"), F.sum("lists").alias("lists"))
        lists = stage(with_centers(stage(lists, "jaccard-lists")), "jaccard-centers")
        if held is None:
            members = sets.where("sk IS NOT NULL").groupBy("sk").agg(F.min("th").alias("m_th"))
            wanted = members.join(lists.select(F.col("sk").alias("w_sk")).distinct(), F.col("sk") == F.col("w_sk"), "left_semi")
            texts_ = docs.select("th", "text").join(wanted, F.col("th") == F.col("m_th"), "inner").dropDuplicates(["sk"])
            held = stage(packed_sets(texts_, rule), "jaccard-held")
        pairs = lists.select(F.col("center").alias("a"), F.col("sk").alias("b")).where("a <> b").distinct()
        compared = stage(differences(pairs, held, rule), "jaccard-differences")
        links = compared.where("links").select("a", "b")
        labels = connected_components(links) if labels is None else with_edges(labels, links)
        heavy = lists.where(F.col("key").bitwiseAND(255) != LIGHT_LISTS)
        rows = heavy.join(labels.select(F.col("node").alias("l_sk"), "label"), F.col("sk") == F.col("l_sk"), "left").select("key", "sk", "center", F.coalesce("label", "sk").alias("label"))
        # Lists that still lie in several components; together by their centre.
        several = rows.groupBy(F.col("key").alias("s_key")).agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
        rest = rows.join(several, F.col("key") == F.col("s_key"), "left_semi").where("sk <> center").select("center", "sk", "label").distinct()
        rest = stage(rest, "jaccard-rest")
        sizes = rest.groupBy(F.col("center").alias("g_center")).agg(F.count(F.lit(1)).alias("members"))
        small = rest.join(sizes.where(F.col("members") <= GROUP), F.col("center") == F.col("g_center"), "left_semi")
        labels = with_edges(labels, stage(settle(small, compared, rule), "jaccard-settled"))
        large = rest.join(sizes.where(F.col("members") > GROUP), F.col("center") == F.col("g_center"), "left_semi").select(F.col("center").alias("a"), F.col("sk").alias("b"))
        now = labels.select(F.col("node").alias("l_sk"), "label")
        large = large.join(now, F.col("b") == F.col("l_sk"), "left").select("a", "b", F.coalesce("label", "b").alias("label"))
        lists = stage(scan_lists(difference_lists(large, held, rule)), "jaccard-scanned")
    return sets.join(labels.select(F.col("node").alias("l_sk"), "label"), F.col("sk") == F.col("l_sk"), "left").select("doc_id", "th", "n", F.coalesce("label", "sk").alias("label"))


def hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text")


def jaccard_components(docs: DataFrame, rule: Rule = Rule(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, component_size``."""
    named = components(hashed(docs, id_col, text_col), rule)
    groups = named.where("label IS NOT NULL").groupBy(F.col("label").alias("g")).agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("size"))
    return named.join(groups, F.col("label") == F.col("g"), "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"), F.coalesce("size", F.lit(1)).alias("component_size"))


def keep_one(docs: DataFrame, rule: Rule = Rule(5, 80)) -> DataFrame:
    """The documents (with their own columns) without near duplicates: of each component
    one row stays, that with the smallest id (null ids last), then text hash. Rows with
    empty sets stay."""
    named = stage(components(hashed(docs, "doc_id", "text"), rule), "jaccard-named").where("label IS NOT NULL")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")
    groups = named.groupBy(F.col("label").alias("g")).agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("size")).where("size > 1")
    marked = named.join(groups, F.col("label") == F.col("g")).select(F.col("doc_id").alias("m_id"), F.col("th").alias("m_th"), (first == F.col("first")).alias("stays"))
    verdicts = marked.groupBy("m_id", "m_th").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("rows"))
    # The documents' own columns travel in one struct: no name of theirs meets one of ours.
    keyed = docs.select(F.col("doc_id").alias("k_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("k_th"), F.struct("*").alias("row"))
    same = (F.col("k_th") == F.col("m_th")) & F.col("k_id").eqNullSafe(F.col("m_id"))
    left = keyed.join(verdicts.where("NOT stays"), same, "left_anti")
    repeated = verdicts.where("stays AND rows > 1")
    if not repeated.isEmpty():
        left = left.join(repeated, same, "left_anti").unionByName(left.join(repeated, same, "left_semi").dropDuplicates(["k_id", "k_th"]))
    return left.select("row.*")


def op7_jaccard_join(spark, sf_dir: str) -> DataFrame:
    from tidewrack.llm.common import table

    return jaccard_components(table(spark, sf_dir, "documents"))
