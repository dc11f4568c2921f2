"""Ranked lexical search, reversed: the items' inverted index is broadcast and documents
stream through it.

Terms are maximal runs of ASCII letters and digits and of any characters over U+007F; only
A-Z are lower-cased. With N documents that hold a term, L terms in all of them, n terms in
a document, df documents that hold a term and tf its occurrences in one, all with repeats:

    w = floor(1000 * ln((2 N + 2) / (2 df + 1)))         in doubles
    m = 100 - 75 + (75 n N) div L
    score = sum over the item's terms, repeats included, of w * ((10^9 tf) div (1000 tf + 8 m))

1. *Statistics.* Every document is split into terms once; a task counts N, L and the df of
   the terms that items hold, and gives one row for each of them.
2. *Search.* An item is a list of (term, occurrences); turned round, every term has its
   list of items. Weights and lists are broadcast. A document's counts of these terms are
   multiplied through the lists, for some hundred documents at once, which gives its scores
   for all items that it shares a term with. A task keeps a bounded heap for each item, the
   ``top`` best: candidates are gathered, and cut back to the heap when the buffer is full;
   a candidate under its item's worst kept score is not gathered.
3. *Merge.* The tasks' heaps are merged for groups of tasks first, then for all.

Items are taken in blocks of about ``BLOCK_BYTES`` of text, so what is broadcast, and what
a task holds, is bounded for a benchmark of any size; each block is a pass over documents.

Defined results: a null or term-less text is in no result and not in N; a null or
term-less item has no rows; equal item rows are one item, rows with equal ids but other
texts are items of their own; repeated documents are ranked each; equal scores are ordered
by id, null ids last; an empty table on either side gives no rows; extra columns are
ignored.

Scale: documents never move. The shuffles carry one row for each term and task, and
``top`` rows for each item and task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.llm.common import texts
from tidewrack.session import stage

TOP = 10
BLOCK_BYTES = 4_000_000  # bytes of item text in one broadcast index
SLICE = 1 << 20  # bytes of a text that are split into terms at once
GROUP = 50_000  # counted terms of documents that are scored together
BUFFER = 200_000  # candidates gathered before they are cut back to the heaps
MERGE = 64  # groups of tasks whose heaps are merged first
_LETTERS = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
TO_TERMS = bytes(c if c in _LETTERS else 0x20 for c in range(256)).translate(bytes(range(256)).lower())


def term_lists(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a slice at a time."""
    text = text.translate(TO_TERMS)
    lo = 0
    while lo < len(text):
        hi = text.find(b" ", lo + SLICE) if len(text) - lo > SLICE else -1
        hi = len(text) if hi < 0 else hi
        yield text[lo:hi].split()
        lo = hi


@dataclass
class Index:
    """Inverted index over a block of items."""

    term: dict[bytes, int] = field(default_factory=dict)
    first: np.ndarray | None = None  # of each term's list; one more at the end
    item: np.ndarray | None = None
    times: np.ndarray | None = None
    weight: np.ndarray | None = None
    ids: list[int | None] = field(default_factory=list)

    @staticmethod
    def of(items: list[tuple[int | None, bytes]]) -> Index:
        out, rows = Index(ids=[i for i, _ in items]), []
        for k, (_, text) in enumerate(items):
            for t, n in Counter(t for part in term_lists(text) for t in part).items():
                rows.append((out.term.setdefault(t, len(out.term)), k, n))
        rows.sort()
        at = np.array(rows, np.int64).reshape(-1, 3)
        out.first = np.searchsorted(at[:, 0], np.arange(len(out.term) + 1))
        out.item, out.times = at[:, 1].copy(), at[:, 2].copy()
        return out

    def count(self, text: bytes) -> tuple[int, Counter]:
        """All terms of the text, and the counts of those in the index."""
        n, found = 0, Counter()
        for part in term_lists(text):
            n += len(part)
            found.update(map(self.term.get, part))
        del found[None]
        return n, found


def statistics(docs: DataFrame, held) -> tuple[int, int, dict[int, int]]:
    """N, L, and df of the index's terms."""

    def run(batches):
        index = held.value
        df, some, total = Counter(), 0, 0
        for batch in batches:
            for text in texts(batch.column(0)):
                n, found = index.count(text or b"")
                df.update(found.keys())
                some += n > 0
                total += n
        keys = [-2, -1, *df]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([total, some, *df.values()], pa.int64())], names=["term", "n"])

    rows = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = {r.term: r.n for r in rows.collect()}  # at most one row for each term of the block
    return df.pop(-1, 0), df.pop(-2, 0), df


class Heaps:
    """The best candidates of each item, in arrays that are cut back when they are full."""

    def __init__(self, items: int, top: int):
        self.top, self.items = top, items
        self.worst = np.zeros(items, np.int64)
        self.kept = [np.zeros(0, np.int64) for _ in range(4)]  # item, score, null id, id
        self.new: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, item: np.ndarray, score: np.ndarray, null: np.ndarray, doc: np.ndarray) -> None:
        good = (score > 0) & (score >= self.worst[item])
        self.new.append((item[good], score[good], null[good], doc[good]))
        self.size += int(good.sum())
        if self.size >= BUFFER + self.top * self.items:
            self.cut()

    def cut(self) -> None:
        item, score, null, doc = (np.concatenate(x) for x in zip(self.kept, *self.new, strict=True))
        order = np.lexsort((doc, null, -score, item))
        item, score, null, doc = item[order], score[order], null[order], doc[order]
        first = np.searchsorted(item, np.arange(self.items + 1))
        place = np.arange(len(item)) - first[item]
        keep = place < self.top
        full = np.flatnonzero(np.diff(first) >= self.top)
        self.worst[full] = score[first[full] + self.top - 1]
        self.kept = [x[keep] for x in (item, score, null, doc)]
        self.new, self.size = [], 0


HEAP = "item int, item_id long, doc_id long, score long"


def heaps(docs: DataFrame, held, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """At most ``top`` rows for each item and task."""

    def run(batches):
        index = held.value
        best = Heaps(len(index.ids), top)
        rows: list[tuple[int, int, int]] = []  # document of the group, term, tf
        m, null, doc = [], [], []

        def flush() -> None:
            if rows:
                of, term, tf = np.array(rows, np.int64).T
                part = index.weight[term] * ((10**9 * tf) // (1000 * tf + 8 * np.array(m, np.int64)[of]))
                size = index.first[term + 1] - index.first[term]
                at = np.repeat(index.first[term] - np.cumsum(size) + size, size) + np.arange(size.sum())
                cell = np.repeat(of, size) * best.items + index.item[at]
                score = np.zeros(len(m) * best.items, np.int64)
                np.add.at(score, cell, np.repeat(part, size) * index.times[at])
                hit = np.flatnonzero(score)
                best.add(hit % best.items, score[hit], np.array(null, np.int64)[hit // best.items], np.array(doc, np.int64)[hit // best.items])
            rows.clear(), m.clear(), null.clear(), doc.clear()

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                n, found = index.count(text or b"")
                if found:
                    rows.extend((len(m), t, tf) for t, tf in found.items())
                    m.append(25 + 75 * n * n_docs // n_terms)
                    null.append(i is None)
                    doc.append(i or 0)
                    if len(rows) >= GROUP or len(m) * best.items >= 4_000_000:
                        flush()
        flush()
        best.cut()
        item, score, no_id, ids = best.kept
        if len(item):
            names = pa.array([index.ids[k] for k in item.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), names, pa.array(ids, mask=no_id.astype(bool)), pa.array(score)], names=["item", "item_id", "doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, HEAP)


def merged(found: DataFrame, top: int) -> DataFrame:
    """``item, item_id, rank, doc_id, score`` from the tasks' heaps."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = found.withColumn("part", F.spark_partition_id() % MERGE)
    some = part.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= top).drop("rank", "part")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, *, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score`` for ``docs(doc_id, text)`` and ``items(item_id, text)``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = stage(items.where("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct(), "search-items")
    blocks = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    out = None
    for block in range(blocks):
        # Bounded: about block_bytes of text.
        rows = sorted(((r.item_id, r.text.encode()) for r in items.where(F.col("block") == block).collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        index = Index.of(rows)
        counts = spark.sparkContext.broadcast(index)
        n_docs, n_terms, df = statistics(docs, counts)
        weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(index.term))]
        index.weight = np.array(weights, np.int64)
        found = merged(heaps(docs, spark.sparkContext.broadcast(index), n_docs, n_terms, top), top)
        out = found if out is None else out.unionByName(found)
    return out.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op11_reversed_search(spark, sf_dir: str) -> DataFrame:
    from tidewrack.llm.common import table

    return search(table(spark, sf_dir, "documents"), spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE = f"""WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY ALL),
totals AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(len(terms)) AS BIGINT) AS ll FROM d WHERE len(terms) > 0),
q AS (SELECT k, item_id, term, count(*) AS times FROM (
  SELECT row_number() OVER () AS k, item_id, unnest({_TERMS}) AS term
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(tf.r) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM (SELECT DISTINCT term FROM q) JOIN tf USING (term), totals GROUP BY term, nn),
m AS (SELECT r, doc_id, 25 + (75 * len(terms) * nn) // ll AS m FROM d, totals WHERE len(terms) > 0),
s AS (SELECT k, item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10"""
