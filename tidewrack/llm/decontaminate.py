"""Benchmark decontamination: size-partitioned MinHash containment search.

A document is contaminated by a test item if it holds at least ``CONTAINMENT`` of the
item's distinct shingles (``SHINGLE`` words), wherever they stand in the document.

Containment of a short set in a long one makes no useful Jaccard, so the sketch is on the
item's side: the bottom-s MinHash of its shingles, with s = n - ceil(CONTAINMENT * n) + 1.
A document that lacks at most n - ceil(CONTAINMENT * n) of the n shingles holds at least
one of any s of them, so the search misses nothing. Items are partitioned by size into
powers of two; a partition's largest sketch hash bounds the document hashes that are looked
up in it. Every hit document is then held against all shingles of the item: first by
hash, then, for those that pass, by the words themselves.

Words are runs of ASCII letters and digits and of any characters over 0x7F, in ASCII lower
case, so punctuation and line breaks do not hide a passage. An item with fewer words than
SHINGLE is one shingle of all its words; an item without words matches nothing.

Documents never move: the items are the query set, taken in blocks of at most
``BLOCK_BYTES`` of text, each broadcast and matched against all documents in one map pass.
A larger benchmark takes more passes, not more memory.

Defined results: a null text or item matches nothing; repeated rows are each matched;
items with equal ids are matched as separate rows; an empty table on either side gives no
match and keeps all documents; extra columns pass through ``drop_contaminated``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.llm.common import as_u8, prefix_hash, runs, shingle_hashes, span, table, texts

SHINGLE = 5
CONTAINMENT = 0.8
BLOCK_BYTES = 8_000_000

WORD = np.zeros(256, bool)
WORD[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = True


def needed(n: int, containment: float) -> int:
    """Shingles that a document must hold of an item with ``n``."""
    return max(1, int(np.ceil(containment * n - 1e-9)))


def word_spans(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    low = text.lower()
    s, e = runs(WORD[as_u8(low)])
    return low, s, e


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    return shingle_hashes(words, k) if len(words) >= k else words[:0]


def spelled(low: bytes, s: np.ndarray, e: np.ndarray, k: int) -> set[tuple[bytes, ...]]:
    """The distinct shingles as words."""
    words = [low[a:b] for a, b in zip(s.tolist(), e.tolist(), strict=True)]
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


class Items:
    """Index over one block of items."""

    def __init__(self, rows: list[tuple[int | None, bytes]], containment: float, shingle: int):
        self.ids, self.sets, self.words, self.k, self.need, self.containment = [], [], [], [], [], containment
        parts: dict[tuple[int, int], list[tuple[np.ndarray, int]]] = {}
        for item_id, text in rows:
            low, s, e = word_spans(text)
            if not len(s):
                continue
            k = min(shingle, len(s))
            x = np.unique(shingles(span(prefix_hash(as_u8(low)), s, e), k))
            need, at = needed(len(x), containment), len(self.ids)
            self.ids.append(item_id)
            self.sets.append(x)
            self.words.append(spelled(low, s, e, k))
            self.k.append(k)
            self.need.append(need)
            parts.setdefault((k, len(x).bit_length()), []).append((x[: len(x) - need + 1], at))
        self.parts = []
        for (k, _), sketches in sorted(parts.items()):
            hashes = np.concatenate([h for h, _ in sketches])
            owner = np.repeat([at for _, at in sketches], [len(h) for h, _ in sketches])
            order = np.argsort(hashes, kind="stable")
            self.parts.append((k, hashes[order], owner[order]))

    def matches(self, text: bytes | None) -> list[tuple[int, int]]:
        """(item, shared shingles) of the items that the text contains."""
        if not text or not self.parts:
            return []
        low, s, e = word_spans(text)
        words = span(prefix_hash(as_u8(low)), s, e)
        sets: dict[int, np.ndarray] = {}
        spelt: dict[int, set] = {}
        out = []
        for k, hashes, owner in self.parts:
            if k not in sets:
                sets[k] = np.unique(shingles(words, k))
            x = sets[k]
            x = x[: np.searchsorted(x, hashes[-1], "right")]
            at = np.searchsorted(hashes, x)
            seen = x[hashes[np.minimum(at, len(hashes) - 1)] == x]
            if not len(seen):
                continue
            lo, hi = np.searchsorted(hashes, seen, "left"), np.searchsorted(hashes, seen, "right")
            for item in np.unique(np.concatenate([owner[a:b] for a, b in zip(lo, hi, strict=True)])).tolist():
                if len(np.intersect1d(self.sets[item], sets[k], assume_unique=True)) < self.need[item]:
                    continue
                if k not in spelt:
                    spelt[k] = spelled(low, s, e, k)
                both = len(self.words[item] & spelt[k])
                if both >= needed(len(self.words[item]), self.containment):
                    out.append((item, both))
        return sorted(out)


def blocks(items: DataFrame, containment: float, shingle: int, block_bytes: int, id_col: str, text_col: str) -> Iterator[Items]:
    """The items in blocks of bounded size (an average; a block holds whole items)."""
    items = items.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).cast("binary").alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for b in range(n):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b).toArrow()
        yield Items(sorted(zip(rows.column("item").to_pylist(), rows.column("text").to_pylist(), strict=True), key=lambda r: (r[0] is None, r)), containment, shingle)


def find_contamination(docs: DataFrame, items: DataFrame, *, containment: float = CONTAINMENT, shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES,
                       id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, n_item, n_shared, containment`` for every contained item."""
    out = None
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    for index in blocks(items, containment, shingle, block_bytes, item_id_col, item_text_col):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, held=held):
            for batch in batches:
                index, rows = held.value, []
                for i, t in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                    rows += [(i, index.ids[m], len(index.words[m]), both, both / len(index.words[m])) for m, both in index.matches(t)]
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "item_id", "n_item", "n_shared", "containment"])

        found = docs.mapInArrow(run, "doc_id long, item_id long, n_item long, n_shared long, containment double")
        out = found if out is None else out.unionByName(found)
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, *, containment: float = CONTAINMENT, shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES,
                      item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents (with their own columns) that contain no item."""
    at = docs.columns.index("text")
    for index in blocks(items, containment, shingle, block_bytes, item_id_col, item_text_col):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, held=held):
            for batch in batches:
                yield batch.filter(pa.array([not held.value.matches(t) for t in texts(batch.column(at))], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    return find_contamination(table(spark, sf_dir, "documents"), spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


ORACLE = r"""
WITH lower_d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents WHERE text IS NOT NULL),
lower_b AS (SELECT row_number() OVER () AS b, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark WHERE text IS NOT NULL),
items AS (SELECT b, item_id, least(5, len(w)) AS k, w FROM lower_b WHERE len(w) > 0),
item_shingles AS (SELECT DISTINCT b, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS s FROM items),
sizes AS (SELECT b, count(*) AS n_item FROM item_shingles GROUP BY b),
ks AS (SELECT DISTINCT k FROM items),
doc_shingles AS (SELECT DISTINCT r, k, unnest(list_transform(range(1, greatest(len(w) - k + 2, 1)), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS s FROM lower_d, ks),
shared AS (SELECT r, b, count(*) AS n_shared FROM doc_shingles JOIN item_shingles USING (k, s) GROUP BY r, b)
SELECT doc_id, item_id, n_item::BIGINT AS n_item, n_shared::BIGINT AS n_shared, n_shared / n_item::DOUBLE AS containment
FROM shared JOIN sizes USING (b) JOIN lower_d USING (r) JOIN items USING (b)
WHERE n_shared >= ceil(0.8::DOUBLE * n_item - 1e-9)
"""
