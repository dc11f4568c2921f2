"""Stupid-backoff language model scores, computed relationally.

The model is the corpus itself, without the document that is scored (leave one out): with
c' = count in all documents - count in this one, and N' words in the others,

    S(w | v) = c'(v w) / c'(v)        if c'(v w) > 0
             = ALPHA * c'(w) / N'     else if c'(w) > 0
             = ALPHA^2 / N'           else (N' at least 1)

and a text's first word takes the second and third line without ALPHA's first factor. A
document's score is the sum of ln S over its words; copies elsewhere count as corpus.

Relational plan: documents are dealt by hash into chunks of about ``CHUNK_BYTES``. Every
chunk explodes into its distinct n-grams with their counts; they go, packed, to the count
table's partition of their hash. There the counts of all chunks are summed per n-gram and
joined back to the chunks that asked, which look up every word of every document and sum
per document. Since a chunk sends an n-gram once, however often it occurs, a frequent
n-gram has one row per chunk and no partition is hot.

Words are maximal runs of bytes other than white space; n-grams are known by 64-bit hashes.

Defined results: a null, empty or white-space text has 0 words and score 0; rows with equal
or null ids are scored row by row, each against all other rows; in a corpus of one document
all words are unseen; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.llm.common import U64, as_u8, mix, shingle_hashes, table, texts, word_hashes
from tidewrack.session import stage

ALPHA = 0.4
CHUNK_BYTES = 8_000_000
BUCKET_BYTES = 8_000_000  # bytes of text for one partition of the count tables


def pack(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes, so that equal high bytes cost nothing."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def orders(text: bytes | None) -> list[np.ndarray]:
    """Hashes of the text's words and word pairs, in order."""
    words = word_hashes(as_u8(text))
    return [words, mix(shingle_hashes(words, 2), 2) if len(words) > 1 else words[:0]]


def chunk_tables(docs: list[list[np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per order: the chunk's distinct n-grams, sorted, and their counts."""
    return [np.unique(np.concatenate([d[k] for d in docs]), return_counts=True) for k in (0, 1)]


def bucket_cuts(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where the buckets (equal ranges of the hash) begin in sorted hashes."""
    bounds = np.array([(b << 64) // buckets for b in range(1, buckets)], U64)
    return np.concatenate([[0], np.searchsorted(sorted_hashes, bounds), [len(sorted_hashes)]])


def grouped(batches, key: int = 0):
    """Rows with equal keys, which stand together, as lists of tuples."""
    held, now = [], None
    for batch in batches:
        for row in zip(*(c.to_pylist() if not pa.types.is_string(c.type) else c.cast(pa.binary()).to_pylist() for c in batch.columns), strict=True):
            if held and row[key] != now:
                yield now, held
                held = []
            now = row[key]
            held.append(row)
    if held:
        yield now, held


ASK = "chunk int, bucket int, ord int, hashes binary, counts binary"


def ask(chunked: DataFrame, buckets: int) -> DataFrame:
    """The distinct n-grams of every chunk, packed per bucket of the count tables."""
    names = ["chunk", "bucket", "ord", "hashes", "counts"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]

    def run(batches):
        for chunk, rows in grouped(batches):
            for k, (h, c) in enumerate(chunk_tables([orders(r[1]) for r in rows])):
                cuts, out = bucket_cuts(h, buckets), []
                for b in range(buckets):
                    lo, hi = cuts[b], cuts[b + 1]
                    if hi > lo:
                        out.append((chunk, b, k, pack(np.diff(h[lo:hi], prepend=U64(0))), pack(c[lo:hi])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return chunked.select("chunk", "text").mapInArrow(run, ASK)


ANSWER = "chunk int, bucket int, ord int, counts binary"


def answer(asked: DataFrame) -> DataFrame:
    """For every pack the corpus counts of its n-grams, in its order."""
    names = ["chunk", "bucket", "ord", "counts"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]

    def run(batches):
        for _, rows in grouped(batches, 4):
            parts = [np.cumsum(unpack(r[2]), dtype=np.uint64) for r in rows]
            sizes = [len(x) for x in parts]
            _, inverse = np.unique(np.concatenate(parts), return_inverse=True)
            total = np.bincount(inverse, weights=np.concatenate([unpack(r[3]) for r in rows]).astype(np.float64)).astype(np.int64)[inverse]
            at = np.concatenate([[0], np.cumsum(sizes)])
            for lo in range(0, len(rows), 64):
                out = [(rows[i][0], rows[i][1], rows[i][5], pack(total[at[i] : at[i + 1]])) for i in range(lo, min(len(rows), lo + 64))]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    keyed = asked.select("chunk", "bucket", "hashes", "counts", (F.col("bucket") * 2 + F.col("ord")).alias("at"), "ord")
    return keyed.repartition("at").sortWithinPartitions("at", "chunk").mapInArrow(run, ANSWER)


def text_score(own: list[np.ndarray], corpus: list[np.ndarray], n_corpus: int) -> tuple[float, int, int, int]:
    """(sum of ln S, pairs seen, backed off, unseen) of one text from its n-grams and their
    corpus counts, word by word."""
    words = own[0]
    if not len(words):
        return 0.0, 0, 0, 0
    left = []
    for h, c in zip(own, corpus, strict=True):
        _, inverse, mine = np.unique(h, return_inverse=True, return_counts=True)
        left.append(c - mine[inverse])
    others = max(1, n_corpus - len(words))
    w, pair = left
    back = np.where(w > 0, np.log(np.maximum(w, 1) / others), np.log(ALPHA / others))
    out = back.copy()
    out[1:] += np.log(ALPHA)
    seen = pair > 0
    out[1:][seen] = np.log(pair[seen] / w[:-1][seen])
    known = int((~np.append(False, seen) & (w > 0)).sum())
    return float(out.sum()), int(seen.sum()), known, len(words) - int(seen.sum()) - known


SCORE = "doc_id long, n_words long, log_prob double, n_pairs_seen long, n_backed_off long, n_unseen long"


def stupid_backoff(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_words, log_prob, n_pairs_seen, n_backed_off,
    n_unseen``."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, buckets = (max(1, -(-size // b)) for b in (chunk_bytes, bucket_bytes))
    chunked = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("chunk"), "doc_id", "text")
    asked = ask(chunked.select("chunk", "text").repartition("chunk").sortWithinPartitions("chunk"), buckets)
    answers = stage(answer(asked), "lm-counts")
    # Answers first, then the chunk's documents, in one partition.
    both = chunked.select("chunk", F.lit(1).alias("kind"), F.lit(0).alias("bucket"), F.lit(0).alias("ord"), "doc_id", "text", F.lit(None).cast("binary").alias("counts")).unionByName(
        answers.select("chunk", F.lit(0).alias("kind"), "bucket", "ord", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "counts"))
    # The number of words: the unigram counts of all chunks add up to it.
    n_words = words_in(docs)
    names = [x.split()[0] for x in SCORE.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches):
        for _, rows in grouped(batches):
            held = [[r for r in rows if r[1] == 0 and r[3] == k] for k in (0, 1)]
            rows = [r for r in rows if r[1] == 1]
            if not rows:
                continue
            grams = [orders(r[5]) for r in rows]
            tables = [h for h, _ in chunk_tables(grams)]
            counts = [np.concatenate([unpack(r[6]) for r in sorted(held[k], key=lambda r: r[2])]).astype(np.int64) if held[k] else np.zeros(0, np.int64) for k in (0, 1)]
            for lo in range(0, len(rows), 2000):
                out = []
                for r, own in zip(rows[lo : lo + 2000], grams[lo : lo + 2000], strict=True):
                    found = [counts[k][np.searchsorted(tables[k], own[k])] for k in (0, 1)]
                    total, *n = text_score(own, found, n_words)
                    out.append((r[4], len(own[0]), total, *n))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return both.repartition("chunk").sortWithinPartitions("chunk", "kind", "bucket").mapInArrow(run, SCORE)


def words_in(docs: DataFrame) -> int:
    """Words of the corpus (one number)."""
    return docs.agg(F.sum(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")))).first()[0] or 0


def op4_lm_score(spark, sf_dir: str) -> DataFrame:
    return stupid_backoff(table(spark, sf_dir, "documents")).withColumn("log_prob", F.round("log_prob", 4))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
t AS (SELECT r, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM d),
p AS (SELECT r, i, w, lag(w) OVER (PARTITION BY r ORDER BY i) AS v FROM t),
own1 AS (SELECT r, w, count(*) AS c FROM p GROUP BY r, w), all1 AS (SELECT w, sum(c) AS c FROM own1 GROUP BY w),
own2 AS (SELECT r, v, w, count(*) AS c FROM p WHERE v IS NOT NULL GROUP BY r, v, w), all2 AS (SELECT v, w, sum(c) AS c FROM own2 GROUP BY v, w),
one AS (SELECT r, w, all1.c - own1.c AS c FROM own1 JOIN all1 USING (w)),
two AS (SELECT r, v, w, all2.c - own2.c AS c FROM own2 JOIN all2 USING (v, w)),
n AS (SELECT d.r, greatest(1, sum(len(w)) OVER () - len(w)) AS others FROM d),
s AS (SELECT p.r, coalesce(two.c, 0) > 0 AS seen, a.c > 0 AS known,
             CASE WHEN coalesce(two.c, 0) > 0 THEN ln(two.c / b.c::DOUBLE)
                  ELSE (CASE WHEN p.v IS NULL THEN 0 ELSE ln(0.4::DOUBLE) END) + (CASE WHEN a.c > 0 THEN ln(a.c / others::DOUBLE) ELSE ln(0.4::DOUBLE / others) END) END AS x
      FROM p JOIN n USING (r) JOIN one a ON a.r = p.r AND a.w = p.w LEFT JOIN one b ON b.r = p.r AND b.w = p.v LEFT JOIN two ON two.r = p.r AND two.v = p.v AND two.w = p.w)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(round(q.log_prob, 4), 0) AS log_prob, coalesce(n_pairs_seen, 0)::BIGINT AS n_pairs_seen,
       coalesce(n_backed_off, 0)::BIGINT AS n_backed_off, coalesce(n_unseen, 0)::BIGINT AS n_unseen
FROM d LEFT JOIN (SELECT r, sum(x) AS log_prob, count(*) FILTER (WHERE seen) AS n_pairs_seen, count(*) FILTER (WHERE NOT seen AND known) AS n_backed_off,
                         count(*) FILTER (WHERE NOT seen AND NOT known) AS n_unseen FROM s GROUP BY r) q USING (r)
"""
