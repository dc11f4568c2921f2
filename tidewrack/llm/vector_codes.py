"""Product-quantised vector codes by a member-resident Lloyd iteration.

A component x becomes floor(256 x); a vector is cut into ``parts`` equal parts, each with a
codebook of its own, which begins as that part of the vectors with the smallest ids.

The members live with their entry: a task takes the parts of the vectors that it reads,
assigns them, and packs those of one (position, entry) into a block with a salt. Blocks are
partitioned by (position, entry, salt) and written: the *residents*. In each round

1. the owners add up their resident members; the sums of an entry's salts are added (one
   row for each entry and component), and the entry becomes their mean, rounded down;
2. the residents are assigned anew where they are. Members that keep their entry stay in the
   block; only the others are packed into new blocks and move in the next shuffle.

The last assignment is made by the residents, too; its codes and errors go back to the
vectors' row keys.

Defined results: rows whose vector is null or empty or holds a null or non-finite component
are dropped. Null ids come last in the order that gives the first entries; equal ids are
ordered by their vectors. With fewer vectors than entries there are that many entries.
Repeated rows are coded each. Null labels are one label. An empty table gives an empty
result; extra columns are ignored. Kept vectors of different lengths, a length that is no
multiple of ``parts``, or components beyond 2^20 raise ValueError.

Scale: the codebooks (parts x entries x part length integers, fixed by parameters) are all
that reaches the driver or is broadcast. The salts grow with the number of partitions, so
that an entry with a third of all members is spread over many tasks. The shuffles carry
every part once when it first goes to its owner, the movers of a round, and one row for each
part at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.operators.joins import small_side
from tidewrack.session import scratch_path, stage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LARGEST = 1 << 28
AT_ONCE = 32_768  # vectors that are packed into blocks together
BLOCK = "position int, was int, entry int, salt int, keys array<long>, x array<int>"


def written(df: DataFrame, name: str) -> DataFrame:
    """The table in the shared folder, with the partitions that it was written with."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def integers(vectors: DataFrame) -> DataFrame:
    """``key, id, label, v``: the kept vectors as integers, with a row key."""
    good = F.coalesce((F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    whole = F.transform("v", lambda x: F.floor(x.cast("double") * SCALE))
    rows = vectors.where(good).select(F.monotonically_increasing_id().alias("key"), "id", "label", whole.alias("v"))
    return stage(rows, "vector-integers")


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (ties: the lower) and its squared distance; exact."""
    index, error = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    exact = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)) ** 2 * 4 * x.shape[1] < 2**53
    for lo in range(0, len(x), 4096):
        part = x[lo : lo + 4096]
        if exact:
            p, c = part.astype(np.float64), entries.astype(np.float64)
            d = (p * p).sum(1)[:, None] - 2 * (p @ c.T) + (c * c).sum(1)
        else:
            d = np.stack([((part - c) ** 2).sum(1) for c in entries], 1)
        index[lo : lo + 4096] = d.argmin(1)
        error[lo : lo + 4096] = d.min(1)
    return index, error


def blocks(position: int, was: np.ndarray | None, entry: np.ndarray, salt: int, keys: np.ndarray, x: np.ndarray) -> Iterator[tuple]:
    """One block for each entry; ``was`` is -1 for members that come from no block."""
    order = np.argsort(entry, kind="stable")
    cuts = np.flatnonzero(np.diff(entry[order], prepend=-1))
    for rows in np.split(order, cuts[1:]) if len(order) else ():
        yield position, -1 if was is None else int(was[rows[0]]), int(entry[rows[0]]), salt, keys[rows], x[rows].ravel()


def packed(rows: list[tuple]) -> pa.RecordBatch:
    position, was, entry, salt, keys, x = zip(*rows, strict=True)
    lists = [pa.ListArray.from_arrays(np.cumsum([0] + [len(v) for v in col]).astype(np.int32), pa.array(np.concatenate(col), t)) for col, t in ((keys, pa.int64()), (x, pa.int32()))]
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in (position, was, entry, salt)), *lists], names=["position", "was", "entry", "salt", "keys", "x"])


def salt_of(key: int, salts: int) -> int:
    return (int(key) * 0x9E3779B97F4A7C15 % 2**64 >> 33) % salts


def first_blocks(rows: DataFrame, book, salts: int) -> DataFrame:
    """The parts of all vectors, assigned and packed."""

    def run(batches):
        c = book.value
        keys, vectors, n = [], [], 0

        def flush():
            k, v = np.concatenate(keys), np.concatenate(vectors).reshape(sum(map(len, keys)), len(c), -1)
            out = [b for p in range(len(c)) for b in blocks(p, None, nearest(v[:, p], c[p])[0], salt_of(k[0], salts), k, v[:, p])]
            yield packed(out)

        for batch in batches:
            if batch.num_rows:
                keys.append(batch.column(0).to_numpy())
                vectors.append(batch.column(1).flatten().to_numpy())
                n += batch.num_rows
            if n >= AT_ONCE:
                yield from flush()
                keys, vectors, n = [], [], 0
        if n:
            yield from flush()

    return rows.select("key", "v").mapInArrow(run, BLOCK)


def members(batches, c: np.ndarray):
    """``position, entry, salt, keys, x`` of the resident blocks."""
    for batch in batches:
        for position, _, entry, salt, keys, x in zip(*batch.columns, strict=True):
            yield position.as_py(), entry.as_py(), salt.as_py(), keys.values.to_numpy(), x.values.to_numpy().astype(np.int64).reshape(-1, c.shape[2])


def updated(residents: DataFrame, book, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after the owners' update."""

    def run(batches):
        c = book.value
        sums: dict[tuple[int, int], np.ndarray] = {}
        for position, entry, _, keys, x in members(batches, c):
            part = np.append(x.sum(0), len(keys))
            sums[position, entry] = sums.get((position, entry), 0) + part
        rows = [(p, e, i, s) for (p, e), total in sums.items() for i, s in enumerate(total.tolist())]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["position", "entry", "i", "total"])

    totals = residents.mapInArrow(run, "position int, entry int, i int, total long").groupBy("position", "entry", "i").agg(F.sum("total").alias("total"))
    out, width = codebooks.copy(), codebooks.shape[2]
    by = {(r.position, r.entry, r.i): r.total for r in totals.collect()}  # a row for each codebook component
    for (p, e, i), total in by.items():
        if i < width:
            out[p, e, i] = total // by[p, e, width]
    return out


def migrated(residents: DataFrame, book, partitions: int) -> DataFrame:
    """The residents after an assignment. Only the members that change their entry move."""

    def run(batches):
        c = book.value
        out, n = [], 0
        for position, entry, salt, keys, x in members(batches, c):
            to, _ = nearest(x, c[position])
            out += blocks(position, np.full(len(to), entry), to, salt, keys, x)
            n += len(keys)
            if n >= 16 * AT_ONCE:
                yield packed(out)
                out, n = [], 0
        if out:
            yield packed(out)

    assigned = written(residents.mapInArrow(run, BLOCK), "vector-assigned")
    movers = assigned.where("entry <> was").repartition(partitions, "position", "entry", "salt")
    return assigned.where("entry = was").unionByName(written(movers, "vector-movers"))


def coded(residents: DataFrame, book) -> DataFrame:
    """``key, high, low, error``: the last assignment's indexes, a byte each, and errors."""

    def run(batches):
        c = book.value
        for position, _, _, keys, x in members(batches, c):
            index, error = nearest(x, c[position])
            byte = (index.astype(np.uint64) << np.uint64(8 * (7 - position % 8))).view(np.int64)
            none = np.zeros(len(keys), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (keys, *((byte, none) if position < 8 else (none, byte)), error)], names=["key", "high", "low", "error"])

    return residents.mapInArrow(run, "key long, high long, low long, error long").groupBy("key").agg(*(F.sum(x).alias(x) for x in ("high", "low", "error")))


def vector_codes(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray]:
    """``(id, label, code, error)`` of the kept vectors, and the codebooks
    (part, entry, component)."""
    if not 1 <= parts <= 16 or not 1 <= entries <= 256 or rounds < 1:
        raise ValueError("parts up to 16, entries up to 256, one round or more")
    spark = vectors.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = integers(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"), F.col(label_col).alias("label")))
    least, most, low, high = rows.agg(F.min(F.size("v")), F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    if least is None:
        return rows.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), np.zeros((parts, 0, 0), np.int64)
    if least != most or least % parts:
        raise ValueError(f"vectors of {least} to {most} components; one length, a multiple of {parts}, is needed")
    if max(-low, high) >= LARGEST:
        raise ValueError(f"components from {low / SCALE} to {high / SCALE}; up to {LARGEST // SCALE} is supported")
    seeds = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()  # entries rows
    books = np.array([r.v for r in seeds], np.int64).reshape(len(seeds), parts, -1).transpose(1, 0, 2).copy()
    share = spark.sparkContext.broadcast
    book = share(books)
    residents = written(first_blocks(rows, book, max(1, partitions // 8)).repartition(partitions, "position", "entry", "salt"), "vector-residents")
    for k in range(rounds):
        books = updated(residents, book, books)
        book = share(books)
        if k < rounds - 1:
            residents = migrated(residents, book, partitions)
    code = F.lower(F.substring(F.concat(*(F.lpad(F.hex(x), 16, "0") for x in ("high", "low"))), 1, 2 * parts))
    found = coded(residents, book).select(F.col("key").alias("c_key"), code.alias("code"), "error")
    return rows.join(found, F.col("key") == F.col("c_key")).select("id", "label", "code", "error"), books


def op13_vector_codes(spark, sf_dir: str) -> DataFrame:
    from tidewrack.llm.common import table

    codes, books = vector_codes(table(spark, sf_dir, "embeddings"))
    codes = stage(codes, "vector-codes")
    per_label = small_side(codes.groupBy(F.col("label").alias("l_label")).agg(F.sum("error").alias("label_error")), row_bytes=32)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return codes.join(per_label, F.col("label").eqNullSafe(F.col("l_label"))).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _assign(book: str) -> str:
    distance = "list_sum(list_transform(list_zip(q.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    return f"SELECT r, p, any_value(q.x) AS x, min({{'d': CAST({distance} AS BIGINT), 'e': e}}) AS a FROM q JOIN {book} c USING (p) GROUP BY r, p"


def _update(assigned: str, book: str) -> str:
    means = f"""SELECT p, e, list(m ORDER BY i) AS x FROM (
      SELECT p, e, i, CAST(floor(sum(v)::DOUBLE / count(*)) AS BIGINT) AS m
      FROM (SELECT p, a.e AS e, unnest(x) AS v, unnest(range(len(x))) AS i FROM {assigned}) GROUP BY p, e, i) GROUP BY p, e"""
    return f"SELECT c.p, c.e, coalesce(n.x, c.x) AS x FROM {book} c LEFT JOIN ({means}) n USING (p, e)"


ORACLE = f"""WITH k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, * FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
q AS MATERIALIZED (SELECT r, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS x FROM k, range({PARTS}) t(p)),
c0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM q WHERE r <= {ENTRIES}),
a1 AS MATERIALIZED ({_assign("c0")}),
c1 AS MATERIALIZED ({_update("a1", "c0")}),
a2 AS MATERIALIZED ({_assign("c1")}),
c2 AS MATERIALIZED ({_update("a2", "c1")}),
a3 AS MATERIALIZED ({_assign("c2")}),
codes AS (SELECT r, string_agg(printf('%02x', a.e), '' ORDER BY p) AS code, CAST(sum(a.d) AS BIGINT) AS error FROM a3 GROUP BY r),
sha AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM k JOIN codes USING (r), sha"""
