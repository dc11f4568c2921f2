"""Shared helpers of the training-data operators.

Texts are handled as UTF-8 bytes inside Arrow tasks. A *word* is a maximal run of bytes
other than space and 0x09-0x0D, which is what ``bytes.split()`` returns. Hashes are
64-bit polynomial prefix hashes over the whole text, so the hash of any byte span is two
array look-ups; they are deterministic across processes and reruns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from tidewrack.session import spread

U64 = np.uint64
_rng = np.random.default_rng(20240607)
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 2**64)
NOT_WS = np.ones(256, bool)
NOT_WS[[32, 9, 10, 11, 12, 13]] = False

_pow: dict[str, np.ndarray] = {}


def _powers(name: str, base: int, n: int) -> np.ndarray:
    have = _pow.get(name)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        steps = np.full(size, U64(base))
        steps[0] = 1
        have = _pow[name] = np.multiply.accumulate(steps)
    return have


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Finaliser with full avalanche over 64 bits."""
    x = x + U64((salt * 0x632BE59BD9B4E019 + 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def prefix_hash(b: np.ndarray) -> np.ndarray:
    """``p`` of length n+1; the span [s, e) hashes to ``span(p, s, e)``."""
    p = np.zeros(len(b) + 1, U64)
    np.cumsum(BYTE_CODE[b] * _powers("up", BASE, max(1, len(b)))[: len(b)], out=p[1:])
    return p


def span(p: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hash of the byte spans [s, e), independent of where they stand; length included."""
    inv = _powers("down", BASE_INV, len(p))
    return mix((p[e] - p[s]) * inv[s] + (e - s).astype(U64) * U64(0xD6E8FEB86659FD93))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edge = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
    return edge[0::2], edge[1::2]


LONG_WORD = 64


def word_hashes(b: np.ndarray, spans: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """One 64-bit hash for each word of the text, in order. The polynomial hash is weak for
    long words (modulo 2^64, words built by doubling can agree), so words of more than
    ``LONG_WORD`` bytes are hashed from their bytes. ``spans``: the words, if known."""
    s, e = spans or runs(NOT_WS[b])
    out = span(prefix_hash(b), s, e)
    for i in np.flatnonzero(e - s > LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(b[s[i] : e[i]].tobytes())
    return out


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words; with fewer words (but some), the whole sequence."""
    n = len(words)
    if not n:
        return words
    k = min(k, n)
    out = np.zeros(n - k + 1, U64)
    for i in range(k):
        out = (out ^ words[i : n - k + 1 + i]) * U64(0xFF51AFD7ED558CCD) + U64(i + 1)
        out ^= out >> U64(29)
    return mix(out, k)


def as_u8(text: bytes | None) -> np.ndarray:
    return np.frombuffer(text or b"", np.uint8)


def texts(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes | None]:
    """UTF-8 bytes of a string column, one row at a time."""
    for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield x.as_py()


def map_rows(df: DataFrame, schema: str, make: Callable[[pa.RecordBatch], dict]) -> DataFrame:
    """``mapInArrow`` with one output batch per input batch; ``make`` returns named columns."""
    from pyspark.sql.types import StructType, _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = _parse_datatype_string(schema) if df.sparkSession else StructType()
    arrow = to_arrow_schema(kind)

    def run(batches):
        for batch in batches:
            got = make(batch)
            yield pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) if not isinstance(got[f.name], pa.Array) else got[f.name].cast(f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, kind)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table; spread over the cores when it has fewer splits than cores."""
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))
