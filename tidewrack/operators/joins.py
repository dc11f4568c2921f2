"""Join helpers: broadcast only behind a size check, salt hot keys otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only if it takes at most this many bytes (checked beforehand).
BROADCAST_MAX_BYTES = 64_000_000


def small_side(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES, row_bytes: int | None = None) -> DataFrame:
    """Broadcast-hint ``df`` when it takes at most ``max_bytes``.

    With ``row_bytes`` (rows of fixed size) a bounded count decides. Else the bytes of the
    string columns are summed, plus 32 per row and column: one aggregate over ``df``,
    which should be a staged table. Larger sides are left to a shuffle join."""
    if row_bytes:
        limit = max_bytes // row_bytes
        return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
    strings = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if f.dataType.typeName() in ("string", "binary")]
    size = F.lit(32 * len(df.columns)).cast("long")
    for s in strings:
        size = size + s
    total = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if total <= max_bytes else df


def salted_join(big: DataFrame, dim: DataFrame, key: str, salts: int, salt_from: str, how: str = "inner") -> DataFrame:
    """Equi-join where ``big`` may have hot keys: ``big`` rows get salt
    ``pmod(hash(salt_from), salts)``; ``dim`` rows are replicated once per salt. Each
    hot key is thus spread over ``salts`` tasks. ``dim`` must be unique on ``key``."""
    salted_big = big.withColumn("_salt", F.pmod(F.hash(F.col(salt_from)), F.lit(salts)))
    salted_dim = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_big.join(salted_dim, [key, "_salt"], how).drop("_salt")
