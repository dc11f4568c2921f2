"""Preference data: feedback fold, pair store, sampling, training rows.

A comparison pair is ``(id, input, accepted, rejected: array<string>)``.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.functions.text import strip
from tidewrack.operators.order import global_row_number
from tidewrack.schemas import PAIR, STORED_PAIR


class SampleTooLargeError(ValueError):
    pass


def feedback_pairs(posts: DataFrame, proposals: DataFrame, decisions: DataFrame) -> DataFrame:
    """fold decisions into pairs.

    ``posts`` (id, raw_text, ...), ``proposals`` (id, proposal), ``decisions``
    (id, choice, human_text). ``y`` gives (accepted=proposal, rejected=[]), ``n`` gives
    (accepted=stripped human text, rejected=[proposal]), anything else nothing; only
    pairs with a non-empty ``rejected`` are stored, so only ``n`` rows survive. Extra
    columns of ``posts`` (e.g. feed position) are carried along."""
    j = posts.join(proposals, "id").join(decisions, "id")
    folded = j.withColumn("accepted", F.when(F.col("choice") == "y", F.col("proposal"))
                          .when(F.col("choice") == "n", strip("human_text")))
    folded = folded.withColumn("rejected", F.when(F.col("choice") == "y", F.array().cast("array<string>"))
                               .when(F.col("choice") == "n", F.array(F.col("proposal"))))
    extra = [c for c in posts.columns if c not in ("id", "raw_text")]
    return folded.where(F.col("rejected").isNotNull() & (F.size("rejected") > 0)).select(
        "id", F.col("raw_text").alias("input"), "accepted", "rejected", *extra)


def exclude_labelled(posts: DataFrame, pairs: DataFrame) -> DataFrame:
    """M4: posts that have no pair yet (anti join on id). Pairs are append-only, so one
    post may be labelled many times: ids are made distinct first (map-side combined)."""
    return posts.join(pairs.select("id").distinct(), "id", "left_anti")


def sample(rows: DataFrame, n: int, seed: str = "0", key: str = "id") -> DataFrame:
    """M5: ``n`` rows without replacement, reproducible: the ``n`` smallest
    sha256(seed || key). Planned as a top-k (TakeOrderedAndProject), never a full sort.
    Asking for more rows than exist raises, as sampling without replacement does."""
    have = rows.limit(n).count()
    if have < n:
        raise SampleTooLargeError(f"sample of {n} requested from {have} rows")
    h = F.sha2(F.concat(F.lit(seed), F.col(key).cast("string")), 256)
    return rows.withColumn("_h", h).orderBy("_h").limit(n).drop("_h")


def append_pairs(spark: SparkSession, path: str, new: DataFrame, order: Sequence[str] = ("id",)) -> int:
    """add pairs behind the stored ones, no dedupe. They go to a folder of their own,
    ``batch=N``, with their place in it by ``order`` as ``seq``, so nothing that is stored
    (and may be read by this very job) is touched. Returns the batch number."""
    batch = 1 + max(_batches(spark, path), default=0)
    _numbered(new, order).write.mode("errorifexists").json(f"{path}/batch={batch}")
    return batch


def _numbered(pairs: DataFrame, order: Sequence[str]) -> DataFrame:
    cols = [f.name for f in PAIR.fields]
    extra = [c for c in order if c not in cols]
    return global_row_number(pairs.select(*cols, *extra), list(order), "seq").select(*cols, "seq")


def _batches(spark: SparkSession, path: str) -> list[int]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return [int(n[6:]) for n in names if n.startswith("batch=")]


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Pairs stored as JSON lines in batches, or the single-object export
    ``{"comparison_pairs": [...]}``. A missing path is an empty set, with a warning.
    ``batch`` and ``seq`` give the stored order."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        warnings.warn(f"preference dataset {path} does not exist", stacklevel=2)
        return spark.createDataFrame([], STORED_PAIR)
    if fs.getFileStatus(p).isFile() and path.endswith(".json"):
        return _explode_document(spark.read.option("multiLine", True).schema(_DOC).json(path))
    if fs.exists(jvm.org.apache.hadoop.fs.Path(path, "_EXPORT")):
        return _explode_document(spark.read.schema(_DOC).json(path))
    return spark.read.schema(STORED_PAIR).json(path)


_DOC = f"comparison_pairs array<{PAIR.simpleString()}>"


def _explode_document(doc: DataFrame) -> DataFrame:
    return doc.select(F.posexplode("comparison_pairs").alias("_i", "p")).select(
        "p.*", (F.col("_i") + 1).cast("long").alias("seq"), F.lit(0).alias("batch"))


def write_pairs(pairs: DataFrame, path: str, order: Sequence[str] = ("id",)) -> None:
    """Replace the stored set by one batch. The new set is written beside the old one,
    which it may have been read from, and takes its place when it is complete: the old files
    go last. A job that fails before leaves the stored set as it was."""
    spark = pairs.sparkSession
    mark = uuid.uuid4().hex[:12]
    _numbered(pairs, order).withColumn("batch", F.lit(1)).write.partitionBy("batch").json(f"{path}.new-{mark}")
    jvm = spark.sparkContext._jvm
    place, fresh, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.new-{mark}", f"{path}.old-{mark}"))
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(place) and not fs.rename(place, old):
        raise OSError(f"{path} cannot be moved away")
    if not fs.rename(fresh, place):
        raise OSError(f"{path}.new-{mark} cannot be moved to {path}")
    fs.delete(old, True)


# A one-document export holds every pair in one JSON object, so it is only written for
# sets whose size has been checked.
EXPORT_MAX_PAIRS = 100_000


def export_pairs_document(pairs: DataFrame, path: str, max_pairs: int = EXPORT_MAX_PAIRS) -> None:
    """S11 export: ``{"comparison_pairs": [...]}`` as one JSON document (the original
    file format), by (batch, seq).
    Refuses sets larger than ``max_pairs`` (counted with a bounded ``limit``); large sets
    stay in the parallel JSON-lines form of ``write_pairs``."""
    n = pairs.limit(max_pairs + 1).count()
    if n > max_pairs:
        raise ValueError(f"{n}+ pairs: too many for a one-document export; use write_pairs")
    cols = [f.name for f in PAIR.fields]
    doc = pairs.agg(F.array_sort(F.collect_list(F.struct("batch", "seq", *cols))).alias("_ps")).select(
        F.to_json(F.struct(F.transform("_ps", lambda x: x.dropFields("batch", "seq")).alias("comparison_pairs"))).alias("value"))
    doc.coalesce(1).write.mode("overwrite").text(path)
    jvm = pairs.sparkSession.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path, "_EXPORT")
    marker.getFileSystem(pairs.sparkSession.sparkContext._jsc.hadoopConfiguration()).create(marker, True).close()


def reward_rows(pairs: DataFrame) -> DataFrame:
    """(chosen, rejected) for pairs with a non-empty accepted and rejected list;
    rejected is the first rejected text."""
    ok = (F.col("accepted").isNotNull() & (F.col("accepted") != "")
          & F.col("rejected").isNotNull() & (F.size("rejected") > 0))
    return pairs.where(ok).select(F.col("accepted").alias("chosen"), F.element_at("rejected", 1).alias("rejected"))


def _msg(content, role: str):
    return F.struct(content.alias("content"), F.lit(role).alias("role"))


def ppo_rows(pairs: DataFrame, tolerant: bool = False) -> DataFrame:
    """F8: prompt = input; chosen / rejected = [user input, assistant answer]. Like the
    original, a pair with an empty ``rejected`` list fails (ANSI index error) unless
    ``tolerant``, which yields a null answer instead."""
    first = F.get(F.col("rejected"), 0) if tolerant else F.col("rejected")[0]
    return pairs.select(
        F.col("input").alias("prompt"),
        F.array(_msg(F.col("input"), "user"), _msg(F.col("accepted"), "assistant")).alias("chosen"),
        F.array(_msg(F.col("input"), "user"), _msg(first, "assistant")).alias("rejected"),
        *[c for c in pairs.columns if c not in ("id", "input", "accepted", "rejected")],
    )


def positional_split(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """the last floor(n/2) rows (in ``order``) are ``eval``, the rest ``train``.
    Row numbers come from range blocks, not a one-partition window."""
    numbered = global_row_number(rows, list(order), "_rn")
    # Counted on the numbered rows (a scan of the staged table), not on ``rows``.
    n = numbered.agg(F.count(F.lit(1)).cast("long")).scalar()  # scalar subquery, run once
    split = F.when(F.col("_rn") <= n - F.floor(n / 2), F.lit("train")).otherwise(F.lit("eval"))
    return numbered.withColumn("split", split).withColumnRenamed("_rn", "row_number")
