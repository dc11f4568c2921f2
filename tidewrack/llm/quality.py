"""Quality classifier: ordinal cumulative-link regression on hashed text.

Grades come from the labels: 0 toxic, 1 poor, 2 good. One weight vector ``w`` over hashed
tokens is shared by all grades, and thresholds ``t1 < t2`` cut the score:
``P(grade <= k) = sigmoid(t_{k+1} - w.x)``. Selection uses the expected grade and the
tail probability ``P(grade >= 2)``.

Tokens are maximal runs of letters and digits (ASCII lower case, all bytes over 127) and
maximal runs of other marks; a feature is a token's presence in the text, hashed to
``BUCKETS``, plus a few features of shape (share of capitals, marks, repeated words).
Presence does not grow with length, and buckets whose frequency does not differ
significantly between good and other documents are left out, so a long clean text does
not collect noise.

The fit uses a bounded sample of the labelled rows: at most ``MAX_FIT`` documents and
``MAX_FIT_BYTES`` bytes of text, none above ``MAX_TEXT_BYTES``, those with the smallest hash
of their id. If the bounds leave fewer than two grades of several, ``fit`` raises. Scoring
covers every row and the whole text.

Defined results: a null text has no token and gets the score of its shape features; rows
with a null id are scored like others (they cannot carry a label); a document with
several labels takes its lowest grade; labels with a null quality are not used; without
labels of at least two grades there is no model, scores are null and all rows are kept;
an empty table gives an empty result; extra columns pass through ``select_quality``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.llm.common import U64, as_u8, map_rows, prefix_hash, runs, span, table, texts

BITS = 18
BUCKETS = 1 << BITS
SHAPES = 24
MAX_FIT = 12_000
MAX_FIT_BYTES = 64_000_000
MAX_TEXT_BYTES = 2_000_000  # of one text in the fit's sample
MIN_TAIL = 0.5
MIN_Z = 4.5
EPOCHS = 200

KIND = np.full(256, 2, np.int8)  # 0 white space, 1 letters and digits, 2 marks
KIND[[32, 9, 10, 11, 12, 13]] = 0
KIND[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = 1
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def level(x: float, steps: tuple[float, ...]) -> int:
    return sum(x >= s for s in steps)


def features(text: bytes | None) -> np.ndarray:
    """Distinct feature ids of a text, sorted."""
    b = as_u8(text)
    kind = KIND[b]
    p = prefix_hash(LOWER[b])
    ids, words = [], np.zeros(0, U64)
    for k in (1, 2):
        h = span(p, *runs(kind == k))
        words = h if k == 1 else words
        ids.append((h >> U64(64 - BITS)).astype(np.int64))
    n = max(1, len(b))
    capital = float(((b >= 65) & (b <= 90)).sum()) / n
    marks = float((kind == 2).sum()) / n
    varied = len(np.unique(words)) / max(1, len(words))
    shape = [
        level(capital, (0.02, 0.05, 0.1, 0.2, 0.4)),
        6 + level(marks, (0.01, 0.03, 0.06, 0.12, 0.2)),
        12 + level(varied, (0.05, 0.1, 0.2, 0.35, 0.5)),
        18 + level(len(words), (3, 10, 20, 50, 200)),
    ]
    return np.unique(np.concatenate([*ids, np.array(shape) + BUCKETS]))


def grade_of() -> Column:
    return F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)


def fit_sample(docs: DataFrame, labels: DataFrame, max_rows: int, max_bytes: int, max_text: int = MAX_TEXT_BYTES) -> DataFrame:
    """Bounded sample of labelled rows: ``doc_id, grade, text``.

    It is chosen from ids and sizes: of a repeated id the smallest text (then by hash), no
    text above ``max_text``, then by the ids' hash while the sum of bytes is within
    ``max_bytes``. At most ``max_rows`` rows without texts go through the window; the texts of
    the chosen ids are joined after it."""
    graded = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min(grade_of()).alias("grade"))
    some = graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    keyed = docs.where("text IS NOT NULL").select("doc_id", F.octet_length("text").alias("bytes"), F.xxhash64("text").alias("th"), "text")
    sizes = keyed.drop("text").where(F.col("bytes") <= max_text).join(F.broadcast(some), "doc_id").groupBy("doc_id", "grade").agg(F.min(F.struct("bytes", "th")).alias("t"))
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = sizes.select("doc_id", "grade", "t.bytes", "t.th", F.sum("t.bytes").over(order).alias("sum")).where(F.col("sum") <= max_bytes).select("doc_id", "grade", "th")
    return keyed.join(F.broadcast(chosen), ["doc_id", "th"]).select("doc_id", "grade", "text").dropDuplicates(["doc_id"])


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT, max_bytes: int = MAX_FIT_BYTES) -> dict | None:
    """Weights and thresholds, or None if the labels hold fewer than two grades."""

    def make(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0), "grade": batch.column(1), "ids": [features(t).astype("<i4").tobytes() for t in texts(batch.column(2))]}

    rows = map_rows(fit_sample(docs, labels, max_rows, max_bytes), "doc_id long, grade int, ids binary", make).toArrow().sort_by("doc_id")
    grade = rows.column("grade").to_numpy()
    if len(np.unique(grade)) < 2:
        there = labels.where("quality IS NOT NULL").join(docs.where("text IS NOT NULL").select("doc_id"), "doc_id", "left_semi").select(grade_of().alias("grade")).distinct()
        if there.count() > max(1, len(np.unique(grade))):
            raise ValueError("labelled documents of several grades, but the bounded sample has one at most: raise its bounds")
        return None
    parts = [np.frombuffer(x.as_py(), "<i4") for x in rows.column("ids")]
    return cumulative_link(parts, grade)


def screen(ids: np.ndarray, doc: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Buckets whose share of non-good documents differs from the sample's by MIN_Z
    standard errors; a bucket needs five documents. Shape features always stay."""
    seen = np.bincount(ids, minlength=BUCKETS + SHAPES)
    low = np.bincount(ids, weights=bad[doc], minlength=BUCKETS + SHAPES)
    base = bad.mean()
    z = np.abs(low - seen * base) / np.sqrt(np.maximum(seen, 1) * base * (1 - base))
    keep = (seen >= 5) & (z >= MIN_Z)
    keep[BUCKETS:] = True
    return keep


def cumulative_link(parts: list[np.ndarray], grade: np.ndarray, epochs: int = EPOCHS, l2: float = 2e-4) -> dict:
    """Full-batch Adam on the mean negative log likelihood of the cumulative-link model."""
    ids = np.concatenate(parts)
    doc = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
    keep = screen(ids, doc, (grade < 2).astype(float))
    ids, doc = ids[keep[ids]], doc[keep[ids]]
    column = np.cumsum(keep) - 1
    ids = column[ids]
    n, width = len(parts), int(keep.sum())
    w = np.zeros(width)
    share = np.clip([(grade <= 0).mean(), (grade <= 1).mean()], 0.002, 0.998)
    t = np.log(share / (1 - share))
    t[1] = max(t[1], t[0] + 0.1)
    theta = np.array([t[0], np.log(t[1] - t[0])])  # second threshold = first + exp
    first, second = [np.zeros(width), np.zeros(2)], [np.zeros(width), np.zeros(2)]
    for step in range(1, epochs + 1):
        score = np.bincount(doc, weights=w[ids], minlength=n)
        cuts = np.array([-np.inf, theta[0], theta[0] + np.exp(theta[1]), np.inf])
        with np.errstate(over="ignore"):
            upper = 1 / (1 + np.exp(-(cuts[grade + 1] - score)))
            lower = 1 / (1 + np.exp(-(cuts[grade] - score)))
        p = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
        g_w = np.bincount(ids, weights=(du - dl)[doc], minlength=width) / n + l2 * w
        at = [(-(du * (grade == k)) + dl * (grade == k + 1)).mean() for k in (0, 1)]
        g_t = np.array([at[0] + at[1], at[1] * np.exp(theta[1])])
        for x, g, m, v in ((w, g_w, first[0], second[0]), (theta, g_t, first[1], second[1])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    full = np.zeros(BUCKETS + SHAPES, np.float32)
    full[keep] = w
    return {"w": full, "cuts": (float(theta[0]), float(theta[0] + np.exp(theta[1])))}


def tails(score: np.ndarray, cuts: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """P(grade >= 1) and P(grade >= 2)."""
    return tuple(1 / (1 + np.exp(-(score - c))) for c in cuts)


def score(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, score, expected_grade, p_good, kept`` for every row. The broadcast model
    has a fixed size (BUCKETS + SHAPES floats)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make(batch: pa.RecordBatch) -> dict:
        m, n = held.value, batch.num_rows
        if m is None:
            none = pa.nulls(n, pa.float64())
            return {"doc_id": batch.column(0), "score": none, "expected_grade": none, "p_good": none, "kept": [True] * n}
        s = np.array([m["w"][features(t)].sum(dtype=np.float64) for t in texts(batch.column(1))])
        one, two = tails(s, m["cuts"])
        return {"doc_id": batch.column(0), "score": s, "expected_grade": one + two, "p_good": two, "kept": two >= MIN_TAIL}

    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), "doc_id long, score double, expected_grade double, p_good double, kept boolean", make)


def select_quality(docs: DataFrame, model: dict | None) -> DataFrame:
    """The rows whose tail probability passes, with their own columns. One pass, no join:
    the verdict is a filter on the text itself."""
    if model is None:
        return docs
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            m = held.value
            s = np.array([m["w"][features(t)].sum(dtype=np.float64) for t in texts(batch.column(at))])
            yield batch.filter(pa.array(tails(s, m["cuts"])[1] >= MIN_TAIL))

    return docs.mapInArrow(run, docs.schema)


def fit_tables(docs: DataFrame, spark, sf_dir: str) -> dict | None:
    return fit(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def op2_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit_tables(docs, spark, sf_dir))
