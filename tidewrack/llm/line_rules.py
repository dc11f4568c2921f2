"""Quality rules with cross-document line frequency.

Per text (inside Arrow tasks): word, symbol, repeated-line and repeated-window counts,
and one hash per distinct normalised line (ASCII lower case, white space collapsed).
Across documents (relational): for every (host, line) the number of distinct documents
that hold it. A line found in more than ``max(min_docs, share * documents of the host)``
documents of its host is boilerplate and is removed; a document that keeps fewer than
``min_left`` of its words is depleted and rejected.

Defined results: a null text counts as empty and fails the base rule; a null host is a
host of its own; rows of a host with equal ids are one document, which holds the lines of
all of them, and each row with a null id is a document of its own; words are removed and
judged per row; an empty table gives an empty result; extra columns are ignored.

Scale: lines are reduced to (host, hash, words) before the shuffle and their rows counted
map-side, so a line held by a third of all documents is one row per task. A line's rows
are at least its documents, so only lines in more than ``min_docs`` rows are joined back
and their documents counted, after a distinct that spreads one line by its documents. The
joins have one row per key on their right side, so a hot key can be split. Rows carry the
number they were staged with; sums and the last join are by that number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.llm.common import as_u8, map_rows, shingle_hashes, texts, word_hashes
from tidewrack.session import stage

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MIN_DOCS = 30
SHARE = 0.01
MIN_LEFT = 0.5

METRICS = "doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<struct<h:long,w:int>>"


def repeat_words(words: np.ndarray, k: int = 8) -> int:
    """Words inside ``k``-word windows that occur at least twice in the text."""
    if len(words) <= k:
        return 0
    win = shingle_hashes(words, k)
    order = np.argsort(win, kind="stable")
    same = win[order][1:] == win[order][:-1]
    twice = np.zeros(len(win), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    cover = np.zeros(len(words) + 1, np.int32)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + k, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def text_metrics(text: bytes | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, [(line hash, words)])."""
    b = as_u8(text)
    words = word_hashes(b)
    chars = int(((b & 0xC0) != 0x80).sum())
    white = int(np.isin(b, (32, 9, 10, 11, 12, 13)).sum())
    seen: set[bytes] = set()
    normal: dict[int, int] = {}
    repeated = 0
    for line in (text or b"").split(b"\n"):
        parts = line.split()
        if not parts:
            continue
        if line in seen:
            repeated += 1
        seen.add(line)
        h = xxhash.xxh3_64_intdigest(b" ".join(parts).lower())
        normal[h] = normal.get(h, 0) + len(parts)
    lines = [{"h": h - 2**64 if h >= 2**63 else h, "w": w} for h, w in normal.items()]
    return len(words), chars - white, int(SYMBOLS[b].sum()), repeated, repeat_words(words), lines


def line_metrics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    def make(batch: pa.RecordBatch) -> dict:
        rows = [text_metrics(t) for t in texts(batch.column(1))]
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines")
        return {"doc_id": batch.column(0), "host": batch.column(2)} | {n: [r[i] for r in rows] for i, n in enumerate(names)}

    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"), F.col(host_col).cast("string")), METRICS, make)


def quality_rules(docs: DataFrame, *, min_docs: int = MIN_DOCS, share: float = SHARE, min_left: float = MIN_LEFT, **columns: str) -> DataFrame:
    """One row per document: counts, words left after line removal, base rule and verdict."""
    m = stage(line_metrics(docs, **columns).withColumn("row", F.monotonically_increasing_id()), "line-metrics")
    document = F.struct("doc_id", F.when(F.col("doc_id").isNull(), F.col("row")).alias("no_id")).alias("document")
    base = m.select("row", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    lines = m.select("row", document, "host", F.explode("lines").alias("l")).select("row", "document", "host", "l.h", "l.w")
    limits = m.select("host", document).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("docs")).select(
        F.col("host").alias("limit_host"), F.greatest(F.lit(float(min_docs)), F.col("docs") * share).alias("limit"))
    in_rows = lines.groupBy("host", "h").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > min_docs).select(F.col("host").alias("f_host"), F.col("h").alias("f_h"))
    same = (F.col("h") == F.col("f_h")) & F.col("host").eqNullSafe(F.col("f_host"))
    held = stage(lines.join(in_rows, same, "inner").select("row", "document", "host", "h", "w"), "line-held")
    frequent = (
        held.select("host", "h", "document").distinct()
        .groupBy("host", "h").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > min_docs)
        .join(limits, F.col("host").eqNullSafe(F.col("limit_host")), "inner")
        .where(F.col("df") > F.col("limit"))
        .select(F.col("host").alias("f_host"), F.col("h").alias("f_h"))
    )
    removed = held.join(frequent, same, "inner").groupBy(F.col("row").alias("r_row")).agg(F.sum("w").alias("removed"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.coalesce(F.col("removed"), F.lit(0))
    return (
        base.join(removed, F.col("row") == F.col("r_row"), "left")
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                failed.alias("base_failed"), left.alias("n_words_left"),
                (~failed & (left >= min_left * F.col("n_words"))).alias("kept"))
    )


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    from tidewrack.llm.common import table

    return quality_rules(table(spark, sf_dir, "documents"))
