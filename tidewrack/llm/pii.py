"""Personal data by weak supervision.

*Base spans* (always kept), leftmost and non-overlapping per kind: email, ip, card, phone,
with their validity tests (a failing match is dropped without another try). They are found
in one linear scan per kind, also on very long runs of digits or letters.

*Candidates* are the base matches, the matches that fail their test, and spans of looser
patterns (named or prefixed secrets, long hex strings, national phone numbers, social
security numbers).

1. Labelers (regex, strict form, gazetteer, negative gazetteer, context words, borders)
   vote +1, 0 or -1 on every candidate.
2. Expectation-maximisation (Dawid and Skene) estimates each labeler's vote
   probabilities for true and false spans and every kind's share of true ones. It needs
   only the number of candidates per kind and vote pattern: at most kinds * 3^6 rows,
   whatever the number of documents.
3. A logistic span classifier on the span's form and context is trained on the posteriors
   of at most ``MAX_FIT`` candidates (those with the smallest hash). It decides on every
   candidate that is not a base span; those with p >= ``MIN_P`` are added.

Defined results: a null text is empty; rows with null or equal ids are handled row by row;
without candidates there is no model and nothing is added; an empty table gives an empty
result; extra columns pass through ``redact``.

Scale: one map pass, a table of candidates that is read back, an aggregate of vote
patterns. The driver sees the vote table and the bounded sample only.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.llm.common import map_rows, table
from tidewrack.session import stage

KINDS = ("email", "ip", "card", "phone", "secret", "hex", "national", "ssn")
BASE = KINDS[:4]
MAX_FIT = 20_000
MIN_P = 0.5
WIDTH = 2048
AROUND = 32  # code points of context on each side

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORTH = re.compile(r"[0-9@]")
LOOSE = (
    ("secret", re.compile(r"AKIA[0-9A-Z]{16}(?![0-9A-Z])")),
    ("secret", re.compile(r"(?i)(?:password|passwd|pwd|token|secret|api_?key)[\x20\t]{0,3}[=:][\x20\t]{0,3}\"?[^\s\"]{8,}\"?")),
    ("hex", re.compile(r"(?<![0-9a-fA-F])[0-9a-f]{32,}(?![0-9a-fA-F])")),
    ("national", re.compile(r"(?<![0-9+])(?:\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|0[0-9]{2,4}[ /-][0-9]{5,8})(?![0-9])")),
    ("ssn", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
)

# Gazetteers.
TOP_DOMAINS = frozenset("com org net edu gov mil int info biz io ai de fr es it uk us eu ch at nl be pl ru cn jp in br ca au".split())
COUNTRY_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "52", "54", "55", "61", "81", "82", "86", "90", "91", "351", "353", "358", "420")
CARD_PREFIXES = ("34", "37", "35", "36", "4", "51", "52", "53", "54", "55", "60", "62", "65")
CUES = {
    "email": ("mail", "contact", "write", "reach"), "ip": ("ip", "host", "server", "address", "from"), "card": ("card", "visa", "credit", "payment", "number"),
    "phone": ("tel", "phone", "call", "mobile", "fax"), "secret": ("key", "secret", "login", "credential"), "hex": ("key", "token", "secret", "hash"),
    "national": ("tel", "phone", "call", "fax"), "ssn": ("ssn", "social", "security"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str):
    """At each @: the run of local characters before it and the domain after it. Same
    spans as a leftmost search, but linear on long runs without an @."""
    free = 0
    at = text.find("@")
    while at >= 0:
        s = at
        while s > free and text[s - 1] in LOCAL:
            s -= 1
        m = DOMAIN.match(text, at + 1) if s < at else None
        if m:
            yield s, m.end(), True
            free = m.end()
        at = text.find("@", max(at + 1, free))


def ips(text: str):
    """Chains of numbers joined by dots, four at a time from the left."""
    for m in DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        parts, at = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            yield at, end, all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four)
            at = end + 1


def matched(pattern: re.Pattern, low: int, high: int, check):
    def find(text: str):
        for m in pattern.finditer(text):
            digits = digits_of(m.group())
            yield m.start(), m.end(), low <= len(digits) <= high and check(digits)

    return find


FINDERS = {"email": emails, "ip": ips, "card": matched(CARD, 12, 19, luhn), "phone": matched(PHONE, 9, 15, lambda d: True)}


def candidates(text: str) -> list[tuple[int, int, int, bool]]:
    """(start, end, kind, base) by start, then kind. Short numbers are no candidates."""
    out = []
    if not WORTH.search(text):
        return out
    for k, kind in enumerate(BASE):
        for s, e, ok in FINDERS[kind](text):
            if ok or kind != "card" or e - s >= 12:
                out.append((s, e, k, ok))
    for kind, pattern in LOOSE:
        out += [(m.start(), m.end(), KINDS.index(kind), False) for m in pattern.finditer(text)]
    return sorted(set(out), key=lambda x: (x[0], x[2], x[1]))


def votes(text: str, s: int, e: int, k: int, base: bool) -> tuple[int, ...]:
    """One vote of each labeler: regex, strict form, gazetteer, negative, context, borders."""
    kind, span = KINDS[k], text[s:e]
    digits = digits_of(span)
    regex = 1 if base else (-1 if kind in BASE else 0)
    strict = gazetteer = negative = 0
    if kind == "email":
        local, _, domain = span.partition("@")
        top = domain.rpartition(".")[2].lower()
        strict = 1 if top.isalpha() and 2 <= len(top) <= 24 and len(local) <= 64 and ".." not in local else -1
        gazetteer = 1 if top in TOP_DOMAINS else 0
    elif kind == "ip":
        parts = span.split(".")
        strict = 1 if all(p == "0" or p[0] != "0" for p in parts) and all(len(p) < 4 for p in parts) else -1
        gazetteer = 1 if base and 1 <= int(parts[0].lstrip("0") or 0) <= 223 else 0
        negative = -1 if span in ("0.0.0.0", "1.1.1.1", "1.2.3.4") or parts[0] in ("0", "127", "255") else 0
    elif kind == "card":
        strict = 1 if 13 <= len(digits) <= 19 and luhn(digits) else -1
        gazetteer = 1 if digits.startswith(CARD_PREFIXES) else 0
        negative = -1 if len(set(digits)) < 3 else 0
    elif kind in ("phone", "national"):
        strict = 1 if 10 <= len(digits) <= 13 else -1
        gazetteer = 1 if kind == "phone" and digits.startswith(COUNTRY_CODES) else 0
        negative = -1 if len(set(digits)) < 3 else 0
    elif kind == "ssn":
        strict = 1 if digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000" else -1
    else:
        value = re.split(r"[=:]", span)[-1].strip(" \t\"")
        strict = 1 if len(set(value)) >= 8 and digits else -1
        gazetteer = 1 if re.match(r"AKIA|(?i:password|token|secret|api_?key)", span) else 0
        negative = -1 if len(set(value)) < 5 or value.isalpha() else 0
    before = text[max(0, s - AROUND) : s].lower()
    context = 1 if any(c in before for c in CUES[kind]) else 0
    left, right = text[s - 1 : s], text[e : e + 1]
    borders = -1 if left.isalnum() or right.isalnum() else 1
    return regex, strict, gazetteer, negative, context, borders


def span_features(text: str, s: int, e: int, k: int) -> list[int]:
    """Hashed features of the form and the context of a span."""
    span = text[s:e]
    n_digits = len(digits_of(span))
    shape = re.sub(r"[a-z]+", "a", re.sub(r"[A-Z]+", "A", re.sub(r"[0-9]+", "9", span)))[:12]
    left, right = text[s - 1 : s], text[e : e + 1]
    word = re.findall(r"\w+", text[max(0, s - AROUND) : s].lower())[-1:]
    names = [
        f"k{k}", f"k{k} length {min(20, (e - s).bit_length() * 2 + ((e - s) >> max(0, (e - s).bit_length() - 2) & 1))}", f"k{k} digits {n_digits if n_digits < 20 else 20}",
        f"k{k} varied {min(16, len(set(span)))}", f"k{k} shape {shape}", f"k{k} left {'w' if left.isalnum() else left}", f"k{k} right {'w' if right.isalnum() else right}",
        f"k{k} luhn {n_digits >= 12 and luhn(digits_of(span))}", f"word {word}",
    ]
    return sorted({xxhash.xxh32_intdigest(n.encode()) % WIDTH for n in names})


FOUND = "doc_id long, found array<struct<s:long,e:long,k:int,base:boolean,votes:string,f:array<int>>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its candidates, votes and features."""

    def make(batch: pa.RecordBatch) -> dict:
        found = []
        for t in batch.column(1):
            text = t.as_py() or ""
            found.append([{"s": s, "e": e, "k": k, "base": base, "votes": " ".join(map(str, votes(text, s, e, k, base))), "f": span_features(text, s, e, k)} for s, e, k, base in candidates(text)])
        return {"doc_id": batch.column(0), "found": found}

    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), FOUND, make)


def expectation_maximisation(patterns: list[tuple[int, tuple[int, ...], int]], rounds: int = 50) -> dict[tuple[int, tuple[int, ...]], float]:
    """Posterior of a true span for each (kind, votes), from (kind, votes, count)."""
    kind = np.array([p[0] for p in patterns])
    vote = np.array([p[1] for p in patterns]) + 1
    count = np.array([p[2] for p in patterns], float)
    posterior = 1 / (1 + np.exp(-(vote - 1).sum(axis=1).astype(float)))
    for _ in range(rounds):
        mass = np.stack([count * (1 - posterior), count * posterior])
        prior = np.array([(1 + mass[1][kind == k].sum()) / (2 + count[kind == k].sum()) if (kind == k).any() else 0.5 for k in range(len(KINDS))])
        log_odds = np.log(prior[kind]) - np.log(1 - prior[kind])
        for j in range(vote.shape[1]):
            like = np.array([[1 + mass[c][vote[:, j] == v].sum() for v in range(3)] for c in (0, 1)])
            like /= like.sum(axis=1, keepdims=True)
            log_odds += np.log(like[1][vote[:, j]] / like[0][vote[:, j]])
        posterior = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    return {(int(k), tuple(int(x) for x in v)): float(p) for (k, v, _), p in zip(patterns, posterior, strict=True)}


def logistic(features: list[list[int]], target: np.ndarray, epochs: int = 150, l2: float = 1e-4) -> np.ndarray:
    """Weights of a logistic regression on soft targets (full-batch Adam)."""
    ids = np.array([i for f in features for i in f], np.int64)
    row = np.repeat(np.arange(len(features)), [len(f) for f in features])
    w, m, v = np.zeros(WIDTH), np.zeros(WIDTH), np.zeros(WIDTH)
    for step in range(1, epochs + 1):
        p = 1 / (1 + np.exp(-np.bincount(row, weights=w[ids], minlength=len(features))))
        g = np.bincount(ids, weights=(p - target)[row], minlength=WIDTH) / len(features) + l2 * w
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return w


def fit(found: DataFrame, max_rows: int = MAX_FIT) -> np.ndarray | None:
    """Span classifier weights from the scanned documents; None without candidates."""
    spans = found.select("doc_id", F.explode("found").alias("x")).select("doc_id", "x.*")
    patterns = [(r.k, tuple(map(int, r.votes.split())), r["count"]) for r in spans.groupBy("k", "votes").count().orderBy("k", "votes").collect()]
    if not patterns:
        return None
    posterior = expectation_maximisation(patterns)
    sample = spans.orderBy(F.xxhash64("doc_id", "s", "k"), "doc_id", "s", "e", "k").select("k", "votes", "f").limit(max_rows).collect()
    return logistic([r.f for r in sample], np.array([posterior[r.k, tuple(map(int, r.votes.split()))] for r in sample]))


def accepted(base: bool, features: list[int], w: np.ndarray | None) -> bool:
    return base or (w is not None and 1 / (1 + math.exp(-max(-50.0, min(50.0, float(w[features].sum()))))) >= MIN_P)


RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def detect(docs: DataFrame, **columns: str) -> DataFrame:
    """One row per document: base counts, digest of the base spans, all spans."""
    found = stage(scan(docs, **columns), "pii-candidates")
    held = found.sparkSession.sparkContext.broadcast(fit(found))

    def named(spans) -> str:
        return ",".join(f"{KINDS[x['k']]}:{x['s']}:{x['e']}" for x in spans)

    def make(batch: pa.RecordBatch) -> dict:
        out = {c: [] for c in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added")}
        for spans in batch.column(1):
            spans = spans.as_py() or []
            base = [x for x in spans if x["base"]]
            every = [x for x in spans if accepted(x["base"], x["f"], held.value)]
            for k, kind in enumerate(BASE):
                out[f"n_{kind}"].append(sum(x["k"] == k for x in base))
            out["base_sha256"].append(hashlib.sha256(named(base).encode()).hexdigest())
            out["spans"].append(named(every))
            out["n_added"].append(len(every) - len(base))
        return {"doc_id": batch.column(0)} | out

    return map_rows(found, RESULT, make)


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by ``<KIND>`` (overlapping spans as one, by
    its first kind) and ``n_chars`` renewed where the table has it. The model is fitted on
    all documents first."""
    held = docs.sparkSession.sparkContext.broadcast(fit(stage(scan(docs), "pii-candidates")))
    at = docs.columns.index("text")
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        out, end = [], 0
        for s, e, k, base in candidates(text):
            if not accepted(base, span_features(text, s, e, k), held.value):
                continue
            if s >= end:
                out += [text[end:s], f"<{KINDS[k].upper()}>"]
            end = max(end, e)
        return "".join([*out, text[end:]])

    def run(batches):
        for batch in batches:
            rows = [clean(t.as_py()) for t in batch.column(at)]
            columns = list(batch.columns)
            columns[at] = pa.array(rows, batch.schema.field(at).type)
            if chars is not None:
                new = [n.as_py() if r is None or r == t.as_py() else len(r) for r, t, n in zip(rows, batch.column(at), batch.column(chars), strict=True)]
                columns[chars] = pa.array(new, batch.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def op6_pii(spark, sf_dir: str) -> DataFrame:
    return detect(table(spark, sf_dir, "documents"))
