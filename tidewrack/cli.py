"""Command line: the feed-to-dataset jobs as Spark jobs.

    python -m tidewrack ingest    --pages DIR --table DIR [--total-pages N]
    python -m tidewrack stream    --pages DIR --landed DIR --checkpoint DIR
    python -m tidewrack normalise --table DIR [--force] [--model module:factory]
    python -m tidewrack sample    --table DIR --pairs DIR --n N [--seed S] --out DIR
    python -m tidewrack prepare   --pairs DIR --out DIR
    python -m tidewrack corpus    --table DIR --out DIR [--clean] [--length 128]

Each command reads and writes parquet/JSON folders (local paths or any Hadoop file
system URI); the session comes from ``spark-submit`` settings or ``get_spark``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F


def _ingest(spark, a):
    from tidewrack.plans.corpus import refresh_posts_table
    v = refresh_posts_table(spark, a.pages, a.table, a.total_pages, a.validation, a.quarantine)
    print(f"posts table {a.table}: version {v}")


def _stream(spark, a):
    from tidewrack.streaming.ingest import start_ingest
    q = start_ingest(spark, a.pages, a.landed, a.checkpoint, available_now=not a.continuous)
    q.awaitTermination()


def load_factory(spec: str):
    """``package.module:function`` -> the model factory (called once per Python worker)."""
    import importlib
    mod, _, name = spec.partition(":")
    return getattr(importlib.import_module(mod), name)


def _normalise(spark, a):
    from tidewrack.operators.infer import ModelBackend
    from tidewrack.plans.training import normalise_table
    backend = ModelBackend(load_factory(a.model)) if a.model else None
    print(f"posts table {a.table}: version {normalise_table(spark, a.table, a.force, backend)}")


def _sample(spark, a):
    from tidewrack.operators import prefs as PF
    from tidewrack.sources import table_store as TS
    posts = TS.read(spark, a.table)
    todo = PF.exclude_labelled(posts, PF.read_pairs(spark, a.pairs))
    PF.sample(todo, a.n, seed=a.seed).write.mode("overwrite").parquet(a.out)


def _label(spark, a):
    """Folds decisions (id, choice, human_text, proposal) and appends the pairs."""
    from tidewrack.operators import prefs as PF
    from tidewrack.sources import table_store as TS
    decisions = spark.read.parquet(a.decisions)
    pairs = PF.feedback_pairs(TS.read(spark, a.table).select("id", "raw_text"), decisions.select("id", "proposal"), decisions.select("id", "choice", "human_text"))
    print(f"pairs {a.pairs}: batch {PF.append_pairs(spark, a.pairs, pairs)}")


def _posts(spark, a):
    """Landed stream rows -> posts table version."""
    from tidewrack.operators.table import full_refresh
    from tidewrack.plans import corpus
    from tidewrack.sources import table_store as TS
    from tidewrack.streaming import ingest as ST
    posts = ST.landed_posts(ST.read_landed(spark, a.landed))
    print(f"posts table {a.table}: version {TS.write(full_refresh(corpus.sort_posts(posts).select('id', 'date', 'raw_text')), a.table)}")


def _prepare(spark, a):
    from tidewrack.operators import prefs as PF
    from tidewrack.plans.training import training_sets
    t = training_sets(PF.read_pairs(spark, a.pairs), ["batch", "seq"])
    t.reward.write.mode("overwrite").parquet(f"{a.out}/reward")
    t.ppo.drop("batch", "seq").write.mode("overwrite").parquet(f"{a.out}/ppo")
    t.tokens.write.mode("overwrite").parquet(f"{a.out}/tokens")


def _corpus(spark, a):
    from tidewrack.operators import lm as LM
    from tidewrack.sources import table_store as TS
    col = "clean_text" if a.clean else "raw_text"
    texts = TS.read(spark, a.table).select("id", F.col(col).alias("text")).where(F.col("text").isNotNull())
    rows = LM.lm_rows(LM.encode(texts, LM.vocabulary(texts), "id", length=a.length), "id", a.length)
    rows.write.mode("overwrite").parquet(f"{a.out}/sequences")


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidewrack")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("ingest")
    s.add_argument("--pages", required=True)
    s.add_argument("--table", required=True)
    s.add_argument("--total-pages", type=int, default=None)
    s.add_argument("--validation", choices=("failfast", "quarantine", "off"), default="failfast")
    s.add_argument("--quarantine", default=None, help="folder for the items of invalid pages")
    s = sub.add_parser("stream")
    s.add_argument("--pages", required=True)
    s.add_argument("--landed", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--continuous", action="store_true")
    s = sub.add_parser("posts")
    s.add_argument("--landed", required=True)
    s.add_argument("--table", required=True)
    s = sub.add_parser("normalise")
    s.add_argument("--table", required=True)
    s.add_argument("--force", action="store_true")
    s.add_argument("--model", default=None, help="module:factory of a model backend (default: rules)")
    s = sub.add_parser("sample")
    s.add_argument("--table", required=True)
    s.add_argument("--pairs", required=True)
    s.add_argument("--n", type=int, required=True)
    s.add_argument("--seed", default="0")
    s.add_argument("--out", required=True)
    s = sub.add_parser("label")
    s.add_argument("--table", required=True)
    s.add_argument("--decisions", required=True, help="parquet: id, proposal, choice, human_text")
    s.add_argument("--pairs", required=True)
    s = sub.add_parser("prepare")
    s.add_argument("--pairs", required=True)
    s.add_argument("--out", required=True)
    s = sub.add_parser("corpus")
    s.add_argument("--table", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--clean", action="store_true")
    s.add_argument("--length", type=int, default=128)
    return p


COMMANDS = {"ingest": _ingest, "stream": _stream, "posts": _posts, "normalise": _normalise, "sample": _sample,
            "label": _label, "prepare": _prepare, "corpus": _corpus}


def main(argv: list[str] | None = None, spark=None) -> int:
    args = build_parser().parse_args(argv)
    if spark is None:
        from tidewrack.session import get_spark
        spark = get_spark(app=f"tidewrack-{args.cmd}")
    COMMANDS[args.cmd](spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
