"""Evaluate an expensive expression once.

``df.withColumn("t", chain).where(pred(t))`` lets the optimizer push the filter below
the projection, inlining the whole regex chain into the Filter once per predicate and
again in the Project. Binding the value through a one-element ``explode`` (a Generate)
stops that push-down, so the chain runs once per row. A null input still gives one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def materialise_once(df: DataFrame, name: str, expr: Column) -> DataFrame:
    cols = [F.col(c) for c in df.columns if c != name]
    out = df.select(*cols, F.explode(F.array(expr)).alias(name))
    order = df.columns if name in df.columns else [*df.columns, name]
    return out.select(*order)
