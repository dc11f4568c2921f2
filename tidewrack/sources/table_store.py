"""Versioned parquet table (S6 create-if-absent, S5/S9/S10 writes).

A table is a folder of versions ``v=00000001, v=00000002, ...``. A write goes to a new
version folder; readers take the highest version that has a ``_SUCCESS`` marker. So an
upsert may read version n and write version n+1 without ever overwriting what it is
reading, and a failed job leaves the previous version current.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewrack.operators.table import POSTS_SCHEMA


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def versions(spark: SparkSession, root: str, committed: bool = True) -> list[int]:
    """Version numbers in order; ``committed=False`` includes aborted writes."""
    fs, p, jvm = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            if not committed or fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[2:]))
    return sorted(out)


def create_if_absent(spark: SparkSession, root: str, schema=POSTS_SCHEMA) -> None:
    """CREATE TABLE IF NOT EXISTS - an empty first version with the schema."""
    if not versions(spark, root):
        write(spark.createDataFrame([], schema), root)


def read(spark: SparkSession, root: str, schema=POSTS_SCHEMA) -> DataFrame:
    vs = versions(spark, root)
    if not vs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/v={vs[-1]:08d}")


def write(df: DataFrame, root: str) -> int:
    """Write ``df`` as the next version; returns the version number. It is above every
    folder there is, so an aborted write does not block later ones."""
    spark = df.sparkSession
    vs = versions(spark, root, committed=False)
    nxt = (vs[-1] + 1) if vs else 1
    df.write.mode("errorifexists").parquet(f"{root}/v={nxt:08d}")
    return nxt
