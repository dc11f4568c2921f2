"""The pipeline's stages on a small folder, and odd rows through every stage."""

import corpus_pipeline as P
from conftest import SF0001


def test_stages_on_small_tables(spark):
    assert [name for name, _ in P.STAGES] == ["quality classifier", "n-gram jaccard join", "benchmark decontamination", "personal data", "mixing sources"]
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    odd = spark.createDataFrame([(None, "a text without an id and without a label", "en", "src0", 40), (10_001, None, None, None, None), (10_002, "", "en", "x", 0)], docs.schema)
    docs = docs.unionByName(odd).withColumn("score", docs.doc_id)  # an extra column with a name of its own use
    columns = docs.columns
    for name, step in P.STAGES[:-1]:
        kept = step(spark, docs, SF0001)
        assert kept.columns == columns, name
        rows = kept.collect()
        assert 0 < len(rows) <= docs.count(), name
        docs = spark.createDataFrame(rows, kept.schema)
    last = P.mixing_stage(spark, docs, SF0001).collect()
    assert {r.doc_id for r in last} <= {r.doc_id for r in docs.collect()} and all(0 < r.taken <= 2 * r.size for r in last)
    positions = [r.position for r in last]
    assert positions == sorted(positions)
