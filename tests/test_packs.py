"""Packs of many pages: the same rows as one file for each page, files that follow the bytes."""

import pytest
from pyspark.sql import functions as F

from tidewrack import catalog
from tidewrack.plans import corpus
from tidewrack.session import scratch_path
from tidewrack.sources import pages as PG
from tidewrack.sources import table_store
from tidewrack.sources.feed import load_feed
from tidewrack.streaming import ingest as ST
from conftest import SF001


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def data_files(path):
    from pathlib import Path
    return [f for f in Path(path.removeprefix("file:")).rglob("part-*") if "_temporary" not in str(f)]


@pytest.fixture(scope="module")
def both(spark):
    """100 pages in both layouts; pages 3 and 64 also in a second revision."""
    documents = PG.build_pages(PG.feed_item_json(load_feed(spark, SF001))).cache()
    again = documents.where("page IN (3, 64)").select("page", F.concat("file_key", F.lit("-1")).alias("file_key"), F.regexp_replace("body", '"text":"', '"text":"new ').alias("body"))
    single, packs = scratch_path(spark, "single"), scratch_path(spark, "packs")
    for part in (documents, again):
        PG.write_pages(part, single)
        PG.write_packs(part, packs, 16)
    return single, packs


def test_same_pages_in_fewer_files(spark, both):
    single, packs = both
    assert PG.pack_size(spark, single) is None and PG.pack_size(spark, packs) == 16
    assert len(data_files(single)) == 102 and len(data_files(packs)) == 7 + 2
    assert rows(PG.read_documents(spark, single).select("file_key", F.trim("value", F.lit("\n")))) == rows(PG.read_documents(spark, packs).select("file_key", "value"))
    assert rows(PG.read_pages(spark, single).select("file_key", "meta", "data", "stats")) == rows(PG.read_pages(spark, packs).select("file_key", "meta", "data", "stats"))
    got = PG.scan_pages(spark, packs)
    assert rows(got) == rows(PG.scan_pages(spark, single).select(*got.columns)) and got.where("text LIKE 'new %'").count() > 0


def test_the_stream_takes_packs(spark, both):
    landed = []
    for path in both:
        landed.append(scratch_path(spark, "landed"))
        q = ST.start_ingest(spark, path, landed[-1], scratch_path(spark, "ckpt"), max_files_per_trigger=4)
        q.awaitTermination()
        assert q.exception() is None
    single, packs = (spark.read.parquet(p) for p in landed)
    assert rows(ST.read_landed(spark, landed[0])) == rows(ST.read_landed(spark, landed[1]))
    assert single.agg(F.max("batch")).first()[0] == 25 and packs.agg(F.max("batch")).first()[0] == 2


def test_query_pages_are_packed(spark):
    """100 pages are one file, not 100."""
    path = catalog._written_pages(spark, SF001)
    assert len(data_files(path)) == 1 and PG.read_pages(spark, path).count() == 100


def test_validation_of_packed_documents(spark, both):
    """A document stays one document: bad ones and those of several lines, too."""
    bad = spark.createDataFrame([(7, "0007-9", '{"meta": {"page": 7}, "da'), (8, "0008-9", '{"meta":\n {"page": 8},\n "data": []}')], "page long, file_key string, body string")
    path = scratch_path(spark, "packs")
    PG.write_packs(bad, path)
    assert rows(PG.read_documents(spark, path).select("file_key", "value")) == [("0007-9", bad.collect()[0].body), ("0008-9", bad.collect()[1].body)]
    found = PG.validate_items(PG.read_documents(spark, path)).select("page", "wrong", "valid").collect()
    assert len(found) == 2 and not any(r.valid for r in found) and "document" in {r.wrong for r in found}
    single, packs = both
    raw = [PG.validate_items(PG.newest_revisions(PG.read_documents(spark, p).select("value", "file_key"))) for p in (single, packs)]
    assert rows(raw[0]) == rows(raw[1])
    with pytest.raises(Exception):
        PG.read_pages(spark, path).collect()
    assert rows(PG.read_pages(spark, path, "PERMISSIVE").select("file_key")) == [("0007-9",), ("0008-9",)]


def test_posts_table_of_packs(spark, both):
    """The feed job over packs, with and without validation."""
    tables = []
    for path in both:
        for validation in ("off", "quarantine"):
            root = scratch_path(spark, "posts-table")
            corpus.refresh_posts_table(spark, path, root, validation=validation, quarantine_dir=scratch_path(spark, "bad"))
            tables.append(rows(table_store.read(spark, root)))
    assert tables[0] == tables[2] and tables[1] == tables[3] and len(tables[0]) > len(tables[1]) > 0


def test_streamed_posts_of_packs(spark, both):
    posts = []
    for path in both:
        landed = scratch_path(spark, "landed")
        ST.start_ingest(spark, path, landed, scratch_path(spark, "ckpt"), max_files_per_trigger=64).awaitTermination()
        posts.append(rows(ST.landed_posts(ST.read_landed(spark, landed))))
    assert posts[0] == posts[1] and posts[0]
