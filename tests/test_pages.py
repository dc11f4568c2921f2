"""JSON page sink/scan, completeness, validation, backlog, paging."""

import json

import pytest
from pyspark.sql import functions as F

from tidewrack.session import scratch_path
from tidewrack.sources import pages as PG
from tidewrack.sources.feed import load_feed
from conftest import SF0001


@pytest.fixture(scope="module")
def written(spark):
    feed = load_feed(spark, SF0001)
    path = scratch_path(spark, "pages-test")
    PG.write_pages(PG.build_pages(PG.feed_item_json(feed)), path)
    return feed, path


def test_roundtrip_keeps_feed_order(spark, written):
    feed, path = written
    items = PG.scan_pages(spark, path).select("page", "pos", "text").collect()
    want = feed.select((F.col("page") + 1).alias("page"), "pos", "text").collect()
    assert sorted(map(tuple, items), key=str) == sorted(map(tuple, want), key=str)


def test_missing_page_raises(spark, written):
    _, path = written
    pages = PG.read_pages(spark, path).where("meta.page <> 3")
    with pytest.raises(PG.MissingPagesError):
        PG.check_complete(pages)


def test_validation_modes(spark, written):
    _, path = written
    v = PG.validate_items(spark.read.option("wholetext", True).text(path))
    bad = v.where("NOT valid").select("missing", "wrong").distinct().collect()
    assert sorted(map(tuple, bad)) == [("", "social.post_text"), ("account_url", "")]  # null texts of Twitter items
    good, quarantined = PG.quarantine(v)
    assert good.where("NOT valid").count() == 0 and quarantined.count() > 0
    with pytest.raises(PG.InvalidPageError):
        PG.failfast(v)


def _document(**change):
    """A valid one-item page; ``change`` replaces values by dotted name (None: null,
    ``...``: absent)."""
    social = {"author": "a", "deleted_date": None, "favorite_count": 1, "hashtags": [], "in_reply_to_screen_name": None, "media_count": None,
              "media_durations": None, "media_filenames": ["f", 1], "media_urls": ["u"], "post_text": "t", "quote_flag": False, "repost_count": None,
              "repost_flag": False, "urls": [], "user_mentions": [], "repost_id": None, "quote_id": None}
    item = {"browse_flag": True, "date": "2024-01-01T00:00:00Z", "sequence": 1, "text": None, "deleted_flag": False, "score": 1.5, "platform": "Twitter", "social": social}
    item |= {k: "s" for k in ("document_id", "image_url", "media_type", "speaker", "speaker_id", "subject", "type", "handle", "id", "post_url", "search_id")}
    doc = {"meta": {k: 1 for k in ("milliseconds", "total_hits", "page_size", "page", "from", "page_count")} | {"pagination": {"previous_page": None, "next_page": None}},
           "data": [item], "stats": {"deleted": {"deleted": 0, "not_deleted": 1}, "platform": {"truth_social": 0, "x_twitter": 1, "unknown": 0}}}
    for name, value in change.items():
        at, keys = doc, name.split("__")
        for k in keys[:-1]:
            at = at["data"][0] if k == "item" else at[k]
        at.pop(keys[-1]) if value is ... else at.update({keys[-1]: value})
    return json.dumps(doc)


@pytest.mark.parametrize("change,missing,wrong", [
    ({}, "", ""), ({"item__extra": 1}, "", ""), ({"item__date": ...}, "date", ""), ({"item__date": None}, "", "date"), ({"item__sequence": "x"}, "", "sequence"),
    ({"item__platform": None}, "", "platform"), ({"item__platform": "Other"}, "", "platform"), ({"item__social__urls": ...}, "social.urls", ""),
    ({"item__social__hashtags": [1]}, "", "social.hashtags"), ({"item__social__post_text": None}, "", "social.post_text"),
    ({"meta__page_size": "x"}, "", "meta.page_size"), ({"stats__deleted": ...}, "", "stats.deleted.deleted,stats.deleted.not_deleted")])
def test_validation_of_values(spark, change, missing, wrong):
    r = PG.validate_items(spark.createDataFrame([(_document(**change),)], "value string")).collect()
    assert [(x.missing, x.wrong, x.valid, x.page_valid) for x in r] == [(missing, wrong, not missing + wrong, not missing + wrong)]


def test_malformed_document_is_a_bad_row(spark):
    rows = PG.validate_items(spark.createDataFrame([(_document(),), ('{"meta": {"page": 2}, "da',), ("",)], "value string"))
    assert sorted((r.wrong, r.valid) for r in rows.collect()) == [("", True), ("document", False), ("document", False)]
    with pytest.raises(PG.InvalidPageError):
        PG.failfast(rows)


def test_pages_past_9999_and_revisions(spark):
    feed = load_feed(spark, SF0001).where("page < 8")
    path = scratch_path(spark, "pages-many")
    items = PG.feed_item_json(feed, page_base=9997)
    PG.write_pages(PG.build_pages(items), path)
    pages = PG.read_pages(spark, path)
    numbers = sorted(r.page for r in items.select("page").distinct().collect())
    assert sorted(r.file_key for r in pages.select("file_key").collect()) == sorted(f"{n:04d}" for n in numbers) and numbers[-1] > 9999
    assert PG.page_items(pages).count() == items.count()
    # A newer revision of one page replaces it; pages outside 1..N do not count.
    one = scratch_path(spark, "pages-rev")
    PG.write_pages(PG.build_pages(PG.feed_item_json(feed)), one)
    small = PG.build_pages(PG.feed_item_json(feed.where("page = 2 AND pos < 1")))
    PG.write_pages(small.withColumn("file_key", F.lit("0003-2")), one, mode="append")
    got = PG.scan_pages(spark, one, 4)
    assert got.where("page = 3").count() == 1 and got.agg(F.max("page")).first()[0] == 4


def test_backlog(spark):
    present = spark.createDataFrame([(1,), (2,), (3,), (5,)], "page long")
    got = {r.page: (r.fetch, r.save) for r in PG.backlog(spark, present, 6).collect()}
    assert got == {1: (True, False), 2: (False, False), 3: (True, True), 4: (True, True), 5: (True, True), 6: (True, True)}


def test_paging(spark):
    rows = spark.range(0, 120).withColumnRenamed("id", "k")
    got = PG.paging(rows, ["k"], 50).orderBy("page").collect()
    assert [(r.page, r.page_size, r["from"], r.previous_page, r.next_page) for r in got] == [
        (1, 50, 1, None, 2), (2, 50, 51, 1, 3), (3, 20, 101, 2, None)]
