"""Page files NNNN.json as a data source."""

import json

import pytest
from pyspark.sql import functions as F

from tidewrack.sources import page_files as PF
from tidewrack.sources import pages as PG


def body(page, pages, texts):
    return json.dumps({"meta": {"page": page, "page_count": pages}, "data": [{"id": f"{page}-{k}", "text": t} for k, t in enumerate(texts)]})


def frame(spark, rows):
    return spark.createDataFrame(rows, "page long, body string").repartition(3)


def test_names_and_round_trip(spark, tmp_path):
    root = str(tmp_path / "pages")
    rows = [(p, body(p, 3, [f"text {p}", None, "é"])) for p in (1, 2, 3)]
    PF.write_page_files(frame(spark, rows), root)
    assert sorted(p.name for p in (tmp_path / "pages").iterdir()) == ["0001.json", "0002.json", "0003.json"]
    assert [json.loads((tmp_path / "pages" / f"000{p}.json").read_text())["meta"]["page"] for p in (1, 2, 3)] == [1, 2, 3]
    (tmp_path / "pages" / "notes.json").write_text("{}")
    (tmp_path / "pages" / "12.json").write_text("{}")
    read = PF.read_page_files(spark, root, files_per_task=2)
    assert sorted(map(tuple, read.collect())) == rows and read.rdd.getNumPartitions() == 2
    items = PF.scan_page_files(spark, root)
    assert sorted((r.page, r.pos, r.text or "") for r in items.collect()) == sorted((p, k, t or "") for p in (1, 2, 3) for k, t in enumerate([f"text {p}", None, "é"]))


def test_append_replaces_given_pages_and_overwrite_all(spark, tmp_path):
    root = str(tmp_path / "pages")
    PF.write_page_files(frame(spark, [(1, "a"), (2, "b"), (12345, "c")]), root)
    PF.write_page_files(frame(spark, [(2, "B")]), root)
    assert sorted(map(tuple, PF.read_page_files(spark, root).collect())) == [(1, "a"), (2, "B"), (12345, "c")]
    PF.write_page_files(frame(spark, [(7, "x")]), root, overwrite=True)
    assert sorted(p.name for p in (tmp_path / "pages").iterdir()) == ["0007.json"]


def test_a_failed_write_leaves_no_file(spark, tmp_path):
    root = str(tmp_path / "pages")
    PF.write_page_files(frame(spark, [(1, "old")]), root)
    fails = F.udf(lambda p: 1 / 0 if p == 9 else "new", "string")
    with pytest.raises(Exception, match="ZeroDivisionError"):
        PF.write_page_files(frame(spark, [(p, "") for p in range(1, 10)]).withColumn("body", fails("page")), root)
    with pytest.raises(Exception, match="more than once"):
        PF.write_page_files(frame(spark, [(1, "a"), (1, "b")]), root)
    assert [(p.name, p.read_text()) for p in (tmp_path / "pages").iterdir() if p.is_file()] == [("0001.json", "old")]


def test_missing_pages_and_bad_documents_raise(spark, tmp_path):
    root = str(tmp_path / "pages")
    PF.write_page_files(frame(spark, [(p, body(p, 3, ["x"])) for p in (1, 3)]), root)
    with pytest.raises(PG.MissingPagesError, match="2"):
        PF.scan_page_files(spark, root)
    PF.write_page_files(frame(spark, [(2, "not a page")]), root)
    with pytest.raises(Exception, match="(?i)malformed"):
        PF.scan_page_files(spark, root).collect()
    assert PF.read_page_files(spark, str(tmp_path / "nowhere")).collect() == []
    assert {PF.file_system(p)[1] for p in ("/a/b", "file:/a/b", "file:///a/b")} == {"/a/b"}
