"""The incremental merge against the full one, for random pages, splits and revisions."""

import json
import random
import shutil

import pytest
from pyspark.sql import functions as F

from tidewrack.plans import corpus
from tidewrack.plans import incremental as IN
from tidewrack.sources import pages as PG

DATE = "2024-01-0{}T10:00:00-05:00"


def document(page, texts):
    items = [{"id": f"{page}-{k}", "date": DATE.format(1 + (page + k) % 9), "platform": "Twitter", "deleted_flag": False, "text": t} for k, t in enumerate(texts)]
    return json.dumps({"meta": {"page": page, "page_count": 1}, "data": items})


def save(root, page, texts, revision=""):
    folder = root / f"file_key={page:04d}{revision}"
    folder.mkdir(parents=True, exist_ok=True)
    for f in folder.iterdir():
        f.unlink()
    (folder / f"part-{random.randrange(10**9)}.txt").write_text(document(page, texts))


def full(spark, path):
    """The whole chain over the newest revisions."""
    rows = PG.page_items(PG.newest_revisions(PG.read_pages(spark, str(path)))).select("page", "pos", "date", "text")
    kept = corpus.filter_feed(corpus.clean_feed(rows))
    merged = corpus.thread_merge(kept, carry=("date",)).select("page", "pos", "date", "text", "n_parts")
    return merged, corpus.dedupe_posts(corpus.keyed_posts(merged))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def some_texts(rng, heads):
    pool = ["... goes on", "....on", "...", "...same", "[Image]", None, "   "]
    pool += ["A post", "Another one", "Same post"] * heads
    return [rng.choice(pool) for _ in range(rng.randint(0, 5))]


@pytest.mark.parametrize("seed, heads", [(1, 0), (2, 1), (3, 4)])
def test_equal_to_the_full_merge(spark, tmp_path, seed, heads):
    rng = random.Random(seed)
    pages_dir, root = tmp_path / "pages", str(tmp_path / "merged")
    live = {}
    for step in range(4):
        changed = set()
        for _ in range(rng.randint(2, 9)):
            page = rng.randint(1, 30)
            revision = live.get(page, -1) + 1
            save(pages_dir, page, some_texts(rng, heads), f"-{revision}" if revision else "")
            live[page] = revision
            changed.add(page)
        if step == 2 and live:
            gone = rng.choice(sorted(live))
            for f in pages_dir.glob(f"file_key={gone:04d}*"):
                shutil.rmtree(f)
            del live[gone]
            changed.add(gone)
        before = {r[:5] for r in rows(IN._posts(IN._read(spark, f"{root}/merged", IN.MERGED, None)))} if step else set()
        ops = rows(IN.refresh(spark, str(pages_dir), root, changed, 3))
        merged, posts = full(spark, pages_dir)
        assert rows(IN.merged_feed(spark, root)) == rows(merged)
        assert rows(IN.posts(spark, root).select(*posts.columns)) == rows(posts)
        after = {r[:5] for r in rows(IN._posts(IN._read(spark, f"{root}/merged", IN.MERGED, None)))}
        assert {o[1:] for o in ops if o[0] > 0} == after - before and {o[1:] for o in ops if o[0] < 0} == before - after


def files_read(df):
    """The partition values of the rows, and how many files the scan opened."""
    rows = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return {r[1] for r in rows}, sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def test_only_the_closure_is_read(spark, tmp_path):
    pages_dir, root = tmp_path / "pages", str(tmp_path / "merged")
    for page in range(40):
        save(pages_dir, page, ["... lead", "A post", "...more"] if page not in (21, 22, 23) else ["... only", "...going on"])
    IN.refresh(spark, str(pages_dir), root, range(40), 1)
    save(pages_dir, 20, ["A new post"], "-1")
    assert files_read(IN.page_files(spark, str(pages_dir), [20], 1).select("meta.page", "file_key")) == ({"0020", "0020-1"}, 2)
    old = IN.read_ranges(spark, root)
    owners, read = IN.closure(old, old, [20])
    # Page 19 has the post before; 21 to 23 go on page 20's last post, 24's lead as well. Page 0 is the first.
    assert owners == [0, 19, 20] and read == [0, 1, 19, 20, 21, 22, 23, 24]
    assert files_read(IN._read(spark, f"{root}/parts", IN.PARTS, read).select("_p", "range")) == (set(read), len(read))
    IN.refresh(spark, str(pages_dir), root, [20], 1)
    merged, _ = full(spark, pages_dir)
    assert rows(IN.merged_feed(spark, root)) == rows(merged)


def test_a_failed_refresh_is_done_again(spark, tmp_path, monkeypatch):
    pages_dir, root = tmp_path / "pages", str(tmp_path / "merged")
    for page in range(6):
        save(pages_dir, page, ["... x", "A post", "...y"])
    IN.refresh(spark, str(pages_dir), root, range(6), 2)
    save(pages_dir, 0, [], "-1")
    save(pages_dir, 1, ["...all", "...lead"], "-1")
    for fails_at in (1, 2, 3):
        done = []

        def replace(*a, real=IN._replace, fails_at=fails_at, done=done):
            done.append(1)
            if len(done) == fails_at:
                raise RuntimeError("lost")
            real(*a)

        with monkeypatch.context() as m:
            m.setattr(IN, "_replace", replace)
            if fails_at == 3:
                m.setattr(IN.table_store, "write", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError, match="lost"):
                IN.refresh(spark, str(pages_dir), root, [0, 1], 2)
    IN.refresh(spark, str(pages_dir), root, [0, 1], 2)
    merged, _ = full(spark, pages_dir)
    assert rows(IN.merged_feed(spark, root)) == rows(merged)


def test_stream_in_any_batches(spark, tmp_path):
    pages_dir, root = tmp_path / "pages", str(tmp_path / "merged")
    rng = random.Random(8)
    for round_ in range(3):
        for page in rng.sample(range(1, 25), 9):
            save(pages_dir, page, some_texts(rng, 1), f"-{round_}" if round_ else "")
        q = IN.start_merge(spark, str(pages_dir), root, str(tmp_path / "ckpt"), max_files_per_trigger=4, pages_per_range=3)
        q.awaitTermination()
        assert q.exception() is None
        merged, _ = full(spark, pages_dir)
        assert rows(IN.merged_feed(spark, root)) == rows(merged)


def test_nothing_changed_and_empty(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    root = str(tmp_path / "merged")
    assert IN.refresh(spark, str(tmp_path / "pages"), root, []).collect() == []
    assert IN.merged_feed(spark, root).collect() == [] and IN.posts(spark, root).collect() == []
    save(tmp_path / "pages", 3, ["...first row is a post"])
    assert [r.op for r in IN.refresh(spark, str(tmp_path / "pages"), root, [3]).collect()] == [1]
    assert [r.raw_text for r in IN.posts(spark, root).collect()] == ["...first row is a post"]
    assert IN.merged_feed(spark, root).select(F.max("n_parts")).first()[0] == 1


def test_packs_give_the_same_feed(spark, tmp_path):
    """Pages in packs: the stream takes them in fewer batches and merges the same posts."""
    single, packs, rng = tmp_path / "pages", str(tmp_path / "packs"), random.Random(5)
    roots = [str(tmp_path / "merged"), str(tmp_path / "merged-packs")]
    for round_ in range(2):
        texts = {page: some_texts(rng, 1) for page in rng.sample(range(1, 40), 24)}
        revision = f"-{round_}" if round_ else ""
        for page, t in texts.items():
            save(single, page, t, revision)
        PG.write_packs(spark.createDataFrame([(p, f"{p:04d}{revision}", document(p, t)) for p, t in texts.items()], "page long, file_key string, body string"), packs, 8)
        for path, root in zip((str(single), packs), roots, strict=True):
            IN.start_merge(spark, path, root, str(tmp_path / f"ckpt-{root[-5:]}"), max_files_per_trigger=4, pages_per_range=3).awaitTermination()
    assert rows(IN.merged_feed(spark, roots[0])) == rows(IN.merged_feed(spark, roots[1]))
    batches = [len(list((tmp_path / f"ckpt-{root[-5:]}" / "commits").glob("[0-9]*"))) for root in roots]
    assert batches[0] >= 12 and batches[1] <= 4
    assert files_read(IN.page_files(spark, packs, [0], 3).select("meta.page", "file_key"))[1] <= 2


def test_closure_of_many_ranges_joins_no_pairs(spark):
    """The nearest head before each range comes from one order, not from all pairs."""
    n = 4000
    ranges = spark.range(n).select(F.col("id").alias("range"), F.lit(2).cast("long").alias("n_rows"), F.when(F.col("id") % 10 == 0, 1).otherwise(0).cast("long").alias("n_heads"))
    owners, read = IN.closure(ranges, ranges, [15, 20, 3999])
    assert owners == [0, 10, 15, 20, 3990, 3999] and read == [*range(11), *range(11, 31), *range(3990, 4000)]


def test_files_follow_rows_not_ranges(spark, tmp_path):
    """Many ranges share bundles; a small refresh adds a folder and leaves the others as they
    are; folders without rows in use go."""
    packs, root = str(tmp_path / "packs"), tmp_path / "merged"

    def put(pages, text, revision=""):
        PG.write_packs(spark.createDataFrame([(p, f"{p:04d}{revision}", document(p, [text, "...more"])) for p in pages], "page long, file_key string, body string"), packs, 100)

    def equal():
        merged, _ = full(spark, packs)
        assert rows(IN.merged_feed(spark, str(root))) == rows(merged)

    put(range(600), "A post")
    IN.refresh(spark, packs, str(root), range(600), 1)
    assert len(list(root.glob("parts/v=1/bundle=*/*.parquet"))) == len(list(root.glob("merged/v=1/bundle=*/*.parquet"))) == 200
    put([7, 300], "...on", "-1")
    IN.refresh(spark, packs, str(root), [7, 300], 1)
    assert len(list(root.glob("parts/v=2/bundle=*/*.parquet"))) == 2 and files_read(IN._read(spark, f"{root}/parts", IN.PARTS, [6, 7, 8]).select("_p", "range")) == ({6, 7, 8}, 2)
    equal()
    put(range(600), "Again", "-2")
    IN.refresh(spark, packs, str(root), range(600), 1)
    assert {p.name for p in root.glob("*/v=[0-9]")} == {"v=1", "v=2", "v=3"}
    IN.refresh(spark, packs, str(root), [5], 1)
    assert {p.name for p in root.glob("*/v=[0-9]")} == {"v=3", "v=4"}
    equal()
