"""Snapshots (A6), the bucketed corpus store and change sets (L1)."""

import os

import pytest
from pyspark.sql import functions as F

from folio.operators import folders as FD
from folio.sources import corpus_io as IO
from folio.sources.snapshots import Snapshots
from folio.streaming import corpus_stream as S
from folio.streaming.corpus_store import CorpusStore

PAGE = "path string, listing_no long, page int, page_text string, delivery long, removed boolean"


def docs(spark, rows):
    """rows: (path, listing_no, page, text, delivery, removed)."""
    drop = spark.createDataFrame(rows, PAGE).withColumn("ocr_text", F.lit(None).cast("string")).withColumn("md", F.lit(None).cast("string"))
    return S.page_docs(drop)


def path(title, folder="A"):
    return f".\\2024\\{folder}\\{title}.pdf"


def texts(df):
    return sorted((r.title or "", r.page, r.page_content.split("\n")[-1]) for r in df.collect())


def test_a_merge_rewrites_the_touched_buckets_only(spark, tmp_path):
    store = CorpusStore(spark, str(tmp_path / "c"), buckets=32)
    store.merge(docs(spark, [(path(f"t{i}"), i, p, f"v0 {i} {p}", None, None) for i in range(200) for p in range(3)]), 0)
    before = store.folders()
    for n, batch in enumerate([1, 4, 16], 1):
        titles = [f"t{i * 7}" for i in range(batch)]
        store.merge(docs(spark, [(path(t), 0, 0, f"v{n}", None, None) for t in titles]), n)
        after = store.folders()
        changed = {b for b in after["docs"] if after["docs"][b] != before["docs"].get(b)}
        assert 1 <= len(changed) <= batch
        assert {b for b in after["versions"] if after["versions"][b] != before["versions"].get(b)} == changed
        before = after
    rows = store.read()
    # one version of each title is scanned: as many rows in the files as the corpus has
    assert rows.count() == 200 * 3 - 2 * 16 == spark.read.parquet(*rows.inputFiles()).count()
    assert texts(store.read_title("t7")) == [("t7", 0, "v3")]
    assert len(store.read_title("t7").inputFiles()) == 1
    assert store.read_title("nothing").count() == 0


def test_a_batch_tried_again_changes_nothing(spark, tmp_path):
    store = CorpusStore(spark, str(tmp_path / "c"), buckets=4)
    batch = docs(spark, [(path("a"), 0, 0, "one", 1, None)])
    assert store.merge(batch, 0, "s") and not store.merge(batch, 0, "s")
    assert store.merge(batch, 0, "another stream")  # its own numbers
    assert store.snapshots.numbers() == [0, 1]


def test_a_merge_that_dies_half_way_leaves_the_last_snapshot(spark, tmp_path, monkeypatch):
    store = CorpusStore(spark, str(tmp_path / "c"), buckets=4)
    store.merge(docs(spark, [(path("a"), 0, 0, "old", None, None), (path("b"), 1, 0, "b", None, None)]), 0)
    reader = store.read()
    with monkeypatch.context() as m:
        m.setattr(Snapshots, "commit", lambda *_: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError):
            store.merge(docs(spark, [(path("a"), 0, 0, "new", None, None)]), 1)
    assert texts(store.read()) == [("a", 0, "old"), ("b", 0, "b")]
    assert store.merge(docs(spark, [(path("a"), 0, 0, "new", None, None)]), 1)  # the batch comes again
    assert texts(store.read()) == [("a", 0, "new"), ("b", 0, "b")]
    assert texts(reader) == [("a", 0, "old"), ("b", 0, "b")]  # read before the merge, collected after it
    assert texts(store.read(0)) == [("a", 0, "old"), ("b", 0, "b")]
    commits = lambda: {t: len(os.listdir(tmp_path / "c" / t)) for t in ("docs", "versions")}
    assert commits() == {"docs": 3, "versions": 3}  # the dead merge's too
    store.expire(keep=1)
    assert commits()["docs"] == 2 and texts(store.read()) == [("a", 0, "new"), ("b", 0, "b")]
    with pytest.raises(ValueError, match="no snapshot 0"):
        store.read(0)


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path):
    a = Snapshots(spark, str(tmp_path / "s"))
    a.commit(0, {"folders": []})
    with pytest.raises(RuntimeError, match="another writer"):
        Snapshots(spark, str(tmp_path / "s")).commit(0, {"folders": ["x"]})
    assert a.read() == (0, {"folders": []}) and a.names("manifests") == ["0000000000.json"]


def test_a_removed_file_goes_and_its_title_falls_to_another(spark, tmp_path):
    store = CorpusStore(spark, str(tmp_path / "c"), buckets=2)
    a, b = path("doc", "A"), path("doc", "B")
    steps = [
        ([(a, 0, 0, "a", None, None), (a, 0, 1, "a1", None, None)], [("doc", 0, "a"), ("doc", 1, "a1")]),
        ([(a, None, None, None, None, True)], []),  # A removed
        ([(b, 1, 0, "b", None, None)], [("doc", 0, "b")]),  # B
        ([(a, 2, 0, "a again", None, None)], [("doc", 0, "a again")]),
        ([(a, None, None, None, None, True)], [("doc", 0, "b")]),  # B is still there
        ([(b, None, None, None, None, True), (b, 5, 0, "b new", None, None)], [("doc", 0, "b new")]),  # gone and back in one batch
        ([(path("other"), 0, 0, "x", None, None), (b, None, None, None, 7, True), (b, 5, 0, "late", 6, None)], [("other", 0, "x")]),  # by number, the removal is last
    ]
    for n, (rows, want) in enumerate(steps):
        store.merge(docs(spark, rows), n)
        assert texts(store.read()) == want, n


def test_a_late_part_of_an_old_delivery_does_not_win(spark, tmp_path):
    store = CorpusStore(spark, str(tmp_path / "c"), buckets=2)
    a, b = path("doc", "A"), path("doc", "B")
    store.merge(docs(spark, [(a, 0, 0, "a0", 1, None)]), 0)
    store.merge(docs(spark, [(b, 1, 0, "b0", 2, None)]), 1)
    store.merge(docs(spark, [(a, 0, 1, "a1", 1, None)]), 2)
    assert texts(store.read()) == [("doc", 0, "b0")]
    store.merge(docs(spark, [(b, None, None, None, None, True)]), 3)
    assert texts(store.read()) == [("doc", 0, "a0"), ("doc", 1, "a1")]  # whole


def test_changes_through_the_stream(spark, tmp_path):
    schema = "path string, length long, modified long"
    listing = [spark.createDataFrame(x, schema) for x in ([], [(path("a"), 1, 1), (path("b"), 1, 1)], [(path("b"), 2, 1), (path("c"), 1, 1)])]
    for n, (old, new) in enumerate(zip(listing, listing[1:], strict=False)):
        decoded = new.select("path", F.lit(0).cast("long").alias("listing_no"), F.lit(0).alias("page"), F.lit(f"run {n}").alias("page_text"), *[F.lit(None).cast(t).alias(c) for c, t in (("ocr_text", "string"), ("md", "string"), ("delivery", "long"))])
        S.change_drop(FD.listing_changes(old, new), decoded).write.mode("append").parquet(str(tmp_path / "in"))
        S.stream_corpus(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"), buckets=3).awaitTermination()
    assert texts(S.read_corpus(spark, str(tmp_path / "out"))) == [("b", 0, "run 1"), ("c", 0, "run 1")]
    assert texts(S.read_corpus(spark, str(tmp_path / "out"), snapshot=0)) == [("a", 0, "run 0"), ("b", 0, "run 0")]


def test_listing_changes_on_odd_rows(spark):
    schema = "path string, length long, modified long"
    old = [("same", 1, 1), ("null length", None, 1), ("longer", 1, 1), ("touched", 1, 1), ("gone", 9, 3), ("twice", 1, 1), ("twice", 2, 2), (None, 1, 1)]
    new = [("same", 1, 1), ("null length", None, 1), ("longer", 2, 1), ("touched", 1, 2), ("came", 5, 5), ("twice", 2, 2), (None, 2, 2)]
    got = FD.listing_changes(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema))
    assert sorted(map(tuple, got.collect())) == [("came", "added", 5, 5), ("gone", "removed", 9, 3), ("longer", "changed", 2, 1), ("touched", "changed", 1, 2)]
    assert FD.listing_changes(spark.createDataFrame([], schema), spark.createDataFrame([], schema)).collect() == []


def corpus(spark, text, n=3):
    return spark.createDataFrame([(f"t{i}", 0, text, "2024", None, f"t{i}", path(f"t{i}")) for i in range(n)], IO.DOCS_SCHEMA)


def test_a_write_that_dies_keeps_the_old_corpus(spark, tmp_path):
    root = str(tmp_path / "docs")
    with pytest.raises(ValueError, match="holds no corpus"):
        IO.read_docs(spark, root)
    assert IO.write_docs(corpus(spark, "old"), root) == 0
    dying = corpus(spark, "new", 500).repartition(8).withColumn("page", F.when(F.col("title") == "t499", F.raise_error(F.lit("died"))).otherwise(F.col("page")).cast("int"))
    with pytest.raises(Exception, match="died"):
        IO.write_docs(dying, root)
    assert {r.page_content for r in IO.read_docs(spark, root).collect()} == {"old"}


def test_a_reader_during_a_write_and_older_snapshots(spark, tmp_path):
    root = str(tmp_path / "docs")
    IO.write_docs(corpus(spark, "one"), root)
    reader = IO.read_docs(spark, root)
    IO.write_docs(IO.read_docs(spark, root).withColumn("page_content", F.lit("two")), root)  # from itself
    assert {r.page_content for r in reader.collect()} == {"one"}
    assert {r.page_content for r in IO.read_docs(spark, root).collect()} == {"two"}
    assert IO.write_docs(corpus(spark, "three", 1), root, mode="append") == 2
    assert sorted(r.page_content for r in IO.read_docs(spark, root).collect()) == ["three", "two", "two", "two"]
    assert {r.page_content for r in IO.read_docs(spark, root, snapshot=0).collect()} == {"one"}
    IO.expire_docs(spark, root)
    assert sorted(r.page_content for r in IO.read_docs(spark, root).collect()) == ["three", "two", "two", "two"]
    with pytest.raises(ValueError, match="no snapshot 0"):
        IO.read_docs(spark, root, snapshot=0)
    with pytest.raises(ValueError, match="neither"):
        IO.write_docs(corpus(spark, "x"), root, mode="ignore")


def test_scratch_tables_are_cleared_on_request(spark):
    from folio import session

    path = session.scratch_path(spark, "table")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path.removeprefix("file:"))
    session.clear_scratch(spark)
    assert not os.path.exists(path.removeprefix("file:"))
    again = session.scratch_path(spark, "table")  # a new folder
    spark.range(3).write.parquet(again)
    assert spark.read.parquet(again).count() == 3
