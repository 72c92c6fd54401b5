"""J1 on byte ranges: one file by many tasks, the page filter in the decoder, errors by range."""

import io
import json
import os

import pytest

from folio.sources import ranges as R
from folio.sources.files import BUNDLE_SCHEMA


@pytest.mark.parametrize("data", [b"", b"\n", b"a", b"a\n", b"a\nbb\n\nccc\ndddd", b"one long record without an end", b"\n\n\n", b"ab\ncd\n"])
def test_every_record_belongs_to_one_range(data):
    want = data.split(b"\n")
    want = want[:-1] if want[-1] == b"" else want
    for size in range(1, len(data) + 2):
        got = [r for start in range(0, len(data), size) for r in R.records(io.BytesIO(data), start, min(start + size, len(data)))]
        assert got == want, size


def test_ranges_are_dealt_to_tasks():
    assert R.split([], 10) == []
    assert R.split([("a", 25), ("b", 2), ("c", 3), ("d", 0)], 10) == [[("a", 0, 10)], [("a", 10, 20)], [("a", 20, 25), ("b", 0, 2), ("c", 0, 3)]]


def bundle(path, docs):
    path.write_text("".join(json.dumps({"doc_id": i, "pages": p}) + "\n" for i, p in docs))


def test_one_bundle_is_decoded_by_many_tasks(spark, tmp_path):
    docs = [(i, [f"{i}.{k} " * 20 for k in range(i % 7)]) for i in range(400)]
    bundle(tmp_path / "big.txt", docs)
    bundle(tmp_path / "small.txt", [(1000, ["x"])])
    (tmp_path / "_hidden.txt").write_text("no record")
    (tmp_path / "other.bin").write_text("no record")
    size = os.path.getsize(tmp_path / "big.txt")
    rows, errors = R.decode_ranges(spark, str(tmp_path), R.bundled_pages, BUNDLE_SCHEMA, suffix=".txt", split_bytes=size // 20)
    assert rows.rdd.getNumPartitions() >= 20
    assert sorted((r.doc_id, r.page, r.page_text) for r in rows.collect()) == sorted((i, k, t) for i, p in [*docs, (1000, ["x"])] for k, t in enumerate(p))
    assert errors.collect() == []
    uri = R.decode_ranges(spark, f"file://{tmp_path}", R.bundled_pages, BUNDLE_SCHEMA, suffix=".txt")[0]
    assert uri.count() == rows.count()


def test_the_page_filter_reaches_the_decoder(spark, tmp_path):
    bundle(tmp_path / "b.txt", [(i, ["a", "b", "c"]) for i in range(5)])

    def telling(record, wanted):  # what the decoder was asked for, in the text
        doc = json.loads(record)
        asked = "".join(str(k) for k in range(3) if wanted(k))
        return [{"doc_id": doc["doc_id"], "page": k, "page_text": asked} for k in range(3)]

    spark.conf.set(R.PUSHDOWN, "true")
    try:
        rows = R.decode_ranges(spark, str(tmp_path), telling, BUNDLE_SCHEMA)[0]
        for test, asked in (("page = 1", "1"), ("page in (0, 2)", "02"), ("page >= 1 and page < 2", "1"), ("doc_id = 3", "012"), ("page > 0 and page <= 2", "12")):
            got = rows.where(test).collect()
            assert got and {r.page_text for r in got} == {asked}, test
            assert {r.page for r in got} == set(map(int, asked))
    finally:
        spark.conf.unset(R.PUSHDOWN)
    rows = R.decode_ranges(spark, str(tmp_path), telling, BUNDLE_SCHEMA)[0]
    off = rows.where("page = 1").collect()  # Spark filters
    assert {(r.page, r.page_text) for r in off} == {(1, "012")}
    chosen = R.decode_ranges(spark, str(tmp_path), telling, BUNDLE_SCHEMA, pages=[1, 7])[0].collect()
    assert {(r.page, r.page_text) for r in chosen} == {(1, "1")}


def test_a_bad_record_spoils_its_range_only(spark, tmp_path):
    good = json.dumps({"doc_id": 1, "pages": ["x"]})
    lines = [good] * 50 + ["{broken"] + [good] * 49
    (tmp_path / "b.txt").write_text("\n".join(lines))
    size = os.path.getsize(tmp_path / "b.txt")
    rows, errors = R.decode_ranges(spark, str(tmp_path), R.bundled_pages, BUNDLE_SCHEMA, split_bytes=size // 10)
    bad = errors.collect()
    assert len(bad) == 1 and bad[0].path.endswith("b.txt") and "JSONDecodeError" in bad[0].error and 0 < bad[0].range_start < size
    assert 80 <= rows.count() < 99 and not rows.where(rows.range_start == bad[0].range_start).count()


def test_no_files(spark, tmp_path):
    rows, errors = R.decode_ranges(spark, str(tmp_path), R.bundled_pages, BUNDLE_SCHEMA)
    assert rows.collect() == [] and errors.collect() == []
