import struct
import zlib

from pyspark.sql import functions as F

from folio.operators import raster as K
from folio.sources import corpus_io as IO
from folio.sources import files as SF
from folio.streaming import corpus_stream as S


def write_png(path, rows):
    """Minimal RGB PNG writer (no image library needed)."""
    h, w = len(rows), len(rows[0])
    raw = b"".join(b"\x00" + bytes(v for px in row for v in px) for row in rows)

    def chunk(t, d):
        return struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d) & 0xFFFFFFFF)

    data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    path.write_bytes(data)


def test_list_files_recursive_flat_and_suffix(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "empty").mkdir()
    for p in ["x.pdf", "y.txt", "a/z.pdf", "a/b/w.pdf"]:
        (tmp_path / p).write_bytes(b"1234")
    rec = {r.path.rsplit("/", 1)[-1] for r in SF.list_files(spark, str(tmp_path)).collect()}
    assert rec == {"x.pdf", "y.txt", "z.pdf", "w.pdf"}
    pdfs = {r.path.rsplit("/", 1)[-1] for r in SF.list_files(spark, str(tmp_path), suffix=".pdf").collect()}
    assert pdfs == {"x.pdf", "z.pdf", "w.pdf"}
    flat = {r.path.rsplit("/", 1)[-1] for r in SF.list_files(spark, str(tmp_path), recursive=False).collect()}
    assert flat == {"x.pdf", "y.txt"}
    plan = SF.list_files(spark, str(tmp_path)).select("path")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]


def test_read_images_gray_and_preprocess(spark, tmp_path):
    rows = [[(10 * x, 20 * y, 30) for x in range(4)] for y in range(3)]
    write_png(tmp_path / "img.png", rows)
    planes = SF.read_images(spark, str(tmp_path))
    assert planes.count() == 3 * 4 * 3
    gray = {(r.y, r.x): r.v for r in K.to_gray(planes).collect()}
    r, g, b = rows[1][2]
    assert gray[(1, 2)] == (299 * r + 587 * g + 114 * b + 500) // 1000
    assert K.preprocess(planes).count() == 12


def test_dilate_composes(spark):
    import random

    rnd = random.Random(5)
    px = [(0, y, x, 255 if rnd.random() < 0.02 else 0) for y in range(64) for x in range(64)]
    df = spark.createDataFrame(px, "image_id long, y int, x int, v int")
    big = {(r.y, r.x): r.v for r in K.dilate(df, 9, 4).collect()}  # 9x9 kernel, 4 iterations
    twice = {(r.y, r.x): r.v for r in K.dilate(K.dilate(df, 9, 2), 9, 2).collect()}
    assert big == twice
    fg = {(y, x) for (_, y, x, v) in px if v}
    assert all(big[(y, x)] == (255 if any(abs(y - a) <= 16 and abs(x - b) <= 16 for a, b in fg) else 0) for (y, x) in list(big)[:300])


def test_regions_and_numbering(spark):
    px = [(7, y, x, 255 if (y < 2 and x < 3) or (y == 5 and x >= 4) else 0) for y in range(8) for x in range(8)]
    df = spark.createDataFrame(px, "image_id long, y int, x int, v int")
    reg = sorted((r.x, r.y, r.w, r.h, r.area) for r in K.regions(df).collect())
    assert reg == [(0, 0, 3, 2, 6), (4, 5, 4, 1, 4)]
    n = K.number_regions(K.regions(df).withColumn("img_h", F.lit(8)), min_area=3, max_h_ratio=1.0)
    assert sorted((r.roi, r.name) for r in n.collect()) == [(0, "ROI_0.jpg"), (1, "ROI_1.jpg")]


def test_corpus_round_trip(spark, tmp_path):
    rows = [("t", 0, "c", "2024", None, "t", ".\\2024\\t.pdf"), ("u", 1, "d", "2023", "m", "u", ".\\2023\\m\\u.pdf")]
    df = spark.createDataFrame(rows, IO.DOCS_SCHEMA)
    IO.write_docs(df, str(tmp_path / "docs"))
    back = IO.read_docs(spark, str(tmp_path / "docs"))
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    assert back.where(F.col("first_division") == "2024").count() == 1


def test_decode_form_feed_with_a_bad_file(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("one\ftwo\fthree".encode())
    (tmp_path / "b.txt").write_bytes(b"\xff\xfe\xfa bad")
    rows, errors = SF.decode(spark, str(tmp_path), SF.form_feed_pages, SF.PAGE_TEXT_SCHEMA)
    assert sorted((r.page, r.page_text) for r in rows.collect()) == [(0, "one"), (1, "two"), (2, "three")]
    errs = errors.collect()
    assert len(errs) == 1 and errs[0].path.endswith("b.txt") and "UnicodeDecodeError" in errs[0].error


def test_stream_equals_batch_and_later_title_wins(spark, tmp_path):
    drops = [
        [(".\\2024\\A\\doc.pdf", 0, 0, "first", None, None, 1)],
        [(".\\2024\\B\\other.pdf", 1, 0, "", "ocr words", "|a|\n|-|", 2)],
        # the pages of one delivery may come in several files, and so in several batches
        [(".\\2024\\C\\doc.pdf", 2, 0, "second", None, None, 3), (".\\2024\\C\\doc.pdf", 2, 1, "more", None, None, 3)],
    ]
    for d in drops:
        spark.createDataFrame(d, S.DROP_SCHEMA).write.mode("append").parquet(str(tmp_path / "in"))
    q = S.stream_corpus(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"), max_files_per_trigger=1)
    q.awaitTermination()
    got = sorted((r.title, r.page, r.page_content, r.second_division) for r in S.read_corpus(spark, str(tmp_path / "out")).collect())
    assert got == [
        ("doc", 0, "This page explains doc.\nsecond", "C"),
        ("doc", 1, "This page explains doc.\nmore", "C"),
        ("other", 0, "This page explains other.\nocr words\n\n|a|\n|-|", "B"),
    ]


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["title", "page", "page_content", "first_division", "second_division", "file_name", "file_path"]
    assert set(E.oracle_sql()) <= set(E.queries())


def test_write_regions_crops(spark, tmp_path):
    px = [(1, y, x, 10 * y + x) for y in range(6) for x in range(6)]
    pixels = spark.createDataFrame(px, "image_id long, y int, x int, v int")
    regs = spark.createDataFrame([(1, 0, 2, 1, 3, 2), (1, 1, 0, 4, 2, 2)], "image_id long, roi long, x long, y long, w long, h long")
    crops = IO.region_crops(K.region_pixels(pixels, regs, region_cols=("roi",)))
    IO.write_regions(crops, str(tmp_path / "rois"))
    back = {r.name: (r.h, r.w, list(r.pixels)) for r in spark.read.parquet(str(tmp_path / "rois")).collect()}
    assert back["ROI_0.jpg"] == (2, 3, [12, 13, 14, 22, 23, 24])  # image[y:y+h, x:x+w]
    assert back["ROI_1.jpg"] == (2, 2, [40, 41, 50, 51])


def test_flatten_line_boxes(spark):
    from folio.functions import boxes as B

    schema = "lines array<array<struct<box: array<struct<x: double, y: double>>, ch: string>>>"
    pt = lambda x, y: {"x": float(x), "y": float(y)}
    box = lambda i: [pt(i, 0), pt(i + 1, 0), pt(i + 1, 1), pt(i, 1)]
    df = spark.createDataFrame([([[{"box": box(0), "ch": "a"}, {"box": box(1), "ch": "b"}], [{"box": box(5), "ch": "c"}]],), ([],)], schema)
    got = [r.b for r in df.select(B.flatten_line_boxes("lines").alias("b")).collect()]
    assert [len(b) for b in got] == [3, 0]
    assert got[0][2][0].x == 5.0


def test_stream_restart_is_exactly_once(spark, tmp_path):
    rows = [(".\\2024\\A\\doc.pdf", 0, 0, "one", None, None, None), (".\\2024\\A\\doc.pdf", 0, 1, "two", None, None, None)]
    spark.createDataFrame(rows, S.DROP_SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in"))
    args = (spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"))
    S.stream_corpus(*args).awaitTermination()
    first = sorted(map(tuple, S.read_corpus(spark, str(tmp_path / "out")).collect()))
    S.stream_corpus(*args).awaitTermination()  # restart: the checkpoint says everything is done
    again = sorted(map(tuple, S.read_corpus(spark, str(tmp_path / "out")).collect()))
    assert first == again and len(first) == 2
    spark.createDataFrame([(".\\2024\\B\\doc.pdf", 1, 0, "new", None, None, None)], S.DROP_SCHEMA).write.mode("append").parquet(str(tmp_path / "in"))
    S.stream_corpus(*args).awaitTermination()  # only the new drop is processed; it replaces the title
    last = sorted((r.page, r.page_content, r.second_division) for r in S.read_corpus(spark, str(tmp_path / "out")).collect())
    assert last == [(0, "This page explains doc.\nnew", "B")]


def _deliver(spark, tmp_path, rows):
    spark.createDataFrame(rows, S.DROP_SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    S.stream_corpus(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    return sorted((r.title, r.page, r.page_content.split("\n")[-1]) for r in S.read_corpus(spark, str(tmp_path / "out")).collect())


def test_a_file_delivered_again_replaces_all_of_its_pages(spark, tmp_path):
    a, b = ".\\2024\\A\\doc.pdf", ".\\2024\\B\\doc.pdf"
    assert len(_deliver(spark, tmp_path, [(a, 0, 0, "old 0", None, None, None), (a, 0, 1, "old 1", None, None, None)])) == 2
    assert _deliver(spark, tmp_path, [(a, 0, 0, "new 0", None, None, None)]) == [("doc", 0, "new 0")]
    assert _deliver(spark, tmp_path, [(b, 1, 0, "rival", None, None, None)]) == [("doc", 0, "rival")]
    assert _deliver(spark, tmp_path, [(a, 0, 0, "again", None, None, None)]) == [("doc", 0, "again")]  # A, B, A
    # two deliveries in one drop are told apart by their numbers
    both = [(a, 0, 0, "first", None, None, 1), (a, 0, 1, "first", None, None, 1), (a, 0, 0, "second", None, None, 2)]
    last = _deliver(spark, tmp_path, both)
    assert last == [("doc", 0, "second")]
    S.compact_corpus(spark, str(tmp_path / "out"), str(tmp_path / "small"))
    assert spark.read.parquet(str(tmp_path / "small" / "docs")).count() == 1
    assert sorted((r.title, r.page) for r in S.read_corpus(spark, str(tmp_path / "small")).collect()) == [("doc", 0)]


def test_short_paths_keep_a_null_title_in_stream_and_batch(spark, tmp_path):
    from folio.operators.assemble import build_corpus

    got = _deliver(spark, tmp_path, [(".\\short.pdf", 0, 0, "text", None, None, None)])
    assert got == [(None, 0, "text")]
    files = spark.createDataFrame([(1, ".\\short.pdf", 0)], "doc_id long, path string, listing_no long")
    pages = spark.createDataFrame([(1, 0, "text")], "doc_id long, page int, page_text string")
    lines = spark.createDataFrame([], "doc_id long, page int, result_idx int, line_no int, txt string, conf double")
    cells = spark.createDataFrame([], "doc_id long, page int, table_no int, row_no int, col_no int, txt string")
    assert [(r.title, r.page, r.page_content.split("\n")[-1]) for r in build_corpus(files, pages, lines, cells).collect()] == got


def write_gray_png(path, rows):
    h, w = len(rows), len(rows[0])

    def chunk(t, d):
        return struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d) & 0xFFFFFFFF)

    raw = b"".join(b"\x00" + bytes(r) for r in rows)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_gray_and_broken_images(spark, tmp_path):
    rows = [[(7 * x + 40 * y) % 256 for x in range(5)] for y in range(4)]
    write_gray_png(tmp_path / "gray.png", rows)
    (tmp_path / "broken.png").write_bytes(b"no image")
    gray = K.to_gray(SF.read_images(spark, str(tmp_path))).collect()
    assert {(r.y, r.x): r.v for r in gray} == {(y, x): rows[y][x] for y in range(4) for x in range(5)}
    bad = SF.unreadable_images(spark, str(tmp_path)).collect()
    assert [r.path.rsplit("/", 1)[-1] for r in bad] == ["broken.png"]


def _mirror(i, n):
    while not 0 <= i < n:
        i = (-i if i < 0 else 2 * (n - 1) - i) if n > 1 else 0
    return i


def test_filters_on_small_images(spark):
    import random

    rnd = random.Random(2)
    images = {}
    for k, (h, w) in enumerate([(1, 1), (1, 12), (12, 1), (2, 3), (3, 4), (4, 4), (5, 9), (12, 11)]):
        images[k] = [[rnd.randrange(256) for _ in range(w)] for _ in range(h)]
    df = spark.createDataFrame([(k, y, x, v) for k, m in images.items() for y, r in enumerate(m) for x, v in enumerate(r)], "image_id long, y int, x int, v int")
    weights = K.binomial(9)
    blurred = {(r.image_id, r.y, r.x): r.v for r in K.blur(df).collect()}
    sharp = {(r.image_id, r.y, r.x): r.v for r in K.convolve(df, K.SHARPEN).collect()}
    limit = {(r.image_id, r.y, r.x): r.v for r in K.adaptive_threshold(df).collect()}
    assert len(blurred) == len(sharp) == len(limit) == df.count()
    for k, m in images.items():
        h, w = len(m), len(m[0])
        for y in range(h):
            for x in range(w):
                s = sum(weights[i] * weights[j] * m[_mirror(y + i - 4, h)][_mirror(x + j - 4, w)] for i in range(9) for j in range(9))
                assert blurred[k, y, x] == (s + 2**15) // 2**16
                s = sum(K.SHARPEN[i][j] * m[_mirror(y + i - 1, h)][_mirror(x + j - 1, w)] for i in range(3) for j in range(3))
                assert sharp[k, y, x] == min(255, max(0, s))


def test_text_regions_of_a_page_with_its_defaults(spark, tmp_path):
    h, w = 260, 420
    rows = [[(255, 255, 255)] * w for _ in range(h)]
    for y in range(100, 112):  # one line of dark strokes
        for x in range(60, 360):
            if x % 6 < 3:
                rows[y][x] = (0, 0, 0)
    write_png(tmp_path / "page.png", rows)
    planes = SF.read_images(spark, str(tmp_path))
    found = K.find_text_regions(planes).collect()
    lines = SF.read_image_lines(spark, str(tmp_path))
    assert lines.count() == 3 * h
    by_lines = K.find_text_regions(lines)
    assert by_lines.collect() == found
    assert "posexplode" not in by_lines._jdf.queryExecution().executedPlan().toString()  # no row for a pixel
    assert len(found) == 1 and found[0].x < 60 and found[0].y < 100 and found[0].w > 300
    crops = IO.region_crops(K.region_pixels(K.to_gray(planes), spark.createDataFrame(found), region_cols=("roi",)))
    IO.write_regions(crops, str(tmp_path / "rois"))
    back = spark.read.parquet(str(tmp_path / "rois")).first()
    assert (back.name, back.h, back.w) == ("ROI_0.jpg", found[0].h, found[0].w) and min(back.pixels) == 0


def test_a_decoder_that_fails_half_way_leaves_no_rows(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"ok")
    (tmp_path / "b.txt").write_bytes(b"bad")

    def fn(path, content):
        yield {"page": 0, "page_text": "early"}
        if content == b"bad":
            raise ValueError("half-way")

    rows, errors = SF.decode(spark, str(tmp_path), fn, SF.PAGE_TEXT_SCHEMA)
    assert [r.path.rsplit("/", 1)[-1] for r in rows.collect()] == ["a.txt"]
    assert [(r.path.rsplit("/", 1)[-1], r.error) for r in errors.collect()] == [("b.txt", "ValueError: half-way")]


def test_a_path_without_separator_is_in_no_folder(spark):
    from folio.operators import folders as FD

    df = spark.createDataFrame([("x.pdf",), ("a\\y.pdf",)], "path string")
    assert [(r.folder, r.n_files) for r in FD.folder_tree(df).collect()] == [("a", 1)]
    assert [(r.folder, r.has_subfolders) for r in FD.has_subfolders(df).collect()] == [("a", False)]


def test_a_cluster_without_shared_folder_is_an_error():
    from folio import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    import pytest

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())
