import pytest
import random


from folio.operators import components as C
from folio.operators import layout as L
from folio.operators import numbering as N
from folio.operators import ruling as R

WORDS = "doc_id long, page int, word_no int, word string, x0 double, x1 double, top double, bottom double"


def test_detect_columns_reference_threshold(spark):
    rows = [(1, 0, i, "w", 100.0 + (i % 2) * 0.5, 110.0, 10.0 * i, 10.0 * i + 8) for i in range(51)]
    rows += [(1, 0, 100 + i, "w", 300.0, 310.0, 10.0 * i, 10.0 * i + 8) for i in range(51)]
    rows += [(1, 1, 0, "w", 300.0, 310.0, 0.0, 8.0)]
    words = spark.createDataFrame(rows, WORDS)
    pages = spark.createDataFrame([(1, 0), (1, 1), (1, 2)], "doc_id long, page int")
    got = {r.page_number: (r.n_clusters, r.multi_column, r.report) for r in L.detect_columns(words, pages).collect()}
    assert got[1] == (2, True, "Page 1: Detected a multi-column layout 2.")
    assert got[2] == (0, False, "Page 2: Single-column layout detected. 0")
    assert got[3][0] == 0  # page without words is reported


def test_split_columns_partition_words(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(300):
        x0 = rnd.uniform(0, 560)
        rows.append((1, 0, i, f"w{i}", x0, min(595.0, x0 + rnd.uniform(5, 60)), float(12 * (i // 10)), float(12 * (i // 10) + 9)))
    words = spark.createDataFrame(rows, WORDS)
    pages = spark.createDataFrame([(1, 0, 595.0, 841.0)], "doc_id long, page int, width double, height double")
    r = L.split_columns(words, pages).first()
    left = set(r.left_text.split())
    right = set(r.right_text.split())
    straddle = {w for (_, _, _, w, x0, x1, _, _) in rows if x0 < 297.5 < x1}
    assert not (left & right)
    assert left | right | straddle == {w for (_, _, _, w, *_) in rows}


def grid_edges(xs, ys, missing=()):
    """Ruling edges of a grid; ``missing`` removes horizontal segments (row i, col j) to merge cells."""
    e = []
    for x in xs:
        e.append((1, 0, "v", float(x), float(ys[0]), float(ys[-1])))
    for i, y in enumerate(ys):
        for j in range(len(xs) - 1):
            if (i, j) not in missing:
                e.append((1, 0, "h", float(y), float(xs[j]), float(xs[j + 1])))
    return e


def test_find_cells_regular_and_merged(spark):
    xs, ys = [0, 50, 100, 150], [0, 20, 40, 60]
    edges = spark.createDataFrame(grid_edges(xs, ys, missing={(1, 1)}), "doc_id long, page int, orient string, pos double, lo double, hi double")
    cells = {(r.x0, r.top, r.x1, r.bottom) for r in R.find_cells(edges).collect()}
    assert (50.0, 0.0, 100.0, 40.0) in cells  # merged cell spans two rows (found by the exact round)
    assert (0.0, 0.0, 50.0, 20.0) in cells
    assert len(cells) == 8
    tables = R.group_cells(R.find_cells(edges)).select("table_no").distinct().count()
    assert tables == 1


def test_snap_is_idempotent_and_join_merges(spark):
    e = spark.createDataFrame(
        [(1, 0, "h", 10.0, 0.0, 50.0), (1, 0, "h", 11.0, 52.0, 100.0), (1, 0, "h", 30.0, 0.0, 2.0)],
        "doc_id long, page int, orient string, pos double, lo double, hi double",
    )
    s1 = R.snap_edges(e)
    s2 = R.snap_edges(s1)
    assert sorted(map(tuple, s1.collect())) == sorted(map(tuple, s2.collect()))
    j = R.clean_edges(e).collect()
    assert [(r.pos, r.lo, r.hi) for r in j] == [(10.5, 0.0, 100.0)]  # joined; the 2-point stub dropped


def test_union_find_and_whole_groups():
    import pandas as pd

    # a chain, a star and a lone node
    lab = C.union_find(12, [0, 1, 2, 6, 6, 6], [1, 2, 3, 7, 8, 9])
    assert lab.tolist() == [0, 0, 0, 0, 4, 5, 6, 6, 6, 6, 10, 11]
    rows = pd.DataFrame({"g": [1, 1, 1, 1, 1, 2, 3, 3], "v": range(8)})
    for size in (1, 2, 3, 8):
        got = list(C.whole_groups((rows[i : i + size] for i in range(0, 8, size)), ["g"]))
        assert pd.concat(got)["v"].tolist() == list(range(8))
        seen = [set(b["g"]) for b in got]
        assert all(not (a & b) for i, a in enumerate(seen) for b in seen[i + 1 :])


def test_ordinal_numbers_a_null_group(spark):
    df = spark.createDataFrame([(None, 5), (None, 3), (1, 9)], "g int, o int")
    assert {(r.g, r.o): r.n for r in N.ordinal(df, ["g"], ["o"]).collect()} == {(None, 3): 0, (None, 5): 1, (1, 9): 0}


def test_ordinal_matches_row_number_on_a_hot_group(spark):
    rows = [(0 if i % 3 else i % 7, i * 7919 % 1000, i) for i in range(3000)]  # one group holds 2/3
    df = spark.createDataFrame(rows, "g int, o int, id int")
    got = {r.id: r.n for r in N.ordinal(df, ["g"], ["o", "id"]).collect()}
    exp = {}
    for g in {r[0] for r in rows}:
        for n, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))):
            exp[r[2]] = n
    assert got == exp


def test_extract_tables_with_crop(spark):
    # a 2x2 grid at the top of the page (above the A4 crop box) and one inside it
    e = grid_edges([10, 60, 110], [20, 40, 60]) + [
        (1, 0, o, p + (100.0 if o == "h" else 0.0), lo + (100.0 if o == "v" else 0.0), hi + (100.0 if o == "v" else 0.0))
        for (_, _, o, p, lo, hi) in grid_edges([10, 60, 110], [20, 40, 60])
    ]
    edges = spark.createDataFrame(e, "doc_id long, page int, orient string, pos double, lo double, hi double")
    words = spark.createDataFrame([(1, 0, 0, "top", 20.0, 30.0, 22.0, 30.0), (1, 0, 1, "in", 20.0, 30.0, 122.0, 130.0)], WORDS)
    whole = R.extract_tables(words, edges)
    assert whole.select("table_no").distinct().count() == 2
    cropped = R.extract_tables(words, edges, crop_box=(3, 70, 590, 770)).collect()
    assert {r.table_no for r in cropped} == {0}
    assert [r.txt for r in cropped if r.row_no == 0 and r.col_no == 0] == ["in"]


def test_number_pages_without_page_column(spark):
    from folio.operators.pages import number_pages

    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "z")], "doc_id long, key string")
    got = {(r.doc_id, r.key): r.page_number for r in number_pages(df, base=1, page_col=None, order_cols=("key",)).collect()}
    assert got == {(1, "a"): 1, (1, "b"): 2, (2, "z"): 1}


def test_crop_touching_and_within(spark):
    box = (10.0, 10.0, 100.0, 100.0)
    rows = [
        (1, 0, 0, "inside", 20.0, 30.0, 20.0, 30.0),
        (1, 0, 1, "straddle", 90.0, 120.0, 50.0, 60.0),  # clipped to x1 = 100
        (1, 0, 2, "touch", 100.0, 110.0, 50.0, 60.0),  # touches the right edge: overlap 0 in x, > 0 in y
        (1, 0, 3, "corner", 100.0, 110.0, 100.0, 110.0),  # touches only at a corner: dropped
        (1, 0, 4, "outside", 200.0, 210.0, 50.0, 60.0),
    ]
    words = spark.createDataFrame(rows, WORDS)
    got = {r.word: (r.x0, r.x1, r.top, r.bottom) for r in L.crop(words, box).collect()}
    assert set(got) == {"inside", "straddle", "touch"}
    assert got["straddle"] == (90.0, 100.0, 50.0, 60.0)
    assert {r.word for r in L.within_bbox(words, box).collect()} == {"inside"}


def test_merged_cell_is_found_by_search(spark):
    # a 2x2 grid whose two lower cells are one: the middle vertical rule ends at y = 40
    e = [(1, 0, "h", y, 10.0, 110.0) for y in (20.0, 40.0, 60.0)] + [(1, 0, "v", 10.0, 20.0, 60.0), (1, 0, "v", 110.0, 20.0, 60.0), (1, 0, "v", 60.0, 20.0, 40.0)]
    edges = spark.createDataFrame(e, "doc_id long, page int, orient string, pos double, lo double, hi double")
    got = sorted((r.x0, r.top, r.x1, r.bottom) for r in R.find_cells(edges).collect())
    assert got == [(10.0, 20.0, 60.0, 40.0), (10.0, 40.0, 110.0, 60.0), (60.0, 20.0, 110.0, 40.0)]


def test_explicit_lines_reach_pages_without_rules(spark):
    edges = spark.createDataFrame([], "doc_id long, page int, orient string, pos double, lo double, hi double")
    pages = spark.createDataFrame([(1, 0, 200.0, 100.0)], "doc_id long, page int, width double, height double")
    s = R.GridSettings(explicit_vertical_lines=(10.0, 60.0), explicit_horizontal_lines=(20.0, 80.0))
    assert [(r.x0, r.top, r.x1, r.bottom) for r in R.find_cells(edges, pages, s).collect()] == [(10.0, 20.0, 60.0, 80.0)]
    with pytest.raises(ValueError, match="pages"):
        R.find_cells(edges, None, s)


def test_text_strategy_takes_rules_from_words(spark):
    # three rows of two aligned words, no ruling edge at all
    rows = [(1, 0, 2 * i + j, f"{'ab'[j]}{i}", 10.0 + 60 * j, 30.0 + 60 * j, 20.0 * i, 20.0 * i + 10) for i in range(3) for j in range(2)]
    words = spark.createDataFrame(rows, WORDS)
    none = spark.createDataFrame([], "doc_id long, page int, orient string, pos double, lo double, hi double")
    s = R.GridSettings(vertical_strategy="text", horizontal_strategy="text")
    texts = {r.txt for r in R.extract_tables(words, none, s=s).collect()}
    assert {"a0", "b0", "a1", "b1"} & texts
    assert R.extract_tables(words, none).count() == 0
    with pytest.raises(ValueError, match="strategy"):
        R.extract_tables(words, none, s=R.GridSettings(vertical_strategy="other"))


def test_text_between_overlapping_tables(spark):
    # the first table reaches below the second one's end: the word beside it is in no band
    boxes = spark.createDataFrame([(1, 0, 0, 0.0, 20.0, 50.0, 90.0), (1, 0, 1, 60.0, 30.0, 90.0, 50.0)], "doc_id long, page int, table_no int, x0 double, top double, x1 double, bottom double")
    pages = spark.createDataFrame([(1, 0, 100.0, 120.0)], "doc_id long, page int, width double, height double")
    words = spark.createDataFrame([(1, 0, 0, "above", 5.0, 30.0, 5.0, 15.0), (1, 0, 1, "beside", 60.0, 90.0, 60.0, 70.0), (1, 0, 2, "below", 5.0, 30.0, 95.0, 105.0)], WORDS)
    assert [r.full_text for r in L.text_between_tables(words, boxes, pages).collect()] == ["above\n\nbelow"]


def test_every_fixture_table_has_a_page_and_all_rows(spark):
    from folio.sources import fixtures as fx

    d = "/root/testdata/sf0.001"
    cells, pages, li = fx.cells(spark, d), fx.pages(spark, d), fx.table(spark, d, "lineitem")
    assert cells.select("doc_id", "page").distinct().join(pages, ["doc_id", "page"], "left_anti").count() == 0
    assert cells.where("row_no > 0").count() == 4 * li.count()
    assert R.find_cells(fx.edges(spark, d)).count() == cells.count()
