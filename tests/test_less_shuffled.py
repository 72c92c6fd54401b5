"""What is shuffled is text, not the words made of it; small ranges share tasks; image blocks are worked on together."""

import re

import pyarrow as pa
import pytest

from folio.operators import layout as L
from folio.operators import markdown as M
from folio.operators import ocr as O
from folio.operators import raster as K
from folio.operators import sentences as S
from folio.operators import trigram_index as X
from folio.plans.catalog import REGISTRY
from folio.plans.stream_queries import decoded_drops
from folio.sources import fixtures as fx
from folio.sources import ranges as R


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    docs = [(i, " ".join(f"w{i % 5} ab,\ncd" for _ in range(300 * (i % 3))), "en", "web") for i in range(12)] + [(3, "again", "en", "web")]
    spark.createDataFrame([(*r, len(r[1])) for r in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i,) for i in range(20)], "l_orderkey long").write.parquet(f"{d}/lineitem.parquet")
    return d


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"(?<!Reused)Exchange hashpartitioning", plan(df)))


def test_words_and_boxes_lie_where_their_page_is(spark, tables):
    assert exchanges(O.flatten_boxes(fx.predictions(spark, tables))) == 1
    assert exchanges(O.annotation_layout(fx.predictions(spark, tables))) == 1
    assert exchanges(L.page_lines(fx.words(spark, tables))) == 1
    assert exchanges(L.edges_from_words(fx.words(spark, tables))) <= 2  # the text, for both kinds of rules


def test_pages_without_their_text_shuffle_none(spark, tables):
    sizes = plan(fx.pages(spark, tables).select("doc_id", "page", "width"))
    assert not re.search(r"(Exchange|Join)[^\n]*\n[^\n]*Project \[doc_id#\d+L?, text#", sizes)


def test_rules_count_words_of_one_place(spark):
    rows = [(1, 0, 10.0, 20.0, 5.0, 9.0)] * 3 + [(1, 0, 12.0, 30.0, 40.0, 44.0), (None, 0, 1.0, 2.0, 5.0, 9.0)]
    words = spark.createDataFrame(rows, "doc_id long, page int, x0 double, x1 double, top double, bottom double")
    got = sorted((r.doc_id or 0, r.orient, r.anchor, r.pos, r.lo, r.hi) for r in L.edges_from_words(words).collect())
    assert got == [(0, "h", "top", 5.0, 1.0, 2.0), (1, "h", "top", 5.0, 10.0, 20.0), (1, "h", "top", 40.0, 12.0, 30.0)] + [
        (1, "v", "center", 15.0, 5.0, 9.0), (1, "v", "x0", 10.0, 5.0, 44.0), (1, "v", "x1", 20.0, 5.0, 9.0)
    ]


def test_only_windows_of_a_sentence_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_SENTENCES", 0)
    pages = spark.createDataFrame([(1, 0, "a b c d e f"), (2, 0, "x y")], "doc_id long, page int, page_text string")
    out = S.drop_sentences(pages, spark.createDataFrame([(1, "c d")], "sentence_no long, sentence string"))
    assert "LeftSemi" in plan(out)
    assert sorted(r.page_text for r in out.collect()) == ["a b  e f", "x y"]  # the blanks before a sentence stay


def test_many_small_ranges_share_tasks():
    tasks = [[("f", i, i + 1)] for i in range(25)]
    few = R.few(tasks, 4)
    assert [r for t in few for r in t] == [r for t in tasks for r in t]
    assert sorted(map(len, few)) == [6, 6, 6, 7]
    assert R.few(tasks, 100) == tasks and R.few([], 4) == []


def test_postings_are_put_together_in_the_task(monkeypatch):
    monkeypatch.setattr(X, "HELD_NUMBERS", 5)
    pages = [(0, "Abcd"), (1, "abc"), (4096, "abcabc"), (4097, None), (4098, "ab")]
    batch = pa.RecordBatch.from_arrays([pa.array([p for p, _ in pages], pa.int64()), pa.array([t for _, t in pages])], names=["page_no", "page_text"])
    got = {}
    for b in X._posted([batch]):
        for r in b.to_pylist():
            got.setdefault((r["trigram"], r["block"]), []).extend(r["page_nos"])
    assert got == {("abc", 0): [0, 1], ("bcd", 0): [0], ("abc", 1): [4096], ("bca", 1): [4096], ("cab", 1): [4096]}


@pytest.mark.parametrize("cells", [1, 1 << 22])
def test_blocks_of_many_images_are_dilated_together(spark, monkeypatch, cells):
    monkeypatch.setattr(K, "HELD_CELLS", cells)
    images = {1: [[1, 2, 3]], 2: [[5]], 3: [[i * j % 7 for j in range(4)] for i in range(9)], None: [[4, 1], [0, 9]]}
    px = spark.createDataFrame([(i, y, x, v) for i, m in images.items() for y, r in enumerate(m) for x, v in enumerate(r)], "image_id long, y int, x int, v int")
    out = K.dilate(px, 3, 1)
    assert "FlatMapGroupsInPandas" not in plan(out)  # no Python call for a block
    near = lambda m, y, x: max(v for r in m[max(0, y - 1) : y + 2] for v in r[max(0, x - 1) : x + 2])
    assert {(r.image_id, r.y, r.x): r.v for r in out.collect()} == {(i, y, x): near(m, y, x) for i, m in images.items() for y, r in enumerate(m) for x in range(len(r))}


def test_cells_lie_where_their_page_is(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fx, "LINES_A_PART", 5)
    d = str(tmp_path)
    spark.createDataFrame([(i, "text", "en", "web", 4) for i in range(5)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    lines = [(o, n, o, n, 1.0 * n, "A", "F", 2.0) for o in range(20) for n in range(1, 1 + o % 4)]
    columns = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_returnflag string, l_linestatus string, l_quantity double"
    spark.createDataFrame(lines, columns).write.parquet(f"{d}/lineitem.parquet")
    for key in ("markdown_tables", "last_table", "header_separator"):
        assert exchanges(REGISTRY[key].build(spark, d)) == 2  # the line items by order, the tables by document
    assert not re.search(r"Exchange hashpartitioning[^\n]*\n[^\n]*Generate explode[^\n]*col_no", plan(decoded_drops(spark, d)))
    cells = fx.cells(spark, d)
    for keep in ("all", "last", "joined"):
        lying, dealt = (sorted(map(str, M.markdown_tables(c, keep=keep, together=t).collect())) for c, t in ((cells, True), (cells.repartition(3), False)))
        assert lying == dealt
        assert sorted(map(str, M.markdown_tables(cells.repartition(3), keep=keep, together=True).collect())) == dealt  # right also where it is not so


def test_the_words_of_a_sentence_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_SENTENCES", 0)
    pages = spark.createDataFrame([(1, 0, "a b c d e f"), (1, 1, "a b c d e g"), (2, 0, None)], "doc_id long, page int, page_text string")
    out = S.drop_sentences(pages, spark.createDataFrame([(1, "a b  c d e f"), (2, "b c"), (3, None)], "sentence_no long, sentence string"))
    assert not re.search(r"(?<!n)_words#", plan(out))
    got = {(r.doc_id, r.page): (r.page_text, [tuple(x) for x in r.dropped]) for r in out.collect()}
    assert got == {(1, 0): ("", [(0, 1, 6)]), (1, 1): ("a  d e g", [(1, 2, 2)]), (2, 0): (None, [])}


def test_lines_are_shuffled_as_numbers_first(spark, tables):
    from folio.plans import corpus_queries as Q

    seen = []
    with pytest.MonkeyPatch.context() as m:
        m.setattr(Q, "stored", lambda df, name: seen.append((name, plan(df))) or df)
        REGISTRY["drop_sentences"].build(spark, tables)
    first = dict(seen)["shared-marks"]
    assert not re.search(r"hashpartitioning\(sentence", first) and "hashpartitioning(_mark" in first


def test_words_meet_rules_where_they_lie(spark, tables):
    li = spark.createDataFrame([(i, 1, 2, 3, 4.0, "A", "F", 5.0) for i in range(20)], LINE_ITEMS)
    li.write.mode("overwrite").parquet(f"{tables}/lineitem.parquet")
    # the text, and the line items for the rules and for the words in their cells
    for key in ("words_in_cells", "extract_tables", "extract_tables_cropped"):
        assert exchanges(REGISTRY[key].build(spark, tables)) == 3, key
    assert exchanges(REGISTRY["extract_tables_text"].build(spark, tables)) <= 4


LINE_ITEMS = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_returnflag string, l_linestatus string, l_quantity double"


def test_text_beside_tables_is_not_joined_to_them_again(spark, tables):
    at = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(at)
    spark.conf.set(at, "-1")  # as for tables of some size
    for key in ("text_around_tables", "text_between_tables"):
        p = plan(REGISTRY[key].build(spark, tables))
        assert not re.search(r"hashpartitioning\([^)]*(table_no|band|part|_b#)", p), key
    spark.conf.set(at, before)
