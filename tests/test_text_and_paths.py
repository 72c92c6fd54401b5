from pyspark.sql import functions as F

from folio.functions import paths as P
from folio.functions import text as T
from folio.operators import markdown as M
from folio.operators import ocr as O


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "s string").select(fn(F.col("s")).alias("r")).first()["r"]


def test_clean_text_is_one_pass(spark):
    # newline -> space, every "- " dropped (hyphenation and bullets), then one pass of "  " -> " "
    assert one(spark, "ab-\ncd", T.clean_text) == "abcd"
    assert one(spark, "a    b", T.clean_text) == "a  b"
    assert one(spark, "x - y", T.clean_text) == "x y"
    assert one(spark, "a  b", lambda c: T.clean_text(c, squeeze=False)) == "a  b"


def test_header_separator_literal_example(spark):
    assert one(spark, "||HEATING MEDIUM|COOLING MEDIUM|", T.header_separator) == "|-|--------------|--------------|"
    # only the first '||' is repaired
    assert one(spark, "||a||", T.header_separator) == "|-|-||"
    assert one(spark, "||a|", lambda c: T.header_separator(c, repair=False)) == "||-|"


def test_drop_boilerplate_spacing_tolerant(spark):
    s = "text Evaluation Warning :  The document was created with Spire.XLS\nfor Python"
    assert one(spark, s, lambda c: T.drop_boilerplate(c, ["Evaluation Warning : The document was created with  Spire.XLS for Python"])) == "text "


def test_levels_and_stem(spark):
    rows = [
        (".\\2024\\Manual\\Guide.pdf",),
        (".\\2024\\Guide.pdf",),
        (".\\2024\\a\\b\\Deep.pdf.pdf",),
        (".\\2024\\\\x.pdf",),
        (".\\x",),
        (".\\2024\\POS\\ rev.3.PDF",),
    ]
    df = spark.createDataFrame(rows, "path string")
    lv = P.levels("path")
    got = df.select(lv["lv1"], lv["lv2"], lv["lv3"], P.file_stem("path")).collect()
    assert tuple(got[0]) == ("2024", "Manual", "Guide", "Guide")
    assert tuple(got[1]) == ("2024", None, "Guide", "Guide")
    assert tuple(got[2]) == ("2024", "a", "Deep", "Deep")  # deeper folders skipped, every ".pdf" removed
    assert tuple(got[3])[1:3] == (None, None)  # empty 3rd part leaves the names unset
    assert tuple(got[4])[1:3] == (None, None)  # fewer than three parts
    assert tuple(got[5]) == ("2024", "POS", " rev.3.PDF", "rev")  # case-sensitive removal; stem at first dot


def test_title_line(spark):
    df = spark.createDataFrame([("X", "en"), ("X", "ko"), (None, "en")], "n string, l string")
    got = [r[0] for r in df.select(T.title_line("n", F.col("l"))).collect()]
    assert got == ["This page explains X.", "이 문서의 제목은 X 입니다.", "This page explains None."]


def test_markdown_tables(spark):
    cells = spark.createDataFrame(
        [
            (1, 0, 0, 0, 0, None), (1, 0, 0, 0, 1, "A"), (1, 0, 0, 0, 2, "B\nC"),
            (1, 0, 0, 1, 0, "1"), (1, 0, 0, 1, 1, ""), (1, 0, 0, 1, 2, "2"),
            (1, 0, 1, 0, 0, "only"),
        ],
        "doc_id long, page int, table_no int, row_no int, col_no int, txt string",
    )
    got = {r.table_no: r.md for r in M.markdown_tables(cells).collect()}
    assert got[0] == "|None|A|B C|\n|----|-|---|\n|1||2|"
    assert got[1] == "|only|\n|----|"  # a one-row table: header and separator only
    assert got[0].count("\n") + 1 == 3  # rows + separator
    last = M.markdown_tables(cells, keep="last").collect()
    assert [r.md for r in last] == [got[1]]


def test_ocr_last_result_wins_even_if_empty(spark):
    lines = spark.createDataFrame(
        [(1, 0, 0, 0, "a"), (1, 0, 0, 1, "b"), (1, 0, 1, 0, None), (2, 0, 0, 1, "y"), (2, 0, 0, 0, "x")],
        "doc_id long, page int, result_idx int, line_no int, txt string",
    )
    got = {r.doc_id: r.ocr_text for r in O.ocr_text(lines).collect()}
    assert got == {1: "", 2: "x y"}
    pages = spark.createDataFrame([(1, 0, ""), (2, 0, ""), (3, 0, " "), (4, 0, "")], "doc_id long, page int, page_text string")
    t = {r.doc_id: r.text for r in O.page_texts(pages, lines).collect()}
    assert t == {1: "", 2: "x y", 3: " ", 4: ""}  # whitespace-only is not empty; no OCR rows -> ''


CLEANED = {
    "plain": "plain",
    "one\ntwo": "one two",
    "hyphen-\nated word": "hyphenated word",
    "a  b": "a b",
    "a   b": "a  b",  # pairs of spaces shrink once, from the left
    "end-": "end-",
    "": "",
    "\n": " ",
    "a - b": "a b",
}


def test_clean_text_cases(spark):
    df = spark.createDataFrame(list(CLEANED), "string").withColumnRenamed("value", "s")
    got = {r.s: r.c for r in df.select("s", T.clean_text("s").alias("c")).collect()}
    assert got == CLEANED
    assert not any("\n" in v for v in got.values())


SEPARATORS = {"|a|bb|": "|-|--|", "|": "|", "||": "|-|", "|x||y|": "|-|-|-|", "|word word|": "|---------|", "||||": "|-|||"}


def test_header_separator_cases(spark):
    df = spark.createDataFrame(list(SEPARATORS), "string").withColumnRenamed("value", "s")
    got = {r.s: r.h for r in df.select("s", T.header_separator("s").alias("h")).collect()}
    assert got == SEPARATORS


def test_clean_cell_cases(spark):
    df = spark.createDataFrame([(None,), ("",), ("a\nb",), ("a|b",)], "s string")
    assert [r.k for r in df.select(T.clean_cell("s").alias("k")).collect()] == ["None", "", "a b", "a|b"]


def test_levels_and_stem_cases(spark):
    cases = {
        ".\\2024\\A\\doc.pdf": ("2024", "A", "doc", "doc"),
        ".\\2024\\A\\B\\x.pdf.pdf": ("2024", "A", "x", "x"),
        ".\\2024\\A\\ rev.3.pdf": ("2024", "A", " rev.3", "rev"),
        ".\\2024\\only.pdf": ("2024", None, "only", "only"),
        ".\\2024\\A\\e.tar.gz": ("2024", "A", "e.tar.gz", "e"),
    }
    df = spark.createDataFrame(list(cases), "string").withColumnRenamed("value", "p")
    lv = P.levels("p")
    got = {r.p: tuple(r[1:]) for r in df.select("p", lv["lv1"], lv["lv2"], lv["lv3"], P.file_stem("p")).collect()}
    assert got == cases


def test_annotation_layout_properties(spark):
    from folio.functions.boxes import corners

    # four words on a 400 x 300 image; the two upper ones on the left share their top
    rows = [(0, "low", 20.0, 200.0), (1, "first", 30.0, 40.0), (2, "second", 10.0, 40.0), (3, "right", 390.0, 0.0)]
    df = spark.createDataFrame([(1, i, w, x, t, x + 5, t + 10) for i, w, x, t in rows], "image_id long, idx int, word string, x0 double, top double, x1 double, bottom double")
    df = df.select("image_id", "idx", "word", corners("x0", "top", "x1", "bottom").alias("box"), F.lit(400.0).alias("img_w"), F.lit(300.0).alias("img_h"))
    out = {r.word: r for r in O.annotation_layout(df).collect()}
    assert {w: r.side for w, r in out.items()} == {"low": "left", "first": "left", "second": "left", "right": "right"}
    assert [w for w, _ in sorted(((w, r.text_y) for w, r in out.items() if r.side == "left"), key=lambda x: -x[1])] == ["first", "second", "low"]
    assert (out["first"].text_y, out["right"].text_y) == (1.0, 1.0)
    assert (out["right"].anchor_x, out["right"].anchor_y, out["right"].text_x, out["right"].align) == (0.975, 1.0, 1.05, "left")
    assert (out["low"].text_x, out["low"].align) == (-0.05, "right")
