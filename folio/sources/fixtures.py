"""Decoded-document tables derived from the driver tables (FIXTURES.md F1-F9).

The operators start after decoding; these functions build the decoded tables
(files, pages, OCR lines, words, cells, ruling edges, pixels, predictions,
regions) from the driver's parquet tables with plain DataFrame expressions, so
that every query's work grows with the input tables.

Two deliberate widenings of FIXTURES.md, so that queries run over whole tables:
ruling edges are drawn for the tables of every document (no document-id
subset), and OCR predictions hold every word of every page
(``image_id = doc_id * 1000 + page``) instead of the first words of page 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BS = "\\"  # the reference's path separator

# fixed values: page slicing and word grid of the fixture definition
PAGE_CHARS = 1800
GRID_COLS = 80
CHAR_W = 6
LINE_H = 34


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def files(spark: SparkSession, d: str) -> DataFrame:
    """F1 ``files(doc_id, path, listing_no)`` — five path shapes by ``doc_id % 5``."""
    docs = table(spark, d, "documents").select("doc_id", "source", "lang")
    k = F.col("doc_id") % 5
    sep = F.lit(BS)
    did = _s("doc_id")
    tail = (
        F.when(k == 0, F.concat("source", sep, F.lit("doc_"), did, F.lit(".pdf")))
        .when(k == 1, F.concat(F.lit("doc_"), did, F.lit(".pdf")))
        .when(k == 2, F.concat("source", sep, "lang", sep, F.lit("doc_"), did, F.lit(".pdf")))
        .when(k == 3, F.concat("source", sep, did, sep, F.lit(" rev."), _s(F.col("doc_id") % 50), F.lit(".pdf")))
        .otherwise(F.concat("source", sep, F.lit("note_"), did, F.lit(".txt")))
    )
    return docs.select(
        "doc_id",
        F.concat(F.lit("." + BS + "2024" + BS), tail).alias("path"),
        F.col("doc_id").alias("listing_no"),
    )


def doc_lang(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "lang")


def _pages_up_to(docs: DataFrame, last: Column) -> DataFrame:
    """One row per page 0..last (none if last is negative) with its slice of the text."""
    return docs.where(last >= 0).select("doc_id", "text", F.explode(F.sequence(F.lit(0), last)).alias("page")).select(
        "doc_id",
        "page",
        F.col("text").substr(F.col("page") * PAGE_CHARS + 1, F.lit(PAGE_CHARS)).alias("raw"),
    )


def _last_text_page() -> Column:
    return F.floor((F.length("text") - 1) / PAGE_CHARS).cast("int")


def raw_pages(spark: SparkSession, d: str) -> DataFrame:
    """The pages that hold text."""
    return _pages_up_to(table(spark, d, "documents").select("doc_id", "text"), _last_text_page())


def pages(spark: SparkSession, d: str) -> DataFrame:
    """F2 ``pages(doc_id, page, width, height, raw, page_text)``: the text pages, and the pages of a
    document's tables behind them (without text)."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    n_docs = table(spark, d, "documents").select(F.count(F.lit(1))).scalar()
    orders = table(spark, d, "lineitem").select("l_orderkey").distinct()
    docs = docs.withColumn("_text_to", F.coalesce(_last_text_page(), F.lit(-1)))  # before the join: readers of the sizes alone shuffle no text
    held = orders.groupBy((F.col("l_orderkey") % n_docs).alias("doc_id")).agg(F.floor((F.count(F.lit(1)) - 1) / 2).cast("int").alias("_tables_to"))
    last = F.greatest("_text_to", F.coalesce("_tables_to", F.lit(-1)))
    small = (F.col("doc_id") % 13) == 0
    raw = F.coalesce("raw", F.lit(""))
    text = F.replace(
        F.replace(F.replace(raw, F.lit("th"), F.lit("t-\nh")), F.lit(", "), F.lit(",  ")),
        F.lit(". "),
        F.lit(".    "),
    )
    return _pages_up_to(docs.join(held, "doc_id", "left"), last).select(
        "doc_id",
        "page",
        F.when(small, 500.0).otherwise(595.0).alias("width"),
        F.when(small, 700.0).otherwise(841.0).alias("height"),
        raw.alias("raw"),
        F.when((F.col("doc_id") + F.col("page")) % 7 == 0, F.lit("")).otherwise(text).alias("page_text"),
    )


# fixed value: the converter's warning sentence, as written in the reference's note
WARNING_SENTENCE = "Evaluation Warning : The document was created with  Spire.XLS for Python"


def pages_with_warning(spark: SparkSession, d: str) -> DataFrame:
    """F2 with the converter warning appended where ``doc_id % 3 = 0``."""
    p = pages(spark, d)
    return p.withColumn(
        "page_text",
        F.when(F.col("doc_id") % 3 == 0, F.concat("page_text", F.lit(WARNING_SENTENCE))).otherwise(F.col("page_text")),
    )


def raw_lines(spark: SparkSession, d: str) -> DataFrame:
    return raw_pages(spark, d).select("doc_id", "page", F.posexplode(F.split("raw", "\n")).alias("line_no", "txt"))


def ocr_lines(spark: SparkSession, d: str) -> DataFrame:
    """F3 ``ocr_lines(doc_id, page, result_idx, line_no, txt, conf)``."""
    dp = F.col("doc_id") + F.col("page")
    return (
        raw_lines(spark, d)
        .where((dp % 7 == 0) & (dp % 14 != 0))
        .select(
            "doc_id",
            "page",
            F.when(F.col("doc_id") % 11 == 0, F.col("line_no") % 2).otherwise(F.lit(0)).alias("result_idx"),
            "line_no",
            "txt",
            ((F.length("txt") % 100).cast("double") / 100.0).alias("conf"),
        )
    )


CHARS_A_PART = 3_000_000  # characters of text whose words one task holds


def text_parts(spark: SparkSession, d: str) -> int:
    """The parts of the text: no fewer than in the session's own shuffles, since a join takes the finer of its sides' parts."""
    chars = table(spark, d, "documents").select(F.sum("n_chars")).first()[0] or 0
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // CHARS_A_PART))


def parts(spark: SparkSession, d: str) -> int:
    """Parts enough for the text and for the line items, for readers that meet words and rules where they lie."""
    return max(text_parts(spark, d), -(-table(spark, d, "lineitem").count() // LINES_A_PART))


def _dealt(pages: DataFrame, spark: SparkSession, d: str, by, n: int | None = None) -> DataFrame:
    """Pages with text in parts that hold as much whatever the size of the table: the text is shuffled, and what is made of it
    (words, boxes) is not, for readers keyed by ``by``."""
    return pages.repartition(n or text_parts(spark, d), *by)


def words(spark: SparkSession, d: str, by=("doc_id",), n: int | None = None) -> DataFrame:
    """F4 ``words(doc_id, page, word_no, word, x0, x1, top, bottom)``; ``by``: what they are partitioned by, into ``n`` parts."""
    return _positioned(_dealt(raw_pages(spark, d), spark, d, by, n), ())


def _positioned(pages: DataFrame, also) -> DataFrame:
    """The words of the pages on a grid; ``also``: columns that the page tells, which they keep."""
    w = Window.partitionBy(*also, "doc_id", "page").orderBy("word_no").rowsBetween(Window.unboundedPreceding, 0)
    pw = pages.select(*also, "doc_id", "page", F.posexplode(F.split("raw", "[ \n]")).alias("word_no", "word")).withColumn(
        "off", F.sum(F.length("word") + 1).over(w) - F.length("word") - 1
    )
    col = F.col("off") % GRID_COLS
    row = F.floor(F.col("off") / GRID_COLS)
    return pw.where(F.col("word") != "").select(
        *also,
        "doc_id",
        "page",
        "word_no",
        "word",
        (36 + CHAR_W * col).cast("double").alias("x0"),
        (36 + CHAR_W * col + CHAR_W * F.length("word")).cast("double").alias("x1"),
        (40 + LINE_H * row).cast("double").alias("top"),
        (52 + LINE_H * row).cast("double").alias("bottom"),
    )


LINES_A_PART = 50_000  # line items whose tables one task holds


def tables(spark: SparkSession, d: str, n: int | None = None) -> DataFrame:
    """One table per order, one row per line item, two tables per page, all from one pass over
    the line items: ``(doc_id, page, table_no, y0, n_rows, rows)``.

    ``n_rows`` counts the header; the second table of a page starts below the first one's end.  Parts by document hold as
    much whatever the number of line items: a table is a short row here, and many rules or cells next.  With their number ``n``
    given, the line items are dealt to them, and neither orders nor tables are shuffled."""
    li = table(spark, d, "lineitem")
    n_docs = table(spark, d, "documents").select(F.count(F.lit(1))).scalar()
    row = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus", F.col("l_quantity").cast("int").alias("qty"))
    li = li.withColumn("doc_id", F.col("l_orderkey") % n_docs)
    if n:
        li = li.repartition(n, "doc_id")
    # the rows are counted by themselves, so that readers of the sizes alone (rules) don't gather them
    orders = li.groupBy(*(["doc_id"] if n else []), "l_orderkey").agg(F.sort_array(F.collect_list(row)).alias("rows"), (F.count(F.lit(1)) + 1).cast("int").alias("n_rows"))
    if not n:
        orders = orders.withColumn("doc_id", F.col("l_orderkey") % n_docs).repartition(max(1, -(-li.count() // LINES_A_PART)), "doc_id")
    w = Window.partitionBy("doc_id").orderBy("l_orderkey")
    nth = F.row_number().over(w) - 1
    below = F.greatest(F.lit(350), 20 * F.lag("n_rows").over(w) + 50)
    return orders.withColumn("_nth", nth).withColumn("_below", below).select(
        "doc_id",
        F.floor(F.col("_nth") / 2).cast("int").alias("page"),
        (F.col("_nth") % 2).cast("int").alias("table_no"),
        F.when(F.col("_nth") % 2 == 0, F.lit(60)).otherwise(60 + F.col("_below")).cast("double").alias("y0"),
        "n_rows",
        "rows",
    )


def _slots(t: DataFrame) -> DataFrame:
    """Every (row, column) of every table with its text; header row 0."""
    r = F.get("rows", F.col("row_no") - 1)
    head = F.when(F.col("col_no") == 1, F.lit("FLAG")).when(F.col("col_no") == 2, F.lit("QTY")).otherwise(F.lit(""))
    body = (
        F.when(F.col("col_no") == 0, F.when(F.col("row_no") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("L"), _s(r["l_linenumber"]))))
        .when(F.col("col_no") == 1, F.concat(r["l_returnflag"], F.lit("\n"), r["l_linestatus"]))
        .when(F.col("col_no") == 2, _s(r["qty"]))
        .otherwise(F.lit(""))
    )
    slots = t.select("*", _upto(F.col("n_rows") - 1, "row_no")).select("*", _upto(F.lit(3), "col_no"))
    return slots.withColumn("txt", F.when(F.col("row_no") == 0, head).otherwise(body))


def cells(spark: SparkSession, d: str) -> DataFrame:
    """F5 ``cells(doc_id, page, table_no, row_no, col_no, txt)`` with header row 0."""
    return _slots(tables(spark, d)).select("doc_id", "page", "table_no", "row_no", "col_no", "txt")


def _upto(n: Column, name: str) -> Column:
    return F.explode(F.sequence(F.lit(0), n)).alias(name)


def edges(spark: SparkSession, d: str, n: int | None = None) -> DataFrame:
    """F6 ruling ``edges(doc_id, page, orient, pos, lo, hi)`` of every fixture table.

    A table's rules are one array, so the tables are derived once."""
    y0, size = F.col("y0"), F.col("n_rows")

    def rule(orient, pos, lo, hi):
        return F.struct(F.lit(orient).alias("orient"), pos.cast("double").alias("pos"), lo.cast("double").alias("lo"), hi.cast("double").alias("hi"))

    rows = F.sequence(F.lit(0), size)
    left = F.transform(rows, lambda r: rule("h", y0 + 20.0 * r, F.lit(50.0), F.lit(229.0)))
    right = F.transform(rows, lambda r: rule("h", y0 + 20.0 * r + 0.5 * (r % 3), F.lit(231.0), F.lit(410.0)))
    upright = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda c: rule("v", 50.0 + 90.0 * c, y0, y0 + 20.0 * size + 1.0))
    stub = F.array(rule("h", y0 + 9.0, F.lit(500.0), F.lit(502.0)))
    return tables(spark, d, n).select("doc_id", "page", F.explode(F.concat(left, right, upright, stub)).alias("e")).select("doc_id", "page", "e.orient", "e.pos", "e.lo", "e.hi")


def grid_words(spark: SparkSession, d: str, n: int | None = None) -> DataFrame:
    """Words placed inside the ruled cells; ``table_no/row_no/col_no`` are the expected answer."""
    return _slots(tables(spark, d, n)).where(F.col("txt").isNotNull() & (F.col("txt") != "")).select(
        "doc_id",
        "page",
        "table_no",
        "row_no",
        "col_no",
        F.replace("txt", F.lit("\n"), F.lit("/")).alias("word"),
        (55.0 + 90.0 * F.col("col_no")).alias("x0"),
        (55.0 + 90.0 * F.col("col_no") + 6.0 * F.length("txt")).alias("x1"),
        (F.col("y0") + 20.0 * F.col("row_no") + 4.0).alias("top"),
        (F.col("y0") + 20.0 * F.col("row_no") + 16.0).alias("bottom"),
    )


def pixels(spark: SparkSession, d: str) -> DataFrame:
    """F7 ``pixels(image_id, y, x, v)``: every embedding is an 8x8 image."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("image_id"), F.posexplode("embedding").alias("p", "e"))
    return e.select(
        "image_id",
        F.floor(F.col("p") / 8).cast("int").alias("y"),
        (F.col("p") % 8).cast("int").alias("x"),
        F.greatest(F.lit(0), F.least(F.lit(255), F.floor((F.col("e").cast("double") + 0.55) * 230))).cast("int").alias("v"),
    )


def predictions(spark: SparkSession, d: str) -> DataFrame:
    """F8 ``predictions(image_id, idx, word, box, img_w, img_h)``; one image per page."""
    imaged = raw_pages(spark, d).withColumn("image_id", F.col("doc_id") * 1000 + F.col("page"))
    w = _positioned(_dealt(imaged, spark, d, ["image_id"]), ["image_id"])
    pt = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    return w.select(
        "image_id",
        F.col("word_no").alias("idx"),
        "word",
        F.array(pt("x0", "top"), pt("x1", "top"), pt("x1", "bottom"), pt("x0", "bottom")).alias("box"),
        F.lit(595.0).alias("img_w"),
        F.lit(841.0).alias("img_h"),
    )


def regions(spark: SparkSession, d: str) -> DataFrame:
    """F9 candidate text regions; 50 images share all line items (hot keys on purpose)."""
    li = table(spark, d, "lineitem")
    w = 20 + 10 * F.col("l_quantity").cast("int")
    h = 10 + 25 * F.col("l_linenumber")
    return li.select(
        (F.col("l_orderkey") % 50).alias("image_id"),
        (F.col("l_partkey") % 400).alias("x"),
        (F.col("l_suppkey") * 3).alias("y"),
        w.alias("w"),
        h.alias("h"),
        (w * h).alias("area"),
        F.lit(500).alias("img_h"),
    )


def pixel_regions(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    v = F.col("vec_id")
    return e.select(v.alias("image_id"), (v % 4).alias("x"), (v % 3).alias("y"), (1 + v % 4).alias("w"), (1 + v % 5).alias("h"))


def planes(spark: SparkSession, d: str) -> DataFrame:
    """F7 as colour planes: images 3k, 3k+1, 3k+2 are the B, G, R planes of image k; the last image is all planes that the
    last triple lacks."""
    p = pixels(spark, d)
    last = table(spark, d, "embeddings").select(F.max("vec_id")).scalar()
    k = (F.col("image_id") % 3).cast("int")
    channels = F.slice(F.array(F.lit("b"), F.lit("g"), F.lit("r")), k + 1, F.when(F.col("image_id") == last, 3 - k).otherwise(F.lit(1)))
    return p.select((F.floor(F.col("image_id") / 3)).cast("long").alias("image_id"), F.explode(channels).alias("channel"), "y", "x", "v")
