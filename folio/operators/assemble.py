"""Page documents and the corpus.

A page document is flat: ``page_content`` plus its metadata fields
(``page, first_division, second_division, file_name, file_path``; the older
'levels' style uses ``page_number, lv1, lv2, lv3, source``).  The corpus is the
set of page documents of the files that win their title, keyed by ``title``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.paths import DEFAULT_SEP, has_suffix
from folio.functions.text import title_line
from folio.operators.folders import last_wins, with_levels
from folio.operators.layout import CROP_BOX, box_fits, page_text
from folio.operators.layout import crop as crop_words
from folio.operators.markdown import markdown_tables
from folio.operators.numbering import ordinal
from folio.operators.ocr import page_texts
from folio.operators.pages import empty_pages
from folio.operators.ruling import GridSettings, crop_edges, table_rows
from folio.session import checkpoint_dir

PAGE_KEYS = ["doc_id", "page"]
META_V3 = ["page", "first_division", "second_division", "file_name", "file_path"]
META_LEVELS = ["page_number", "lv1", "lv2", "lv3", "source"]


def _table_suffix(md: Column) -> Column:
    return F.when(md.isNotNull(), F.concat(F.lit("\n\n"), md)).otherwise(F.lit(""))


def assemble_pages(
    files: DataFrame,
    texts: DataFrame,
    tables_md: DataFrame,
    lang: str | Column = "en",
    style: str = "v3",
    sep: str = DEFAULT_SEP,
) -> DataFrame:
    """One document per page.

    ``files(doc_id, path, ...)``, ``texts(doc_id, page, text)``, ``tables_md(doc_id,
    page, md)`` with at most one row per page (see ``markdown_tables(keep=...)``).
    Pages without a table keep their text only (C1, left join).

    * ``v3``: ``title. \\n text [\\n\\n table]``
    * ``v2``: ``title \\n\\n text [\\n\\n table]`` (title without the period)
    * ``levels``: ``text [\\n\\n table]`` with the older metadata names
    """
    j = texts.join(tables_md.select(*PAGE_KEYS, "md"), PAGE_KEYS, "left").join(with_levels(files, sep), "doc_id")
    return _page_documents(j, [c for c in files.columns if c not in ("doc_id", "path")], lang, style)


def _page_documents(j: DataFrame, keep: list[str], lang: str | Column, style: str) -> DataFrame:
    """The documents of pages with their ``text``, ``md`` and the levels of their file."""
    tail = _table_suffix(F.col("md"))
    if style == "levels":
        content = F.concat(F.col("text"), tail)
        return j.select(
            "doc_id",
            *keep,
            F.col("page").alias("page_number"),
            content.alias("page_content"),
            "lv1",
            "lv2",
            "lv3",
            F.col("path").alias("source"),
        )
    title = title_line(F.col("lv3"), lang, style)
    gap = "\n\n" if style == "v2" else "\n"
    content = F.concat(title, F.lit(gap), F.col("text"), tail)
    return j.select(
        "doc_id",
        *keep,
        "page",
        content.alias("page_content"),
        F.col("lv1").alias("first_division"),
        F.col("lv2").alias("second_division"),
        F.col("lv3").alias("file_name"),
        F.col("path").alias("file_path"),
    )


def winning_files(files: DataFrame, pages: DataFrame, sep: str = DEFAULT_SEP) -> DataFrame:
    """D7 for the corpus: per title the file latest in listing order, among files that have pages."""
    has_pages = pages.select("doc_id").distinct()
    f = with_levels(files.select("doc_id", "path", "listing_no"), sep).join(has_pages, "doc_id", "left_semi")
    return last_wins(f.select(F.col("lv3").alias("title"), "doc_id", "listing_no"), "title", "listing_no")


def _corpus(f: DataFrame, win: DataFrame, pages: DataFrame, ocr_lines: DataFrame, tables: DataFrame, lang, sep) -> DataFrame:
    """Page documents of the winning files only; OCR lines are gathered for pages without text only."""
    p = pages.join(win, "doc_id", "left_semi")
    texts = page_texts(p, ocr_lines.join(empty_pages(p), PAGE_KEYS, "left_semi"))
    docs = assemble_pages(f.join(win, "doc_id", "left_semi").select("doc_id", "path"), texts, tables, lang, "v3", sep)
    return docs.select(F.col("file_name").alias("title"), "page", "page_content", "first_division", "second_division", "file_name", "file_path")


def _stored(ids: DataFrame) -> DataFrame:
    """A list of ids that every branch of a plan reads, stored once."""
    checkpoint_dir(ids.sparkSession)
    return ids.checkpoint()


def build_corpus(
    files: DataFrame,
    pages: DataFrame,
    ocr_lines: DataFrame,
    cells: DataFrame,
    lang: str | Column = "en",
    suffix: str | None = ".pdf",
    tables_kept: str = "last",
    sep: str = DEFAULT_SEP,
) -> DataFrame:
    """Listing -> levels -> last file per title wins -> cleaned text -> OCR fallback ->
    tables -> page documents.  One flat row per page of the corpus.

    The winners are chosen first, so the pages, lines and cells of the other files
    are dropped before any work on them."""
    f = files.where(has_suffix("path", suffix)).select("doc_id", "path", "listing_no")
    win = _stored(winning_files(f, pages, sep).select("doc_id"))
    tables = markdown_tables(cells.join(win, "doc_id", "left_semi"), keep="last" if tables_kept == "last" else "joined")
    return _corpus(f, win, pages, ocr_lines, tables, lang, sep)


def build_corpus_from_layout(
    files: DataFrame,
    pages: DataFrame,
    words: DataFrame,
    edges: DataFrame,
    ocr_lines: DataFrame,
    crop: bool = False,
    lang: str | Column = "en",
    suffix: str | None = ".pdf",
    tables_kept: str = "last",
    s: GridSettings = GridSettings(),
    sep: str = DEFAULT_SEP,
) -> DataFrame:
    """The whole job from decoded words and rules (H3 -> H8 -> G4): tables are found on the
    winning files' pages, on the A4 crop box if ``crop`` is set (the text is not cropped)."""
    f = files.where(has_suffix("path", suffix)).select("doc_id", "path", "listing_no")
    win = _stored(winning_files(f, pages, sep).select("doc_id"))
    keep = lambda df: df.join(win, "doc_id", "left_semi")
    rows = table_rows(keep(words), keep(edges), keep(pages), s, crop_box=CROP_BOX if crop else None)
    tables = markdown_tables(rows, keep="last" if tables_kept == "last" else "joined")
    return _corpus(f, win, pages, ocr_lines, tables, lang, sep)


def layout_pages(
    files: DataFrame,
    pages: DataFrame,
    words: DataFrame,
    edges: DataFrame,
    suffix: str | None = ".pdf",
    sep: str = DEFAULT_SEP,
) -> DataFrame:
    """The older converter: page text from the words and the last table, both inside the A4 crop
    box; a document with a page that the box does not fit is converted uncropped, whole
    (B10).  Page documents in the 'levels' style, of every file."""
    f = files.where(has_suffix("path", suffix)).select("doc_id", "path")
    # whether a document is cropped is a flag of its rows, so tables are found and text is made once, for all of them
    fits = _stored(pages.groupBy("doc_id").agg(F.min(box_fits(CROP_BOX)).alias("_crop")).join(f, "doc_id", "left_semi"))
    flag = F.col("_crop")
    p = pages.join(fits, "doc_id", "left_semi")
    w = crop_words(words.join(fits, "doc_id"), CROP_BOX, flag).drop("_crop")
    e = crop_edges(edges.join(fits, "doc_id"), CROP_BOX, flag).drop("_crop")
    tables = markdown_tables(table_rows(w, e, p), keep="last")
    # a page gets its file before its text, which is then shuffled by page only
    of_file = p.select(*PAGE_KEYS).join(with_levels(f, sep), "doc_id")
    texts = of_file.join(page_text(w), PAGE_KEYS, "left").withColumn("text", F.coalesce("text", F.lit("")))
    return _page_documents(texts.join(tables.select(*PAGE_KEYS, "md"), PAGE_KEYS, "left"), [], "en", "levels")


def collect_docs(corpus: DataFrame) -> DataFrame:
    """One entry per title with its page documents in page order.

    Only for the corpus (one file per title), so a group is one file's pages.
    """
    return corpus.groupBy("title").agg(
        F.sort_array(F.collect_list(F.struct("page", "page_content", *[c for c in META_V3 if c != "page"]))).alias("pages")
    )


def first_titles(files: DataFrame, pages: DataFrame, suffix: str | None = ".pdf", sep: str = DEFAULT_SEP) -> DataFrame:
    """Insertion position of every title: where it first appears in the listing."""
    has_pages = pages.select("doc_id").distinct()
    f = with_levels(files.where(has_suffix("path", suffix)).select("doc_id", "path", "listing_no"), sep).join(has_pages, "doc_id", "left_semi")
    return f.groupBy(F.col("lv3").alias("title")).agg(F.min("listing_no").alias("first_no"))


def corpus_summary(files: DataFrame, pages: DataFrame, suffix: str | None = ".pdf", sep: str = DEFAULT_SEP) -> DataFrame:
    """Number of documents (titles) and the first title in insertion order."""
    t = first_titles(files, pages, suffix, sep)
    return t.agg(F.count(F.lit(1)).alias("n_docs"), F.min_by("title", "first_no").alias("first_title"))


def sample_page(corpus: DataFrame, summary: DataFrame, n: int = 5) -> DataFrame:
    """The n-th page document (0-based list position) of the first title."""
    first = summary.select(F.col("first_title").alias("title"))
    docs = corpus.join(first, "title", "left_semi")
    return nth_pages(docs, n)


def nth_pages(corpus: DataFrame, n: int = 5) -> DataFrame:
    """S3 for every title: its n-th page document (0-based list position), if it has so many."""
    pos = F.row_number().over(Window.partitionBy("title").orderBy("page")) - 1
    return corpus.withColumn("_pos", pos).where(F.col("_pos") == n).drop("_pos")


def corpus_titles(files: DataFrame, pages: DataFrame, suffix: str | None = ".pdf", sep: str = DEFAULT_SEP) -> DataFrame:
    """The corpus's titles, numbered in insertion order."""
    return ordinal(first_titles(files, pages, suffix, sep), [], ["first_no"], name="title_no").select("title", "title_no")
