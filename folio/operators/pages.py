"""Page-level projections and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions.text import clean_text, is_empty

PAGE_KEYS = ("doc_id", "page")


def select_page(df: DataFrame, n: int, page_col: str = "page") -> DataFrame:
    """The page (sheet, result) with index ``n``."""
    return df.where(F.col(page_col) == n)


def number_pages(
    df: DataFrame, base: int = 1, page_col: str | None = "page", name: str = "page_number", doc_col: str = "doc_id", order_cols: tuple[str, ...] = ()
) -> DataFrame:
    """Page numbers counted from ``base`` (0 for metadata, 1 for reports).

    Without a page column, pages are numbered in ``order_cols`` order inside each
    document (distributed numbering, see ``numbering.ordinal``)."""
    if page_col is not None:
        return df.withColumn(name, F.col(page_col) + F.lit(base))
    from folio.operators.numbering import ordinal

    return ordinal(df, [doc_col], list(order_cols), name=name, base=base)


def empty_pages(pages: DataFrame, keys=PAGE_KEYS, squeeze: bool = True) -> DataFrame:
    """Pages whose cleaned text is empty (these go to OCR)."""
    return pages.where(is_empty(clean_text("page_text", squeeze))).select(*keys)


def page_count(pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """Number of pages per file."""
    return pages.groupBy(key).agg(F.count(F.lit(1)).alias("n_pages"))


def pages_without_tables(pages: DataFrame, cells: DataFrame, keys=PAGE_KEYS) -> DataFrame:
    """Pages with no table at all (anti-join on the page key).

    Cells are met as their pages, and never broadcast: equal keys are small on disk, and large in a driver's hash table."""
    k = list(keys)
    return pages.select(*k).join(cells.select(*k).distinct().hint("merge"), k, "left_anti")
