"""Cells -> markdown tables.

Input ``cells(<page keys>, table_no, row_no, col_no, txt)``; ``txt`` null means
"no cell" and prints as ``None``.  The rows of one table are aggregated
twice (cells -> row text, rows -> table text); both aggregations run on one
hash partitioning by page, so the plan has a single shuffle.  Cells that are made
where their page lies (``together``: partitioned by some of the page keys) are not shuffled.
Rows of tables, ``(<page keys>, table_no, row_no, txts)`` as ``ruling.table_rows`` finds them, are taken as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions.text import clean_cell, header_separator, row_markdown

PAGE_KEYS = ("doc_id", "page")


def markdown_rows(cells: DataFrame, keys=PAGE_KEYS, escape: bool = False, together: bool = False) -> DataFrame:
    k = list(keys)
    cells = cells if together else cells.repartition(*k)
    if "txts" in cells.columns:
        return cells.select(*k, "table_no", "row_no", row_markdown(F.transform("txts", clean_cell), escape).alias("md_row"))
    rows = cells.groupBy(*k, "table_no", "row_no").agg(
        F.sort_array(F.collect_list(F.struct("col_no", clean_cell("txt").alias("t")))).alias("_cs")
    )
    return rows.select(*k, "table_no", "row_no", row_markdown(F.transform("_cs", lambda s: s["t"]), escape).alias("md_row"))


def markdown_tables(cells: DataFrame, keys=PAGE_KEYS, keep: str = "all", repair: bool = True, escape: bool = False, together: bool = False) -> DataFrame:
    """H8: one markdown string per table; the separator follows the first row.

    ``keep='last'`` (H9) keeps only the page's last table, as the main parser's
    loop does; ``keep='joined'`` joins all tables of a page with a blank line.
    ``together``: the cells are partitioned by some of ``keys`` already (the result does not depend on it).
    """
    k = list(keys)
    rows = markdown_rows(cells, keys, escape, together)
    t = rows.groupBy(*k, "table_no").agg(F.sort_array(F.collect_list(F.struct("row_no", "md_row"))).alias("_rs"))
    head = F.element_at("_rs", 1)["md_row"]
    rest = F.array_join(F.transform(F.slice("_rs", 2, F.greatest(F.size("_rs") - 1, F.lit(1))), lambda r: r["md_row"]), "\n")
    md = F.concat(
        head,
        F.lit("\n"),
        header_separator(head, repair),
        F.when(F.size("_rs") > 1, F.concat(F.lit("\n"), rest)).otherwise(F.lit("")),
    )
    tables = t.select(*k, "table_no", md.alias("md"))
    if keep == "all":
        return tables
    if keep == "last":
        return tables.groupBy(*k).agg(F.max_by("md", "table_no").alias("md"))
    if keep == "joined":
        return tables.groupBy(*k).agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("table_no", "md"))), lambda r: r["md"]), "\n\n").alias("md")
        )
    raise ValueError(f"keep must be 'all', 'last' or 'joined', not {keep!r}")


def header_rows(cells: DataFrame, keys=PAGE_KEYS, together: bool = False) -> DataFrame:
    """The first row of every table as markdown, for the separator queries."""
    k = list(keys)
    rows = markdown_rows(cells, keys, together=together)
    return rows.groupBy(*k, "table_no").agg(F.min_by("md_row", "row_no").alias("header"))
