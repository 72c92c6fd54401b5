"""Column functions for page text and markdown rows.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the title sentences of the page documents
TITLE_EN = "This page explains {}."
TITLE_OTHER = "이 문서의 제목은 {} 입니다."
# older layout (v2): the English sentence without the final period
TITLE_EN_V2 = "This page explains {}"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _rep(c: Column, a: str, b: str) -> Column:
    return F.replace(c, F.lit(a), F.lit(b))


def clean_text(col, squeeze: bool = True) -> Column:
    """Newline -> space, drop every "- ", then one pass of double space -> single."""
    c = _rep(_rep(_c(col), "\n", " "), "- ", "")
    return _rep(c, "  ", " ") if squeeze else c


def flatten_lines(col) -> Column:
    """OCR output on one line."""
    return _rep(_c(col), "\n", " ")


def boilerplate_pattern(sentences) -> str:
    """One regex for the given sentences, tolerant of any run of whitespace between words."""
    alts = [r"\s+".join(re.escape(w) for w in s.split()) for s in sentences]
    return "(" + "|".join(alts) + ")"


def drop_boilerplate(col, sentences) -> Column:
    """T4: remove quoted sentences (e.g. a converter's evaluation warning)."""
    return F.regexp_replace(_c(col), boilerplate_pattern(sentences), "")


def header_separator(col, repair: bool = True) -> Column:
    """Every non-'|' character becomes '-'; then the first '||' becomes '|-|' once."""
    sep = F.regexp_replace(_c(col), r"[^|]", "-")
    if repair:
        # the lazy anchored prefix makes the replace-all act on the first match only
        sep = F.regexp_replace(sep, r"^([\s\S]*?)\|\|", "$1|-|")
    return sep


def clean_cell(col) -> Column:
    """Missing cell -> 'None'; newlines inside a cell -> space."""
    return F.coalesce(_rep(_c(col), "\n", " "), F.lit("None"))


def row_markdown(cells_sorted: Column, escape: bool = False) -> Column:
    """An ordered array of cleaned cells -> ``|a|b|``."""
    arr = F.transform(cells_sorted, lambda x: F.replace(x, F.lit("|"), F.lit("\\|"))) if escape else cells_sorted
    return F.concat(F.lit("|"), F.array_join(arr, "|", "None"), F.lit("|"))


def title_line(name, lang, style: str = "v3") -> Column:
    """The first line of a page document; ``lang`` is a column or a literal."""
    n = F.coalesce(_c(name), F.lit("None"))
    lg = F.lit(lang) if isinstance(lang, str) else lang
    en = TITLE_EN_V2 if style == "v2" else TITLE_EN
    a, b = en.split("{}")
    c, d = TITLE_OTHER.split("{}")
    return F.when(lg == "en", F.concat(F.lit(a), n, F.lit(b))).otherwise(F.concat(F.lit(c), n, F.lit(d)))


def is_empty(col) -> Column:
    """A page with no text layer (whitespace-only text is *not* empty)."""
    return F.length(_c(col)) == 0


def search(col, pattern: str, ignore_case: bool = True) -> tuple[Column, Column, Column]:
    """(matches?, number of matches, first match) for a regex over page text."""
    p = ("(?i)" if ignore_case else "") + pattern
    c = _c(col)
    return c.rlike(p), F.regexp_count(c, F.lit(p)), F.regexp_extract(c, p, 0)
