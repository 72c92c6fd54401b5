"""Path functions: folder levels, file stem, page image name."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SEP = "\\"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parts(path, sep: str = DEFAULT_SEP) -> Column:
    return F.split(_c(path), re.escape(sep))


def levels(path, sep: str = DEFAULT_SEP) -> Column:
    """B1: ``struct(lv1, lv2, lv3)`` from a path.

    lv1 is the 2nd part; lv2 the 3rd part unless it is also the last, then
    null; lv3 the last part with every ".pdf" removed (case-sensitive).
    Folders deeper than the 3rd part are skipped.  A path with fewer than
    three parts, or an empty 3rd part, leaves lv2/lv3 null.
    """
    p = parts(path, sep)
    p2 = F.get(p, 2)
    last = F.element_at(p, -1)
    named = p2.isNotNull() & (p2 != "")
    lv2 = F.when(named & (p2 != last), p2)
    lv3 = F.when(named, F.replace(last, F.lit(".pdf"), F.lit("")))
    return F.struct(F.get(p, 1).alias("lv1"), lv2.alias("lv2"), lv3.alias("lv3"))


def file_name(path, sep: str = DEFAULT_SEP) -> Column:
    return F.element_at(parts(path, sep), -1)


def file_stem(path, sep: str = DEFAULT_SEP) -> Column:
    """B2: last part cut at the *first* dot, surrounding whitespace removed."""
    return F.regexp_replace(F.substring_index(file_name(path, sep), ".", 1), r"^\s+|\s+$", "")


def page_image_path(stem, page, root: str = "images") -> Column:
    """``{root}/{stem}/{stem}_{page}.png``."""
    s = _c(stem)
    return F.concat(F.lit(root + "/"), s, F.lit("/"), s, F.lit("_"), _c(page).cast("string"), F.lit(".png"))


def has_suffix(path, suffix: str | None) -> Column:
    return F.lit(True) if not suffix else _c(path).endswith(suffix)
