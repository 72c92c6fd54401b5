"""Box functions over ``ARRAY<STRUCT<x DOUBLE, y DOUBLE>>`` corner lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def corners(x0, top, x1, bottom) -> Column:
    """Four corners clockwise from the top-left, as an OCR detector returns them."""
    pt = lambda x, y: F.struct(_c(x).alias("x"), _c(y).alias("y"))
    return F.array(pt(x0, top), pt(x1, top), pt(x1, bottom), pt(x0, bottom))


def min_x(box) -> Column:
    return F.array_min(F.transform(_c(box), lambda p: p["x"]))


def min_y(box) -> Column:
    return F.array_min(F.transform(_c(box), lambda p: p["y"]))


def flatten_line_boxes(lines) -> Column:
    """T9 'lines' format: ``ARRAY<ARRAY<STRUCT<box, ch>>>`` -> ``ARRAY<box>`` (empty stays empty)."""
    return F.transform(F.flatten(_c(lines)), lambda e: e["box"])
