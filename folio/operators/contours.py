"""K6 with borders and holes: the contours of a mask in two levels, outer borders and the holes in them.

The foreground is 8-connected, the background 4-connected, and what lies around
the image is background.  A contour runs through the centres of foreground
pixels: the border pixels of a component, or those around a hole.  Its area is
that of the polygon, so a line or a single pixel has none and a full
rectangle of w x h pixels has (w - 1)(h - 1); holes count as filled in the
area of the outer border around them.

An image's lines come to one task as arrays and are labelled by runs: the runs
of a line meet those of the next one, foreground and background alike, and a
union-find joins them.  Components form a tree (what is left of a component's
first pixel is its parent).  The area comes from the 2 x 2 windows of pixel
centres: a window counts whole for the smallest component that holds all of it
and for everything around that, a half where a border cuts it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.operators.components import union_find, whole_groups

IMG = "image_id"
COLUMNS = {"contour_no": T.IntegerType(), "hole": T.BooleanType(), "parent_no": T.IntegerType(), "x": T.IntegerType(), "y": T.IntegerType(), "w": T.IntegerType(), "h": T.IntegerType(), "area": T.DoubleType()}


def label_runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of a mask that is framed by background, in reading order: first cell, foreground?, label (the component's first
    run), and each run's length."""
    h, w = mask.shape
    flat = mask.ravel()
    begins = np.ones(h * w, bool)
    begins[1:] = flat[1:] != flat[:-1]
    begins[::w] = True
    start = np.flatnonzero(begins)
    length = np.diff(np.append(start, h * w))
    ink = flat[start]
    upper = np.flatnonzero(start + w < h * w)
    # the runs of the next line that a run touches: with a corner for the foreground, with an edge for the background
    left = np.maximum(start[upper] - ink[upper], (start[upper] // w) * w) + w
    right = np.minimum(start[upper] + length[upper] - 1 + ink[upper], (start[upper] // w) * w + w - 1) + w
    first = np.searchsorted(start, left, "right") - 1
    n = np.searchsorted(start, right, "right") - first
    a = np.repeat(upper, n)
    b = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
    same = ink[a] == ink[b]
    return start, ink, union_find(len(start), a[same], b[same]), length


def image_contours(mask: np.ndarray) -> dict[str, np.ndarray]:
    """The contours of one image (``mask``: foreground, as [h, w]), in the order of their first pixels."""
    framed = np.zeros((mask.shape[0] + 2, mask.shape[1] + 2), bool)
    framed[1:-1, 1:-1] = mask
    w = framed.shape[1]
    start, ink, label, length = label_runs(framed)
    top, node = np.unique(label, return_inverse=True)  # a component's first run; components in reading order, 0 is the outside
    fore = ink[top]
    parent = np.full(len(top), -1)
    parent[1:] = node[top[1:] - 1]
    y, x0 = start // w, start % w
    box = [np.full(len(top), fill) for fill in (framed.size, framed.size, -1, -1)]
    for at, (op, v) in zip(box, ((np.minimum, x0), (np.minimum, y), (np.maximum, x0 + length - 1), (np.maximum, y)), strict=True):
        op.at(at, node, v)
    twelfths = _areas(framed, np.repeat(node, length).reshape(framed.shape), fore, parent)
    out = np.arange(1, len(top))
    hole = ~fore[out]
    # a hole's contour runs through the pixels around it; the frame shifts everything by one pixel
    left, up, right, down = (b[out] + grow * hole - 1 for b, grow in zip(box, (-1, -1, 1, 1), strict=True))
    return {
        "contour_no": out - 1, "hole": hole, "parent_no": np.where(hole, parent[out] - 1, -1),
        "x": left, "y": up, "w": right - left + 1, "h": down - up + 1, "area": twelfths[out] / 12,
    }


def _areas(framed: np.ndarray, node: np.ndarray, fore: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Twelve times the area of each component's contour."""
    corner = lambda m: np.stack([m[:-1, :-1].ravel(), m[:-1, 1:].ravel(), m[1:, :-1].ravel(), m[1:, 1:].ravel()])
    at, ink = corner(node), corner(framed)
    inside = ~((at == 0).all(0))
    at, ink = at[:, inside], ink[:, inside]
    black = np.where(ink, at, -1).max(0)  # foreground pixels of a window are of one component
    some = black >= 0
    around = np.where(some, parent[black], -1)
    outer = (~ink & (at == around)).any(0) & some  # part of the window lies outside that component
    whole = np.where(some, np.where(outer, around, black), at[0])
    total = np.bincount(whole, minlength=len(fore)) * 12
    # three corners in the component or its holes: half
    three = outer & ((ink | (at != around)).sum(0) == 3)
    half = np.bincount(black[three], minlength=len(fore)) * 6
    # a hole gets half a window for one corner, the window for more; dealt to the corners in it
    held = ~ink & some & (at != around)
    n = np.stack([(held & (at == at[k])).sum(0) for k in range(4)])
    for k in range(4):
        mine = held[k]
        half += np.bincount(at[k][mine], np.array([0, 6, 6, 4, 3])[n[k][mine]], minlength=len(fore)).astype(np.int64)
    depth = np.zeros(len(fore), np.int64)
    for c in range(1, len(fore)):  # a parent comes before its children
        depth[c] = depth[parent[c]] + 1
    for d in range(int(depth.max(initial=0)), 0, -1):
        level = np.flatnonzero(depth == d)
        np.add.at(total, parent[level], total[level])
    return total + half


def contours(mask: DataFrame, min_v: int = 1) -> DataFrame:
    """K6: the contours of the foreground (v >= ``min_v``) of each image of ``(image_id, y, x, v)`` pixels.

    ``(image_id, contour_no, hole, parent_no, x, y, w, h, area)``: numbered from 0 by their first pixel in reading order;
    a hole's parent is the outer contour around it (outer contours: -1).  The box holds the contour's pixels.
    Images are shuffled once, as lines; one image is bounded by its resolution."""
    lines = mask.groupBy(IMG, "y").agg(F.sort_array(F.collect_list(F.struct("x", (F.col("v") >= min_v).alias("ink")))).alias("line"))
    return _contours(lines.select(IMG, "y", F.transform("line", lambda p: p["x"].cast("long")).alias("xs"), F.transform("line", lambda p: p["ink"]).alias("ink")))


def line_contours(lines: DataFrame, min_v: int = 1) -> DataFrame:
    """K6 on scan lines ``(image_id, y, line)``: as `contours`, without a row for each pixel."""
    xs = F.sequence(F.lit(0).cast("long"), F.size("line").cast("long") - 1)
    return _contours(lines.where(F.size("line") > 0).select(IMG, "y", xs.alias("xs"), F.transform("line", lambda v: v >= min_v).alias("ink")))


def _contours(lines: DataFrame) -> DataFrame:
    kind = lines.schema[IMG].dataType
    schema = T.StructType([T.StructField(IMG, kind), *[T.StructField(n, t) for n, t in COLUMNS.items()]])
    lines = lines.withColumn("y", F.col("y").cast("long"))
    return lines.repartition(IMG).sortWithinPartitions(IMG, "y").mapInPandas(_contours_of_images, schema)


def _contours_of_images(batches):
    for pdf in whole_groups(batches, [IMG]):
        for image, lines in pdf.groupby(IMG, sort=False):
            m = np.zeros((int(lines["y"].max()) + 1, int(max(x[-1] for x in lines["xs"])) + 1), bool)
            for y, xs, ink in zip(lines["y"], lines["xs"], lines["ink"], strict=True):
                m[y, np.asarray(xs)] = np.asarray(ink, bool)
            found = image_contours(m)
            if len(found["contour_no"]):
                yield pd.DataFrame({IMG: image, **found})
