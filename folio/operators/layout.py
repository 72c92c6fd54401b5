"""Page geometry over positioned words.

``words(<page keys>, word_no, word, x0, x1, top, bottom)`` in PDF points, y
downwards.  Everything is keyed by page; no join or window crosses pages.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.session import stored

PAGE_KEYS = ("doc_id", "page")
# fixed values: the reference's A4 crop box (x0, top, x1, bottom) and the A3 page size in points
CROP_BOX = (3.0, 70.0, 590.0, 770.0)
A3 = (842.0, 1191.0)


def _box_cols(box):
    return tuple(F.lit(float(b)) if isinstance(b, (int, float)) else b for b in box)


def overlaps(box, x0="x0", top="top", x1="x1", bottom="bottom") -> Column:
    """The object touches the box: overlap >= 0 on both axes and > 0 on one of them."""
    bx0, bt, bx1, bb = _box_cols(box)
    ow = F.least(F.col(x1), bx1) - F.greatest(F.col(x0), bx0)
    oh = F.least(F.col(bottom), bb) - F.greatest(F.col(top), bt)
    return (ow >= 0) & (oh >= 0) & ((ow + oh) > 0)


def inside(box, x0="x0", top="top", x1="x1", bottom="bottom") -> Column:
    bx0, bt, bx1, bb = _box_cols(box)
    return (F.col(x0) >= bx0) & (F.col(x1) <= bx1) & (F.col(top) >= bt) & (F.col(bottom) <= bb)


def unbounded(box, of: Column) -> tuple[Column, ...]:
    """``box`` for the rows where ``of`` holds, a box without limits for the others."""
    inf = float("inf")
    return tuple(F.when(of, b).otherwise(F.lit(far)) for b, far in zip(_box_cols(box), (-inf, -inf, inf, inf)))


def crop(df: DataFrame, box=CROP_BOX, of: Column | None = None) -> DataFrame:
    """Keep the objects touching ``box`` and clip them to it; with ``of``, only rows where it holds are cropped."""
    bx0, bt, bx1, bb = _box_cols(box) if of is None else unbounded(box, of)
    return (
        df.where(overlaps(box) if of is None else ~of | overlaps(box))
        .withColumn("x0", F.greatest("x0", bx0))
        .withColumn("x1", F.least("x1", bx1))
        .withColumn("top", F.greatest("top", bt))
        .withColumn("bottom", F.least("bottom", bb))
    )


def within_bbox(df: DataFrame, box=CROP_BOX) -> DataFrame:
    """Keep only the objects wholly inside ``box``."""
    return df.where(inside(box))


def box_fits(box, width="width", height="height") -> Column:
    bx0, bt, bx1, bb = _box_cols(box)
    return (bx0 >= 0) & (bt >= 0) & (bx1 <= F.col(width)) & (bb <= F.col(height))


def crop_or_whole(words: DataFrame, pages: DataFrame, box=CROP_BOX, doc_key: str = "doc_id") -> DataFrame:
    """Crop every page of a document when the box fits all its pages, else keep it whole."""
    fit = pages.groupBy(doc_key).agg(F.min(box_fits(box)).alias("cropped"))
    w = words.join(fit, doc_key)
    bx0, bt, bx1, bb = _box_cols(box)
    c = F.col("cropped")
    return w.where(~c | overlaps(box)).select(
        *[x for x in words.columns if x not in ("x0", "x1", "top", "bottom")],
        F.when(c, F.greatest("x0", bx0)).otherwise(F.col("x0")).alias("x0"),
        F.when(c, F.least("x1", bx1)).otherwise(F.col("x1")).alias("x1"),
        F.when(c, F.greatest("top", bt)).otherwise(F.col("top")).alias("top"),
        F.when(c, F.least("bottom", bb)).otherwise(F.col("bottom")).alias("bottom"),
        "cropped",
    )


def rescale_pages(words: DataFrame, pages: DataFrame, target=A3, keys=PAGE_KEYS) -> DataFrame:
    """Draw each page on a target page (A3), no margins, aspect kept: scale by the smaller ratio."""
    k = list(keys)
    tw, th = target
    s = F.least(F.lit(float(tw)) / F.col("width"), F.lit(float(th)) / F.col("height"))
    j = words.join(pages.select(*k, "width", "height"), k).withColumn("scale", s)
    return j.select(
        *[c for c in words.columns if c not in ("x0", "x1", "top", "bottom")],
        *[(F.col(c) * F.col("scale")).alias(c) for c in ("x0", "x1", "top", "bottom")],
        "scale",
    )


def x_histogram(words: DataFrame, bin_width: float = 2, keys=PAGE_KEYS) -> DataFrame:
    """Word count per x0 bin ``floor(x0 / w) * w`` per page."""
    b = (F.floor(F.col("x0") / F.lit(bin_width)) * F.lit(bin_width)).cast("long")
    return words.groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


# fixed values: the layout report sentences
MULTI_REPORT = "Page {}: Detected a multi-column layout {}."
SINGLE_REPORT = "Page {}: Single-column layout detected. {}"


def _fmt(template: str, a: Column, b: Column) -> Column:
    p0, p1, p2 = template.split("{}")
    return F.concat(F.lit(p0), a.cast("string"), F.lit(p1), b.cast("string"), F.lit(p2))


def detect_columns(words: DataFrame, pages: DataFrame, bin_width: float = 2, threshold: int = 50, keys=PAGE_KEYS) -> DataFrame:
    """D3: bins holding more than ``threshold`` words are clusters; more than one = multi-column.
    Pages without words are reported with 0 clusters (1-based page numbers)."""
    k = list(keys)
    h = x_histogram(words, bin_width, keys)
    per_page = h.groupBy(*k).agg(F.count(F.when(F.col("n") > threshold, 1)).alias("n_clusters"))
    j = pages.select(*k).join(per_page, k, "left").withColumn("n_clusters", F.coalesce("n_clusters", F.lit(0)).cast("long"))
    pn = F.col("page") + 1
    multi = F.col("n_clusters") > 1
    return j.select(
        *[c for c in k if c != "page"],
        pn.alias("page_number"),
        "n_clusters",
        multi.alias("multi_column"),
        F.when(multi, _fmt(MULTI_REPORT, pn, F.col("n_clusters"))).otherwise(_fmt(SINGLE_REPORT, pn, F.col("n_clusters"))).alias("report"),
    )


def assign_lines(words: DataFrame, y_tol: float = 3, keys=PAGE_KEYS) -> DataFrame:
    """Words whose tops are within ``y_tol`` of the previous top (sorted) share a line.

    The running count of line starts uses a RANGE frame over ``top``, so words
    with equal tops always land on the same line whatever their tie order.
    """
    k = list(keys)
    w = Window.partitionBy(*k).orderBy("top")
    prev = F.lag("top").over(w)
    new = F.when(prev.isNull() | ((F.col("top") - prev) > y_tol), 1).otherwise(0)
    upto = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return words.withColumn("_new", new).withColumn("line_no", (F.sum("_new").over(upto) - 1).cast("long")).drop("_new")


def page_lines(words: DataFrame, y_tol: float = 3, keys=PAGE_KEYS, by=None) -> DataFrame:
    """E5: text lines — words of a line ordered by x0, joined with ' '.  ``by`` (some of ``keys``): what the words are
    partitioned by, for callers that go on with coarser groups; words that come partitioned by some of ``keys`` stay where they are."""
    k = list(keys)
    lw = assign_lines(words.repartition(*by) if by else words, y_tol, keys)
    g = lw.groupBy(*k, "line_no").agg(F.sort_array(F.collect_list(F.struct("x0", "word_no", "word"))).alias("_ws"))
    return g.select(*k, "line_no", F.array_join(F.transform("_ws", lambda x: x["word"]), " ").alias("line"))


def page_text(words: DataFrame, y_tol: float = 3, keys=PAGE_KEYS) -> DataFrame:
    """E5: plain page text — lines joined with newlines."""
    k = list(keys)
    lines = page_lines(words, y_tol, keys)
    g = lines.groupBy(*k).agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("_ls"))
    return g.select(*k, F.array_join(F.transform("_ls", lambda x: x["line"]), "\n").alias("text"))


def split_columns(words: DataFrame, pages: DataFrame, keys=PAGE_KEYS) -> DataFrame:
    """H6: left-half text and right-half text; words across the middle are in neither."""
    k = list(keys)
    j = words.join(pages.select(*k, "width", "height"), k)
    half = F.col("width") / 2
    left = inside((F.lit(0.0), F.lit(0.0), half, F.col("height")))
    right = inside((half, F.lit(0.0), F.col("width"), F.col("height")))
    sided = j.withColumn("side", F.when(left, F.lit("left")).when(right, F.lit("right"))).where(F.col("side").isNotNull())
    t = page_text(sided.drop("width", "height"), keys=(*k, "side"))
    both = t.groupBy(*k).agg(
        F.max(F.when(F.col("side") == "left", F.col("text"))).alias("left_text"),
        F.max(F.when(F.col("side") == "right", F.col("text"))).alias("right_text"),
    )
    return pages.select(*k).join(both, k, "left").select(
        *k, F.coalesce("left_text", F.lit("")).alias("left_text"), F.coalesce("right_text", F.lit("")).alias("right_text")
    )


def text_around_tables(words: DataFrame, boxes: DataFrame, pages: DataFrame, keys=PAGE_KEYS) -> DataFrame:
    """H4: for every table box, the page text above it and the page text below it.

    ``boxes(<keys>, table_no, x0, top, x1, bottom)``.  Words pair with the tables
    of their own page only (equi-join on the page key); a word is in the text above or
    below every table of its page, so the pairs are the size of the output.
    """
    k = list(keys)
    boxes = stored(boxes.select(*k, "table_no", "top", "bottom"), "table-boxes")
    b = boxes.select(*k, "table_no", F.col("top").alias("_bt"), F.col("bottom").alias("_bb")).join(pages.select(*k, "width", "height"), k, "left")
    above = inside((F.lit(0.0), F.lit(0.0), F.col("width"), F.col("_bt")))
    below = inside((F.lit(0.0), F.col("_bb"), F.col("width"), F.col("height")))
    # a table without such words keeps a row without a word, so its text need not be joined to it
    j = _joined(b, words, k, above | below).withColumn("part", F.when(above, F.lit("above")).when(below, F.lit("below")))
    t = page_text(j.select(*k, "table_no", "part", "word_no", "word", "x0", "x1", "top", "bottom"), keys=(*k, "table_no", "part"))
    agg = t.groupBy(*k, "table_no").agg(
        F.max(F.when(F.col("part") == "above", F.col("text"))).alias("above"),
        F.max(F.when(F.col("part") == "below", F.col("text"))).alias("below"),
    )
    return agg.select(*k, "table_no", F.coalesce("above", F.lit("")).alias("above"), F.coalesce("below", F.lit("")).alias("below"))


def _joined(areas: DataFrame, words: DataFrame, k: list[str], where: Column) -> DataFrame:
    """The areas of a page with their words, an area without any once.  Joined by page alone: words that lie by page stay."""
    same = [F.col(f"a.{c}") == F.col(f"w.{c}") for c in k]
    both = areas.alias("a").join(words.alias("w"), reduce(lambda a, b: a & b, [*same, where]), "left")
    return both.select("a.*", *[F.col(f"w.{c}") for c in words.columns if c not in k])


def text_between_tables(words: DataFrame, boxes: DataFrame, pages: DataFrame, keys=PAGE_KEYS) -> DataFrame:
    """H5: text above the first table, between consecutive tables, below the last,
    joined with newlines (a band without text counts as '')."""
    k = list(keys)
    b = boxes.select(*k, "table_no", "top", "bottom").join(pages.select(*k, "width", "height"), k)
    w = Window.partitionBy(*k).orderBy("top", "table_no")
    b = (
        b.withColumn("_i", F.row_number().over(w) - 1)
        .withColumn("_prev_bottom", F.max("bottom").over(w.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_end", F.max("bottom").over(Window.partitionBy(*k)))
        .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*k)))
    )
    # band i lies above table i (below table i-1); band n lies below the last table
    above = b.select(*k, F.col("_i").alias("band"), F.coalesce("_prev_bottom", F.lit(0.0)).alias("lo"), F.col("top").alias("hi"), "width")
    last = b.where(F.col("_i") == F.col("_n") - 1).select(
        *k, F.col("_n").alias("band"), F.col("_end").alias("lo"), F.col("height").alias("hi"), "width"
    )
    bands = stored(above.unionByName(last), "bands")
    here = inside((F.lit(0.0), F.col("lo"), F.col("width"), F.col("hi")))
    j = _joined(bands, words, k, here)
    t = page_text(j.select(*k, "band", "word_no", "word", "x0", "x1", "top", "bottom"), keys=(*k, "band"))
    g = t.groupBy(*k).agg(F.sort_array(F.collect_list(F.struct("band", "text"))).alias("_bs"))
    return g.select(*k, F.array_join(F.transform("_bs", lambda x: x["text"]), "\n").alias("full_text"))


def _clusters(df: DataFrame, part_cols: list[str], value: str, tol: float) -> DataFrame:
    """Gaps-and-islands: sorted values within ``tol`` of the previous one share a cluster
    (RANGE frame, so equal values always share one)."""
    w = Window.partitionBy(*part_cols).orderBy(value)
    prev = F.lag(value).over(w)
    new = F.when(prev.isNull() | ((F.col(value) - prev) > tol), 1).otherwise(0)
    upto = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("_new", new).withColumn("cluster", F.sum("_new").over(upto)).drop("_new")


def edges_from_words(words: DataFrame, x_tol: float = 3, y_tol: float = 3, min_words_vertical: int = 3, min_words_horizontal: int = 1, keys=PAGE_KEYS) -> DataFrame:
    """H7 ('text' strategy): vertical rules where at least ``min_words_vertical`` words
    align on x0, x1 or their centre; horizontal rules on the tops shared by at
    least ``min_words_horizontal`` words.

    Words of one place are counted before the places are sorted."""
    k = list(keys)
    anchors = F.explode(
        F.array(
            F.struct(F.lit("x0").alias("anchor"), F.col("x0").alias("v")),
            F.struct(F.lit("x1").alias("anchor"), F.col("x1").alias("v")),
            F.struct(F.lit("center").alias("anchor"), ((F.col("x0") + F.col("x1")) / 2).alias("v")),
        )
    )
    a = words.select(*k, "top", "bottom", anchors.alias("_a")).select(*k, "top", "bottom", "_a.anchor", "_a.v")
    a = a.groupBy(*k, "anchor", "v").agg(F.count(F.lit(1)).alias("n"), F.min("top").alias("lo"), F.max("bottom").alias("hi"))
    vc = _clusters(a, [*k, "anchor"], "v", x_tol)
    vert = (
        vc.groupBy(*k, "anchor", "cluster")
        .agg(F.sum("n").alias("n"), F.min("v").alias("pos"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .where(F.col("n") >= min_words_vertical)
        .select(*k, F.lit("v").alias("orient"), "anchor", "pos", "lo", "hi")
    )
    tops = words.groupBy(*k, "top").agg(F.count(F.lit(1)).alias("n"), F.min("x0").alias("lo"), F.max("x1").alias("hi"))
    hc = _clusters(tops, k, "top", y_tol)
    hor = (
        hc.groupBy(*k, "cluster")
        .agg(F.sum("n").alias("n"), F.min("top").alias("pos"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .where(F.col("n") >= min_words_horizontal)
        .select(*k, F.lit("h").alias("orient"), F.lit("top").alias("anchor"), "pos", "lo", "hi")
    )
    return vert.unionByName(hor)
