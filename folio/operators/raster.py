"""Image operators as table operators over ``pixels(image_id, y, x, v)``.

All arithmetic is integer.  Kernels run on scan lines (one row per image
line, an array of values): the x pass is a built-in ``transform`` over the
reflected neighbours (border 'reflect 101': -1 -> 1, n -> n-2), the y pass
sends each line to the few target lines it feeds and sums them with
``aggregate``, so a pass shuffles each value about kernel-height times and
never joins pixel rows.  Kernels may be larger than the image.  Dilation is a moving maximum of running maxima
over blocks, so its work does not grow with the radius.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.operators.contours import line_contours
from folio.operators.numbering import ordinal

IMG = "image_id"
# fixed values: BT.601 luma weights (x1000), the sharpening mask, binomial weights
GRAY_WEIGHTS = {"r": 299, "g": 587, "b": 114}
SHARPEN = [[-1, -1, -1], [-1, 10, -1], [-1, -1, -1]]


def binomial(n: int) -> list[int]:
    """Row n-1 of Pascal's triangle: the integer Gaussian kernel of size n (sum 2**(n-1))."""
    row = [1]
    for _ in range(n - 1):
        row = [a + b for a, b in zip([0, *row], [*row, 0])]
    return row


def image_dims(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy(IMG).agg((F.max("y") + 1).alias("_h"), (F.max("x") + 1).alias("_w"))


def reflect101(i: Column, n: Column) -> Column:
    """Index of the reflected neighbour: the line mirrored at its ends, again and again (period 2(n-1)); 0 if n is 1."""
    period = 2 * (n - 1)
    m = F.pmod(i, F.greatest(period, F.lit(1)))
    return F.when(n == 1, F.lit(0)).when(m < n, m).otherwise(period - m)


def to_gray(planes: DataFrame, channel: str = "channel") -> DataFrame:
    """K1: ``(image_id, channel 'b'|'g'|'r', y, x, v)`` -> gray ``(299R + 587G + 114B + 500) div 1000``;
    pixels missing a channel are dropped."""
    parts = [F.max(F.when(F.col(channel) == c, F.col("v"))).alias(f"_{c}") for c in GRAY_WEIGHTS]
    g = planes.groupBy(IMG, "y", "x").agg(*parts)
    total = sum((F.col(f"_{c}") * w for c, w in GRAY_WEIGHTS.items()), F.lit(500))  # null if a channel is missing
    return g.where(total.isNotNull()).select(IMG, "y", "x", (total / 1000).cast("long").cast("int").alias("v"))


def plane_lines(planes: DataFrame, channel: str = "channel") -> DataFrame:
    """Colour planes as scan lines ``(image_id, channel, y, line, _h)`` (images are dense)."""
    lines = planes.groupBy(IMG, F.col(channel).alias("channel"), "y").agg(F.sort_array(F.collect_list(F.struct("x", "v"))).alias("_l"))
    lines = lines.select(IMG, "channel", "y", F.transform("_l", lambda p: p["v"].cast("long")).alias("line"))
    return lines.withColumn("_h", (F.max("y").over(Window.partitionBy(IMG)) + 1).cast("int"))


def gray_lines(lines: DataFrame) -> DataFrame:
    """K1 on scan lines: ``(image_id, channel, y, line, _h)`` -> ``(image_id, y, line, _h)``; a line that lacks a channel, or
    whose channels differ in length, is dropped."""
    of = {c: F.max(F.when(F.col("channel") == c, F.col("line"))).alias(f"_{c}") for c in GRAY_WEIGHTS}
    g = lines.groupBy(IMG, "y").agg(*of.values(), F.max("_h").alias("_h"))
    same = (F.size("_r") == F.size("_g")) & (F.size("_g") == F.size("_b"))
    rgb = F.arrays_zip("_r", "_g", "_b")
    total = lambda p: ((p["_r"] * GRAY_WEIGHTS["r"] + p["_g"] * GRAY_WEIGHTS["g"] + p["_b"] * GRAY_WEIGHTS["b"] + 500) / 1000).cast("long")
    return g.where(F.col("_r").isNotNull() & F.col("_g").isNotNull() & F.col("_b").isNotNull() & same).select(IMG, "y", F.transform(rgb, total).alias("line"), "_h")


def to_lines(pixels: DataFrame) -> DataFrame:
    """Scan lines ``(image_id, y, line ARRAY<BIGINT>, _h)``: one row per image line, values
    in x order (images are dense), plus the image height."""
    lines = pixels.groupBy(IMG, "y").agg(F.sort_array(F.collect_list(F.struct("x", "v"))).alias("_l"))
    lines = lines.select(IMG, "y", F.transform("_l", lambda p: p["v"].cast("long")).alias("line"))
    return lines.withColumn("_h", F.max("y").over(Window.partitionBy(IMG)) + 1)


def from_lines(lines: DataFrame, col: str = "line") -> DataFrame:
    return lines.select(IMG, "y", F.posexplode(col).alias("x", "v"))


def _xpass(line: Column, weights: list[int]) -> Column:
    """Weighted sum along a line at reflected neighbours: a built-in ``transform``."""
    r = len(weights) // 2
    n = F.size(line)

    def at(x, k):
        return F.element_at(line, reflect101(x + k, n) + 1)

    def out(x):
        terms = [at(x, i - r) * w for i, w in enumerate(weights) if w != 0]
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        return total

    return F.transform(F.sequence(F.lit(0), n - 1), out)


def _ypass(lines: DataFrame, rows: list[tuple[int, list[int]]], keep: str | None = None) -> DataFrame:
    """Combine lines across y: target line t sums, over kernel rows (dy, row weights), the
    x-pass of line reflect(t + dy).  Each source line is sent only to the target lines it
    feeds, so the shuffle carries kernel-height copies of each line and no pixel-level
    join.  ``keep`` names a column of the target line itself to carry along."""
    reach = max(abs(dy) for dy, _ in rows)
    own = (lambda dy: F.col(keep) if dy == 0 else F.lit(None)) if keep else (lambda dy: F.lit(None))
    entry = F.explode(
        F.array(*[F.struct(F.lit(dy).alias("dy"), _xpass(F.col("line"), w).alias("part"), own(dy).cast("array<bigint>").alias("own")) for dy, w in rows])
    )
    c = lines.select(IMG, "y", "_h", entry.alias("_e")).select(IMG, "y", "_h", "_e.dy", "_e.part", "_e.own")
    # t + dy is y or -y, some periods away: as many as the kernel can reach beyond the image
    period = 2 * (F.col("_h") - 1)
    turns = F.ceil((F.col("_h") + 2 * reach) / F.greatest(period, F.lit(1))).cast("int")
    at = F.transform(F.sequence(-turns, turns), lambda k: F.array(F.col("y") + k * period - F.col("dy"), -F.col("y") + k * period - F.col("dy")))
    inside = F.filter(F.array_distinct(F.flatten(at)), lambda t: (t >= 0) & (t < F.col("_h")))
    c = c.select(IMG, "_h", "part", "own", F.explode(F.when(F.col("_h") == 1, F.array(F.lit(0))).otherwise(inside)).alias("y"))
    g = c.groupBy(IMG, "y", "_h").agg(F.collect_list("part").alias("_parts"), F.first("own", ignorenulls=True).alias("_own"))
    width = F.size(F.element_at("_parts", 1))
    summed = F.transform(
        F.sequence(F.lit(0), width - 1),
        lambda x: F.aggregate("_parts", F.lit(0).cast("long"), lambda acc, p: acc + F.element_at(p, x + 1)),
    )
    return g.select(IMG, "y", summed.alias("line"), "_h", *([F.col("_own").alias(keep)] if keep else []))


def convolve(pixels: DataFrame, kernel: list[list[int]], clamp: bool = True) -> DataFrame:
    """K2: integer 2-D convolution (correlation), reflect-101 borders, saturated to 0..255."""
    r = len(kernel) // 2
    out = _ypass(to_lines(pixels), [(dy - r, list(kernel[dy])) for dy in range(len(kernel))])
    px = from_lines(out)
    v = F.greatest(F.lit(0), F.least(F.lit(255), F.col("v"))) if clamp else F.col("v")
    return px.select(IMG, "y", "x", v.cast("int").alias("v"))


def _weighted(lines: DataFrame, weights: list[int]) -> DataFrame:
    """Separable integer weighted sum (x pass, then y pass): scan lines with their sums ``_s`` beside them."""
    r = len(weights) // 2
    xs = lines.select(IMG, "y", "_h", F.col("line").alias("_v"), _xpass(F.col("line"), weights).alias("line"))
    both = _ypass(xs, [(i - r, [w]) for i, w in enumerate(weights)], keep="_v")
    return both.select(IMG, "y", "_h", F.col("_v").alias("line"), F.col("line").alias("_s"))


def _rounded(s: Column, total: int) -> Column:
    return ((s + total // 2) / total).cast("long")


def _blurred(lines: DataFrame, size: int) -> DataFrame:
    total = sum(binomial(size)) ** 2
    return _weighted(lines, binomial(size)).select(IMG, "y", "_h", F.transform("_s", lambda s: _rounded(s, total)).alias("line"))


def _thresholded(lines: DataFrame, block: int, c: int, maxval: int) -> DataFrame:
    total = sum(binomial(block)) ** 2
    dark = lambda v, s: F.when(v <= _rounded(s, total) - c, maxval).otherwise(0).cast("long")
    return _weighted(lines, binomial(block)).select(IMG, "y", "_h", F.zip_with("line", "_s", dark).alias("line"))


def _pixels(lines: DataFrame) -> DataFrame:
    return from_lines(lines).select(IMG, "y", F.col("x").cast("int").alias("x"), F.col("v").cast("int").alias("v"))


def blur(pixels: DataFrame, size: int = 9) -> DataFrame:
    """K3: Gaussian blur with the binomial kernel of ``size``, rounded half up."""
    return _pixels(_blurred(to_lines(pixels), size))


def adaptive_threshold(pixels: DataFrame, block: int = 11, c: int = 30, maxval: int = 255) -> DataFrame:
    """K4 (inverse, Gaussian): ``maxval`` where v <= round(local weighted mean) - c, else 0."""
    return _pixels(_thresholded(to_lines(pixels), block, c, maxval))


LEAST = -(1 << 62)  # below every value: what lies outside an image
HELD_CELLS = 1 << 22  # pixels of blocks that are worked on together, one block at least


def moving_max(m: np.ndarray, r: int) -> np.ndarray:
    """The maximum over 2r + 1 neighbours along the last axis, with as much work for any radius: of the blocks of 2r + 1
    values that a span touches, the running maximum from its start to the first's end, and from the second's start to its end."""
    n, k = m.shape[-1], 2 * r + 1
    padded = np.full((*m.shape[:-1], -(-(n + 2 * r) // k) * k), LEAST, np.int64)
    padded[..., r : r + n] = m
    blocks = padded.reshape(*m.shape[:-1], -1, k)
    ahead = np.maximum.accumulate(blocks, -1).reshape(padded.shape)
    behind = np.maximum.accumulate(blocks[..., ::-1], -1)[..., ::-1].reshape(padded.shape)
    return np.maximum(behind[..., :n], ahead[..., 2 * r : 2 * r + n])


def _block_maxima(batches, r: int):
    """The lines of blocks (image, block, _h, lines: list of (y, line)) -> their running maxima, as (image, y, part).

    Blocks of one width are worked on together, as [block, line, x]."""
    k = 2 * r + 1
    for b in batches:
        lists = b.column("lines")
        group = np.repeat(np.arange(b.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        y, line = pc.struct_field(lists.flatten(), "y").to_numpy(), pc.struct_field(lists.flatten(), "line")
        width = pc.list_value_length(line).to_numpy(zero_copy_only=False)
        flat, ends = line.flatten().to_numpy(zero_copy_only=True), np.cumsum(width)
        wide = np.zeros(b.num_rows, np.int64)
        wide[group] = width
        if (wide[group] != width).any():
            raise ValueError("the lines of an image differ in length")
        at, height = b.column("_block").to_numpy() * k, b.column("_h").to_numpy()
        for w in np.unique(wide):
            alike = np.flatnonzero(wide == w)
            step = max(1, HELD_CELLS // (k * max(1, int(w))))
            for some in (alike[i : i + step] for i in range(0, len(alike), step)):
                mine = np.flatnonzero((group >= some[0]) & (group <= some[-1]) & (wide[group] == w))
                place = np.searchsorted(some, group[mine])
                m = np.full((len(some), k, w), LEAST, np.int64)
                m[place, y[mine] - at[group[mine]]] = moving_max(flat[(ends[mine] - w)[:, None] + np.arange(w)], r)
                ahead, behind = np.maximum.accumulate(m, 1), np.maximum.accumulate(m[:, ::-1], 1)[:, ::-1]
                target = at[some][:, None] + np.concatenate([np.arange(k) - r, np.arange(k) + r])
                inside = (target >= 0) & (target < height[some][:, None])
                out = np.concatenate([ahead, behind], 1)[inside]
                part = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * np.int32(w)), pa.array(out.ravel()))
                yield pa.RecordBatch.from_arrays([b.column(IMG).take(pa.array(some[np.nonzero(inside)[0]])), pa.array(target[inside]), part], names=[IMG, "y", "part"])


def _dilated(lines: DataFrame, size: int, iterations: int) -> DataFrame:
    """Moving maximum of scan lines, along the line and then over lines, whose work does not grow with the radius: a line goes
    once to its block of 2r + 1 lines, and from there as two running maxima to the two lines that end a span with it."""
    r = (size // 2) * iterations
    kind = lines.schema[IMG].dataType.simpleString()
    one = F.struct(F.col("y").cast("long").alias("y"), "line")
    blocks = lines.groupBy(IMG, F.floor(F.col("y") / (2 * r + 1)).alias("_block")).agg(F.max(F.col("_h").cast("long")).alias("_h"), F.collect_list(one).alias("lines"))
    parts = blocks.mapInArrow(lambda batches: _block_maxima(batches, r), f"{IMG} {kind}, y long, part array<bigint>")
    both = parts.groupBy(IMG, "y").agg(F.collect_list("part").alias("p"))  # two, at the image's ends one
    line = F.when(F.size("p") == 1, F.col("p")[0]).otherwise(F.zip_with(F.col("p")[0], F.col("p")[1], lambda a, b: F.greatest(a, b)))
    return both.select(IMG, F.col("y").cast("int").alias("y"), line.alias("line"))


def dilate(pixels: DataFrame, size: int = 9, iterations: int = 4) -> DataFrame:
    """Rectangular dilation = moving maximum of radius ``(size // 2) * iterations``
    along x then along y (pixels outside the image do not count)."""
    return _pixels(_dilated(to_lines(pixels), size, iterations))


def regions(mask: DataFrame, min_v: int = 1) -> DataFrame:
    """K6: 8-connected foreground regions (v >= ``min_v``) with their boxes.

    Returns ``(image_id, x, y, w, h, area)``: area counts pixels; the box is in
    pixels.  The foreground is shuffled once by image and sorted inside each
    partition; each Arrow batch of whole images is labelled by one vectorised
    union-find (``mapInPandas``).  An image is bounded by its resolution.
    """
    fg = mask.where(F.col("v") >= min_v).select(IMG, F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"))
    fg = fg.repartition(IMG).sortWithinPartitions(IMG, "y", "x")
    id_type = mask.schema[IMG].dataType
    schema = T.StructType(
        [T.StructField(IMG, id_type)]
        + [T.StructField(c, T.IntegerType()) for c in ("x", "y", "w", "h")]
        + [T.StructField("area", T.LongType())]
    )
    return fg.mapInPandas(_regions_of_images, schema)


def _regions_of_images(batches):
    import numpy as np
    import pandas as pd

    from folio.operators.components import union_find, whole_groups

    for pdf in whole_groups(batches, [IMG]):
        img = pdf.groupby(IMG, sort=False).ngroup().to_numpy().astype(np.int64)
        y = pdf["y"].to_numpy()
        x = pdf["x"].to_numpy()
        span = int(x.max()) + 3
        rows = int(y.max()) + 3
        key = (img * rows + (y + 1)) * span + (x + 1)
        order = np.argsort(key, kind="mergesort")
        skey = key[order]
        a_list, b_list = [], []
        for dy, dx in ((0, 1), (1, -1), (1, 0), (1, 1)):
            nk = key + dy * span + dx
            pos = np.minimum(np.searchsorted(skey, nk), len(skey) - 1)
            hit = skey[pos] == nk
            a_list.append(np.nonzero(hit)[0])
            b_list.append(order[pos[hit]])
        lab = union_find(len(pdf), np.concatenate(a_list), np.concatenate(b_list))
        g = pd.DataFrame({IMG: pdf[IMG].to_numpy(), "lab": lab, "y": y, "x": x}).groupby([IMG, "lab"], sort=False)
        out = g.agg(x=("x", "min"), y=("y", "min"), x1=("x", "max"), y1=("y", "max"), area=("x", "size")).reset_index()
        yield pd.DataFrame(
            {
                IMG: out[IMG],
                "x": out["x"].astype("int32"),
                "y": out["y"].astype("int32"),
                "w": (out["x1"] - out["x"] + 1).astype("int32"),
                "h": (out["y1"] - out["y"] + 1).astype("int32"),
                "area": out["area"].astype("int64"),
            }
        )


def filter_regions(df: DataFrame, min_area: float = 10000, max_h_ratio: float = 0.3, img_h: str | Column = "img_h") -> DataFrame:
    """Keep wide, not-too-tall, large regions: area > min_area, w > h, h < ratio * image height."""
    ih = F.col(img_h) if isinstance(img_h, str) else img_h
    return df.where((F.col("area") > min_area) & (F.col("w") > F.col("h")) & (F.col("h") < F.lit(max_h_ratio) * ih))


def number_regions(df: DataFrame, min_area: float = 10000, max_h_ratio: float = 0.3, img_h: str | Column = "img_h") -> DataFrame:
    """K7: number the kept regions of each image from 0, top to bottom then left to right,
    and name their crops ``ROI_{n}.jpg`` (duplicate boxes count once).

    Numbered with ``ordinal`` (range-partitioned), so an image holding a third
    of all regions is numbered by many tasks."""
    kept = filter_regions(df, min_area, max_h_ratio, img_h).select(IMG, "x", "y", "w", "h", "area").distinct()
    n = ordinal(kept, [IMG], ["y", "x", "w", "h"], name="roi")
    return n.withColumn("name", F.concat(F.lit("ROI_"), F.col("roi").cast("string"), F.lit(".jpg")))


def region_count(df: DataFrame) -> DataFrame:
    """Number of regions per image."""
    return df.groupBy(IMG).agg(F.count(F.lit(1)).alias("n_regions"))


def region_pixels(pixels: DataFrame, regions_df: DataFrame, region_cols: tuple[str, ...] = ()) -> DataFrame:
    """The pixels of each region ``image[y:y+h, x:x+w]`` (clipped to the image).

    Each region lists its own pixel coordinates, which are then equi-joined to
    the pixels — no range join, no broadcast of the region table."""
    keep = list(region_cols)
    r = regions_df.select(IMG, *keep, F.col("x").alias("_rx"), F.col("y").alias("_ry"), "w", "h")
    r = r.where((F.col("w") > 0) & (F.col("h") > 0))
    r = r.select(IMG, *keep, "_rx", "_ry", "w", F.explode(F.sequence(F.col("_ry"), F.col("_ry") + F.col("h") - 1)).alias("y"))
    r = r.select(IMG, *keep, "_rx", "_ry", "y", F.explode(F.sequence(F.col("_rx"), F.col("_rx") + F.col("w") - 1)).alias("x"))
    j = r.join(pixels.select(IMG, "y", "x", "v"), [IMG, "y", "x"])
    return j.select(IMG, *keep, (F.col("y") - F.col("_ry")).alias("ry"), (F.col("x") - F.col("_rx")).alias("rx"), "v")


def preprocess(planes: DataFrame) -> DataFrame:
    """K9: gray, then sharpen (the resize step uses factor 1, the identity)."""
    return convolve(to_gray(planes), SHARPEN)


def find_text_regions(
    planes: DataFrame,
    blur_size: int = 9,
    block: int = 11,
    c: int = 30,
    dilate_size: int = 9,
    iterations: int = 4,
    min_area: float = 10000,
    max_h_ratio: float = 0.3,
) -> DataFrame:
    """K8: gray -> blur -> inverse adaptive threshold -> dilate -> contours (outer ones and holes) -> keep -> number.

    ``planes``: pixels of colour planes, or their scan lines (`plane_lines`, `sources.files.read_image_lines`).  ``area`` is that
    of the contour's polygon, which the least area is compared with."""
    lines = planes if "line" in planes.columns else plane_lines(planes)
    gray = gray_lines(lines)
    # scan lines from the reader to the contours: no row for a pixel on the way
    reg = line_contours(_dilated(_thresholded(_blurred(gray, blur_size), block, c, 255), dilate_size, iterations)).select(IMG, "x", "y", "w", "h", "area")
    heights = lines.groupBy(IMG).agg(F.max("_h").alias("img_h"))
    return number_regions(reg.join(heights, IMG), min_area, max_h_ratio)
