"""OCR results as tables.

``ocr_lines(<keys>, result_idx, line_no, txt, conf)``: one row per recognised
line; a result that recognised nothing is one row with null ``txt``.
``predictions(image_id, idx, word, box, img_w, img_h)``: one row per word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.functions import boxes as B
from folio.functions.text import clean_text
from folio.operators.numbering import ordinal

PAGE_KEYS = ("doc_id", "page")


def ocr_text(lines: DataFrame, keys=PAGE_KEYS) -> DataFrame:
    """Per key, the lines of the *last* result joined in order with ' ' ('' when none).

    The window and the aggregate share one hash partitioning on the keys.
    """
    k = list(keys)
    last = lines.withColumn("_last", F.max("result_idx").over(Window.partitionBy(*k))).where(
        F.col("result_idx") == F.col("_last")
    )
    agg = last.groupBy(*k).agg(F.sort_array(F.collect_list(F.struct("line_no", "txt"))).alias("_ls"))
    return agg.select(*k, F.array_join(F.transform("_ls", lambda l: l["txt"]), " ").alias("ocr_text"))


def ocr_batch(lines: DataFrame, folder_key: str = "doc_id", image_key: str = "page") -> DataFrame:
    """A folder of images -> its image texts, one row per image, numbered in image order.

    Rows, not one list: a folder may hold any number of images (``ordinal`` splits it)."""
    per_image = ocr_text(lines, (folder_key, image_key))
    return ordinal(per_image, [folder_key], [image_key], name="image_no")


def ocr_fallback(texts: DataFrame, ocr: DataFrame, keys=PAGE_KEYS, text_col: str = "text") -> DataFrame:
    """A page whose text is empty takes its OCR text ('' when OCR found nothing)."""
    k = list(keys)
    j = texts.join(ocr.select(*k, "ocr_text"), k, "left")
    return j.withColumn(
        text_col, F.when(F.length(text_col) == 0, F.coalesce("ocr_text", F.lit(""))).otherwise(F.col(text_col))
    ).drop("ocr_text")


def page_texts(pages: DataFrame, lines: DataFrame | None = None, keys=PAGE_KEYS, squeeze: bool = True) -> DataFrame:
    """Cleaned text layer per page, with the OCR fallback when OCR lines are given."""
    k = list(keys)
    t = pages.select(*k, clean_text("page_text", squeeze).alias("text"))
    return t if lines is None else ocr_fallback(t, ocr_text(lines, keys), keys)


def box_bounds(preds: DataFrame) -> DataFrame:
    """The smallest x and y of each 4-point box."""
    return preds.select("image_id", "idx", B.min_x("box").alias("min_x"), B.min_y("box").alias("min_y"))


def prediction_words(preds: DataFrame) -> DataFrame:
    """The recognised word of every prediction."""
    return preds.select("image_id", "idx", "word")


def flatten_boxes(preds: DataFrame) -> DataFrame:
    """Predictions of an image -> its boxes, one row per corner (box order kept)."""
    nth = F.row_number().over(Window.partitionBy("image_id").orderBy("idx", "word")) - 1
    return preds.withColumn("box_no", nth).select("image_id", "box_no", F.posexplode("box").alias("corner", "pt")).select(
        "image_id", "box_no", "corner", F.col("pt.x").alias("x"), F.col("pt.y").alias("y")
    )


def annotation_layout(preds: DataFrame) -> DataFrame:
    """Where each recognised word is written beside the image.

    Words sorted by the top of their box (stable: ties keep prediction order)
    go to the left margin when the box starts in the left half, else the
    right; the i-th of n on a side is written at height ``1 - i/n``; the arrow
    points at the box's first corner in axes fractions (y flipped).
    """
    side = F.when(B.min_x("box") < F.col("img_w") / 2, F.lit("left")).otherwise(F.lit("right"))
    p = preds.withColumn("side", side).withColumn("_miny", B.min_y("box"))
    w = Window.partitionBy("image_id", "side")
    p = p.withColumn("ann_index", F.row_number().over(w.orderBy("_miny", "idx")) - 1).withColumn(
        "n_side", F.count(F.lit(1)).over(w)
    )
    first = F.element_at("box", 1)
    return p.select(
        "image_id",
        "idx",
        "word",
        "side",
        F.col("ann_index").cast("long").alias("ann_index"),
        (1.0 - F.col("ann_index") / F.col("n_side")).alias("text_y"),
        F.when(F.col("side") == "left", F.lit(-0.05)).otherwise(F.lit(1.05)).alias("text_x"),
        (first["x"] / F.col("img_w")).alias("anchor_x"),
        (1.0 - first["y"] / F.col("img_h")).alias("anchor_y"),
        F.when(F.col("side") == "left", F.lit("right")).otherwise(F.lit("left")).alias("align"),
    )
