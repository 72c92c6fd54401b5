"""File sources: listings, page images, and the decoder seam.

Listings use Spark's ``binaryFile`` source with only ``path``, ``length`` and
``modificationTime`` selected, so file contents are never read (the scan's
ReadSchema has no ``content``).  Decoders are plugged in with ``decode``: the
listing is read with contents, spread over the cluster, and each file is
turned into rows by a user function inside ``mapInPandas``; a file that fails
to decode becomes a row of the errors output instead of failing the job.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def list_files(spark: SparkSession, root: str, suffix: str | None = None, recursive: bool = True) -> DataFrame:
    """A1/A2: every file under ``root`` (recursively, or only directly inside it),
    optionally only names ending in ``suffix``: ``(path, length, modified)``."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if suffix:
        r = r.option("pathGlobFilter", f"*{suffix}")
    df = r.load(root).select("path", "length", F.col("modificationTime").alias("modified"))
    return df


def read_images(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """A5: decode every image under ``root`` with Spark's image source into colour planes
    ``(image_id = file path, channel 'b'|'g'|'r', y, x, v)``; a gray image has the same
    values in all three, as colour readers give it.  Files that hold no readable image are
    not here but in ``unreadable_images``.

    Spark decodes the files; numpy only re-shapes each decoded byte buffer
    into rows, one image channel per output batch, inside ``mapInPandas``."""
    imgs = _images(spark, root, recursive).where(F.col("image.nChannels") > 0).select(
        F.col("image.origin").alias("image_id"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("n_channels"),
        F.col("image.data").alias("data"),
    )
    schema = "image_id string, channel string, y int, x int, v int"
    return imgs.mapInPandas(_image_rows, schema)


def read_image_lines(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """A5 as scan lines ``(image_id, channel, y, line, _h)``: one row a line and channel instead of one a pixel, and the
    image's height beside it, so that what follows need not collect pixels."""
    imgs = _images(spark, root, recursive).where(F.col("image.nChannels") > 0).select(
        F.col("image.origin").alias("image_id"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("n_channels"),
        F.col("image.data").alias("data"),
    )
    return imgs.mapInPandas(_image_lines, "image_id string, channel string, y int, line array<bigint>, _h int")


def _image_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import numpy as np

    for b in batches:
        for row in b.itertuples(index=False):
            h, w, c = int(row.height), int(row.width), int(row.n_channels)
            arr = np.frombuffer(row.data, dtype=np.uint8).reshape(h, w, c)
            for i, name in enumerate("bgr"):
                plane = arr[:, :, i if c >= 3 else 0].astype("int64")
                yield pd.DataFrame({"image_id": row.image_id, "channel": name, "y": np.arange(h, dtype="int32"), "line": list(plane), "_h": h})


def unreadable_images(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """A5: ``(path, error)`` of the files under ``root`` that Spark's image source can't decode."""
    bad = _images(spark, root, recursive).where(F.coalesce(F.col("image.nChannels"), F.lit(-1)) <= 0)
    return bad.select(F.col("image.origin").alias("path"), F.lit("not a readable image").alias("error"))


def _images(spark: SparkSession, root: str, recursive: bool) -> DataFrame:
    return spark.read.format("image").option("recursiveFileLookup", str(recursive).lower()).option("dropInvalid", "false").load(root)


def _image_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import numpy as np

    for b in batches:
        for row in b.itertuples(index=False):
            h, w, c = int(row.height), int(row.width), int(row.n_channels)
            arr = np.frombuffer(row.data, dtype=np.uint8).reshape(h, w, c)
            ys, xs = np.divmod(np.arange(h * w, dtype="int32"), np.int32(w))
            for i, name in enumerate("bgr"):
                plane = arr[:, :, i if c >= 3 else 0].ravel().astype("int32")
                yield pd.DataFrame({"image_id": row.image_id, "channel": name, "y": ys, "x": xs, "v": plane})


DECODE_STATUS = [T.StructField("path", T.StringType()), T.StructField("error", T.StringType())]


def decode(
    spark: SparkSession,
    root: str,
    fn: Callable[[str, bytes], Iterable[dict]],
    schema: T.StructType,
    suffix: str | None = None,
    materialize: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Run a per-file decoder over every file under ``root``.

    ``fn(path, content)`` yields dicts matching ``schema``.  Returns
    ``(rows, errors)``: rows carry ``path`` plus the schema's fields; errors are
    ``(path, error)`` for files whose decoder raised, of which no row is kept.  With ``materialize`` the
    decoded table is checkpointed once (to ``spark.checkpoint.dir``), so reading
    both outputs does not run the decoders twice.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if suffix:
        r = r.option("pathGlobFilter", f"*{suffix}")
    src = r.load(root).select("path", "content")
    out_schema = T.StructType(DECODE_STATUS + [T.StructField(f.name, f.dataType, True) for f in schema.fields])
    cols = [f.name for f in schema.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"]):  # a file's rows are kept only if all of it decodes
                try:
                    out = [{"path": path, "error": None, **{c: rec.get(c) for c in cols}} for rec in fn(path, bytes(content))]
                except Exception as e:  # noqa: BLE001 - a bad file is data, not a job failure
                    out = [{"path": path, "error": f"{type(e).__name__}: {e}", **{c: None for c in cols}}]
                yield pd.DataFrame(out, columns=["path", "error", *cols])

    decoded = src.mapInPandas(run, out_schema)
    if materialize:
        from folio.session import checkpoint_dir

        checkpoint_dir(spark)
        decoded = decoded.checkpoint()
    rows = decoded.where(F.col("error").isNull()).drop("error")
    errors = decoded.where(F.col("error").isNotNull()).select("path", "error")
    return rows, errors


PAGE_TEXT_SCHEMA = T.StructType([T.StructField("page", T.IntegerType()), T.StructField("page_text", T.StringType())])


def form_feed_pages(path: str, content: bytes) -> Iterator[dict]:
    """Example decoder: UTF-8 text whose pages are separated by form feeds (the file's
    final line terminator is not part of the last page)."""
    text = content.decode("utf-8")
    if text.endswith("\n"):
        text = text[:-1]
    for i, t in enumerate(text.split("\f")):
        yield {"page": i, "page_text": t}


BUNDLE_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), *PAGE_TEXT_SCHEMA.fields])


def bundled_documents(path: str, content: bytes) -> Iterator[dict]:
    """Example decoder for files that hold many documents, one JSON object
    ``{"doc_id": ..., "pages": [...]}`` a line: a corpus of small documents in few files."""
    for line in content.decode("utf-8").splitlines():
        doc = json.loads(line)
        for i, t in enumerate(doc["pages"]):
            yield {"doc_id": doc["doc_id"], "page": i, "page_text": t}
