"""Sinks and readers for the corpus and region crops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.sources.snapshots import Snapshots

DOCS_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("page_content", T.StringType()),
        T.StructField("first_division", T.StringType()),
        T.StructField("second_division", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("file_path", T.StringType()),
    ]
)


def write_docs(docs: DataFrame, path: str, partition_by: tuple[str, ...] = ("first_division",), mode: str = "overwrite") -> int:
    """Persist the corpus as Parquet, partitioned by first division (readers prune on it), as a new snapshot; its number.

    The rows go to a new folder, and the snapshot is switched when all of them are
    written: readers see the one before until then, also if the write dies, and ``docs`` may be read
    from ``path`` itself.  ``mode``: "overwrite" replaces the corpus, "append" adds to it."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode {mode!r} is neither overwrite nor append")
    snapshots = Snapshots(docs.sparkSession, path)
    last = snapshots.read()
    number = 0 if last is None else last[0] + 1
    folder = snapshots.folder("docs", number)
    w = docs.select(*[f.name for f in DOCS_SCHEMA.fields]).write.mode("error")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{snapshots.root}/{folder}")
    snapshots.commit(number, {"folders": (last[1]["folders"] if last and mode == "append" else []) + [folder]})
    return number


def read_docs(spark: SparkSession, path: str, snapshot: int | None = None) -> DataFrame:
    """Load a corpus written by ``write_docs`` with its declared schema: its newest snapshot, or an older one that is still there."""
    snapshots = Snapshots(spark, path)
    found = snapshots.read(snapshot)
    if found is None:
        raise ValueError(f"{path} holds no corpus")
    folders = [f"{snapshots.root}/{f}" for f in found[1]["folders"]]
    return spark.read.schema(DOCS_SCHEMA).option("basePath", f"{snapshots.root}/docs").parquet(*folders).select(*[f.name for f in DOCS_SCHEMA.fields])


def expire_docs(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Keep the newest ``keep`` snapshots of a corpus; delete older ones, and what writes that died left behind."""
    Snapshots(spark, path).expire(["docs"], lambda manifest: manifest["folders"], keep)


def region_crops(region_pixels_df: DataFrame) -> DataFrame:
    """Region rows with their pixels as a row-major array (one region = one bounded group)."""
    return region_pixels_df.groupBy("image_id", "roi").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("ry", "rx", "v"))), lambda p: p["v"]).alias("pixels"),
        (F.max("ry") + 1).alias("h"),
        (F.max("rx") + 1).alias("w"),
    )


def write_regions(crops: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Persist cropped regions; each row is named ``ROI_{roi}.jpg`` as the reference names its files."""
    named = crops.withColumn("name", F.concat(F.lit("ROI_"), F.col("roi").cast("string"), F.lit(".jpg")))
    named.write.mode(mode).parquet(path)
