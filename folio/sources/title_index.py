"""A corpus laid out by title (S3, D8, A7): files ranged and sorted by title, found by their title ranges.

Each file holds a range of (title, page); what titles it holds is one row of a
small table beside the files.  A lookup takes the files whose range holds the
title and opens only these; inside, row groups are skipped by Parquet's
statistics and Bloom filters on the title.  A title of very many pages
spans several files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.operators.assemble import nth_pages
from folio.sources.corpus_io import DOCS_SCHEMA
from folio.sources.snapshots import Snapshots

RANGES = "file string, first_title string, last_title string, untitled long"


def write_by_title(docs: DataFrame, path: str, files: int | None = None) -> int:
    """Write page documents as a new snapshot of about ``files`` files (default: a shuffle's partitions); its number."""
    spark = docs.sparkSession
    snapshots = Snapshots(spark, path)
    last = snapshots.read()
    number = 0 if last is None else last[0] + 1
    folder, ranges = snapshots.folder("by_title", number), snapshots.folder("ranges", number)
    order = [F.col("title").asc_nulls_first(), F.col("page")]
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(*DOCS_SCHEMA.fieldNames()).repartitionByRange(n, *order).sortWithinPartitions(*order)
    rows.write.option("parquet.bloom.filter.enabled#title", "true").parquet(f"{snapshots.root}/{folder}")
    back = spark.read.schema(DOCS_SCHEMA).parquet(f"{snapshots.root}/{folder}").select("title", F.col("_metadata.file_name").alias("file"))
    held = back.groupBy("file").agg(F.min("title").alias("first_title"), F.max("title").alias("last_title"), F.count_if(F.col("title").isNull()).alias("untitled"))
    held.coalesce(1).write.parquet(f"{snapshots.root}/{ranges}")  # a row a file
    snapshots.commit(number, {"by_title": folder, "ranges": ranges})
    return number


def read_titles(spark: SparkSession, path: str, titles: list[str | None], snapshot: int | None = None) -> DataFrame:
    """The page documents of some titles (None: those without one); only the files that may hold them are read."""
    snapshots = Snapshots(spark, path)
    found = snapshots.read(snapshot)
    if found is None:
        raise ValueError(f"{path} holds no corpus")
    named = sorted({t for t in titles if t is not None})
    inside = F.exists(F.array(*map(F.lit, named)), lambda t: (t >= F.col("first_title")) & (t <= F.col("last_title"))) if named else F.lit(False)
    may = inside | (F.col("untitled") > 0) if None in titles else inside
    files = [r[0] for r in spark.read.schema(RANGES).parquet(f"{snapshots.root}/{found[1]['ranges']}").where(may).select("file").collect()]
    if not files:
        return spark.createDataFrame([], DOCS_SCHEMA)
    rows = spark.read.schema(DOCS_SCHEMA).parquet(*[f"{snapshots.root}/{found[1]['by_title']}/{f}" for f in sorted(files)])
    wanted = F.col("title").isin(named) if named else F.lit(False)
    return rows.where(wanted | F.col("title").isNull() if None in titles else wanted)


def read_title_page(spark: SparkSession, path: str, title: str | None, n: int, snapshot: int | None = None) -> DataFrame:
    """S3: the n-th page document (0-based list position) of a title."""
    return nth_pages(read_titles(spark, path, [title], snapshot), n)


def expire_by_title(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Keep the newest ``keep`` snapshots; delete older ones, and what writes that died left behind."""
    Snapshots(spark, path).expire(["by_title", "ranges"], lambda m: [m["by_title"], m["ranges"]], keep)
