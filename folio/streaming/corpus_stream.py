"""L1: build the corpus incrementally from drops of decoded pages, and from changes of the listing.

A drop is Parquet with one row per decoded page:
``(path, listing_no, page, page_text, ocr_text, md, delivery)`` — ``ocr_text`` and
``md`` (the page's markdown table) may be null — and, where files can go, ``removed``:
a row with it is no page but says that the file is gone.  Each micro-batch is
merged into a `corpus_store.CorpusStore`, which keeps "later arrival wins" per title.

A file may be delivered again, with other pages; each delivery is a version of
the file, and a title shows one version of one file, whole.  ``delivery`` tells
versions apart: rows of a path with one delivery number belong together even if
they arrive in several micro-batches.  Where it is null, a path's rows of one
micro-batch are one delivery.  Order of arrival: the first batch of the version,
then the delivery number (a removal before a delivery without one), then listing
order.  When the file that holds a title goes, the title falls to the file that
arrived last of those still there, if any.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions.paths import DEFAULT_SEP, has_suffix, levels
from folio.functions.text import clean_text, title_line
from folio.streaming.corpus_store import BUCKETS, CorpusStore

DROP_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("listing_no", T.LongType()),
        T.StructField("page", T.IntegerType()),
        T.StructField("page_text", T.StringType()),
        T.StructField("ocr_text", T.StringType()),
        T.StructField("md", T.StringType()),
        T.StructField("delivery", T.LongType()),
    ]
)
# a drop that may also take files away
CHANGE_SCHEMA = T.StructType([*DROP_SCHEMA.fields, T.StructField("removed", T.BooleanType())])


def page_docs(drop: DataFrame, lang: str = "en", suffix: str | None = ".pdf", sep: str = DEFAULT_SEP) -> DataFrame:
    """Decoded pages of one drop -> page documents (G1), keyed by title and delivery; rows of removed files stay, marked."""
    removed = F.coalesce(F.col("removed"), F.lit(False)) if "removed" in drop.columns else F.lit(False)
    d = drop.withColumn("removed", removed).where(has_suffix("path", suffix))
    t = clean_text("page_text")
    lv = levels("path", sep)
    text = F.when(F.length(t) == 0, F.coalesce("ocr_text", F.lit(""))).otherwise(t)
    tail = F.when(F.col("md").isNotNull(), F.concat(F.lit("\n\n"), F.col("md"))).otherwise(F.lit(""))
    return d.select(
        lv["lv3"].alias("title"),
        "listing_no",
        "delivery",
        "page",
        F.concat(title_line(lv["lv3"], lang, "v3"), F.lit("\n"), text, tail).alias("page_content"),
        lv["lv1"].alias("first_division"),
        lv["lv2"].alias("second_division"),
        lv["lv3"].alias("file_name"),
        F.col("path").alias("file_path"),
        "removed",
    )


def change_drop(changes: DataFrame, decoded: DataFrame) -> DataFrame:
    """The drop that carries a change set (`folders.listing_changes`) to the stream: the decoded pages of
    added and changed files, and a row for each removed one.  ``decoded`` has the columns of ``DROP_SCHEMA``."""
    came = decoded.join(changes.where(F.col("change") != "removed").select("path"), "path", "left_semi")
    went = changes.where(F.col("change") == "removed").select("path", F.lit(True).alias("removed"))
    return came.select(*DROP_SCHEMA.fieldNames()).withColumn("removed", F.lit(False)).unionByName(went, allowMissingColumns=True)


def stream_corpus(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, lang: str = "en", max_files_per_trigger: int | None = None, buckets: int = BUCKETS):
    """Start the incremental build; returns the ``StreamingQuery`` (runs until the input is drained).

    ``buckets`` (when the corpus is new): what a merge rewrites is one bucket at least, so choose as many as make a
    bucket some hundred MB."""
    r = spark.readStream.schema(CHANGE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)

    def merge(batch: DataFrame, batch_id: int) -> None:
        CorpusStore(batch.sparkSession, out_dir, buckets).merge(page_docs(batch, lang), batch_id, checkpoint)

    return r.parquet(in_dir).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_corpus(spark: SparkSession, out_dir: str, snapshot: int | None = None) -> DataFrame:
    """The corpus as of the last finished batch (or of an older snapshot): per title, every page of the version that arrived last."""
    return CorpusStore(spark, out_dir).read(snapshot)


def compact_corpus(spark: SparkSession, out_dir: str, new_dir: str, buckets: int = BUCKETS) -> None:
    """Write the current corpus alone, without its history and the files that hold no title, to a new store in ``new_dir``."""
    docs = CorpusStore(spark, out_dir).read()
    empty = F.lit(None).cast("long")
    CorpusStore(spark, new_dir, buckets).merge(docs.withColumn("listing_no", empty).withColumn("delivery", empty).withColumn("removed", F.lit(False)), 0)
