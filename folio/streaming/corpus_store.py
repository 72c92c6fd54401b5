"""The corpus that a stream keeps up to date (L1): hashed by title into buckets, merged bucket by bucket.

Three tables lie under the root, each a folder per commit and bucket:

* ``docs`` — the page documents of the version that holds each title: what readers scan, and nothing else;
* ``held`` — those of files that are there but lose their title to another file;
* ``versions`` — one row for each version of a file that was ever delivered (no text), removals included.

A merge reads the touched buckets of the three, works out the winners, and writes new
folders for these buckets only; a manifest (`folio.sources.snapshots`) then
names the folders of every bucket.  It also holds the last batch of each stream,
so a batch that is tried again after its commit changes nothing.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.sources.corpus_io import DOCS_SCHEMA
from folio.sources.snapshots import Snapshots

BUCKETS = 16
TABLES = ("docs", "held", "versions")
VERSIONS_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("commit", T.LongType()),
        T.StructField("delivery", T.LongType()),
        T.StructField("listing_no", T.LongType()),
        T.StructField("removed", T.BooleanType()),
    ]
)
PAGES_SCHEMA = T.StructType([*DOCS_SCHEMA.fields, T.StructField("version", T.StringType())])
SCHEMAS = {"docs": PAGES_SCHEMA, "held": PAGES_SCHEMA, "versions": VERSIONS_SCHEMA}


def _bucket(title: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(title), F.lit(buckets)).cast("int")


class CorpusStore:
    """The store at ``root``; ``buckets`` counts only when the first commit makes it."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.snapshots = spark, Snapshots(spark, root)
        self._buckets = buckets

    def _state(self, snapshot: int | None = None) -> tuple[int, dict]:
        return self.snapshots.read(snapshot) or (-1, {"buckets": self._buckets, "batches": {}, **{t: {} for t in TABLES}})

    def _load(self, manifest: dict, table: str, buckets: list[int] | None = None) -> DataFrame:
        """A table's rows in some buckets (all by default)."""
        known = manifest[table]
        paths = [f"{self.snapshots.root}/{known[b]}" for b in sorted(known) if buckets is None or int(b) in buckets]
        return self.spark.read.schema(SCHEMAS[table]).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMAS[table])

    def read(self, snapshot: int | None = None) -> DataFrame:
        """The corpus: per title, every page of the version that arrived last; of the newest snapshot or an older one."""
        return self._load(self._state(snapshot)[1], "docs").drop("version")

    def read_title(self, title: str | None, snapshot: int | None = None) -> DataFrame:
        """One title's pages: only its bucket is read."""
        manifest = self._state(snapshot)[1]
        bucket = self.spark.range(1).select(_bucket(F.lit(title).cast("string"), manifest["buckets"])).first()[0]
        return self._load(manifest, "docs", [bucket]).where(F.col("title").eqNullSafe(F.lit(title))).drop("version")

    def folders(self, snapshot: int | None = None) -> dict[str, dict[str, str]]:
        """Table -> bucket -> data folder."""
        manifest = self._state(snapshot)[1]
        return {t: dict(manifest[t]) for t in TABLES}

    def merge(self, docs: DataFrame, batch: int, stream: str = "") -> bool:
        """Put a batch into the store; False if this batch of this stream is in it already.

        ``docs``: the columns of the page documents, ``listing_no``, ``delivery`` and ``removed``
        (true: the file is gone; such a row needs no page)."""
        last, manifest = self._state()
        if manifest["batches"].get(stream, -1) >= batch:
            return False
        number, root = last + 1, self.snapshots.root
        bucket = _bucket(F.col("title"), manifest["buckets"])
        gone = F.coalesce(F.col("removed"), F.lit(False))
        # a removal without a delivery number is a version like any other, before what the batch itself delivers
        name = F.when(F.col("delivery").isNotNull(), F.concat(F.lit("d"), F.col("delivery").cast("string"))).otherwise(F.lit(f"b{number}"))
        new = docs.withColumn("removed", gone).withColumn("version", F.concat(F.when(gone, F.lit("x")).otherwise(F.lit("")), name))
        new = new.persist(StorageLevel.MEMORY_AND_DISK)  # read three times
        try:
            touched = sorted(r[0] for r in new.select(bucket).distinct().collect())  # a number a bucket
            fresh = new.select("title", "file_path", "version", F.lit(number).cast("long").alias("commit"), "delivery", "listing_no", "removed")
            seen = self._load(manifest, "versions", touched).unionByName(fresh).groupBy("title", "file_path", "version")
            versions = seen.agg(F.min("commit").alias("commit"), F.max("delivery").alias("delivery"), F.max("listing_no").alias("listing_no"), F.max("removed").alias("removed"))
            self._write(versions.withColumn("bucket", bucket), "versions", number, touched, manifest)
            live = self._live(self._load(manifest, "versions", touched))
            winners = live.groupBy("title").agg(F.max_by("file", "arrival").alias("file")).select("file.*")
            losers = live.select("file.*").join(winners, ["file_path", "version"], "left_anti")
            before = self._load(manifest, "docs", touched).unionByName(self._load(manifest, "held", touched))
            pages = before.unionByName(new.where(~F.col("removed")).select(*PAGES_SCHEMA.fieldNames())).withColumn("bucket", bucket)
            some = losers.limit(1).count() > 0
            held = pages.join(losers, ["file_path", "version"], "left_semi") if some else None
            wins = pages.join(winners, ["file_path", "version"], "left_semi")
            # both read the folders of before; the manifest is changed when both are written
            folders = [self._written(wins, "docs", number), self._written(held, "held", number) if some else {}]
        finally:
            new.unpersist()
        for table, at in zip(("docs", "held"), folders, strict=True):
            manifest[table] = {b: f for b, f in manifest[table].items() if int(b) not in touched} | at
        manifest["batches"][stream] = batch
        self.snapshots.commit(number, manifest)
        return True

    @staticmethod
    def _live(versions: DataFrame) -> DataFrame:
        """title, file, arrival: the version of each file that arrived last, if that is no removal."""
        arrival = F.struct("commit", F.coalesce("delivery", F.lit(-1)).alias("delivery"), (~F.col("removed")).alias("there"), "listing_no")
        state = F.struct("version", "removed", arrival.alias("arrival"))
        last = versions.groupBy("title", "file_path").agg(F.max_by(state, arrival).alias("last")).where(~F.col("last.removed"))
        return last.select("title", F.struct("file_path", F.col("last.version").alias("version")).alias("file"), F.col("last.arrival").alias("arrival"))

    def _written(self, rows: DataFrame, table: str, number: int) -> dict[str, str]:
        """Write rows (with their ``bucket``) to new folders; bucket -> folder.  A large bucket is written by several tasks."""
        folder = self.snapshots.folder(table, number)
        rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.snapshots.root}/{folder}")
        names = [n for n in self.snapshots.names(folder) if n.startswith("bucket=")]
        return {n.removeprefix("bucket="): f"{folder}/{n}" for n in names}

    def _write(self, rows: DataFrame, table: str, number: int, touched: list[int], manifest: dict) -> None:
        at = self._written(rows, table, number)
        manifest[table] = {b: f for b, f in manifest[table].items() if int(b) not in touched} | at

    def expire(self, keep: int = 1) -> None:
        """Keep the newest ``keep`` snapshots; delete what no kept one names (also what merges that died left)."""
        self.snapshots.expire(list(TABLES), lambda m: [f for t in TABLES for f in m[t].values()], keep)
