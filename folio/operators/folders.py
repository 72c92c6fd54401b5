"""File-listing operators: folder facts, listing order, title collisions.

A listing is a DataFrame with one row per file and a ``path`` column.  Folder
facts are derived by exploding each path into its ancestor folders and
aggregating; the root folder is a key every file shares, so every aggregate
here is one that Spark combines map-side before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.paths import DEFAULT_SEP, file_stem, levels, parts
from folio.operators.numbering import ordinal


def _prefix(p: Column, k: Column, sep: str) -> Column:
    return F.array_join(F.slice(p, 1, k), sep)


def _ancestors(files: DataFrame, sep: str, path_col: str = "path") -> DataFrame:
    p = parts(path_col, sep)
    n = F.size(p)
    # a path without a separator has no folder above it
    return files.where(n > 1).select(
        F.col(path_col).alias("_path"),
        p.alias("_p"),
        n.alias("_n"),
        F.explode(F.sequence(F.lit(1), n - 1)).alias("_k"),
    )


def has_subfolders(files: DataFrame, sep: str = DEFAULT_SEP, path_col: str = "path") -> DataFrame:
    """A3: ``(folder, has_subfolders)`` for every folder that holds a file somewhere below it."""
    a = _ancestors(files, sep, path_col)
    return a.groupBy(_prefix(F.col("_p"), F.col("_k"), sep).alias("folder")).agg(
        F.max((F.col("_n") - F.col("_k")) > 1).alias("has_subfolders")
    )


def folder_tree(files: DataFrame, sep: str = DEFAULT_SEP, path_col: str = "path") -> DataFrame:
    """A4: ``(folder, parent, n_files, n_dirs)``: files directly inside vs direct sub-folders."""
    a = _ancestors(files, sep, path_col)
    below = F.col("_n") - F.col("_k")
    a = a.select(
        _prefix(F.col("_p"), F.col("_k"), sep).alias("folder"),
        F.when(F.col("_k") > 1, _prefix(F.col("_p"), F.col("_k") - 1, sep)).alias("parent"),
        (below == 1).cast("long").alias("_file"),
        F.when(below > 1, F.get(F.col("_p"), F.col("_k"))).alias("_child"),
    )
    return a.groupBy("folder", "parent").agg(
        F.sum("_file").alias("n_files"),
        F.count_distinct("_child").alias("n_dirs"),
    )


def listing_key(path_col: str = "path", sep: str = DEFAULT_SEP, root_depth: int = 2) -> Column:
    """S2 sort key: a folder's files first, then its sub-folders, each by name.

    Each part below the root becomes ``kind + name + U+0001`` (kind 0 = file,
    1 = folder); comparing the concatenation compares the parts in turn.
    """
    p = parts(path_col, sep)
    rel = F.slice(p, root_depth + 1, F.size(p))
    last = F.size(rel) - 1
    comp = F.transform(rel, lambda name, i: F.concat(F.when(i == last, F.lit("0")).otherwise(F.lit("1")), name, F.lit("\u0001")))
    return F.array_join(comp, "")


def listing_order(files: DataFrame, sep: str = DEFAULT_SEP, root_depth: int = 2, path_col: str = "path", name: str = "listing_no") -> DataFrame:
    """Number files in the recursive listing order (0-based), distributed."""
    keyed = files.withColumn("_lkey", listing_key(path_col, sep, root_depth))
    return ordinal(keyed, [], ["_lkey", path_col], name=name).drop("_lkey")


def union_listings(*listings: DataFrame, distinct: bool = False) -> DataFrame:
    """Append listings; repeated listings keep their duplicates unless ``distinct``."""
    u = reduce(lambda a, b: a.unionByName(b), listings)
    return u.distinct() if distinct else u


def listing_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """L1: what happened between two listings ``(path, length, modified)``: ``(path, change, length, modified)`` with change
    'added', 'changed' (another length or time) or 'removed' (then length and time are the old ones).

    A path that a listing holds more than once counts with its latest time (the longer of two at one time).  Nulls are
    values: a length that was null and still is has not changed.  Rows without a path are no files."""

    def last(files: DataFrame) -> DataFrame:
        best = files.where(F.col("path").isNotNull()).groupBy("path").agg(F.max(F.struct("modified", "length")).alias("f"))
        return best.select("path", F.col("f.length").alias("length"), F.col("f.modified").alias("modified"), F.lit(True).alias("there"))

    a, b = last(old).alias("a"), last(new).alias("b")
    same = F.col("a.length").eqNullSafe(F.col("b.length")) & F.col("a.modified").eqNullSafe(F.col("b.modified"))
    change = F.when(F.col("a.there").isNull(), "added").when(F.col("b.there").isNull(), "removed").when(~same, "changed")
    now = lambda c: F.when(F.col("b.there").isNull(), F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c)
    joined = a.join(b, F.col("a.path") == F.col("b.path"), "full")
    return joined.select(F.coalesce("a.path", "b.path").alias("path"), change.alias("change"), now("length"), now("modified")).where(F.col("change").isNotNull())


def with_levels(files: DataFrame, sep: str = DEFAULT_SEP, path_col: str = "path") -> DataFrame:
    lv = levels(path_col, sep)
    return files.withColumn("lv1", lv["lv1"]).withColumn("lv2", lv["lv2"]).withColumn("lv3", lv["lv3"])


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """Per ``key`` keep the row that is last in ``order`` (a later file replaces an earlier one).

    Aggregated with ``max_by`` rather than a window, so a key shared by a third
    of all files is combined map-side instead of being sorted in one task.
    """
    others = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*others), F.col(order)).alias("_w"))
    return best.select(key, *[F.col("_w")[c].alias(c) for c in others])


def collisions(files: DataFrame, sep: str = DEFAULT_SEP, path_col: str = "path") -> DataFrame:
    """Names shared by more than one file — titles (overwrite each other in the corpus)
    and image stems (``{stem}_{page}.png`` files overwrite each other)."""
    lv = levels(path_col, sep)
    t = files.select(F.lit("title").alias("kind"), lv["lv3"].alias("name"), F.col(path_col).alias("_path"))
    s = files.select(F.lit("image").alias("kind"), file_stem(path_col, sep).alias("name"), F.col(path_col).alias("_path"))
    both = t.unionByName(s).where(F.col("name").isNotNull())
    return (
        both.groupBy("kind", "name")
        .agg(F.count(F.lit(1)).alias("n_files"), F.min("_path").alias("first_path"), F.max("_path").alias("last_path"))
        .where(F.col("n_files") > 1)
    )
