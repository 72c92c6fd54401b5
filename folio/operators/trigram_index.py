"""Indexed search (B11): a regular expression over a corpus, reading only pages that can match.

The index is written once: the pages, numbered, and for each trigram of their
text (A-Z lower-cased) the numbers of the pages that hold it.  A posting list is
cut into blocks of consecutive page numbers, so that the list of a trigram
that all pages hold is many rows, not one.  A pattern is turned into the trigrams that every
match must hold (and / or); their lists are intersected block by block, and the
pages left are read and verified with the pattern itself.  A pattern that demands no trigram
scans all pages.
"""

from __future__ import annotations

import json
import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions.text import search

try:
    from re import _constants as C
    from re import _parser
except ImportError:  # Python before 3.11
    import sre_constants as C
    import sre_parse as _parser

BLOCK_BITS = 12  # a block of a posting list: 4,096 page numbers
HELD_NUMBERS = 1_000_000  # page numbers that a task holds
POSTED_ROWS = 10_000
LISTED_PAGES = 10_000  # up to so many candidates are named in the scan's filter, more are joined
POSTINGS = "trigram string, block long, page_nos array<long>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = str.maketrans(UPPER, LOWER)

Formula = tuple | str | bool  # a trigram, ("and" | "or", formulas), or True: anything


def _characters(text: Column) -> Column:
    return F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), "")


def _trigrams(chars: str) -> Column:
    """The distinct trigrams of a column of characters (a column, so that it is made once and not for each trigram)."""
    c = F.col(chars)
    first = F.slice(c, 1, F.greatest(F.size(c) - 2, F.lit(0)))
    return F.array_distinct(F.transform(first, lambda x, i: F.concat(x, F.get(c, i + 1), F.get(c, i + 2))))


def page_trigrams(pages: DataFrame, text: str = "page_text") -> DataFrame:
    """page_no, trigram: the distinct trigrams of each page, A-Z lower-cased (of a null or short text: none)."""
    return pages.select("page_no", _characters(F.col(text)).alias("chars")).select("page_no", F.explode(_trigrams("chars")).alias("trigram"))


def _posted(batches, bits: int = BLOCK_BITS):
    """trigram, block, page_nos of the pages (page_no, text) of a task, handed on whenever HELD_NUMBERS are held."""
    schema = pa.schema([("trigram", pa.string()), ("block", pa.int64()), ("page_nos", pa.list_(pa.int64()))])
    lists: dict[tuple[int, str], list[int]] = {}
    held = 0

    def full():
        keys = list(lists)
        columns = [pa.array([t for _, t in keys], pa.string()), pa.array([b for b, _ in keys], pa.int64()), pa.array(list(lists.values()), pa.list_(pa.int64()))]
        lists.clear()
        rows = pa.RecordBatch.from_arrays(columns, schema=schema)
        return (rows.slice(at, POSTED_ROWS) for at in range(0, rows.num_rows, POSTED_ROWS))

    for b in batches:
        for no, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            t, block = (text or "").translate(_FOLD), no >> bits
            found = {t[i : i + 3] for i in range(len(t) - 2)}
            for x in found:
                lists.setdefault((block, x), []).append(no)
            held += len(found)
            if held >= HELD_NUMBERS:
                yield from full()
                held = 0
    yield from full()


def _all(kind: str, formulas: list[Formula]) -> Formula:
    some = [f for f in dict.fromkeys(formulas) if f is not True]
    if kind == "or" and len(some) < len(set(formulas)):
        return True
    return True if not some else some[0] if len(some) == 1 else (kind, tuple(some))


def required(pattern: str) -> Formula:
    """What trigrams a text must hold for the pattern to match in it, whatever the case of A-Z; True if none or not known."""
    if re.search(r"\\[vQ]|\(\?[a-zA-Z]*[uUd]", pattern):
        return True  # other meaning in Java, or letters that fold to A-Z
    try:
        tree = _parser.parse(pattern)
    except (re.error, OverflowError, RecursionError):
        return True  # syntax that only Java has
    return _need(tree)


def _need(items) -> Formula:
    out: list[Formula] = []
    run: list[str] = []

    def close() -> None:
        text = "".join(run).translate(_FOLD)
        out.extend(text[i : i + 3] for i in range(len(text) - 2))
        run.clear()

    def visit(items) -> None:
        for op, arg in items:
            if op is C.LITERAL:
                run.append(chr(arg))
            elif op is C.SUBPATTERN:
                visit(arg[3])
            elif op is C.ATOMIC_GROUP:
                visit(arg)
            elif op is C.AT:
                pass  # takes no character
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and arg[0] >= 1:
                if arg[0] == arg[1] == 1:
                    visit(arg[2])
                else:
                    close()
                    out.append(_need(arg[2]))
            else:
                close()
                if op is C.BRANCH:
                    out.append(_all("or", [_need(a) for a in arg[1]]))

    visit(items)
    close()
    return _all("and", out)


def _named(formula: Formula) -> set[str]:
    return {formula} if isinstance(formula, str) else set().union(*map(_named, formula[1]))


def _lists(formula: Formula, lists: Column) -> Column:
    """The page numbers of a block that satisfy the formula; ``lists``: trigram -> numbers."""
    if isinstance(formula, str):
        return F.coalesce(F.try_element_at(lists, F.lit(formula)), F.array().cast("array<long>"))
    kind, parts = formula
    return reduce(F.array_intersect if kind == "and" else F.array_union, [_lists(p, lists) for p in parts])


def write_index(pages: DataFrame, path: str, text: str = "page_text") -> None:
    """Write the index of ``pages`` (any columns; ``text`` is searched) to the new folder ``path``."""
    spark = pages.sparkSession
    numbered = pages.withColumn("page_no", F.monotonically_increasing_id()).withColumn("part", F.shiftright("page_no", 33).cast("int"))
    numbered.write.mode("error").partitionBy("part").parquet(f"{path}/pages")  # numbers are what is written
    # an empty partitioned table leaves no file to take the schema from
    spark.createDataFrame([(numbered.schema.json(),)], "value string").coalesce(1).write.mode("error").text(f"{path}/schema")
    # a task puts its pages' numbers together before they are shuffled: no row for a trigram of a page
    bits = BLOCK_BITS
    rows = _pages(spark, path).select("page_no", text).mapInArrow(lambda batches: _posted(batches, bits), POSTINGS)
    lists = rows.groupBy("trigram", "block").agg(F.sort_array(F.flatten(F.collect_list("page_nos"))).alias("page_nos"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lists.repartitionByRange(n, "trigram", "block").sortWithinPartitions("trigram", "block").write.mode("error").parquet(f"{path}/postings")


def _pages(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(spark.read.text(f"{path}/schema").first()[0]))
    return spark.read.schema(schema).parquet(f"{path}/pages")


def candidates(spark: SparkSession, path: str, pattern: str) -> DataFrame | None:
    """page_no of the pages that hold what the pattern requires; None: it requires nothing."""
    formula = required(pattern)
    if formula is True:
        return None
    lists = spark.read.schema(POSTINGS).parquet(f"{path}/postings").where(F.col("trigram").isin(sorted(_named(formula))))
    held = lists.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "page_nos"))).alias("lists"))  # a list a trigram of the pattern
    return held.select(F.explode(_lists(formula, F.col("lists"))).alias("page_no"))


def search_index(spark: SparkSession, path: str, pattern: str, ignore_case: bool = True, text: str = "page_text") -> DataFrame:
    """B11 by the index: the columns of the matching pages, ``n_matches`` and ``first_match`` (as `functions.text.search`)."""
    pages = _pages(spark, path)
    some = candidates(spark, path, pattern)
    if some is not None:
        some = some.persist()
        try:
            parts = [r[0] for r in some.select(F.shiftright("page_no", 33).cast("int")).distinct().collect()]  # files of the index, at most
            listed = [r[0] for r in some.limit(LISTED_PAGES + 1).collect()]
        finally:
            some.unpersist()
        pages = pages.where(F.col("part").isin(parts))
        pages = pages.where(F.col("page_no").isin(listed)) if len(listed) <= LISTED_PAGES else pages.join(candidates(spark, path, pattern), "page_no", "left_semi")
    hit, n, first = search(text, pattern, ignore_case)
    return pages.where(hit).withColumn("n_matches", n.cast("long")).withColumn("first_match", first).drop("page_no", "part")
