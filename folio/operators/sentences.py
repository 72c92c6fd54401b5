"""Quoted sentences taken out of page text (T4), for a table of many sentences.

`functions.text.drop_boilerplate` puts a few sentences into one pattern.  Here
they are a table: the first words of each (WINDOW of them, or all of a shorter
one) are its fingerprint, the pages give one for each window of words at
each position, and the two are equi-joined.  Where the table is too large for a
broadcast, its bare fingerprints are broadcast first, so that only windows that meet one are
shuffled.  What meets the pages is numbers: a sentence's words stay where they are, and a candidate is
verified on its page by the SHA-256 of as many words;
of overlapping hits the leftmost stays, and of those at one word the sentence first in the
table, as an alternation of patterns would do.  All of it is built-in functions.

A sentence is matched by whole words (runs of non-blank characters), with any
blanks between them; the blanks before it stay in the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.session import stored

WINDOW = 4
BROADCAST_SENTENCES = 100_000  # a larger table is joined by shuffle
BROADCAST_MARKS = 4_000_000  # of which up to so many fingerprints (a number each) are broadcast
SALTS = 16  # parts of a sentence in that shuffle: a window may be on every page
PAGE_KEYS = ("doc_id", "page")


def _pieces(text: Column) -> Column:
    """The words of a text, each with the blanks before it; blanks at the end are the last piece."""
    return F.regexp_extract_all(text, F.lit(r"\s*\S+|\s+"), F.lit(0))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0))


def _windows(w: Column, width: int) -> Column:
    """The fingerprint of ``width`` words from each position."""
    starts = F.slice(w, 1, F.greatest(F.size(w) - (width - 1), F.lit(0)))
    return F.transform(starts, lambda _, i: F.xxhash64(F.array_join(F.slice(w, i + 1, F.lit(width)), " ")))


def _marks(w: Column, width: int) -> Column:
    return F.transform(_windows(w, width), lambda m, i: F.struct(i.alias("pos"), F.lit(width).alias("_width"), m.alias("_mark")))


def _identified(pages: DataFrame, keys, text: str) -> DataFrame:
    """The key of a page's row: its keys and its text's hash (equal rows have equal hits)."""
    return pages.withColumn("_page", F.struct(*[F.col(k) for k in keys], F.xxhash64(text).alias("_hash")))


def _digest(w: Column) -> Column:
    """Of words, which hold no blanks: different words, different digests."""
    return F.unhex(F.sha2(F.array_join(w, " "), 256))


def _candidates(pages: DataFrame, sentences: DataFrame, text: str) -> DataFrame:
    """_page, hits: the positions where a sentence's fingerprint is met, sorted by position and sentence."""
    s = sentences.where(F.col("sentence").isNotNull()).select("sentence_no", words(F.col("sentence")).alias("_words")).where(F.size("_words") > 0)
    s = s.withColumn("_width", F.least(F.size("_words"), F.lit(WINDOW)))
    mark = F.xxhash64(F.array_join(F.slice("_words", 1, F.col("_width")), " "))
    s = stored(s.select("sentence_no", "_width", mark.alias("_mark"), F.size("_words").alias("_n"), _digest(F.col("_words")).alias("_digest")), "sentences")
    counted = {r[0]: r[1] for r in s.groupBy("_width").count().collect()}  # WINDOW rows at most
    none = F.array().cast("array<struct<pos:int,_width:int,_mark:bigint>>")
    marks = F.flatten(F.array(none, *[_marks(F.col("_w"), k) for k in sorted(counted)]))
    # the words are a column of their own: made once, not for each position
    met = pages.select("_page", words(F.col(text)).alias("_w")).select("_page", F.explode(marks).alias("m")).select("_page", "m.*")
    n = sum(counted.values())
    if n <= BROADCAST_SENTENCES:
        hits = met.join(F.broadcast(s), ["_width", "_mark"])
    else:
        salted = s.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        if n <= BROADCAST_MARKS:
            met = met.join(F.broadcast(s.select("_mark").distinct()), "_mark", "left_semi")
        hits = met.withColumn("_salt", F.pmod(F.xxhash64("_page", "pos"), F.lit(SALTS)).cast("int")).join(salted, ["_width", "_mark", "_salt"])
    # what one page holds: at most its words times the sentences of one fingerprint
    return hits.groupBy("_page").agg(F.sort_array(F.collect_set(F.struct("pos", "sentence_no", "_n", "_digest"))).alias("_hits"))


def _resolved(w: Column, hits: Column) -> Column:
    """Verified hits that don't overlap, left to right: array of (pos, sentence_no, n_words)."""
    true = F.filter(hits, lambda h: _digest(F.slice(w, h["pos"] + 1, h["_n"])) == h["_digest"])
    span = lambda h: F.struct(h["pos"].alias("pos"), h["sentence_no"].cast("long").alias("sentence_no"), h["_n"].alias("n_words"))
    none = F.array().cast("array<struct<pos:int,sentence_no:bigint,n_words:int>>")
    start = F.struct(F.lit(0).alias("end"), none.alias("spans"))
    take = lambda a, h: F.struct((h["pos"] + h["_n"]).alias("end"), F.concat(a["spans"], F.array(span(h))).alias("spans"))
    return F.aggregate(true, start, lambda a, h: F.when(h["pos"] >= a["end"], take(a, h)).otherwise(a), lambda a: a["spans"])


def drop_sentences(pages: DataFrame, sentences: DataFrame, text: str = "page_text", keys=PAGE_KEYS) -> DataFrame:
    """T4: ``pages`` with ``text`` without the sentences, and ``dropped``: array of (pos, sentence_no, n_words) in its words.

    ``sentences``: (sentence_no, sentence); a null or blank one is none, of equal ones the smallest number counts.
    Texts that are null stay null, with nothing dropped."""
    rows = _identified(pages, keys, text)
    found = _candidates(rows.where(F.col(text).isNotNull()), sentences, text)
    same = F.col("l._page").eqNullSafe(F.col("r._page"))
    joined = rows.alias("l").join(found.alias("r"), same, "left")
    joined = joined.select(*[F.col(f"l.{c}") for c in pages.columns], F.col("r._hits").alias("_hits"))
    hit = F.col("_hits").isNotNull()
    joined = joined.withColumn("_w", F.when(hit, words(F.col(text)))).withColumn("_pieces", F.when(hit, _pieces(F.col(text))))
    none = F.array().cast("array<struct<pos:int,sentence_no:bigint,n_words:int>>")
    joined = joined.withColumn("_spans", F.when(hit, _resolved(F.col("_w"), F.col("_hits"))).otherwise(none))
    p = F.col("_pieces")
    kept = F.aggregate(
        "_spans",
        F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("out")),
        lambda a, h: F.struct(
            (h["pos"] + h["n_words"]).alias("end"),
            # the text up to the sentence, and the blanks before it
            F.concat(a["out"], F.slice(p, a["end"] + 1, h["pos"] - a["end"]), F.array(F.regexp_extract(F.get(p, h["pos"]), r"^\s*", 0))).alias("out"),
        ),
        lambda a: F.array_join(F.concat(a["out"], F.slice(p, a["end"] + 1, F.greatest(F.size(p) - a["end"], F.lit(0)))), ""),
    )
    cleaned = F.when(F.size("_spans") == 0, F.col(text)).otherwise(kept)
    return joined.withColumn(text, cleaned).withColumnRenamed("_spans", "dropped").drop("_pieces", "_w", "_hits")
