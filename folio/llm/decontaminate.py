"""Benchmark decontamination (operator 5).

Method: *size-partitioned MinHash containment search*.  Benchmark items are
partitioned by their number of shingles into classes whose upper sizes double
(4, 8, 16, ...).  For a class of upper size s, every document is read as windows
of 2 s shingles that start each s shingles, so that an item of the class lies
whole in one window and their Jaccard similarity cannot fall far below a quarter of the
containment.  Item and window are candidates if one of HASHES minimum hashes is
equal.  Candidates are verified by exact containment: the share of the item's
distinct shingles (texts of five words, not hashes) that the document holds.

Documents are read once.  Two bit filters of fixed size, broadcast, hold the
items' minimum hashes and shingle hashes; only what passes them leaves the task,
and is joined with the items exactly.  Whatever the filters let pass wrongly is
dropped by those joins, so the results do not depend on the filters' size.

An item of one to four words is one shingle of its own width: the runs of that width
that pass a third filter are equi-joined with such items.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import SHINGLE_WORDS, SIMILARITY, WordHashes, map_rows, odd_multipliers, shingle_hashes, table, words_of, written

HASHES = 64
FIRST_CLASS = 4  # shingles
FILTER_BITS = 26  # 2^26 bits (8 MB) at most, whatever the number of items
SALTS = 8  # parts of an item in the joins: one item may be in a third of all documents

FOUND = "row long, doc_id long, keys array<long>, shingles array<string>, runs array<string>"
SHORT = "item_id long, run string, width int, keys array<long>"
ITEMS = "item_id long, keys array<long>, shingles array<string>, hashes array<long>, cls int"


class BitFilter:
    """Bits of 64-bit keys, at two places each, in 64-bit words."""

    def __init__(self, bits: int):
        self.bits = bits
        self.words = np.zeros(1 << (bits - 6), np.uint64)

    def places(self, keys: np.ndarray, second: bool) -> tuple[np.ndarray, np.ndarray]:
        """The word and the bit of each key."""
        p = (keys * np.uint64(0x9E3779B97F4A7C15) if second else keys) >> np.uint64(64 - self.bits)
        return (p >> np.uint64(6)).astype(np.int64), np.uint64(1) << (p & np.uint64(63))

    def passes(self, keys: np.ndarray) -> np.ndarray:
        """Places (flat) of the keys that may be there."""
        flat = keys.reshape(-1)
        at, bit = self.places(flat, False)
        on = np.flatnonzero(self.words[at] & bit)
        at, bit = self.places(flat[on], True)
        return on[(self.words[at] & bit) != 0]


def bit_filters(index: DataFrame, bits: int) -> tuple[BitFilter, BitFilter]:
    """The filters of the items' minimum hashes and of their shingles, made of words that the tasks have or-ed:
    at most 2^(bits - 6) rows each come to the driver, whatever the number of items."""

    def words(slices):
        parts = BitFilter(bits), BitFilter(bits)
        for c in slices:
            for part, column in zip(parts, ("keys", "hashes"), strict=True):
                keys = np.concatenate([np.array(k, np.int64) for k in c[column]]).view(np.uint64)
                for second in (False, True):
                    np.bitwise_or.at(part.words, *part.places(keys, second))
        for which, part in enumerate(parts):
            at = np.flatnonzero(part.words)
            yield {"which": np.full(len(at), which, np.int32), "at": at, "word": part.words[at].view(np.int64)}

    got = map_rows(index.select("keys", "hashes"), words, "which int, at long, word long").groupBy("which", "at").agg(F.bit_or("word").alias("word")).toArrow()
    out = BitFilter(bits), BitFilter(bits)
    which, at, word = (np.ascontiguousarray(got[c].to_numpy()) for c in ("which", "at", "word"))
    for k, part in enumerate(out):
        part.words[at[which == k]] = word[which == k].view(np.uint64)
    return out


def size_class(n: int) -> int:
    """0 for up to FIRST_CLASS shingles, then one more for each doubling."""
    return max(0, (n - 1) // FIRST_CLASS).bit_length()


_NO_SHINGLES = np.empty(0, np.uint64)
_MULTIPLIERS = odd_multipliers(HASHES, 5)
_SALT = odd_multipliers(HASHES * 64, 55).reshape(64, HASHES)


def block_minima(h: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each hash function over each block of ``size`` shingles: [blocks, HASHES]."""
    blocks = -(-len(h) // size)
    out = np.empty((blocks, HASHES), np.uint64)
    step = max(1, 4096 // size)
    padded = np.concatenate([h, np.full(blocks * size - len(h), h[-1])]).reshape(blocks, size)
    for at in range(0, blocks, step):
        out[at : at + step] = (padded[at : at + step, :, None] * _MULTIPLIERS).min(1)
    return out


def window_keys(h: np.ndarray, classes: list[int]):
    """For each class: the keys of its windows, [windows, HASHES]; a key tells its class and hash function too."""
    if not len(h) or not classes:
        return
    low, k = block_minima(h, FIRST_CLASS << classes[0]), classes[0]
    for c in classes:
        while k < c:
            if len(low) % 2:
                low = np.concatenate([low, low[-1:]])
            low = np.minimum(low[0::2], low[1::2])
            k += 1
        windows = np.minimum(low[:-1], low[1:]) if len(low) > 1 else low
        yield (windows ^ _SALT[c]) * np.uint64(0xD6E8FEB86659FD93)


def item_index(items: DataFrame) -> DataFrame:
    """item_id, keys of its class, distinct shingles, their hashes, the class; items under five words are in `short_items`.
    An item_id with several texts is one item for each text."""

    def run(slices):
        known = WordHashes()
        for c in slices:
            out = {k: [] for k in ("item_id", "keys", "shingles", "hashes", "cls")}
            for item_id, text in zip(c["item_id"], c["text"], strict=True):
                words = words_of(text)
                if len(words) < SHINGLE_WORDS:
                    continue
                h = shingle_hashes(words, known)
                shingles = sorted({" ".join(words[i : i + SHINGLE_WORDS]) for i in range(len(h))})
                cls = size_class(len(h))
                minima = (h[:, None] * _MULTIPLIERS).min(0)
                out["item_id"].append(item_id)
                out["keys"].append(((minima ^ _SALT[cls]) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64))
                out["shingles"].append(shingles)
                out["hashes"].append(np.unique(h).view(np.int64))
                out["cls"].append(cls)
            yield out

    return map_rows(items.select(F.col("item_id").cast("long"), "text"), run, ITEMS).withColumn("item", F.monotonically_increasing_id())


def short_items(items: DataFrame) -> DataFrame:
    """item_id, run, width, keys (one hash): the items of one to four words."""

    def run(slices):
        known = WordHashes()
        for c in slices:
            short = [(i, w) for i, w in zip(c["item_id"], map(words_of, c["text"]), strict=True) if 0 < len(w) < SHINGLE_WORDS]
            yield {"item_id": [i for i, _ in short], "run": [" ".join(w) for _, w in short], "width": [len(w) for _, w in short], "keys": [shingle_hashes(w, known).view(np.int64) for _, w in short]}

    return map_rows(items.select(F.col("item_id").cast("long"), "text"), run, SHORT).withColumn("item", F.monotonically_increasing_id())


def contaminated(docs: DataFrame, items: DataFrame, share: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, n_shared, n_shingles, containment: one row per document row and item of which the
    document holds at least ``share`` of the distinct five-word shingles, in any order of size.  An item of one to
    four words is one shingle, which the document holds as a run of words or does not.

    Null and empty texts hold nothing, and are no items.  Null ids are
    kept as null.  Repeated rows give one row each; ties do not matter, as every
    item that reaches ``share`` is returned.  An empty benchmark gives no rows."""
    spark = docs.sparkSession
    index = written(item_index(items), "benchmark-items")
    classes = sorted(r["cls"] for r in index.select("cls").distinct().collect())  # at most 64
    bits = min(FILTER_BITS, max(20, (index.count() * HASHES * 64).bit_length()))
    keys_in, shingles_in = bit_filters(index, bits)
    short = written(short_items(items), "benchmark-short-items")
    widths = sorted(r["width"] for r in short.select("width").distinct().collect())  # at most 4
    bits = min(FILTER_BITS, max(20, (short.count() * 64).bit_length()))
    runs_in = bit_filters(short.select("keys", F.col("keys").alias("hashes")), bits)[0] if widths else None
    sent = spark.sparkContext.broadcast((keys_in, shingles_in, runs_in))

    def search(slices):
        known = WordHashes()
        keys_in, shingles_in, runs_in = sent.value
        for c in slices:
            out = {k: [] for k in ("row", "doc_id", "keys", "shingles", "runs")}
            for row, doc_id, text in zip(c["row"], c["doc_id"], c["text"], strict=True):
                words = words_of(text)
                runs = {" ".join(words[i : i + w]) for w in widths if w <= len(words) for i in runs_in.passes(shingle_hashes(words, known, w)).tolist()}
                h = shingle_hashes(words, known) if len(words) >= SHINGLE_WORDS else _NO_SHINGLES
                hits = [k.reshape(-1)[on] for k in window_keys(h, classes) if len(on := keys_in.passes(k))]
                if not hits and not runs:
                    continue
                out["row"].append(row)
                out["doc_id"].append(doc_id)
                out["keys"].append(np.unique(np.concatenate(hits)).view(np.int64) if hits else [])
                out["shingles"].append(sorted({" ".join(words[i : i + SHINGLE_WORDS]) for i in shingles_in.passes(h).tolist()}) if hits else [])
                out["runs"].append(sorted(runs))
            yield out

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = written(map_rows(rows, search, FOUND), "benchmark-windows")
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    mine = F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int").alias("salt")
    pairs = (
        found.select("row", mine, F.explode("keys").alias("key"))
        .join(index.select("item", F.explode("keys").alias("key")).select("item", "key", salt), ["key", "salt"])
        .select("row", "salt", "item")
        .distinct()
    )
    held = pairs.join(found.select("row", "doc_id", F.col("shingles").alias("_doc")), "row").join(
        index.select("item", "item_id", F.col("shingles").alias("_item")).select("*", salt), ["item", "salt"]
    )
    shared = F.size(F.array_intersect("_item", "_doc")).cast("long")
    one = F.lit(1).cast("long")
    # rows of found hold a run once; equal items of several ids are found each
    brief = found.select("row", "doc_id", F.explode("runs").alias("run"), mine).join(short.select("item_id", "run", salt), ["run", "salt"]).select("doc_id", "item_id", one.alias("n_shared"), one.alias("n_shingles"))
    return (
        held.select("doc_id", "item_id", shared.alias("n_shared"), F.size("_item").cast("long").alias("n_shingles"))
        .unionByName(brief)
        .withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
        .filter(F.col("containment") >= share)
    )


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
