"""Ranked lexical search (operator 12): the highest-scoring documents of every item, exactly.

A document is a vector of term impacts, an item one of term counts, and the score
their inner product, so the search is a retrieval of largest inner products.

Method: *LEMP-style norm buckets*.  The documents' vectors, over the terms of
the items, are ordered by length (range-partitioned, longest first) and taken in
buckets of consecutive ones.  An item skips a bucket if its own length times
the bucket's largest is under its threshold, the k-th best score it has
(Cauchy-Schwarz).  Inside a bucket the item's FOCUS heaviest coordinates are
multiplied out, and the rest is bounded by the product of the remaining lengths;
what can't reach the threshold is left out.  The survivors are scored exactly in
64-bit integers.  Thresholds start from the scores of the longest documents,
which are searched first.  Bounds are rounded up, and a document at the threshold
is kept, so the result is that of scoring everything.

Items are searched in blocks of about BLOCK_TERMS terms, whose vocabulary is
what is broadcast and collected.  A block reads the texts once; the rest works on term
numbers, written to the shared folder.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folio.llm.common import map_rows, table, written

K = 10
FOCUS = 12
BUCKET = 256
FIRST_ROWS = 4096  # about so many of the longest documents give the first thresholds
BLOCK_TERMS = 100_000

# Bytes of terms: digits, letters (lower-cased) and everything beyond ASCII; the others part them.
_TERM_BYTES = bytes(c if chr(c).isalnum() and c < 128 or c > 127 else 32 for c in range(256)).lower()


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, as UTF-8: runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split() if text else []


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The impact of each term occurrence count ``tf`` in a document of ``n`` terms."""
    m = 25 + (75 * n * n_docs) // max(n_terms, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Items:
    """The items of a block as sparse vectors over its vocabulary."""

    def __init__(self, rows: list[tuple[int, list[int], list[int]]], weights: np.ndarray):
        self.rows = np.array([r[0] for r in rows], np.int64)
        self.terms = [np.array(r[1], np.int64) for r in rows]  # ascending
        self.counts = [np.array(r[2], np.int64) for r in rows]
        self.weights = weights
        self.length = np.array([math.sqrt(float((c * c).sum())) for c in self.counts])
        rest, focus = [], []
        for q, (t, c) in enumerate(zip(self.terms, self.counts, strict=True)):
            heavy = np.argsort(-weights[t] * c, kind="stable")[:FOCUS]
            rest.append(float((c * c).sum() - (c[heavy] ** 2).sum()))
            focus += [(int(t[i]), q, float(c[i])) for i in heavy]
        self.rest = np.sqrt(np.maximum(np.array(rest), 0))  # length beside the focus
        focus.sort()
        owners = np.array([f[0] for f in focus], np.int64)
        self.start = np.searchsorted(owners, np.arange(len(weights) + 1))  # a term's run of focus entries
        self.focus_item = np.array([f[1] for f in focus], np.int64)
        self.focus_count = np.array([f[2] for f in focus])


class Best:
    """The k best documents of each item so far, and the thresholds."""

    def __init__(self, n_items: int, k: int, floor: np.ndarray):
        self.score = np.zeros((n_items, k), np.int64)
        self.id = np.zeros((n_items, k), np.int64)
        self.null = np.zeros((n_items, k), bool)
        self.k, self.floor = k, floor

    @property
    def threshold(self) -> np.ndarray:
        return np.maximum(self.floor, self.score[:, -1])

    def add(self, item: int, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        s, i, n = (np.concatenate([a[item], b]) for a, b in ((self.score, score), (self.id, ids), (self.null, null)))
        top = np.lexsort((i, n, -s))[: self.k]
        self.score[item], self.id[item], self.null[item] = s[top], i[top], n[top]


def search_bucket(items: Items, best: Best, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, length: np.ndarray, ids: np.ndarray, null: np.ndarray) -> tuple[int, int]:
    """Score a bucket (entries ``doc``, ``term``, ``impact`` by document) against the items; (pairs that passed the length test, pairs scored)."""
    threshold = best.threshold.astype(float)
    slack = 1 + 1e-9
    active = (items.length * length.max(initial=0) * slack >= threshold) & (length.max(initial=0) > 0)
    if not active.any():
        return 0, 0
    n_items, n_docs = len(items.rows), len(length)
    value = items.weights[term] * impact.astype(float)
    runs = items.start[term + 1] - items.start[term]
    met = np.flatnonzero(runs)
    at = np.repeat(met, runs[met])
    within = np.arange(len(at)) - np.repeat(np.cumsum(runs[met]) - runs[met], runs[met])
    entry = items.start[term[at]] + within
    pair = doc[at] * n_items + items.focus_item[entry]
    part = np.bincount(pair, items.focus_count[entry] * value[at], n_docs * n_items).reshape(n_docs, n_items)
    squares = np.bincount(pair, value[at] ** 2, n_docs * n_items).reshape(n_docs, n_items)
    bound = part + items.rest[None, :] * np.sqrt(np.maximum((length**2)[:, None] * slack - squares, 0))
    alive = active[None, :] & (bound * slack >= threshold[None, :]) & (bound > 0) & (items.length[None, :] * length[:, None] * slack >= threshold[None, :])
    ends = np.searchsorted(doc, np.arange(n_docs + 1))
    scored = 0
    for q in np.flatnonzero(alive.any(0)):
        docs = np.flatnonzero(alive[:, q])
        scored += len(docs)
        sizes = ends[docs + 1] - ends[docs]
        rows = np.repeat(ends[docs] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        mine = items.terms[q]
        place = np.minimum(np.searchsorted(mine, term[rows]), len(mine) - 1)
        hit = np.flatnonzero(mine[place] == term[rows])
        score = np.zeros(len(docs), np.int64)
        np.add.at(score, np.repeat(np.arange(len(docs)), sizes)[hit], items.counts[q][place[hit]] * items.weights[mine[place[hit]]] * impact[rows[hit]].astype(np.int64))
        some = score > 0
        if some.any():
            best.add(q, score[some], ids[docs[some]], null[docs[some]])
    return int(active.sum()) * n_docs, scored


FOUND = "item_row long, doc_id long, score long"


def _searched(vectors: DataFrame, items: Items, k: int, floor: np.ndarray) -> DataFrame:
    """The k best documents of each item in each partition (buckets in the order of the rows)."""
    shared = vectors.sparkSession.sparkContext.broadcast((items, floor))
    schema = pa.schema([("item_row", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        items, floor = shared.value
        best = Best(len(items.rows), k, floor)
        for b in batches:
            for start in range(0, b.num_rows, BUCKET):
                s = b.slice(start, BUCKET)
                sizes = pc.list_value_length(s["terms"]).to_numpy(zero_copy_only=False)
                flat = lambda c: c.flatten().to_numpy(zero_copy_only=False)
                search_bucket(
                    items, best, np.repeat(np.arange(len(sizes)), sizes), flat(s["terms"]).astype(np.int64), flat(s["impacts"]), s["length"].to_numpy(),
                    pc.fill_null(s["doc_id"], 0).to_numpy(zero_copy_only=False), s["doc_id"].is_null().to_numpy(zero_copy_only=False),
                )
        item, place = np.nonzero(best.score > 0)
        ids = pa.array(best.id[item, place], pa.int64(), mask=best.null[item, place])
        yield pa.RecordBatch.from_arrays([pa.array(items.rows[item]), ids, pa.array(best.score[item, place])], schema=schema)

    return vectors.mapInArrow(run, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("item_row").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _item_terms(items: DataFrame) -> DataFrame:
    """item_row, item_id, terms, counts: one row for each row of ``items`` that has a term."""

    def run(slices):
        for c in slices:
            counts = [Counter(terms_of(t)) for t in c["text"]]
            yield {"item_row": c["item_row"], "item_id": c["item_id"], "terms": [list(x) for x in counts], "counts": [list(x.values()) for x in counts]}

    kind = items.schema["item_id"].dataType.simpleString()
    rows = items.select(F.monotonically_increasing_id().alias("item_row"), "item_id", F.col("text").cast("string").alias("text"))
    return written(map_rows(rows, run, f"item_row long, item_id {kind}, terms array<binary>, counts array<long>").filter(F.size("terms") > 0), "item-terms")


def _doc_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n, terms, tfs: each document's number of terms, and those of the vocabulary by number."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(slices):
        known = shared.value
        for c in slices:
            n, terms, tfs = [], [], []
            for t in c["text"]:
                words = terms_of(t)
                got = sorted((known[w], f) for w, f in Counter(words).items() if w in known)
                n.append(len(words))
                terms.append([x[0] for x in got])
                tfs.append([x[1] for x in got])
            yield {"doc_id": c["doc_id"], "n": n, "terms": terms, "tfs": tfs}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(map_rows(rows, run, "doc_id long, n long, terms array<int>, tfs array<int>"), "doc-terms")


def _vectors(doc_terms: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """doc_id, terms, impacts, length: by length, longest first, over the partitions and inside each."""
    shared = doc_terms.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        weights = shared.value
        for b in batches:
            sizes = pc.list_value_length(b["terms"]).to_numpy(zero_copy_only=False)
            term = b["terms"].flatten().to_numpy(zero_copy_only=False)
            tf = b["tfs"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            got = impacts(tf, b["n"].to_numpy()[doc], n_docs, n_terms)
            length = np.sqrt(np.bincount(doc, (weights[term] * got.astype(float)) ** 2, len(sizes)))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (term, got)]
            yield pa.RecordBatch.from_arrays([b["doc_id"], *lists, pa.array(length)], names=["doc_id", "terms", "impacts", "length"])

    vectors = doc_terms.filter(F.size("terms") > 0).mapInArrow(run, "doc_id long, terms array<int>, impacts array<int>, length double").filter("length > 0")
    parts = int(doc_terms.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # equal lengths (copies) are dealt to several partitions
    order = [F.desc("length"), F.xxhash64("doc_id")]
    return written(vectors.repartitionByRange(parts, *order).sortWithinPartitions(*order), "impact-vectors")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents with the highest score above 0 for each row of ``items``.

    ``docs``: doc_id, text; ``items``: item_id, text.  Each row is a document or an
    item of its own, repeated ids included.  Equal scores are ranked by
    ascending doc_id, null ids last.  Null and empty texts have no terms: such documents are not
    found and don't count, such items have no rows; so do empty tables.  Other columns are not read."""
    spark = docs.sparkSession
    asked = _item_terms(items)
    blocks = max(1, -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_terms))
    block = F.pmod(F.xxhash64("item_row"), F.lit(blocks))
    out, totals = None, None
    for i in range(blocks):
        rows = asked.filter(block == i).select("item_row", "terms", "counts").collect()  # about block_terms terms
        vocabulary = {t: j for j, t in enumerate(sorted({bytes(t) for r in rows for t in r["terms"]}))}
        if not vocabulary:
            continue
        doc_terms = _doc_terms(docs, vocabulary)
        if totals is None:
            totals = doc_terms.agg(F.coalesce(F.count(F.when(F.col("n") > 0, 1)), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = {r[0]: r[1] for r in doc_terms.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}  # a row a term of the vocabulary
        weights = np.array([term_weight(totals[0], df.get(t, 0)) for t in range(len(vocabulary))], np.int64)
        vectors = _vectors(doc_terms, weights, *totals)
        sparse = []
        for r in rows:
            pairs = sorted((vocabulary[bytes(t)], c) for t, c in zip(r["terms"], r["counts"], strict=True))
            sparse.append((r["item_row"], [p[0] for p in pairs], [p[1] for p in pairs]))
        got = Items(sparse, weights)
        n = vectors.count()
        cut = vectors.agg(F.percentile_approx("length", F.lit(max(0.0, 1 - FIRST_ROWS / max(n, 1))), F.lit(10_000))).first()[0] if n else 0.0
        first = written(_ranked(_searched(vectors.filter(F.col("length") >= cut), got, k, np.zeros(len(got.rows), np.int64)), k), "first-found")
        kth = dict(first.filter(F.col("rank") == k).select("item_row", "score").collect())  # a row an item of the block
        floor = np.array([kth.get(int(r), 0) for r in got.rows], np.int64)
        rest = _searched(vectors.filter(F.col("length") < cut), got, k, floor)
        found = _ranked(first.drop("rank").unionByName(rest), k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], FOUND + ", rank int")
    return out.join(asked.select("item_row", "item_id"), "item_row").select("item_id", "rank", "doc_id", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
ORACLE = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
i AS MATERIALIZED (SELECT row_number() OVER () AS r, item_id, {_TERMS} AS terms FROM benchmark WHERE text IS NOT NULL),
totals AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::bigint AS n_terms FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)))::bigint AS w FROM tf, totals GROUP BY term, n_docs),
m AS (SELECT r, doc_id, 100 - 75 + ((75 * len(terms) * n_docs) // n_terms) AS m FROM d, totals WHERE len(terms) > 0),
q AS (SELECT r AS item, item_id, unnest(terms) AS term FROM i),
scores AS (
  SELECT item, item_id, doc_id, tf.r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m ON m.r = tf.r
  GROUP BY item, item_id, doc_id, tf.r)
SELECT item_id, rank::int AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10"""
