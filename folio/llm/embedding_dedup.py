"""Embedding near duplicates (operator 13): vectors of one label whose cosine is at least a threshold.

Method: *inverted multi-index*.  Unit vectors are cut into two halves, each with
a codebook of its own (k-means on a bounded sample); the product of the
codebooks is a grid, and a vector lies in the cell of its halves' nearest
centroids.  A vector then visits cells in the order of their distance by the
multi-sequence algorithm: a heap over the two sorted lists of half distances.
The distance of a cell is a lower bound, how far the vector must move to enter
it (to the bisectors between its own centroids and the cell's), and traversal
ends when the bound passes the reach at which a pair at the threshold is met
with the target recall; at target 1 the reach is the threshold's whole distance
and nothing can be missed.  A pair is looked for from the smaller of its two
cells; every pair met is verified in double precision on the original vectors.

Equal vectors of a label are one node, with a count.  A cell's vectors and
visitors are dealt into parts of bounded size, and pairs of parts are verified as
blocks, which give each node's number of links and a spanning forest, never the
links.  Components of the forests give the classes.
"""

from __future__ import annotations

import heapq
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import map_rows, table, written
from folio.llm.components import components

COSINE = 0.98
TARGET_RECALL = 0.9999
SAMPLE = 10_000  # vectors that the codebooks are fitted on, at most
CELL_ROWS = 64  # vectors of the largest label that a cell holds on average
CENTROIDS = 256  # of a half, at most
PART_ROWS = 512
ROUNDS = 8  # of k-means
SEED = 13


def reach(cosine: float, target: float, dim: int) -> float:
    """How far the traversal goes: a neighbour at the threshold lies sqrt(2 - 2 cosine) away; in a random direction of
    ``dim`` dimensions it passes a given bisector further than this with probability 1 - target."""
    whole = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    return whole if target >= 1 else min(whole, whole * NormalDist().inv_cdf(target) / float(np.sqrt(max(dim, 1))))


def fit_half(points: np.ndarray, k: int) -> np.ndarray:
    """Up to ``k`` centroids of the points, none twice."""
    rng = np.random.default_rng(SEED)
    centroids = np.unique(points, axis=0)
    centroids = centroids[rng.permutation(len(centroids))[:k]]
    for _ in range(ROUNDS):
        near = _squares(points, centroids).argmin(1)
        for c in np.unique(near):
            centroids[c] = points[near == c].mean(0)
    return np.unique(centroids, axis=0)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0)


class MultiIndex:
    """The two codebooks.  Vectors are cut or padded to their width, which only brings vectors nearer to each other."""

    def __init__(self, sample: np.ndarray, k: int):
        self.width = sample.shape[1]
        self.cut = -(-self.width // 2)
        self.books = [fit_half(sample[:, : self.cut], k), fit_half(sample[:, self.cut :], k)]
        self.apart = []
        for b in self.books:
            d = np.sqrt(_squares(b, b))
            np.fill_diagonal(d, 1.0)
            self.apart.append(np.maximum(d, 1e-12))

    def bounds(self, unit: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half: the nearest centroid, and the squared distance to the bisector with every other one."""
        wide = np.zeros((len(unit), self.width))
        wide[:, : unit.shape[1]] = unit[:, : self.width]
        out = []
        for half, book, apart in zip((wide[:, : self.cut], wide[:, self.cut :]), self.books, self.apart, strict=True):
            d = _squares(half, book)
            own = d.argmin(1)
            low = (d - d[np.arange(len(d)), own][:, None]) / (2 * apart[own])
            out.append((own, np.maximum(low, 0) ** 2))
        return out

    def cells(self, unit: np.ndarray, far: float) -> list[tuple[int, list[int]]]:
        """For each vector its own cell, and the cells after it (by number) that the traversal meets within ``far``."""
        (a, low_a), (b, low_b) = self.bounds(unit)
        wide, most = len(self.books[1]), far * far + 1e-12
        out = []
        for own, x, y in zip(a * wide + b, low_a, low_b, strict=True):
            first, second = (sorted((v, i) for i, v in enumerate(z.tolist()) if v <= most) for z in (x, y))
            met, heap, seen = [], [(first[0][0] + second[0][0], 0, 0)], {(0, 0)}
            while heap:
                d, i, j = heapq.heappop(heap)
                if d > most:
                    break
                cell = first[i][1] * wide + second[j][1]
                if cell > own:
                    met.append(cell)
                for nxt in ((i + 1, j), (i, j + 1)):
                    if nxt[0] < len(first) and nxt[1] < len(second) and nxt not in seen:
                        seen.add(nxt)
                        heapq.heappush(heap, (first[nxt[0]][0] + second[nxt[1]][0], *nxt))
            out.append((int(own), met))
        return out


def unit_rows(vectors: list) -> np.ndarray:
    """Vectors of one length as unit rows; scaled by a power of two first, so that nothing overflows."""
    m = np.asarray(vectors, np.float64)
    m = np.ldexp(m, -np.frexp(np.abs(m).max(1))[1][:, None])
    return m / np.sqrt((m * m).sum(1))[:, None]


def by_length(vectors: list, one) -> list:
    """``one`` over the unit rows of the vectors of each length, results in the order of the vectors."""
    out: list = [None] * len(vectors)
    sizes = np.fromiter(map(len, vectors), np.int64, len(vectors))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        for i, got in zip(at, one(unit_rows([vectors[i] for i in at])), strict=True):
            out[i] = got
    return out


def _nodes(vectors: DataFrame) -> DataFrame:
    """vec_id, label, node, v of every vector that can link; a node is the digest of the label and the vector."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    can = F.col("label").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    label = F.col("label").cast("string")
    node = F.unhex(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in (F.xxhash64(v, label), F.xxhash64(F.reverse(v), label, F.lit(SEED)))]))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.when(can, node).alias("node"), F.when(can, v).alias("v"))


def fit(nodes: DataFrame) -> MultiIndex | None:
    """Codebooks from a sample of at most SAMPLE nodes, taken by hash; None if there is no node."""
    sizes = nodes.groupBy("label", F.size("v").alias("dim")).count().agg(F.sum("count"), F.max("count")).first()
    n, most = sizes[0] or 0, sizes[1] or 0
    if not n:
        return None
    parts = max(1, n // SAMPLE)
    rows = [r[0] for r in nodes.filter(F.pmod(F.xxhash64("node"), F.lit(parts)) == 0).orderBy(F.xxhash64("node", F.lit(SEED))).select("v").limit(SAMPLE).collect()]
    if not rows:
        rows = [nodes.select("v").first()[0]]
    width = max(map(len, rows))
    sample = np.zeros((len(rows), width))
    for i, u in enumerate(by_length(rows, lambda m: m)):
        sample[i, : len(u)] = u
    return MultiIndex(sample, max(1, min(CENTROIDS, round(float(np.sqrt(most / CELL_ROWS))))))


def verify(members: np.ndarray, others: np.ndarray | None, cosine: float) -> np.ndarray:
    """Which of ``members`` (unit rows) link with which of ``others`` (None: with each other, not with themselves)."""
    right = members if others is None else others
    score = members @ right.T
    linked = score >= cosine
    for i, j in zip(*np.nonzero(np.abs(score - cosine) < 1e-12), strict=True):  # the same sum for the same two vectors, wherever they lie
        linked[i, j] = float(np.einsum("i,i->", members[i], right[j])) >= cosine
    if others is None:
        np.fill_diagonal(linked, False)
    return linked


def roots(linked: np.ndarray, left: int) -> np.ndarray:
    """The smallest row reachable from each row of a block: all rows if ``left`` is 0, else links lie between rows before and from ``left``."""
    n = left + linked.shape[1] if left else len(linked)
    full = np.zeros((n, n), bool)
    if left:
        full[:left, left:] = linked
        full |= full.T
    else:
        full = linked
    root = np.arange(n)
    while True:
        low = np.minimum(root, np.where(full, root[None, :], n).min(1, initial=n))
        low = low[low]
        if (low == root).all():
            return root
        root = low


LINKS = "node binary, other binary, links long"


def _links(nodes: DataFrame, index: MultiIndex, cosine: float, target: float) -> DataFrame:
    """node, other, links: of every node with a link in a block, a linked node and the number of vectors it links with there."""
    kind = nodes.schema["v"].dataType.simpleString()
    book = nodes.sparkSession.sparkContext.broadcast(index)  # two codebooks of at most CENTROIDS rows

    def place(slices):
        for c in slices:
            got = by_length(c["v"], lambda u: book.value.cells(u, reach(cosine, target, u.shape[1])))
            yield {k: c[k] for k in ("label", "node", "copies", "v")} | {"own": [x[0] for x in got], "met": [x[1] for x in got]}

    placed = written(map_rows(nodes.select("label", "node", "copies", "v"), place, f"label string, node binary, copies long, v {kind}, own int, met array<int>"), "cells")
    cell = ["label", "dim", "cell"]
    placed = placed.withColumn("dim", F.size("v"))
    homes = placed.groupBy("label", "dim", F.col("own").alias("cell")).agg(F.count("*").alias("homes"))
    guests = placed.select("label", "dim", F.explode("met").alias("cell")).groupBy(*cell).agg(F.count("*").alias("guests"))
    parts = lambda n: F.ceil(F.coalesce(F.col(n), F.lit(0)) / PART_ROWS).cast("int")
    sizes = written(homes.join(guests, cell, "left").select(*cell, parts("homes").alias("parts"), parts("guests").alias("guest_parts")), "cell-sizes")
    part = lambda n: F.pmod(F.xxhash64("node"), F.col(n).cast("long")).cast("int")
    home = placed.withColumnRenamed("own", "cell").join(sizes, cell).withColumn("part", part("parts"))
    base = ["label", "dim", "cell"]
    # blocks: parts i <= j of one cell (kind 0), part i of a cell and part j of its guests (kind 1)
    inside = home.withColumn("q", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        *base, F.lit(0).alias("kind"), F.least("part", "q").alias("i"), F.greatest("part", "q").alias("j"), (F.col("part") > F.col("q")).alias("second"), "node", "copies", "v"
    )
    hosts = home.withColumn("q", F.explode(F.when(F.col("guest_parts") > 0, F.sequence(F.lit(0), F.col("guest_parts") - 1)))).select(
        *base, F.lit(1).alias("kind"), F.col("part").alias("i"), F.col("q").alias("j"), F.lit(False).alias("second"), "node", "copies", "v"
    )
    visits = placed.withColumn("cell", F.explode("met")).join(sizes, cell).withColumn("q", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        *base, F.lit(1).alias("kind"), F.col("q").alias("i"), part("guest_parts").alias("j"), F.lit(True).alias("second"), "node", "copies", "v"
    )
    out = pa.schema([("node", pa.binary()), ("other", pa.binary()), ("links", pa.int64())])

    def block(t: pa.Table) -> pa.Table:
        one = t["kind"][0].as_py() == 0 and t["i"][0].as_py() == t["j"][0].as_py()
        dim = t["dim"][0].as_py()
        second = t["second"].to_numpy(zero_copy_only=False) if not one else np.zeros(t.num_rows, bool)
        node = np.array(t["node"].to_pylist(), object)
        order = np.lexsort((node, second))
        node, second = node[order], second[order]
        flat = t["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)[order]
        copies = t["copies"].to_numpy()[order]
        left = len(node) if one else int((~second).sum())
        if not left or left == len(node) and not one:
            return pa.Table.from_arrays([[], [], []], schema=out)
        unit = unit_rows(flat)
        linked = verify(unit[:left], None if one else unit[left:], cosine)
        counts = linked @ (copies if one else copies[left:])
        if not one:
            counts = np.concatenate([counts, copies[:left] @ linked])
        root = roots(linked, 0 if one else left)
        has = np.flatnonzero(counts > 0)
        return pa.Table.from_arrays([pa.array(node[has].tolist(), pa.binary()), pa.array(node[root[has]].tolist(), pa.binary()), pa.array(counts[has].astype(np.int64))], schema=out)

    return inside.unionByName(hosts).unionByName(visits).groupBy(*base, "kind", "i", "j").applyInArrow(block, LINKS)


def near_vectors(vectors: DataFrame, cosine: float = COSINE, target: float = TARGET_RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row for each row of ``vectors`` (vec_id, embedding, label).

    n_links: other rows of the same label whose cosine with it is at least
    ``cosine`` (> 0), in double precision; component_id: the smallest vec_id that links reach,
    its own included; kept: vec_id = component_id.  Vectors that are null, empty,
    zero or hold null or non-finite components, vectors without a label, and
    vectors of another length link with nothing.  Rows without a vec_id take
    part, but are a component_id only where it has no other; kept is then true.  Repeated rows
    are equal vectors.  An empty table gives no rows; other columns are not read."""
    rows = written(_nodes(vectors), "vectors")
    nodes = written(
        rows.filter("node is not null").groupBy("node").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first("label").alias("label"), F.first("v").alias("v")), "vector-nodes"
    )
    index = fit(nodes)
    alone = rows.filter("node is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if index is None:
        return _kept(alone)
    links = written(_links(nodes, index, cosine, target), "vector-links")
    classes = components(links.select(F.col("node").alias("u"), F.col("other").alias("v")))
    degree = links.groupBy("node").agg(F.sum("links").alias("links"))
    # exact copies link as well, without a block
    info = nodes.select("node", "copies", "least").join(degree, "node", "left").join(classes, "node", "left")
    info = info.select("node", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    info = written(info, "vector-classes")
    least = info.groupBy("component").agg(F.min("least").alias("component_id"))
    known = info.join(least, "component").select("node", "n_links", "component_id")
    return _kept(rows.filter("node is not null").select("vec_id", "node").join(known, "node").select("vec_id", "n_links", "component_id").unionByName(alone))


def _kept(rows: DataFrame) -> DataFrame:
    return rows.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE
v AS (SELECT vec_id, label, embedding::double[] AS e FROM embeddings),
good AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) = len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) AND len(list_filter(e, lambda x: x <> 0)) > 0),
scaled AS (SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM good),
links AS MATERIALIZED (
  SELECT a.vec_id AS u, b.vec_id AS w
  FROM scaled a JOIN scaled b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach AS (
  SELECT vec_id AS u, vec_id AS w FROM v
  UNION
  SELECT reach.u, links.w FROM reach JOIN links ON reach.w = links.u)
SELECT vec_id, (SELECT count(*) FROM links WHERE u = vec_id) AS n_links, (SELECT min(w) FROM reach WHERE u = vec_id) AS component_id,
       vec_id = (SELECT min(w) FROM reach WHERE u = vec_id) AS kept
FROM v"""
