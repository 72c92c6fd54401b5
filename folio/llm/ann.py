"""Approximate nearest neighbours by cosine (operator 2).

Method: the vectors are dealt evenly into shards; each shard is a
vantage-point tree over the unit vectors (Euclidean distance, so the triangle
inequality holds).  A subtree is skipped if FACTOR times its lower bound is
beyond the query's current k-th distance: factor 1 is exact search, a larger one
skips more.  Every query block visits every shard; the k best of each shard
meet in a window per query.  Scores are computed in double precision on the
original vectors.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folio.llm.common import map_rows, table

SHARD_ROWS = 4096
QUERY_BLOCK = 256
SHARDS_A_GROUP = 8  # shards that share one copy of the queries, where there are enough groups for every task
LEAF = 64
FACTOR = 1.5
K = 5
SEED = 2


class VantagePointTree:
    """Points sorted so that each subtree is one run of rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(1))
        self.unit = vectors / self.norms[:, None]
        self.order = np.arange(len(ids))
        self.nodes: list[tuple] = []  # (start, stop, vantage row or -1, radius, largest distance, inner, outer)
        self._rng = np.random.default_rng(SEED)
        if len(ids):
            self._build(0, len(ids))

    def _build(self, start: int, stop: int) -> int:
        me = len(self.nodes)
        self.nodes.append((start, stop, -1, 0.0, 0.0, -1, -1))
        if stop - start <= LEAF:
            return me
        rows = self.order[start:stop]
        vantage = rows[self._rng.integers(len(rows))]
        d = self._distance(self.unit[rows], self.unit[vantage])
        radius = float(np.median(d))
        inside = d <= radius
        if inside.all():  # at least half of the rows at the largest distance (copies): part them below it
            inside = d < radius
            if not inside.any():
                return me  # all alike: a leaf, whatever its size
            radius = float(d[inside].max())
        self.order[start:stop] = np.concatenate([rows[inside], rows[~inside]])
        middle = start + int(inside.sum())
        least_outside = float(d[~inside].min())
        inner, outer = self._build(start, middle), self._build(middle, stop)
        self.nodes[me] = (start, stop, int(vantage), radius, least_outside, inner, outer)
        return me

    @staticmethod
    def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 - 2 * (a @ b), 0))

    def bounds(self, unit: np.ndarray) -> np.ndarray:
        """Lower bounds of the distance of each query to the points of each node, by the triangle inequality: [nodes, queries]."""
        low = np.zeros((len(self.nodes), len(unit)))
        inside = [i for i, n in enumerate(self.nodes) if n[2] >= 0]
        if inside:
            d = self._distance(unit, self.unit[[self.nodes[i][2] for i in inside]].T)
            for j, i in enumerate(inside):  # a node comes before its children
                _, _, _, radius, outside, inner, outer = self.nodes[i]
                low[inner] = np.maximum(low[i], d[:, j] - radius)
                low[outer] = np.maximum(low[i], outside - d[:, j])
        return low

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """The k best (ids, scores) of each query, best first, ties to the smaller id; -1 and -inf where there are fewer.

        Each query first visits the leaf of its lowest bound, then the leaves that are not skipped; the queries of a
        block that visit a leaf do so together."""
        n = len(ids)
        norms = np.sqrt((queries * queries).sum(1))
        unit = queries / norms[:, None]
        best_id, best = np.full((n, k), -1, np.int64), np.full((n, k), -np.inf)
        if not n or not len(self.ids):
            return best_id, best

        def visit(start: int, stop: int, q: np.ndarray) -> None:
            for at in range(start, stop, 256):
                rows = self.order[at : min(at + 256, stop)]
                near = unit[q] @ self.unit[rows].T >= best[q, -1][:, None] - 1e-9  # what can still be among the k best
                near &= ids[q][:, None] != self.ids[rows]
                a, b = np.nonzero(near)
                if not len(a):
                    continue
                score = np.full(near.shape, -np.inf)
                # the same sum for the same two vectors, wherever they lie
                score[a, b] = np.einsum("id,id->i", queries[q[a]], self.vectors[rows[b]]) / (norms[q[a]] * self.norms[rows[b]])
                some = np.unique(a)
                qs = q[some]
                all_s = np.concatenate([best[qs], score[some]], 1)
                all_i = np.concatenate([best_id[qs], np.broadcast_to(self.ids[rows], near.shape)[some]], 1)
                top = np.lexsort((all_i, -all_s), axis=1)[:, :k]
                best[qs], best_id[qs] = np.take_along_axis(all_s, top, 1), np.take_along_axis(all_i, top, 1)

        leaves = [i for i, node in enumerate(self.nodes) if node[2] < 0]
        low = self.bounds(unit)[leaves]
        home = low.argmin(0)
        for j, i in enumerate(leaves):
            if len(q := np.flatnonzero(home == j)):
                visit(*self.nodes[i][:2], q)
        for j, i in enumerate(leaves):
            reach = np.sqrt(np.maximum(2 - 2 * np.where(np.isfinite(best[:, -1]), best[:, -1], -1.0), 0)) + 1e-7
            if len(q := np.flatnonzero((home != j) & (factor * low[j] <= reach))):
                visit(*self.nodes[i][:2], q)
        best_id[~np.isfinite(best)] = -1
        return best_id, best


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and its vector as doubles; without vectors that are null, empty, zero or hold a null or non-finite component."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(finite & F.exists(v, lambda x: x != 0)).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def _compact(rows: DataFrame, of: DataFrame) -> DataFrame:
    """``usable`` rows with their vectors as single floats, where the table ``of`` holds them so: half as much to shuffle."""
    single = of.schema["embedding"].dataType.simpleString() == "array<float>"
    return rows.withColumn("v", F.col("v").cast("array<float>")) if single else rows


def _packed(ids: np.ndarray, m: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, ids=ids, m=m)
    return out.getvalue()


def _blocks(rows: DataFrame, key: str) -> DataFrame:
    """One row per value of ``key`` (a bounded number of rows): its ids and vectors as bytes."""

    def pack(t: pa.Table) -> pa.Table:
        ids = t["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        flat = t["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return pa.table({key: [t[key][0].as_py()], "dim": [t["dim"][0].as_py()], "data": [_packed(ids[order], flat.reshape(len(ids), -1)[order])]}, schema=pa.schema([(key, pa.int64()), ("dim", pa.int32()), ("data", pa.binary())]))

    return rows.groupBy(key, "dim").applyInArrow(pack, f"{key} long, dim int, data binary")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, factor: float = FACTOR, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest vectors found for each query, its own id left out.

    Vectors that are null, zero or hold a null or non-finite component take no
    part on either side, nor do null ids; vectors of another length than the
    query's are no candidates.  Ties go to the smaller vec_id.  A repeated vec_id on the candidates' side counts
    once for each row of it; of a repeated query id the least vector is asked.
    With no vectors or no queries there are no rows."""
    rows = _compact(usable(vectors), vectors).withColumn("dim", F.size("v"))
    n = rows.count()
    shards = max(1, -(-n // shard_rows))
    groups = min(shards, max(2 * int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-shards // SHARDS_A_GROUP)))
    # by row, not by id: an id or a vector may be repeated any number of times
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(SEED)), F.lit(shards))
    packed = _blocks(rows.withColumn("shard", dealt), "shard").withColumn("group", F.col("shard") % groups)
    asked = _compact(usable(queries), queries).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    query_blocks = (
        _blocks(asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(SEED + 1)), F.lit(blocks))), "block")
        .withColumnRenamed("data", "asked")
        .withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    )
    met = packed.join(query_blocks.hint("merge"), ["group", "dim"])  # shard by shard: its blocks come one after another

    def run(slices):
        tree, of = None, None
        for c in slices:
            out = {x: [] for x in ("query_id", "vec_id", "score")}
            for shard, dim, data, asked_ in zip(c["shard"], c["dim"], c["data"], c["asked"], strict=True):
                if of != (shard, dim):
                    z = np.load(io.BytesIO(data))
                    tree, of = VantagePointTree(z["ids"], z["m"].astype(np.float64)), (shard, dim)
                z = np.load(io.BytesIO(asked_))
                ids, scores = tree.search(z["ids"], z["m"].astype(np.float64), k, factor)
                hit = ids >= 0 if (z["ids"] >= 0).all() else np.isfinite(scores)
                out["query_id"] += np.broadcast_to(z["ids"][:, None], ids.shape)[hit].tolist()
                out["vec_id"] += ids[hit].tolist()
                out["score"] += scores[hit].tolist()
            yield out

    found = map_rows(met.select("shard", "dim", "data", "asked"), run, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0))
