import numpy as np
import pyarrow.parquet as pq

from folio.llm import ann

MEDIUM = "/root/testdata/sf0.01"


def brute(ids, vectors, queries, k=5):
    out = {}
    v = np.array(vectors, float)
    norm = np.sqrt((v * v).sum(1))
    for q in queries:
        score = np.einsum("d,vd->v", v[q], v) / (norm[q] * norm)
        order = sorted((i for i in range(len(ids)) if ids[i] != ids[q]), key=lambda i: (-score[i], ids[i]))[:k]
        out[ids[q]] = [(ids[i], score[i]) for i in order]
    return out


def rows_of(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_factor_one_is_exact_and_production_recall(spark):
    t = pq.read_table(f"{MEDIUM}/embeddings.parquet").to_pydict()
    df = spark.read.parquet(f"{MEDIUM}/embeddings.parquet")
    queries = df.filter("vec_id % 50 = 0")
    want = brute(t["vec_id"], t["embedding"], [i for i, x in enumerate(t["vec_id"]) if x % 50 == 0])
    got = rows_of(ann.nearest(df, queries, factor=1.0, shard_rows=100))
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    assert all(abs(a - b) < 1e-12 for q in want for (_, a), (_, b) in zip(got[q], want[q], strict=True))
    found = rows_of(ann.op2_nearest(spark, MEDIUM))
    hit = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hit / sum(map(len, want.values())) >= 0.9


def test_copies_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(0)
    same = [1.0, 2.0, 0.5]
    rows = [(i, same, 0) for i in range(0, 400)] + [(i, [float(x) for x in rng.normal(size=3)], 1) for i in range(400, 500)]
    bad = [(500, None, 0), (550, [0.0, 0.0, 0.0], 0), (600, [1.0, None, 2.0], 0), (650, [1.0, float("nan"), 0.0], 0), (700, [float("inf"), 0.0, 0.0], 0), (None, same, 0), (750, [], 0), (800, [1.0, 2.0], 0)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, rank int")
    got = rows_of(ann.nearest(df, df.filter("vec_id % 50 = 0"), factor=1.0, shard_rows=64))
    good = [r for r in rows]
    want = brute([r[0] for r in good], [[float(np.float32(x)) for x in r[1]] for r in good], [i for i, r in enumerate(good) if r[0] % 50 == 0])
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    assert got[0][0] == (1, got[0][0][1]) and [i for i, _ in got[50]] == [0, 1, 2, 3, 4]


def test_the_copies_of_the_queries_are_not_broadcast(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = ann.nearest(df, df.filter("vec_id % 50 = 0"), factor=1.0, shard_rows=20)
    got = rows_of(out)
    want = brute([r[0] for r in rows], [[float(np.float32(x)) for x in r[1]] for r in rows], range(0, 600, 50))
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_doubles_keep_their_precision(spark):
    rows = [(0, [1.0, 1e-9]), (1, [1.0, 2e-9]), (2, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = rows_of(ann.nearest(df, df.filter("vec_id = 2"), factor=1.0))
    assert [i for i, _ in got[2]] == [1, 0]


def test_few_or_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    twice = spark.createDataFrame([(0, [0.0, 2.0]), (0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0])], schema)
    assert [tuple(r) for r in ann.nearest(twice, twice.filter("vec_id = 0")).collect()] == [(0, 1, 1, 1.0), (0, 2, 1, 1.0)]
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], schema)
    assert [tuple(r) for r in ann.nearest(df, df.filter("vec_id = 0")).collect()] == [(0, 1, 1, 0.0)]
    empty = spark.createDataFrame([], schema)
    assert ann.nearest(empty, empty).count() == 0
