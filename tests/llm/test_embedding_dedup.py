"""Operator 13 against brute force over all pairs of a label."""

import numpy as np
import pytest

from folio.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, cosine=E.COSINE):
    """{row number: (vec_id, n_links, component_id, kept)} by all pairs."""
    n = len(rows)
    unit = []
    for _, v, label in rows:
        ok = label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        u = np.array(v, float) / np.abs(np.array(v, float)).max() if ok else None
        unit.append(u / np.linalg.norm(u) if ok else None)
    near = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine] for i in range(n)]
    out, comp = [], [None] * n
    for i in range(n):
        if comp[i] is None:
            group, todo = {i}, [i]
            while todo:
                for j in near[todo.pop()]:
                    if j not in group:
                        group.add(j)
                        todo.append(j)
            for j in group:
                comp[j] = min((rows[k][0] for k in group if rows[k][0] is not None), default=None)
        out.append((rows[i][0], len(near[i]), comp[i], rows[i][0] == comp[i]))
    return sorted(out, key=repr)


def told(df):
    return sorted((tuple(r[x] for x in ("vec_id", "n_links", "component_id", "kept")) for r in df.collect()), key=repr)


def made(n=400, dim=24, seed=1):
    """Vectors in three labels: lone ones, near copies at and around the threshold, chains, exact copies."""
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        v, label = rng.normal(size=dim), int(rng.integers(3))
        rows.append((v, label))
        for _ in range(int(rng.choice([0, 0, 0, 1, 4, 9]))):
            kind = rng.integers(4)
            if kind == 0:
                rows.append((v * rng.choice([1.0, 3.0]), label))
            elif kind == 1:  # about the threshold, in a random direction
                rows.append((v + rng.normal(size=dim) * np.linalg.norm(v) / np.sqrt(dim) * rng.uniform(0.05, 0.25), label))
            elif kind == 2:  # one component only
                w = v.copy()
                w[rng.integers(dim)] += np.linalg.norm(v) * rng.uniform(0.05, 0.2)
                rows.append((w, label))
            else:
                rows.append((v + rng.normal(size=dim) * 0.01, int(rng.integers(3))))
    order = rng.permutation(len(rows))
    return [(int(i), rows[k][0].tolist(), rows[k][1]) for i, k in enumerate(order)]


@pytest.mark.parametrize("target", [1.0, E.TARGET_RECALL])
def test_equals_brute_force(spark, monkeypatch, target):
    monkeypatch.setattr(E, "CELL_ROWS", 2)  # a grid of several cells
    monkeypatch.setattr(E, "PART_ROWS", 16)  # and cells of several parts
    rows = made()
    got, want = told(E.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(4), target=target)), brute(rows)
    assert sum(r[1] for r in want) > 500
    if target == 1:
        assert got == want
    else:
        assert [r[0] for r in got] == [r[0] for r in want] and sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in want)


def test_recall_on_the_given_vectors_with_planted_neighbours(spark):
    t = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in e], int(label)) for i, e, label in zip(t["vec_id"], t["embedding"], t["label"], strict=True)]
    for k in range(600):  # cosine between 0.96 and 1
        _, v, label = rows[k * 3]
        v = np.array(v)
        rows.append((10_000 + k, (v + rng.normal(size=len(v)) * np.linalg.norm(v) / np.sqrt(len(v)) * rng.uniform(0, 0.28)).tolist(), label))
    index = E.fit(E._nodes(spark.createDataFrame(rows, SCHEMA)).groupBy("node", "label").agg(E.F.first("v").alias("v")))
    assert len(index.books[0]) > 1
    got, want = told(E.near_vectors(spark.createDataFrame(rows, SCHEMA))), brute(rows)
    assert sum(r[1] for r in want) > 400
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in want)
    assert all(a[1] <= b[1] for a, b in zip(got, want, strict=True))  # nothing that is no link


def test_traversal_meets_every_cell_in_reach(spark):
    """The multi-sequence order against the whole grid."""
    rng = np.random.default_rng(2)
    index = E.MultiIndex(E.unit_rows(rng.normal(size=(300, 9))), 6)
    unit = E.unit_rows(rng.normal(size=(50, 9)))
    (a, low_a), (b, low_b) = index.bounds(unit)
    wide = len(index.books[1])
    for far in (0.0, 0.1, 0.3):
        for i, (own, met) in enumerate(index.cells(unit, far)):
            assert own == a[i] * wide + b[i]
            grid = low_a[i][:, None] + low_b[i][None, :]
            assert set(met) == {c for c in np.flatnonzero(grid.ravel() <= far * far + 1e-12) if c > own}
            order = [grid.ravel()[c] for c in met]
            assert order == sorted(order)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], None), (4, None, 0), (5, [], 0), (6, [0.0, 0.0], 0), (7, [nan, 1.0], 0), (8, [inf, 1.0], 0),
        (9, [None, 1.0], 0), (10, [1.0, 0.0, 0.0], 0), (11, [1.0, 0.0], 1), (None, [1.0, 0.01], 0), (None, [5.0, 5.0], 2), (12, [0.0, 1.0], 0), (12, [0.0, 1.0], 0),
        (13, [1e300, 1e300], 3), (14, [1e-300, 1e-300], 3), (15, [-1.0, -0.0], 4), (16, [-1.0, 0.0], 4), (17, list(range(1, 5001)), 5), (18, list(range(1, 5001)), 5),
    ]
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], label) for i, v, label in rows]
    assert told(E.near_vectors(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert told(E.near_vectors(spark.createDataFrame([], SCHEMA))) == []
    assert told(E.near_vectors(spark.createDataFrame([(1, None, 1)], SCHEMA))) == [(1, 0, 1, True)]
    wide = spark.createDataFrame([(*r, {"a": 1}, 5, b"x") for r in rows], SCHEMA + ", node map<string,int>, cell int, v binary")
    assert told(E.near_vectors(wide)) == brute(rows)


def test_one_hot_group(spark, monkeypatch):
    """A third of the rows are near copies of each other, another third exact ones."""
    monkeypatch.setattr(E, "PART_ROWS", 32)
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=16), rng.normal(size=16)
    rows = [(i, (a + rng.normal(size=16) * 0.005).tolist(), 1) for i in range(150)] + [(1000 + i, b.tolist(), 1) for i in range(150)] + [(2000 + i, rng.normal(size=16).tolist(), 1) for i in range(150)]
    assert told(E.near_vectors(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
