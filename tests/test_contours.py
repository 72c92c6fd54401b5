"""K6 with borders and holes: hand-worked shapes, and random masks against flooding.  K5: the moving maximum."""

import random

import numpy as np
import pytest

from folio.operators import contours as C
from folio.operators import raster as K


def found(rows):
    m = np.array([[c == "#" for c in r] for r in rows])
    r = C.image_contours(m)
    return [tuple(r[k][i].item() for k in ("hole", "parent_no", "x", "y", "w", "h", "area")) for i in range(len(r["area"]))]


@pytest.mark.parametrize(
    ("rows", "want"),
    [
        (["#"], [(False, -1, 0, 0, 1, 1, 0.0)]),
        (["...", ".#.", "..."], [(False, -1, 1, 1, 1, 1, 0.0)]),
        (["####"], [(False, -1, 0, 0, 4, 1, 0.0)]),  # a line has no area
        (["####", "####", "####"], [(False, -1, 0, 0, 4, 3, 6.0)]),
        (["#..", "##.", "###"], [(False, -1, 0, 0, 3, 3, 2.0)]),  # a triangle
        (["###", "#.#", "###"], [(False, -1, 0, 0, 3, 3, 4.0), (True, 0, 0, 0, 3, 3, 2.0)]),  # a ring; its hole is a diamond
        (["####", "#..#", "#..#", "####"], [(False, -1, 0, 0, 4, 4, 9.0), (True, 0, 0, 0, 4, 4, 7.0)]),
        ([".#.", "#.#", ".#."], [(False, -1, 0, 0, 3, 3, 2.0), (True, 0, 0, 0, 3, 3, 2.0)]),  # closed over corners
        (["#.#", ".#."], [(False, -1, 0, 0, 3, 2, 0.0)]),
        (["##..", "##..", "..##", "..##"], [(False, -1, 0, 0, 4, 4, 2.0)]),  # two squares touching at a corner
        (["#.#"], [(False, -1, 0, 0, 1, 1, 0.0), (False, -1, 2, 0, 1, 1, 0.0)]),
        (["#####", "#.#.#", "#####"], [(False, -1, 0, 0, 5, 3, 8.0), (True, 0, 0, 0, 3, 3, 2.0), (True, 0, 2, 0, 3, 3, 2.0)]),
        (["####", "#.##", "##.#", "####"], [(False, -1, 0, 0, 4, 4, 9.0), (True, 0, 0, 0, 3, 3, 2.0), (True, 0, 1, 1, 3, 3, 2.0)]),  # holes meet at a corner: two
        (
            ["#######", "#.....#", "#.###.#", "#.#.#.#", "#.###.#", "#.....#", "#######"],  # nested rings: two levels, twice
            [(False, -1, 0, 0, 7, 7, 36.0), (True, 0, 0, 0, 7, 7, 34.0), (False, -1, 2, 2, 3, 3, 4.0), (True, 2, 2, 2, 3, 3, 2.0)],
        ),
        (["...", "..."], []),
    ],
)
def test_hand_worked_shapes(rows, want):
    assert found(rows) == want


def flooded(m):
    """The contours by flooding from outside, one component at a time."""
    h, w = m.shape
    g = np.zeros((h + 2, w + 2), bool)
    g[1:-1, 1:-1] = m
    four, eight = [(0, 1), (1, 0), (0, -1), (-1, 0)], [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b]

    def flood(at, allowed, steps):
        seen, todo = {at}, [at]
        while todo:
            y, x = todo.pop()
            for dy, dx in steps:
                n = (y + dy, x + dx)
                if 0 <= n[0] < h + 2 and 0 <= n[1] < w + 2 and n not in seen and allowed(n):
                    seen.add(n)
                    todo.append(n)
        return seen

    cells = [(y, x) for y in range(h + 2) for x in range(w + 2)]
    owner, comps = {}, []
    for c in cells:
        if c not in owner:
            comp = flood(c, lambda n: g[n] == g[c], eight if g[c] else four)
            comps.append((c, comp))
            owner.update(dict.fromkeys(comp, len(comps) - 1))
    out = []
    for k, (first, comp) in enumerate(comps[1:]):
        hole = not g[first]
        outside = flood((0, 0), lambda n: n not in comp, eight if hole else four)
        full = {c for c in cells if c not in outside}
        area = 0.0
        for y in range(h + 1):
            for x in range(w + 1):
                n = sum(c in full for c in ((y, x), (y, x + 1), (y + 1, x), (y + 1, x + 1)))
                area += (0.5 if n == 1 else min(n, 1)) if hole else {4: 1.0, 3: 0.5}.get(n, 0.0)
        ys, xs = [c[0] for c in comp], [c[1] for c in comp]
        out.append((k, hole, owner[first[0], first[1] - 1] - 1 if hole else -1, min(xs) - 1 - hole, min(ys) - 1 - hole, max(xs) - min(xs) + 1 + 2 * hole, max(ys) - min(ys) + 1 + 2 * hole, area))
    return out


def test_random_masks_equal_flooding(spark):
    rnd = random.Random(4)
    masks = [np.array([[rnd.random() < p for _ in range(rnd.choice([1, 6, 11]))] for _ in range(1)] ) for p in (0.2, 0.8)]
    masks += [np.array([[rnd.random() < p for _ in range(w)] for _ in range(h)]) for h, w in [(1, 9), (9, 1), (7, 8), (12, 10), (16, 16)] for p in (0.3, 0.5, 0.7, 0.9)]
    px = [(i, y, x, 255 if v else 0) for i, m in enumerate(masks) for y, r in enumerate(m) for x, v in enumerate(r)]
    df = spark.createDataFrame(px, "image_id long, y int, x int, v int").repartition(4)
    got = {}
    for r in C.contours(df).collect():
        got.setdefault(r.image_id, []).append((r.contour_no, r.hole, r.parent_no, r.x, r.y, r.w, r.h, r.area))
    assert {i: sorted(v) for i, v in got.items()} == {i: v for i, m in enumerate(masks) if (v := flooded(m))}
    assert C.contours(df.where("false")).collect() == []


@pytest.mark.parametrize("r", [0, 1, 3, 40])
def test_moving_maximum(r):
    rnd = np.random.default_rng(1)
    m = rnd.integers(0, 1000, (4, 33))
    want = [[max(row[max(0, i - r) : i + r + 1]) for i in range(33)] for row in m]
    assert K.moving_max(m, r).tolist() == want


@pytest.mark.parametrize(("size", "iterations"), [(1, 1), (3, 1), (9, 4), (5, 40)])
def test_dilation_equals_the_maximum_over_the_square(spark, size, iterations):
    rnd = np.random.default_rng(2)
    images = [rnd.integers(0, 256, shape) * (rnd.random(shape) < 0.1) for shape in [(1, 1), (1, 20), (20, 1), (11, 13), (60, 30)]]
    px = [(i, y, x, int(v)) for i, m in enumerate(images) for y, row in enumerate(m) for x, v in enumerate(row)]
    out = K.dilate(spark.createDataFrame(px, "image_id long, y int, x int, v int"), size, iterations)
    assert "Window [max(v" not in out._jdf.queryExecution().executedPlan().toString()  # none over pixel rows
    r = size // 2 * iterations
    got = {(p.image_id, p.y, p.x): p.v for p in out.collect()}
    assert got == {(i, y, x): int(m[max(0, y - r) : y + r + 1, max(0, x - r) : x + r + 1].max()) for i, m in enumerate(images) for y in range(m.shape[0]) for x in range(m.shape[1])}
