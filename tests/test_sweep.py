"""C4: the plane sweep against all pairs."""

import random
import time

from folio.operators import ruling as R

SCHEMA = "doc_id long, page int, orient string, pos double, lo double, hi double"


def brute(rows, xt=3, yt=3):
    return sorted(
        (d, p, x, vlo, vhi, y, hlo, hhi)
        for d, p, o, x, vlo, vhi in rows
        if o == "v" and None not in (x, vlo, vhi)
        for d2, p2, o2, y, hlo, hhi in rows
        if o2 == "h" and (d, p) == (d2, p2) and None not in (y, hlo, hhi) and vlo <= y + yt and vhi >= y - yt and hlo - xt <= x <= hhi + xt
    )


def test_equals_all_pairs(spark):
    rng = random.Random(6)
    rows = []
    for page in range(40):
        for _ in range(rng.randint(0, 30)):
            lo = rng.randint(0, 60)
            rows.append((page // 3, page % 3, rng.choice("hv"), float(rng.randint(0, 80)), float(lo), float(lo + rng.choice([0, 2, 15, 80]))))
    rows += rows[:5] + [(1, 0, "v", None, 0.0, 1.0), (1, 0, "h", 1.0, None, 1.0), (1, 0, "x", 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted(map(tuple, R.edge_intersections(df).collect())) == brute(rows)
    assert sorted(map(tuple, R.edge_intersections(df, 0, 0).collect())) == brute(rows, 0, 0)
    assert R.edge_intersections(df.where("false")).collect() == []


def test_page_high_rules_are_not_copied(spark):
    """Verticals over the whole page and horizontals that meet one each: what is looked at is what comes out."""
    n = 3000
    v = [(10.0 * i, 0.0, 1e6) for i in range(n)]
    h = [(300.0 * i, 10.0 * i - 4, 10.0 * i + 4) for i in range(n)]
    began = time.time()
    assert sorted(R.sweep(v, h, 3, 3)) == [(i, i) for i in range(n)]
    assert time.time() - began < 5  # nine million pairs would take longer
    df = spark.createDataFrame([(1, 0, "v", *r) for r in v] + [(1, 0, "h", *r) for r in h], SCHEMA)
    out = R.edge_intersections(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
    assert out.count() == n


def test_rules_partitioned_by_page_are_not_shuffled_again(spark):
    df = spark.createDataFrame([(1, 0, "v", 1.0, 0.0, 9.0), (1, 0, "h", 1.0, 0.0, 9.0)], SCHEMA)
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    e = R.clean_edges(df)
    assert plan(R.edge_intersections(e)) == plan(e)
