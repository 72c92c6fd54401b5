"""H1/H2/C7 where pages are many: the cells against brute force, and what is shuffled, gathered and held."""

import random

import pytest

from folio.operators import pages as PG
from folio.operators import ruling as R
from folio.sources import fixtures as fx

SCHEMA = "doc_id long, page int, orient string, pos double, lo double, hi double"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _brute(points):
    """Cells by their definition from the (x, v_lo, y, h_lo) of one page."""
    down = {(x, y, y2) for x, v, y, _ in points for x2, v2, y2, _ in points if (x, v) == (x2, v2) and y2 > y}
    right = {(x, y, x2) for x, _, y, h in points for x2, _, y2, h2 in points if (y, h) == (y2, h2) and x2 > x}
    out = set()
    for x, y in {(x, y) for x, _, y, _ in points}:
        made = [(y2, x2) for a, b, y2 in down if (a, b) == (x, y) for c, d, x2 in right if (c, d) == (x, y) and (x2, y, y2) in down and (x, y2, x2) in right]
        if made:
            out.add((x, y, min(made)[1], min(made)[0]))
    return out


@pytest.mark.parametrize("pairs", [0, 4096])
def test_cells_equal_their_definition(spark, monkeypatch, pairs):
    monkeypatch.setattr(R, "PAIRS", pairs)  # by the sweep and by comparing
    rng = random.Random(pairs)
    rows = []
    for page in range(25):
        for _ in range(rng.randint(0, 24)):
            lo = 10.0 * rng.randint(0, 6)
            rows.append((page // 4, page % 4, rng.choice("hv"), 10.0 * rng.randint(0, 7) + rng.choice([0, 0, 1]), lo, lo + rng.choice([1.0, 10.0, 25.0, 34.0, 60.0])))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    s = R.GridSettings(snap_x_tolerance=0.5, snap_y_tolerance=0.5)
    met = {}
    for d, p, x, v_lo, _, y, h_lo, _ in R.edge_intersections(R.clean_edges(df, s=s)).collect():
        met.setdefault((d, p), set()).add((x, v_lo, y, h_lo))
    want = sorted((*k, *c) for k, pts in met.items() for c in _brute(pts))
    got = R.find_cells(df, s=s)
    assert want and sorted(map(tuple, got.collect())) == want
    apart, together = (R.group_cells(got, together=t) for t in (False, True))
    assert sorted(map(tuple, apart.collect())) == sorted(map(tuple, together.collect()))
    assert R.find_cells(df.where("false")).collect() == []


def test_rules_to_tables_in_one_shuffle(spark):
    df = spark.createDataFrame([(1, 0, "v", 1.0, 0.0, 9.0), (1, 0, "h", 1.0, 0.0, 9.0)], SCHEMA)
    cells = R.group_cells(R.find_cells(df), together=True)
    assert _plan(cells).count("Exchange hashpartitioning") == 1
    by_document = R.clean_edges(df.repartition(3, "doc_id"))
    assert _plan(by_document).count("Exchange hashpartitioning") == 1  # the caller's: pages are together


def test_rules_are_drawn_without_gathering_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fx, "LINES_A_PART", 10)
    lines = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_returnflag string, l_linestatus string, l_quantity double"
    spark.createDataFrame([(o, n, 1, 1, 1.0, "A", "F", 1.0) for o in range(40) for n in range(1 + o % 3)], lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(d, "a") for d in range(20)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    edges = fx.edges(spark, str(tmp_path))
    assert "collect_list" not in _plan(edges)
    assert edges.rdd.getNumPartitions() == 8  # of 79 line items: a part holds as much whatever their number
    assert R.find_cells(edges).count() == fx.cells(spark, str(tmp_path)).count()


def test_pages_without_tables_broadcast_no_cells(spark):
    pages = spark.createDataFrame([(1, 0), (1, 1), (None, 0)], "doc_id long, page int")
    cells = spark.createDataFrame([(1, 0, "a")] * 50 + [(None, 0, "b")], "doc_id long, page int, txt string")
    out = PG.pages_without_tables(pages, cells)
    assert "Broadcast" not in _plan(out)
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 1), (None, 0)]
