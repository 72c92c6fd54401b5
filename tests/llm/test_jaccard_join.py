import random

import numpy as np

from folio.llm import jaccard_join as jj
from folio.llm.common import WORDS
from folio.llm.components import components


def shingles(text):
    w = WORDS.findall((text or "").lower())
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def brute(rows, similarity=0.8):
    """One (doc_id, class_id, n_links, n_copies) per row, from all pairs."""
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    link = [[bool(sets[i]) and bool(sets[j]) and i != j and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= similarity for j in range(n)] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in [j for j in range(n) if link[todo[-1]][j] and j not in seen] if todo else []:
                seen.add(j)
                todo.insert(0, j)
            todo.pop()
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], min(ids) if ids else None, sum(link[i]), sum(sets[j] == sets[i] for j in range(n)) if sets[i] else 1))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["doc_id"], r["class_id"], r["n_links"], r["n_copies"]) for r in df.collect()), key=str)


def test_whole_table_equals_all_pairs(spark, small_docs):
    rows = [(d["doc_id"], d["text"]) for d in small_docs]
    assert result(jj.op10_jaccard_join(spark, "/root/testdata/sf0.001")) == brute(rows)


def test_without_broadcasts(spark, small_docs, monkeypatch):
    monkeypatch.setattr(jj, "BROADCAST_ROWS", 0)
    rows = [(d["doc_id"], d["text"]) for d in small_docs]
    assert result(jj.op10_jaccard_join(spark, "/root/testdata/sf0.001")) == brute(rows)


def test_near_copies_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK_TEXTS", 7)
    r = random.Random(1)
    base = [f"w{r.randint(0, 5000)}" for _ in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(r.randint(0, 4)):
            words[r.randrange(120)] = f"x{r.randint(0, 9)}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(f"q{r.randint(0, 5000)}" for _ in range(60))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert sum(x[2] for x in want) > 400
    assert result(jj.near_duplicates(df)) == want


def test_texts_that_share_a_template_are_not_compared_all(spark, monkeypatch):
    r = random.Random(5)
    template = [f"t{i}" for i in range(60)]
    rows = [(i, " ".join([*template, *(f"u{r.randint(0, 10**9)}" for _ in range(100))])) for i in range(1500)]
    near = rows[7][1].split()
    rows += [(5000 + i, " ".join([*near[:-i], *(f"v{i}" for _ in range(i))])) for i in range(1, 4)]  # and a few that are alike
    compared = []
    verified = jj._verified

    def counted(docs, members, similarity):
        sizes = [x["count"] for x in members.groupBy("cluster").count().collect()]
        compared.append(max(sizes))
        return verified(docs, members, similarity)

    monkeypatch.setattr(jj, "_verified", counted)
    got = result(jj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert compared[0] <= 256
    linked = [rows[7], *rows[1500:]]
    assert [x for x in got if x[2]] == [x for x in brute(linked) if x[2]]
    assert len(got) == len(rows) and len([x for x in got if x[2]]) == 4


def test_members_in_common_order_meet(spark):
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 80))
        x = rng.choice(100, n, replace=False)
        y = np.union1d(rng.permutation(x)[: max(1, n - int(rng.integers(0, 8)))], rng.choice(100, int(rng.integers(0, 8))))
        if len(np.intersect1d(x, y)) / len(np.union1d(x, y)) >= 0.8 - 1e-9:
            a, b = (set(np.sort(z)[: jj.common_least(len(z), 0.8)].tolist()) for z in (x, y))
            assert a & b


def test_links_are_counted_once_where_parts_are_empty(spark, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK_SHINGLES", 300)  # each group of three long texts is dealt to four parts
    r = random.Random(3)
    rows = []
    for g in range(6):
        base = [f"w{g}x{r.randint(0, 5000)}" for _ in range(300)]
        rows += [(10 * g + i, " ".join([*base[:i], f"y{i}", *base[i:]])) for i in range(3)]
    want = brute(rows)
    assert [x[2] for x in want] == [2] * 18
    assert result(jj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == want


def test_rows_without_id_are_fetched_once(spark, monkeypatch):
    rows, fetched = [], []
    for g in range(8):
        base = [f"w{g}x{i}" for i in range(60)]
        rows += [(i, " ".join([*base, f"y{k}"])) for k, i in enumerate((None, None, 5))]
    map_rows = jj.map_rows
    monkeypatch.setattr(jj, "map_rows", lambda df, *a: (fetched.append(df) if "cluster" in df.columns else None, map_rows(df, *a))[1])
    assert result(jj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    assert [df.count() for df in fetched] == [len(rows)]


def test_edge_rows(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [
        (5, text), (3, text.upper() + "!"), (3, text), (None, text), (7, None), (8, ""), (9, "?!"), (10, None), (11, "two words"), (12, "two words"),
        (13, text), (13, "another text with quite other words in it"), (None, None), (20, "long " * 50_000),
    ]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, node string, n int")
    assert result(jj.near_duplicates(df)) == brute(rows)
    assert jj.near_duplicates(df.filter("false")).count() == 0


def test_prefix_depth_is_the_longest_that_reaches_the_target():
    for target in (0.5, 0.9, 0.999, 0.99999):
        d = jj.prefix_depth(0.8, target)
        assert 1 - (1 - 0.8**d) ** jj.TREES >= target
        assert d == jj.LEVELS or 1 - (1 - 0.8 ** (d + 1)) ** jj.TREES < target


def test_recall_of_the_forest_at_the_threshold():
    rng = np.random.default_rng(0)
    depth, hits, tries = jj.prefix_depth(0.8), 0, 400
    for _ in range(tries):
        common = rng.integers(0, 2**63, 160, dtype=np.uint64)
        a, b = (np.concatenate([common, rng.integers(0, 2**63, 20, dtype=np.uint64)]) for _ in range(2))
        hits += any(x[: depth * jj.LEVEL_BYTES] == y[: depth * jj.LEVEL_BYTES] for x, y in zip(jj.labels_of(a), jj.labels_of(b), strict=True))
    assert hits == tries


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(300, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
