"""Operator 12 against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np

from folio.llm import lexical_search as L

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    counts = [(i, Counter(words(t)), len(words(t))) for i, t in docs]
    n_docs, n_terms = sum(n > 0 for _, _, n in counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in counts:
            s = 0
            for t in words(text):
                if c[t]:
                    m = 100 - 75 + (75 * n * n_docs) // n_terms
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def told(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


def made(n, seed=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Été", "ñandú", "漢字", "É", "x1"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([3, 20, 60, 200])))) for i in range(n)]
    docs += [(n + i, docs[i % 5][1]) for i in range(n // 3)]  # copies: equal lengths and scores
    items = [(i, "; ".join(rng.choices(vocabulary, k=rng.choice([1, 4, 12, 40])))) for i in range(30)]
    items += [(100 + i, docs[rng.randrange(n)][1][:60]) for i in range(10)]
    return docs, items


def test_equals_scoring_everything(spark, monkeypatch):
    monkeypatch.setattr(L, "FIRST_ROWS", 40)  # later buckets meet thresholds
    docs, items = made(600)
    df = spark.createDataFrame(docs, DOCS).repartition(6), spark.createDataFrame(items, ITEMS)
    want = brute(docs, items)
    assert told(L.ranked_search(*df)) == want
    assert told(L.ranked_search(*df, block_terms=90)) == want  # several blocks of items
    assert told(L.ranked_search(*df, k=3)) == brute(docs, items, 3)


def test_buckets_are_pruned_and_lose_nothing():
    """Documents longest first, in buckets: fewer pairs are scored than there are, with the best of all."""
    rng = np.random.default_rng(7)
    weights = rng.integers(1, 9000, 300).astype(np.int64)
    docs = []
    for _ in range(2000):
        terms = np.unique(rng.integers(0, 300, rng.integers(1, 25)))
        docs.append((terms, rng.integers(1000, 900_000, len(terms)) // rng.integers(1, 50)))
    length = np.array([math.sqrt(float(((weights[t] * v.astype(float)) ** 2).sum())) for t, v in docs])
    items = L.Items([(q, t.tolist(), rng.integers(1, 3, len(t)).tolist()) for q, t in enumerate(np.unique(rng.integers(0, 300, 8)) for _ in range(40))], weights)
    best = L.Best(40, 5, np.zeros(40, np.int64))
    scored = passed = 0
    order = np.argsort(-length, kind="stable")
    for at in range(0, len(order), 100):
        some = order[at : at + 100]
        sizes = [len(docs[i][0]) for i in some]
        a, b = L.search_bucket(items, best, np.repeat(np.arange(len(some)), sizes), np.concatenate([docs[i][0] for i in some]), np.concatenate([docs[i][1] for i in some]), length[some], some.astype(np.int64), np.zeros(len(some), bool))
        passed, scored = passed + a, scored + b
    assert scored < passed < 40 * 2000 and scored < 0.4 * 40 * 2000
    for q in range(40):
        all_scores = sorted(((-int(sum(int(c) * int(weights[t]) * int(v[np.flatnonzero(ts == t)[0]]) for t, c in zip(items.terms[q], items.counts[q]) if t in ts)), i) for i, (ts, v) in enumerate(docs)))[:5]
        assert [(-s, i) for s, i in all_scores if s] == [(int(s), int(i)) for s, i in zip(best.score[q], best.id[q]) if s]


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "a b c"), (None, "a"), (4, "..."), (5, "A-B_c 1 2"), (6, "z " * 300_000 + "rare"), (7, "é É a" + "\x00b"), (8, "ÀÉ"), (9, " x ")]
    items = [(1, "a"), (1, "a"), (2, None), (3, ""), (4, "b b b c"), (None, "rare z"), (5, "unseen"), (6, "é"), (7, "x y"), (8, "..")]
    want = brute(docs, items)
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert told(L.ranked_search(d, i)) == want
    assert told(L.ranked_search(d.limit(0), i)) == [] and told(L.ranked_search(d, i.limit(0))) == []
    wide_d = spark.createDataFrame([(*r, {"a": 1}, 3, 1.0) for r in docs], DOCS + ", terms map<string,int>, n int, length double")
    wide_i = spark.createDataFrame([(*r, 9, "q") for r in items], ITEMS + ", item_row int, doc_id string")
    assert told(L.ranked_search(wide_d, wide_i)) == want
