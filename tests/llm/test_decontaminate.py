import random

from folio.llm import decontaminate as dc
from folio.llm.common import WORDS


def shingles(text):
    w = WORDS.findall((text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(docs, items, share=0.8):
    out = []
    sets = [(i, shingles(t)) for i, t in items]
    short = [(i, WORDS.findall((t or "").lower())) for i, t in items]
    for doc_id, text in docs:
        s = shingles(text)
        words = WORDS.findall((text or "").lower())
        for item_id, run in short:  # one to four words: a run of the document or not
            if 0 < len(run) < 5 and any(words[k : k + len(run)] == run for k in range(len(words))):
                out.append((doc_id, item_id, 1, 1))
        for item_id, q in sets:
            if q and len(q & s) / len(q) >= share:
                out.append((doc_id, item_id, len(q & s), len(q)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["doc_id"], r["item_id"], r["n_shared"], r["n_shingles"]) for r in df.collect()), key=str)


def test_whole_tables_equal_brute_force(spark, medium_docs):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    want = brute([(d["doc_id"], d["text"]) for d in medium_docs], items)
    assert want
    assert result(dc.op5_decontaminate(spark, "/root/testdata/sf0.01")) == want


def made(seed=2):
    """Items of 5 to 400 words, and documents that hold changed copies of them at any place."""
    r = random.Random(seed)
    word = lambda: f"w{r.randint(0, 3000)}"
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([5, 6, 8, 12, 16, 17, 20, 33, 40, 64, 70, 120, 250, 400] * 3)]
    docs = []
    for k in range(250):
        words = [word() for _ in range(r.choice([0, 10, 100, 3000]))]
        for _ in range(r.randint(0, 2)):
            held = r.choice(items)[1].split()
            for _ in range(r.choice([0, 0, len(held) // 40])):
                held[r.randrange(len(held))] = word()
            at = r.randint(0, len(words))
            words[at:at] = held
        docs.append((k, " ".join(words)))
    return docs, items


def test_changed_passages_at_any_place(spark):
    docs, items = made()
    want = brute(docs, items)
    assert len(want) > 150
    got = result(dc.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    assert got == want


def test_results_do_not_depend_on_the_filters(spark, monkeypatch):
    docs, items = made(5)
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = result(dc.contaminated(*frames))
    monkeypatch.setattr(dc, "FILTER_BITS", 8)  # everything passes
    assert result(dc.contaminated(*frames)) == want


def test_edge_rows(spark):
    item = "a benchmark item of some eight words here"
    docs = [(1, None, "x"), (2, "", "x"), (3, item.upper(), "x"), (3, item, "x"), (None, f"before {item} after", "x"), (5, "one two", "x"), (6, "filler " * 60_000 + item, "x")]
    items = [(7, item), (7, item), (8, None), (9, ""), (10, "too short"), (None, "filler filler filler filler filler filler")]
    d = spark.createDataFrame(docs, "doc_id long, text string, row string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert result(dc.contaminated(d, b)) == brute([(i, t) for i, t, _ in docs], items)
    assert dc.contaminated(d.filter("false"), b).count() == 0
    assert dc.contaminated(d, b.filter("false")).count() == 0


def test_short_items(spark):
    """Items of one to four words, one of them in a third of the documents, beside a long one."""
    items = [(1, "secret answer phrase"), (2, "Word"), (3, "two words"), (4, "exactly four words here"), (5, "secret  ANSWER, phrase"), (6, "unseen"), (7, "a long benchmark item of eight words here"), (8, "...")]
    docs = [(1, "a document holds the secret answer phrase inside"), (2, "secret answer"), (3, "word"), (4, "Two words; word"), (5, "exactly four words here"), (None, "secret answer phrase"), (6, "four words"), (7, "words two"), (8, None)]
    docs += [(100 + i, "filler " * i + "word " + "filler " * 5) for i in range(60)] + [(300, "x " * 50_000 + "two words a long benchmark item of eight words here")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert len(want) > 65
    assert result(dc.contaminated(d, b)) == want
    assert result(dc.contaminated(d, b.filter("item_id < 7"))) == [x for x in want if x[1] < 7]
