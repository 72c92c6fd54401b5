import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from folio.llm import langid, lm_score, toxicity

MEDIUM = "/root/testdata/sf0.01"


def crc(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


# language identification


def test_language_held_out_accuracy(spark, medium_docs):
    rows = {r["doc_id"]: r for r in langid.op4_language_id(spark, MEDIUM).collect()}
    assert len(rows) == len(medium_docs)
    held = [d for d in medium_docs if crc(d["doc_id"], 3) == 1]
    assert all(rows[d["doc_id"]]["held_out"] == (crc(d["doc_id"], 3) == 1) for d in medium_docs)
    assert sum(rows[d["doc_id"]]["lang_pred"] == d["lang"] for d in held) / len(held) > 0.99
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert sum(r["rejected"] for r in rows.values()) <= 0.005 * len(rows)


def test_language_does_not_learn_from_held_out_rows(spark, medium_docs):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    blurred = docs.withColumn("lang", F.when(langid.remainder(3) == 1, F.lit("zz")).otherwise(F.col("lang")))
    a, b = (langid.identify(docs, langid.fit(x)) for x in (docs, blurred))
    assert a.exceptAll(b).count() == 0


def test_language_edges(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !? ²", None), (None, "the and of", None), (3, "the and of", "fr"), (3, "the and of", "fr"), (5, "the and of that " * 40_000, "en"), (7, "a", "en"), (6, "xqzj wvkq jjxq zzqk kqxv " * 40, "en")]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, lang string, score int, gram string")
    fitted = langid.fit(docs)
    got = langid.identify(df, fitted).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert [(by[i]["lang_pred"], by[i]["score"], by[i]["cross_entropy"], by[i]["rejected"]) for i in (1, 2)] == [("und", 0.0, None, True)] * 2
    assert sorted(r["lang_pred"] for r in got if r["doc_id"] == 3) == ["en", "en", "und"]
    assert by[None]["lang_pred"] == "en" and by[None]["held_out"] is False
    assert by[5]["lang_pred"] == "en" and not by[5]["rejected"]
    assert by[6]["lang_pred"] in ("de", "en", "es", "fr") and by[6]["rejected"]
    assert langid.identify(df.filter("false"), fitted).count() == 0
    unlearned = langid.identify(df, langid.fit(docs.filter("false"))).collect()
    assert {r["lang_pred"] for r in unlearned} == {"und"}


def test_language_that_was_not_learned_is_rejected(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    without = docs.filter("lang != 'es'")
    # a few of its texts are among the calibration texts of the others, under a wrong label
    stray = docs.filter("lang = 'es'").filter(langid.remainder(3) == 0).orderBy("doc_id").limit(6).withColumn("lang", F.element_at(F.array(*map(F.lit, ("de", "en", "fr"))), (F.col("doc_id") % 3 + 1).cast("int")))
    fitted = langid.fit(without.unionByName(stray))
    rejected = {r["doc_id"]: r["rejected"] for r in langid.identify(docs, fitted).collect()}
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert np.mean([r for i, r in rejected.items() if lang[i] == "es"]) > 0.9
    assert np.mean([r for i, r in rejected.items() if lang[i] != "es"]) <= 0.01


def test_kneser_ney_probabilities_sum_to_one(spark):
    fitted = langid.fit(spark.read.parquet(f"{MEDIUM}/documents.parquet"))
    models = fitted[0]
    known = set(models.grams[0].tolist())
    letters = [chr(c) for c in range(0x61, 0x3000) if chr(c).isalpha() and langid.gram_hashes([chr(c)])[0][1][1].item() in known]
    assert len(letters) + 2 == models.alphabet  # and the mark, and what was never seen
    # p(next | "th" at the start of a word), over all letters, the mark after the word and one unseen character
    words = ["th" + c for c in [*letters, "\u2c00"]]
    h, place, number = langid.gram_hashes(words)
    total = np.zeros(len(models.langs))
    for i in range(len(words)):
        at = np.flatnonzero((number == i) & (place == 3))[0]
        total += probability(models, h, place, at)
    h, place, _ = langid.gram_hashes(["th"])
    total += probability(models, h, place, 3)  # the closing mark
    assert np.allclose(total, 1, atol=1e-6)


def probability(models, h, place, at):
    p = np.full(len(models.langs), 1.0 / models.alphabet)
    for k in range(1, min(langid.ORDER, place[at] + 1) + 1):
        g, c = models.grams[k - 1], models.ctx[k - 1]
        x, y = np.searchsorted(g, h[k][at]), np.searchsorted(c, h[k - 1][at - 1])
        if x < len(g) and g[x] == h[k][at]:
            p = models.prob[k - 1][x]
        elif y < len(c) and c[y] == h[k - 1][at - 1]:
            p = models.gamma[k - 1][y] * p
    return p


# toxicity


def test_toxicity_held_out(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    rows = toxicity.op7_toxicity(spark, MEDIUM).collect()
    assert len(rows) == 1000
    assert all(r["held_out"] == (crc(r["doc_id"], 5) == 0) and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert not any(p for t, p in held if t == 0)
    assert np.mean([p for t, p in held if t == 1]) > 0.5  # some 40 toxic documents to learn from


def test_machine_learns_a_pair_that_no_sum_can_tell():
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for _ in range(600):  # two terms are harmful together, harmless alone
        a, b = rng.random(2) < 0.5
        rows.append(np.array(([0] if a else []) + ([1] if b else []) + [2 + rng.integers(5)]))
        labels.append(float(a and b))
    fm = toxicity.fit_machine(np.arange(7), rows, np.array(labels))
    assert all((fm.score(x) > 0) == bool(y) for x, y in zip(rows, labels, strict=True))


def neutral_pair_rows():
    """12,000 documents: 10 % hold a marker and are toxic; two terms in a tenth of all, each toxic as often as the rest; 30 with both."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(12_000):
        words = [f"w{x}" for x in rng.integers(0, 2000, 20)]
        bad = rng.random() < 0.1
        pair = i % 400 == 3
        if bad and not pair:
            words.append("marker")
        if pair:
            words += ["mention", "insult"]
        elif rng.random() < 0.2:
            words.append("mention" if rng.random() < 0.5 else "insult")
        rows.append((i, " ".join(rng.permutation(words)), int(bad or pair), pair))
    return rows


def test_fit_finds_a_pair_of_neutral_terms(spark):
    rows = neutral_pair_rows()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(docs, toxicity.fit(docs, labels)).collect()}
    held = [r for r in rows if crc(r[0], 5) == 0]
    assert sum(r[3] for r in held) >= 3
    assert all(got[r[0]] == 1 for r in held if r[2])
    assert not any(got[r[0]] for r in held if not r[2])


def test_score_is_the_sum_over_slots_and_pairs(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    machine = toxicity.fit(docs, labels)
    place = {int(s): i for i, s in enumerate(machine.slots)}
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, machine).collect()}
    for d in docs.limit(300).collect():
        held = {xxhash.xxh64_intdigest(w.encode()) >> (64 - toxicity.TERM_BITS) for w in re.findall(r"\w+", (d["text"] or "").lower())}
        x = [place[s] for s in held if s in place]
        logit = machine.w0 + sum(machine.w[i] for i in x) + sum(machine.v[i] @ machine.v[j] for k, i in enumerate(x) for j in x[:k])
        assert abs(got[d["doc_id"]] - 1 / (1 + math.exp(-logit))) < 1e-9


def test_toxicity_edges(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    extra = spark.createDataFrame([(None, 1, 1), (5, 1, None), (7, 0, 1)], "doc_id long, quality int, toxic int")
    machine = toxicity.fit(docs, labels.unionByName(extra).withColumn("text", F.lit("x")))
    rows = [(1, None), (2, ""), (None, "idiot trash scum"), (3, "idiot trash scum"), (3, "idiot trash scum"), (4, "of the " * 100_000)]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, score int")
    got = toxicity.score_toxicity(df, machine).collect()
    assert len(got) == 6
    score = {(r["doc_id"], i): r for i, r in enumerate(sorted(got, key=lambda r: r["doc_id"] or 0))}
    assert {r["predicted"] for k, r in score.items() if k[0] in (None, 3)} == {1}
    assert {r["predicted"] for k, r in score.items() if k[0] in (1, 2, 4)} == {0}
    assert toxicity.score_toxicity(df.filter("false"), machine).count() == 0
    none = toxicity.score_toxicity(df, toxicity.fit(docs, labels.filter("false"))).collect()
    assert {r["predicted"] for r in none} == {0}


# language-model scoring


def brute_base(rows):
    toks = {i: (t or "").encode().lower().split() for i, (_, t) in enumerate(rows)}
    count, n_docs = Counter(), 0
    for i, (d, _) in enumerate(rows):
        if d is None or crc(d, 10):
            count.update(toks[i])
            n_docs += 1
    if n_docs:
        count["</end>"] = n_docs
    n, v = sum(count.values()), len(count)
    out = []
    for i, (d, _) in enumerate(rows):
        words = [*toks[i], "</end>"]
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        out.append((d, d is not None and crc(d, 10) == 0, len(words), sum(count[w] > 0 for w in words), n, base))
    return out


def compare(df, rows):
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in df.collect()), key=lambda x: str(x[:3]))
    want = sorted(brute_base(rows), key=lambda x: str(x[:3]))
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert all(abs(a[5] - b[5]) < 1e-6 * max(1, abs(b[5])) for a, b in zip(got, want, strict=True))


@pytest.mark.parametrize("frequent", [65_536, 300])
def test_base_and_counts_equal_brute_force(spark, medium_docs, monkeypatch, frequent):
    monkeypatch.setattr(lm_score, "MOST_FREQUENT", frequent)  # 300: nearly all words meet their counts in the join
    df = lm_score.op6_lm_score(spark, MEDIUM)
    compare(df, [(d["doc_id"], d["text"]) for d in medium_docs])


def test_model_beats_the_base_on_held_out_text(spark):
    rows = lm_score.op6_lm_score(spark, MEDIUM).filter("held_out").collect()
    gain = sum(r["score"] - r["base_score"] for r in rows) / sum(r["n_tokens"] for r in rows)
    assert gain > 0.03


def test_probabilities_of_a_context_sum_to_one(spark):
    fitted, counts = lm_score.fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    table = np.exp(fitted.model.log_probabilities().astype(float))
    assert np.allclose(table.sum(2), 1, atol=1e-4)
    # within a class: its words and one unseen word
    mass = np.zeros(lm_score.CLASSES)
    own = set(fitted.frequent[: lm_score.OWN])
    for r in counts.collect():
        if bytes(r["word"]) not in own:
            c = lm_score.bucket(bytes(r["word"]))
            mass[c] += (r["c"] + 0.1) / 10 ** fitted.log_den[c]
    unseen = 0.1 / 10 ** fitted.log_den[lm_score.OWN : lm_score.OWN + lm_score.BUCKETS]
    assert np.allclose(mass[lm_score.OWN : lm_score.OWN + lm_score.BUCKETS] + unseen, 1)


def test_lm_edges(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "A b\x0bc\x1cd é"), (3, "a  B\n"), (3, "a  B\n"), (10, "zz unseen " * 3), (4, "word " * 100_000 + "w" * 50_000), (5, "\x85x y")]
    df = spark.createDataFrame([(*r, "k", 1.5) for r in rows], "doc_id long, text string, word string, base double")
    scored = lm_score.score_documents(df, *lm_score.fit(df))
    compare(scored, rows)
    assert all(math.isfinite(r["score"]) for r in scored.collect())
    empty = df.filter("false")
    assert lm_score.score_documents(empty, *lm_score.fit(empty)).count() == 0
    only_held = [(i, "some words") for i in range(200) if crc(i, 10) == 0]
    compare(lm_score.score_documents(*(lambda d: (d, *lm_score.fit(d)))(spark.createDataFrame(only_held, "doc_id long, text string"))), only_held)
