"""Toxicity (operator 7).

Method: a factorization machine over hashed terms.  Terms are the lower-cased
words of a text, present or not, hashed to 2^TERM_BITS slots; the machine
scores  w0 + sum w_i + sum <v_i, v_j>,  so that pairs of terms (an insult with
the mention of a group) weigh beyond their parts.

It is fitted on a bounded sample of labelled rows: about SAMPLE_DOCS documents,
drawn by hash, whole texts.  The slots it may use are found in rounds: first those
whose document frequency differs between the labels by a z value of at least
LEAST_Z; then, ROUNDS times, those that hold far more toxic documents than the
machine fitted so far expects among the documents that it calls clean
(LEAST_EVIDENCE, a Chernoff bound).  So the
terms of a harmful pair, each neutral taken alone, are found by the documents that
the other terms leave unexplained.  At most MOST_SLOTS in all (the strongest);
this bounds the model, never the texts.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import WORDS, map_rows, table, written

SAMPLE_DOCS = 20_000
TERM_BITS = 22
LEAST_DOCS = 4  # labelled documents that must hold a term
LEAST_Z = 4.0
LEAST_EVIDENCE = 18.0  # natural log: a chance excess as large has a probability of at most e^-18 for a term
LEAST_EXCESS = 6  # toxic documents beyond the expected ones
ROUNDS = 2
MOST_SLOTS = 4096
FACTORS = 8
EPOCHS = 40
RATE = 0.3
DECAY = 1e-5
TOXIC_WEIGHT = 2.0  # of a toxic document in the loss: labels are much rarer than clean ones
SEED = 7

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


class Slots(dict):
    """Word -> its slot's place in the model, -1 if the model has none; forgets when it grows past ``most``."""

    most = 200_000

    def __init__(self, chosen: np.ndarray | None = None):
        super().__init__()
        self.chosen = None if chosen is None else {int(s): i for i, s in enumerate(chosen)}

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        slot = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) >> (64 - TERM_BITS)
        out = slot if self.chosen is None else self.chosen.get(slot, -1)
        self[word] = out
        return out


def terms(text: str | None, slots: Slots) -> np.ndarray:
    """The distinct slots of a text."""
    if not text:
        return np.empty(0, np.int64)
    found = set(map(slots.__getitem__, set(WORDS.findall(text.lower()))))
    found.discard(-1)
    return np.fromiter(found, np.int64, len(found))


class FactorizationMachine:
    def __init__(self, slots: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray):
        self.slots, self.w0, self.w, self.v = slots, w0, w, v

    def score(self, x: np.ndarray) -> float:
        """The logit of one set of slots."""
        v = self.v[x]
        s = v.sum(0)
        return float(self.w0 + self.w[x].sum() + 0.5 * (s @ s - (v * v).sum()))

    def chance(self, x: np.ndarray) -> float:
        """The probability that a document with these slots is labelled toxic, without the weight of toxic ones in the loss."""
        return float(1 / (1 + TOXIC_WEIGHT * np.exp(-np.clip(self.score(x), -30, 30))))


def fit_machine(slots: np.ndarray, rows: list[np.ndarray], labels: np.ndarray) -> FactorizationMachine:
    """AdaGrad on the logistic loss, in fixed random order."""
    rng = np.random.default_rng(SEED)
    n, m = len(rows), len(slots)
    prior = np.clip(labels.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    w0, w, v = float(np.log(prior / (1 - prior))), np.zeros(m), rng.normal(0, 0.01, (m, FACTORS))
    g0, gw, gv = 1e-8, np.full(m, 1e-8), np.full((m, FACTORS), 1e-8)
    sizes = np.fromiter(map(len, rows), np.int64, n)
    flat, ends = (np.concatenate(rows) if n else np.empty(0, np.int64)), np.cumsum(sizes)
    for _ in range(EPOCHS if m else 0):
        order = rng.permutation(n)
        for at in range(0, n, 256):
            batch = order[at : at + 256]
            x = np.concatenate([flat[ends[i] - sizes[i] : ends[i]] for i in batch])
            doc = np.repeat(np.arange(len(batch)), sizes[batch])
            vx = v[x]
            s = np.zeros((len(batch), FACTORS))
            np.add.at(s, doc, vx)
            logit = w0 + np.bincount(doc, w[x], len(batch)) + 0.5 * ((s * s).sum(1) - np.bincount(doc, (vx * vx).sum(1), len(batch)))
            err = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[batch]
            err *= np.where(labels[batch] > 0, TOXIC_WEIGHT, 1.0)
            d0 = err.mean()
            g0 += d0 * d0
            w0 -= RATE * d0 / np.sqrt(g0)
            used, back = np.unique(x, return_inverse=True)
            dw = np.bincount(back, err[doc], len(used)) / len(batch) + DECAY * w[used]
            dv = np.zeros((len(used), FACTORS))
            np.add.at(dv, back, err[doc][:, None] * (s[doc] - vx))
            dv = dv / len(batch) + DECAY * v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            w[used] -= RATE * dw / np.sqrt(gw[used])
            v[used] -= RATE * 0.3 * dv / np.sqrt(gv[used])
    return FactorizationMachine(slots, w0, w, v)


def _in_fold(n: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> FactorizationMachine:
    """Fit on labelled documents whose remainder by 5 is not 0.  A document with
    several labels counts as toxic if one says so; null labels and ids are left out."""
    known = (
        labels.filter("doc_id is not null and toxic is not null")
        .select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
        .filter(_in_fold(5) != 0)
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).cast("double").alias("toxic"))
    )
    n = known.count()
    share = int(min(1.0, sample_docs / max(n, 1)) * 1_000_000)
    sample = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) < share)  # about sample_docs rows, so it may be broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id").select("text", "toxic")

    def tallies(machine: FactorizationMachine | None) -> DataFrame:
        """slot, n, bad, due: documents and toxic documents that hold it, and how many toxic ones the machine expects, among
        those that it calls clean; slot -1: all."""

        def run(slices):
            slots = Slots()
            own = None if machine is None else Slots(machine.slots)
            total: dict[int, list] = {-1: [0, 0, 0.0]}
            for c in slices:
                for text, toxic in zip(c["text"], c["toxic"], strict=True):
                    due = 0.0
                    if machine is not None:
                        x = terms(text, own)
                        if machine.score(x) >= 0:
                            continue
                        due = machine.chance(x)
                    for s in [-1, *terms(text, slots).tolist()]:
                        t = total.setdefault(s, [0, 0, 0.0])
                        t[0] += 1
                        t[1] += int(toxic)
                        t[2] += due
            yield {"slot": [*total], **{k: [t[i] for t in total.values()] for i, k in enumerate(("n", "bad", "due"))}}

        got = map_rows(texts, run, "slot long, n long, bad long, due double").groupBy("slot")
        return got.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum(F.col("due").cast("decimal(30,12)")).cast("double").alias("due"))

    def strongest(found: DataFrame, by: str, most: int) -> np.ndarray:
        return found.orderBy(F.desc(by), "slot").limit(most).select("slot").toArrow()["slot"].to_numpy()

    def fitted(chosen: np.ndarray) -> FactorizationMachine:
        def features(slices):
            slots = Slots(chosen)
            for c in slices:
                yield {"toxic": c["toxic"], "x": [np.sort(terms(t, slots)).astype(np.int32) for t in c["text"]]}

        got = map_rows(texts, features, "toxic double, x array<int>").toArrow().to_pydict()
        pairs = sorted(zip(got["toxic"], got["x"], strict=True))  # the order does not depend on the partitions
        return fit_machine(chosen, [np.array(x, np.int64) for _, x in pairs], np.array([t for t, _ in pairs]))

    terms_of = written(tallies(None), "toxic-terms")
    docs_n, docs_bad = terms_of.filter("slot = -1").select("n", "bad").first() or (0, 0)
    if not docs_n:
        return FactorizationMachine(np.empty(0, np.int64), 0.0, np.zeros(0), np.zeros((0, FACTORS)))
    share_bad = docs_bad / docs_n
    # z of the share of toxic documents among those that hold the term
    z = F.abs(F.col("bad") - F.col("n") * share_bad) / F.sqrt(F.col("n") * max(share_bad * (1 - share_bad), 1e-9))
    strong = terms_of.filter((F.col("slot") >= 0) & (F.col("n") >= LEAST_DOCS)).withColumn("z", z).filter(F.col("z") >= LEAST_Z)
    machine = fitted(strongest(strong, "z", MOST_SLOTS))
    for _ in range(ROUNDS):
        excess = F.col("bad") - F.col("due")
        evidence = F.col("bad") * F.log(F.col("bad") / F.greatest("due", F.lit(1e-6))) - excess
        missed = tallies(machine).filter((F.col("slot") >= 0) & (excess >= LEAST_EXCESS)).withColumn("evidence", evidence).filter(F.col("evidence") >= LEAST_EVIDENCE)
        more = np.setdiff1d(strongest(missed, "evidence", MOST_SLOTS), machine.slots)[: MOST_SLOTS - len(machine.slots)]
        if not len(more):
            break
        machine = fitted(np.concatenate([machine.slots, more]))
    return machine


def score_toxicity(docs: DataFrame, machine: FactorizationMachine) -> DataFrame:
    """doc_id, held_out, score, predicted for each row's whole text.

    Null and empty texts have no terms and get the score of the intercept
    alone; with nothing to learn from, every score is 0.5 less a hair
    (predicted 0).  A null doc_id is not held out.  Repeated rows give one row
    each; other columns are not read."""
    held = F.coalesce(_in_fold(5) == 0, F.lit(False)).alias("held_out")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, "text")
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def run(slices):
        fm = sent.value
        slots = Slots(fm.slots)
        for c in slices:
            logits = np.array([fm.score(terms(t, slots)) for t in c["text"]])
            score = 1 / (1 + np.exp(-np.clip(logits if len(fm.slots) else logits - 1e-9, -500, 500)))
            yield {"doc_id": c["doc_id"], "held_out": c["held_out"], "score": score, "predicted": (score >= 0.5).astype(np.int32)}

    return map_rows(rows, run, SCHEMA)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit(docs, table(spark, sf_dir, "labels")))
