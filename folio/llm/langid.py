"""Language identification (operator 4).

Method: one interpolated Kneser-Ney character model of order ORDER per
language, over the letters of a word between two boundary marks.  The n-grams
of all languages share sorted 64-bit hash arrays; a row holds the finished
interpolated probability in each language, so that a lookup is one binary
search.  A text gets the language of lowest cross-entropy per character.

Calibration, on labelled documents the models were not fitted on: the
temperature that turns cross-entropies into a score between 0 and 1, and the
cross-entropy per language beyond which a text is rejected (``rejected``).  The
limit lies halfway between the OWN_QUANTILE of texts in that language and the
FOREIGN_QUANTILE of texts in other languages that come to it when their own
model is left out; at the former where the two overlap.  Texts that another
model fits better than their label's, or that fit their label no better than
the median left-out text, are set aside as mislabelled.  Cross-entropies are
compared less 4 / sqrt(characters), which short texts may exceed by chance.

Fitting uses a bounded sample: at most about FIT_DOCS documents a language for
the counts and CALIBRATE_DOCS for the calibration, whole texts, drawn by hash.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import map_rows, resident, table

ORDER = 5
FIT_DOCS = 1500  # documents per language, about
CALIBRATE_DOCS = 1500
OWN_QUANTILE = 0.99
FOREIGN_QUANTILE = 0.01
LEAST_FOREIGN = 50  # texts of other languages; a language that fewer come to is held against those of all languages
TEMPERATURES = [2.0, 5.0, 10.0, 20.0, 40.0, 80.0]
MEMORY_CHARS = 2_500_000  # characters of remembered words in a Python worker

LETTERS = re.compile(r"[^\W\d_]+")
GRAMS = "lang int, k int, gram long, lower long, ctx long, starts boolean, n long"
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, cross_entropy double, rejected boolean"


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters; empty if the text has no letter."""
    if not text:
        return []
    words = LETTERS.findall(text.lower())
    return words if any(w.isalpha() or any(c.isalpha() for c in w) for w in words) else []


def remainder(n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def gram_hashes(words: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes h[k][i] of the k characters ending at i (k = 0 .. ORDER), the place of each character in its
    word (0: the mark before it), and the word's number; one mark before and one after each word."""
    flat = np.frombuffer("".join([f" {w} " for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(sizes)
    place = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
    h = [np.zeros(len(flat), np.uint64)]
    for k in range(1, ORDER + 1):
        far = np.zeros(len(flat), np.uint64)
        far[k - 1 :] = flat[: max(len(flat) - k + 1, 0)]  # the k-th character back; beyond the word's start it is not used
        x = (h[-1] + (far + np.uint64(k << 24)) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
        h.append(x ^ (x >> np.uint64(31)))
    return h, place, np.repeat(np.arange(len(words)), sizes)


class Models:
    """The fitted models: per order the sorted n-gram hashes with probabilities, and context hashes with back-off weights."""

    def __init__(self, langs: list[str], grams: dict[str, np.ndarray], alphabet: int):
        self.langs = langs
        self.alphabet = alphabet
        self.grams: list[np.ndarray] = []
        self.prob: list[np.ndarray] = []
        self.ctx: list[np.ndarray] = []
        self.gamma: list[np.ndarray] = []
        n_langs = len(langs)
        at = {k: grams["k"] == k for k in range(1, ORDER + 1)}
        for k in range(1, ORDER + 1):
            t = {c: v[at[k]] for c, v in grams.items()}
            union = np.unique(t["gram"])
            ctxs = np.unique(t["ctx"])
            hi, gamma = np.zeros((len(union), n_langs)), np.ones((len(ctxs), n_langs))
            ctx_of = np.zeros(len(union), np.int64)
            lower_of = np.zeros(len(union), np.uint64)
            row = np.searchsorted(union, t["gram"])
            ctx_of[row] = np.searchsorted(ctxs, t["ctx"])
            lower_of[row] = t["lower"]
            for j in range(n_langs):
                mine = t["lang"] == j
                g, r, starts, raw = t["gram"][mine], row[mine], t["starts"][mine], t["n"][mine].astype(float)
                if not len(g):
                    continue
                if k < ORDER:  # the number of characters that it continues, unless it begins a word
                    up = at[k + 1] & (grams["lang"] == j)
                    kinds, times = np.unique(grams["lower"][up], return_counts=True)
                    p = np.minimum(np.searchsorted(kinds, g), max(len(kinds) - 1, 0))
                    cont = np.where(kinds[p] == g, times[p], 0) if len(kinds) else np.zeros(len(g))
                    raw = np.where(starts, raw, np.maximum(cont, 1))
                n1, n2 = (raw == 1).sum(), (raw == 2).sum()
                d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
                c = ctx_of[r]
                total = np.bincount(c, raw, len(ctxs))
                kinds_after = np.bincount(c, minlength=len(ctxs))
                seen = total > 0
                gamma[seen, j] = d * kinds_after[seen] / total[seen]
                hi[r, j] = np.maximum(raw - d, 0) / total[c]
            below = np.full((len(union), n_langs), 1.0 / alphabet) if k == 1 else self.prob[-1][np.searchsorted(self.grams[-1], lower_of)]
            self.grams.append(union)
            self.prob.append(hi + gamma[ctx_of] * below)
            self.ctx.append(ctxs)
            self.gamma.append(gamma)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Sum of natural log probabilities of each word's letters and closing mark, per language."""
        h, place, number = gram_hashes(words)
        asked = np.flatnonzero(place > 0)
        p = np.full((len(asked), len(self.langs)), 1.0 / self.alphabet)
        for k in range(1, ORDER + 1):
            on = np.flatnonzero(place[asked] >= k - 1)
            i = asked[on]
            g, c = self.grams[k - 1], self.ctx[k - 1]
            x = np.minimum(np.searchsorted(g, h[k][i]), len(g) - 1)
            hit = g[x] == h[k][i]
            back = h[k - 1][i - 1]
            y = np.minimum(np.searchsorted(c, back), len(c) - 1)
            weight = np.where((c[y] == back)[:, None], self.gamma[k - 1][y], 1.0)
            p[on] = np.where(hit[:, None], self.prob[k - 1][x], weight * p[on])
        return np.stack([np.bincount(number[asked], col, len(words)) for col in np.log(p).T], axis=1)


class Scorer:
    """Scores texts, remembering words."""

    def __init__(self, models: Models):
        self.models = models
        self.row: dict[str, int] = {}
        self.table = np.zeros((0, len(models.langs)))
        self.chars = 0

    def totals(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character and language of each word list, and the numbers of characters."""
        new = [w for w in set().union(*texts) if w not in self.row]
        size = sum(map(len, new))
        if self.chars + size > MEMORY_CHARS and self.row:
            self.row, self.table, self.chars = {}, self.table[:0], 0
            new = list(set().union(*texts))
            size = sum(map(len, new))
        if new:
            self.row.update(zip(new, range(len(self.row), len(self.row) + len(new)), strict=True))
            self.table = np.concatenate([self.table, self.models.word_scores(new)])
            self.chars += size
        out, chars = np.zeros((len(texts), len(self.models.langs))), np.zeros(len(texts))
        for i, words in enumerate(texts):
            if words:
                chars[i] = sum(map(len, words)) + len(words)
                out[i] = -self.table[np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))].sum(0) / chars[i]
        return out, chars


def _sampled(docs: DataFrame, langs: list[tuple[str, int]], most: int) -> DataFrame:
    """About ``most`` documents a language, by hash of the id; all of a smaller one."""
    share = F.lit(0)
    for lang, n in langs:
        share = F.when(F.col("lang") == lang, int(min(1.0, most / max(n, 1)) * 1_000_000)).otherwise(share)
    return docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000)) < share)


def chance(chars: np.ndarray) -> np.ndarray:
    """By how much the cross-entropy of so many characters may exceed its mean."""
    return 4 / np.sqrt(np.maximum(chars, 1))


def reject_limit(own: np.ndarray, foreign: np.ndarray) -> float:
    """The cross-entropy between a language's own texts and those that are not in it."""
    if not len(foreign):  # a single language: as far beyond its upper quantile as that is beyond the median
        return float(2 * np.quantile(own, OWN_QUANTILE) - np.median(own))
    clean = own[own < np.median(foreign)]
    upper = np.quantile(clean if len(clean) else own, OWN_QUANTILE)
    return float(max(upper, (upper + np.quantile(foreign, FOREIGN_QUANTILE)) / 2))


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS, calibrate_docs: int = CALIBRATE_DOCS):
    """(models, temperature, limits) from rows (doc_id, text, lang) whose remainder by 3 is not 1; None without any."""
    spark = docs.sparkSession
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn("_r", remainder(3)).filter("_r != 1")
    counted = usable.groupBy("lang").agg(F.sum((F.col("_r") == 2).cast("long")).alias("a"), F.sum((F.col("_r") == 0).cast("long")).alias("b"))
    counts = sorted((r["lang"], r["a"], r["b"]) for r in counted.collect())
    langs = [lang for lang, _, _ in counts]
    if not langs:
        return None
    number = {lang: j for j, lang in enumerate(langs)}
    chosen = _sampled(usable.filter("_r = 2"), [(x, a) for x, a, _ in counts], fit_docs)

    def gram_counts(slices):
        tally: dict[int, dict[str, int]] = {}
        for c in slices:
            for text, lang in zip(c["text"], c["lang"], strict=True):
                t = tally.setdefault(number[lang], {})
                for w in words_of(text):
                    t[w] = t.get(w, 0) + 1
        for j, t in tally.items():
            if not t:
                continue
            words = list(t)
            times = np.fromiter(t.values(), np.int64, len(t))
            h, place, word = gram_hashes(words)
            for k in range(1, ORDER + 1):
                i = np.flatnonzero((place > 0) & (place >= k - 1))
                key = h[k][i]
                kinds, first, back = np.unique(key, return_index=True, return_inverse=True)
                n = np.bincount(back, times[word[i]], len(kinds)).astype(np.int64)
                f = i[first]
                yield {
                    "lang": np.full(len(kinds), j, np.int32),
                    "k": np.full(len(kinds), k, np.int32),
                    "gram": kinds.view(np.int64),
                    "lower": h[k - 1][f].view(np.int64),
                    "ctx": h[k - 1][f - 1].view(np.int64),
                    "starts": place[f] == k - 1,
                    "n": n,
                }

    grams = map_rows(chosen.select("text", "lang"), gram_counts, GRAMS).groupBy("lang", "k", "gram", "lower", "ctx", "starts").agg(F.sum("n").alias("n"))
    arrow = grams.toArrow()
    got = {c: arrow[c].to_numpy() for c in arrow.column_names}
    if not len(got["k"]):
        return None
    got = {c: (v.view(np.uint64) if c in ("gram", "lower", "ctx") else v) for c, v in ((c, np.ascontiguousarray(v)) for c, v in got.items())}
    models = Models(langs, got, int((np.unique(got["gram"][got["k"] == 1])).size) + 1)
    sent = spark.sparkContext.broadcast(models)

    def calibration(slices):
        scorer = _scorer(sent)
        for c in slices:
            ce, chars = scorer.totals([words_of(t) for t in c["text"]])
            keep = chars > 0
            truth = np.array([number[x] for x in c["lang"]], np.int64)[keep]
            ce, rows = ce[keep], np.arange(len(truth))
            own = ce[rows, truth]
            gap = ce - ce.min(1, keepdims=True)
            loss = [-np.log(np.maximum(np.exp(-t * gap)[rows, truth] / np.exp(-t * gap).sum(1), 1e-12)) for t in TEMPERATURES]
            rest = ce.copy()
            rest[rows, truth] = np.inf  # as if the text's language had not been learned
            other = rest.argmin(1) if len(truth) else truth
            yield {
                "lang": truth.astype(np.int32),
                "ce": own - chance(chars[keep]),
                "fits": own <= rest[rows, other],
                "other": other.astype(np.int32),
                "other_ce": rest[rows, other] - chance(chars[keep]),
                "loss": np.stack(loss, 1).tolist() if len(truth) else [],
            }

    held = _sampled(usable.filter("_r = 0"), [(x, b) for x, _, b in counts], calibrate_docs)
    rows = map_rows(held.select("text", "lang"), calibration, "lang int, ce double, fits boolean, other int, other_ce double, loss array<double>").toArrow()
    t = {c: rows[c].to_numpy() for c in rows.column_names if c != "loss"}
    fits, out = t["fits"].astype(bool), np.isfinite(t["other_ce"])
    limits = np.full(len(langs), np.inf)  # a language without calibration texts rejects nothing
    for j in range(len(langs)):
        own = t["ce"][(t["lang"] == j) & fits]
        foreign = t["other_ce"][(t["other"] == j) & fits & out]
        if len(own):
            limits[j] = reject_limit(own, foreign if len(foreign) >= LEAST_FOREIGN else t["other_ce"][fits & out])
    loss = np.array(rows["loss"].to_pylist()).reshape(-1, len(TEMPERATURES)).sum(0)
    return models, TEMPERATURES[int(loss.argmin())], limits


def _scorer(sent) -> Scorer:
    """One scorer, with its memory, per Python worker and model (which the scorer holds, so that its id stays its own)."""
    return resident(("langid", id(sent.value)), lambda: Scorer(sent.value))


def identify(docs: DataFrame, fitted) -> DataFrame:
    """doc_id, held_out, lang_pred, score, cross_entropy, rejected for each row's whole text.

    Null texts and texts without a letter: ``und``, score 0, cross-entropy null,
    rejected; so is every text if nothing could be learned.  Ties go to the
    first language by name.  A null doc_id is not held out (and not learned
    from).  Repeated rows give one row each; other columns are not read."""
    held = F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, "text")
    if fitted is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"))
    models, temperature, limits = fitted
    sent = docs.sparkSession.sparkContext.broadcast(models)
    langs = models.langs

    def run(slices):
        scorer = _scorer(sent)
        for c in slices:
            ce, chars = scorer.totals([words_of(t) for t in c["text"]])
            best = ce.argmin(1)
            low = ce.min(1)
            score = 1 / np.exp(-temperature * (ce - low[:, None])).sum(1)
            some = chars > 0
            yield {
                "doc_id": c["doc_id"],
                "held_out": c["held_out"],
                "lang_pred": [langs[b] if s else "und" for b, s in zip(best, some, strict=True)],
                "score": np.where(some, score, 0.0),
                "cross_entropy": [float(x) if s else None for x, s in zip(low, some, strict=True)],
                "rejected": ~some | (low - chance(chars) > limits[best]),
            }

    return map_rows(rows, run, SCHEMA)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
