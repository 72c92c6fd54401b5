"""Language-model scoring (operator 6).

Method: a log-bilinear neural model over word classes, trained in numpy by
noise-contrastive estimation.  The context vector is the sum of two learned
linear maps of the embeddings of the two previous classes; a class's score is
its product with the class's target vector plus a bias; batched matrix products
over all contexts give the normalised log-probabilities.  A class is one of the
OWN most frequent words, the end, or one of BUCKETS classes of the other words
(by their last two letters and final punctuation).  Within a class a word has
its smoothed relative frequency, one further unseen word included, so that the
probability of a token is normalised over the same V + 1 words as the base.

What the corpus gives: counts of every word (shuffled by word), and counts of
all class trigrams (at most CLASSES^3 rows), over all training documents; the
network is trained on those counts.  Counts of the MOST_FREQUENT words are
broadcast (a fixed bound); all other words of a text meet their counts in a
join by word.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import map_rows, resident, table, written

OWN, BUCKETS = 86, 40
CLASSES = OWN + BUCKETS + 2  # and the end, and the mark before the first word
END, START = CLASSES - 2, CLASSES - 1
MOST_FREQUENT = 65_536
LONGEST_FREQUENT = 64  # bytes; longer words are joined
DIM = 24
NOISE = 25
STEPS = 250
RATE = 0.05
SEED = 6
FLUSH_WORDS = 500_000  # words counted in a task before it passes its counts on

LONG = "row long, word binary, m long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double"


def tokens(text: str | None) -> list[bytes]:
    """Words between white space (x20, x09-x0D), A-Z lower-cased; the end is not included."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def bucket(word: bytes) -> int:
    """The class of a word without a class of its own."""
    bare = word.rstrip(b".,;:!?)]}\"'")
    tail = bare.decode("utf-8", "replace")[-2:]
    return OWN + zlib.crc32(f"{tail}|{word[len(bare):len(bare) + 1].decode('ascii')}".encode()) % BUCKETS


class Codes(dict):
    """Word -> code: the place among the frequent words, or len(frequent) + bucket; forgets the others when too many."""

    most = 150_000

    def __init__(self, frequent: list[bytes]):
        super().__init__(zip(frequent, range(len(frequent)), strict=True))
        self.frequent, self.extra = frequent, 0

    def __missing__(self, word: bytes) -> int:
        if self.extra >= self.most:
            self.clear()
            self.update(zip(self.frequent, range(len(self.frequent)), strict=True))
            self.extra = 0
        code = len(self.frequent) + bucket(word) - OWN
        self[word] = code
        self.extra += 1
        return code


class LogBilinear:
    """Embeddings, context maps, target vectors and biases."""

    def __init__(self, emb, far, near, out, bias):
        self.emb, self.far, self.near, self.out, self.bias = emb, far, near, out, bias

    def log_probabilities(self) -> np.ndarray:
        """log p(class | c2, c1) as float32 [CLASSES, CLASSES, CLASSES], normalised; START has none."""
        table_ = np.empty((CLASSES, CLASSES, CLASSES), np.float32)
        near = self.emb @ self.near
        for c2 in range(CLASSES):  # one matrix product for all contexts that share the farther class
            s = (near + self.emb[c2] @ self.far) @ self.out.T + self.bias
            s[:, START] = -np.inf
            s -= s.max(1, keepdims=True)
            table_[c2] = s - np.log(np.exp(s).sum(1, keepdims=True))
        return table_


def train(codes: np.ndarray, counts: np.ndarray) -> LogBilinear:
    """Noise-contrastive estimation on counted class trigrams ``(c2 * CLASSES + c1) * CLASSES + c0``.

    Each token is told from NOISE draws of the unigram distribution.  With so few classes the sum over the
    draws is taken in expectation, over all contexts at once (Adam on the whole of the counts)."""
    rng = np.random.default_rng(SEED)
    counts = counts.astype(float)
    unigram = np.bincount(codes % CLASSES, counts, CLASSES) + 1e-3
    unigram[START] = 0
    noise = unigram / unigram.sum()
    draw = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    model = LogBilinear(draw(CLASSES, DIM), draw(DIM, DIM), draw(DIM, DIM), draw(CLASSES, DIM), np.log(np.maximum(noise, 1e-12)).astype(np.float32))
    if not len(codes):
        return model
    contexts, row = np.unique(codes // CLASSES, return_inverse=True)
    seen = np.zeros((len(contexts), CLASSES), np.float32)
    seen[row, codes % CLASSES] = counts / counts.sum()
    drawn = (NOISE * seen.sum(1, keepdims=True) * noise).astype(np.float32)  # expected noise tokens
    log_drawn = np.log(NOISE * np.maximum(noise, 1e-12)).astype(np.float32)
    c2, c1 = contexts // CLASSES, contexts % CLASSES
    far_of, near_of = (np.eye(CLASSES, dtype=np.float32)[c] for c in (c2, c1))
    parts = [model.emb, model.far, model.near, model.out, model.bias]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, STEPS + 1):
        e2, e1 = model.emb[c2], model.emb[c1]
        h = e2 @ model.far + e1 @ model.near
        s = h @ model.out.T + model.bias - log_drawn
        real = 1 / (1 + np.exp(-np.clip(s, -30, 30)))
        ds = (seen + drawn) * real - seen
        ds[:, START] = 0
        dh = ds @ model.out
        grads = [far_of.T @ (dh @ model.far.T) + near_of.T @ (dh @ model.near.T), e2.T @ dh, e1.T @ dh, ds.T @ h, ds.sum(0)]
        rate = RATE * (1 - (step - 1) / STEPS)
        for p, g, m, v in zip(parts, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return model


class Fitted:
    """What scoring needs of the corpus, of bounded size."""

    def __init__(self, n: int, v: int, frequent: list[bytes], counts: np.ndarray, end: int, mass: np.ndarray, model: LogBilinear | None):
        self.n, self.v, self.frequent, self.end, self.model = n, v, frequent, end, model
        own = min(OWN, len(frequent))
        self.cls = np.concatenate([np.arange(own), [bucket(w) for w in frequent[own:]], OWN + np.arange(BUCKETS)]).astype(np.int64)
        self.log_count = np.log10(np.concatenate([counts + 0.1, np.ones(BUCKETS)]))
        # words of a bucket share its mass, sum(c + 0.1), and that of one further, unseen word; a class of its own has one word
        self.log_den = np.zeros(CLASSES)
        self.log_den[OWN : OWN + BUCKETS] = np.log10(mass + 0.1)
        self.in_bucket = (self.cls >= OWN).astype(float)


def fold(docs: DataFrame) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text")


def word_counts(training: DataFrame) -> DataFrame:
    """word, c over all texts (pre-counted in each task)."""

    def run(slices):
        seen: Counter = Counter()
        for c in slices:
            for t in c["text"]:
                seen.update(tokens(t))
            if len(seen) > FLUSH_WORDS:
                yield {"word": list(seen), "c": list(seen.values())}
                seen = Counter()
        yield {"word": list(seen), "c": list(seen.values())}

    return map_rows(training.select("text"), run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def trigram_counts(training: DataFrame, sent) -> DataFrame:
    def run(slices):
        f = sent.value
        codes = Codes(f.frequent)
        total = np.zeros(CLASSES**3, np.int64)
        for c in slices:
            parts = []
            for t in c["text"]:
                parts.append(class_trigrams(t, f, codes)[0])
            some = np.concatenate(parts) if parts else np.empty(0, np.int64)
            kinds, n = np.unique(some, return_counts=True)
            total[kinds] += n
        kinds = np.flatnonzero(total)
        yield {"code": kinds, "n": total[kinds]}

    return map_rows(training.select("text"), run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def class_trigrams(text: str | None, f: Fitted, codes: Codes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The class trigram of each token (end included), the words' codes, and the words."""
    words = tokens(text)
    code = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
    cls = np.empty(len(words) + 3, np.int64)
    cls[:2], cls[-1] = START, END
    cls[2:-1] = f.cls[code]
    return (cls[:-2] * CLASSES + cls[1:-1]) * CLASSES + cls[2:], code, words


def fit(docs: DataFrame) -> tuple[Fitted, DataFrame]:
    """The fitted model, and the written table of all training words with their counts."""
    spark = docs.sparkSession
    training = fold(docs).filter(~F.col("held_out"))
    counts = written(word_counts(training), "word-counts")
    end = training.count()
    total, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # the smallest count that leaves at most MOST_FREQUENT words, from the numbers of words in some 10,000 ranges of counts
    level = F.when(F.col("c") <= 4096, F.col("c")).otherwise(4096 + F.floor(F.log2("c") * 128))
    spread = counts.groupBy(level.alias("level")).agg(F.min("c").alias("c"), F.count("*").alias("k")).collect()
    least, room = 2**62, MOST_FREQUENT
    for r in sorted(spread, key=lambda r: -r["c"]):
        room -= r["k"]
        if room < 0:
            break
        least = r["c"]
    else:
        least = 1
    top = counts.filter((F.col("c") >= least) & (F.length("word") <= LONGEST_FREQUENT)).toArrow().to_pydict()
    ranked = sorted(zip(top["c"], top["word"], strict=True), key=lambda x: (-x[0], x[1]))
    own = {w for _, w in ranked[:OWN]}

    def masses(slices):
        mass = np.zeros(BUCKETS)
        for c in slices:
            rest = [(bucket(w) - OWN, n + 0.1) for w, n in zip(c["word"], c["c"], strict=True) if w not in own]
            if rest:
                b, n = zip(*rest, strict=True)
                mass += np.bincount(b, n, BUCKETS)
        yield {"b": list(range(BUCKETS)), "mass": mass}

    mass = np.zeros(BUCKETS)
    for r in map_rows(counts, masses, "b int, mass double").groupBy("b").agg(F.sum("mass").alias("mass")).collect():
        mass[r["b"]] = r["mass"]
    fitted = Fitted(total + end, kinds + (1 if end else 0), [w for _, w in ranked], np.array([c for c, _ in ranked], float), end, mass, None)
    got = trigram_counts(training, spark.sparkContext.broadcast(fitted)).toArrow()
    fitted.model = train(got["code"].to_numpy(), got["n"].to_numpy())
    return fitted, counts


def _log10_table(f: Fitted) -> np.ndarray:
    """The model's normalised table, once per Python worker."""
    return resident(("lm", id(f)), lambda: (f, (f.model.log_probabilities() / np.log(10)).reshape(-1)))[1]


def score_documents(docs: DataFrame, fitted: Fitted, counts: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row's whole text.

    A null or empty text is the end alone.  A null doc_id counts as training.
    Repeated rows count, and are returned, each.  With no training documents the
    base is 0 for each token.  Other columns are not read."""
    sent = docs.sparkSession.sparkContext.broadcast(fitted)

    def run(slices):
        f = sent.value
        codes, table_ = Codes(f.frequent), _log10_table(f)
        limit = len(f.frequent)
        for c in slices:
            out = {k: [] for k in ("row", "word", "m", "doc_id", "held_out", "n_tokens", "n_known", "base", "model")}
            for row, doc_id, held, text in zip(c["row"], c["doc_id"], c["held_out"], c["text"], strict=True):
                tri, code, words = class_trigrams(text, f, codes)
                rare = Counter([words[i] for i in np.flatnonzero(code >= limit).tolist()])
                known = f.log_count[code]
                bucketed = f.in_bucket[code]
                out["row"] += [row] * (1 + len(rare))
                # a row of the document itself, under a word that no text has, and one for each of its rarer words
                out["word"] += [b" %d" % row, *rare]
                out["m"] += [0, *rare.values()]
                out["doc_id"] += [doc_id] + [None] * len(rare)
                out["held_out"] += [held] + [None] * len(rare)
                out["n_tokens"] += [len(words) + 1] + [None] * len(rare)
                out["n_known"] += [int((code < limit).sum()) + (f.end > 0)] + [None] * len(rare)
                out["base"] += [float(known.sum()) + np.log10(f.end + 0.1)] + [None] * len(rare)
                out["model"] += [float(table_[tri].sum(dtype=np.float64) + (bucketed * (known - f.log_den[f.cls[code]])).sum())] + [None] * len(rare)
            yield out

    pieces = map_rows(fold(docs), run, LONG)
    c = F.coalesce("c", F.lit(0))
    return (
        pieces.join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("held_out").alias("held_out"),
            F.max("n_tokens").alias("n_tokens"),
            (F.max("n_known") + F.sum(F.when(c > 0, F.col("m")).otherwise(0))).alias("n_known"),
            F.max("base").alias("_base"),
            F.max("model").alias("_model"),
            F.sum(F.col("m") * F.log10(c + 0.1)).alias("_rare"),
        )
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            F.col("n_known").cast("long"),
            F.lit(fitted.n).cast("long").alias("train_tokens"),
            (F.col("_base") + F.col("_rare") - F.col("n_tokens") * F.log10(F.lit(fitted.n + 0.1 * (fitted.v + 1)))).alias("base_score"),
            (F.col("_model") + F.col("_rare")).alias("score"),
        )
    )


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, *fit(docs))
